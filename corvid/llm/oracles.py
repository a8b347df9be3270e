"""DuckDB twins of the queries of this folder that SQL can express."""

from __future__ import annotations

_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

ORACLES: dict[str, str] = {
    # base32 by groups of 20 bits: five hex digits are four letters
    "op2_warc": f"""
        WITH p AS (SELECT page_id, coalesce(html, '') AS h, sha1(coalesce(html, '')) AS s FROM pages),
             g AS (SELECT s, max(page_id) AS last FROM p GROUP BY s)
        SELECT p.page_id, strlen(h)::BIGINT AS payload_bytes,
               list_aggregate(list_transform(range(32), lambda i: substr('{_BASE32}',
                   ((('0x' || substr(p.s, 5 * (i // 4) + 1, 5))::BIGINT >> (15 - 5 * (i % 4))) & 31)::BIGINT + 1, 1)), 'string_agg', '') AS payload_digest,
               CASE WHEN p.page_id = g.last THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN p.page_id = g.last THEN NULL ELSE g.last END AS refers_to
        FROM p JOIN g USING (s)""",
}

#: Rounds of nearest-entry assignment, written out: a round is a table of owners (a) and one of entries (b).
_ROUND = """
    a{k} AS MATERIALIZED (
        SELECT vec_id, part, arg_min(e, {{'d': d, 'e': e}}) AS e, min(d) AS d
        FROM (SELECT p.vec_id, p.part, b.e, list_sum(list_transform(range(1, len(p.q) + 1), lambda i: (p.q[i] - b.q[i]) * (p.q[i] - b.q[i]))) AS d
              FROM p JOIN b{k} AS b USING (part)) GROUP BY ALL),
    s{k} AS (SELECT part, e, pos, sum(x)::BIGINT AS s, count(*) AS n
             FROM (SELECT part, e, unnest(q) AS x, generate_subscripts(q, 1) AS pos FROM p JOIN a{k} USING (vec_id, part)) GROUP BY ALL),
    u{k} AS (SELECT part, e, list((s - ((s % n) + n) % n) // n ORDER BY pos) AS q FROM s{k} GROUP BY ALL),
    b{n} AS MATERIALIZED (SELECT part, e, coalesce(u{k}.q, b{k}.q) AS q FROM b{k} LEFT JOIN u{k} USING (part, e)),"""

ORACLES["op11_vector_codes"] = f"""
    WITH v AS (SELECT vec_id, label, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS q FROM embeddings
               WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    p AS MATERIALIZED (SELECT vec_id, part, list_slice(q, part * len(q) // 4 + 1, (part + 1) * len(q) // 4) AS q FROM v, range(4) AS r(part)),
    b0 AS MATERIALIZED (SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS e, q FROM p QUALIFY e < 256),
    {"".join(_ROUND.format(k=k, n=k + 1) for k in range(5))}
    books AS (SELECT sha256(string_agg(x, ',' ORDER BY part, e, pos)) AS h
              FROM (SELECT part, e, unnest(q) AS x, generate_subscripts(q, 1) AS pos FROM b4)),
    c AS (SELECT vec_id, label, string_agg(printf('%02x', e), '' ORDER BY part) AS code, sum(d)::BIGINT AS error FROM a4 JOIN v USING (vec_id) GROUP BY ALL)
    SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, h AS codebooks_sha256 FROM c, books"""

_CRC32 = "list_reduce(list_transform(string_split({s}, ''), lambda ch: ord(ch)::BIGINT), lambda crc, b: list_reduce([xor(crc, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, CASE WHEN x % 2 = 1 THEN 3988292384 ELSE 0 END)), 4294967295)"


def _best(*options: str) -> str:
    return f"list_min([{', '.join(options)}])"


def _edge(source: str, edit: str, cost: str = "0", when: str = "true") -> str:
    return f"{{'c': CASE WHEN {when} THEN s.{source}.c + {cost} ELSE 1000000000 END, 'a': s.{source}.a || '{edit}'}}"


def _after_row() -> str:
    """The four states (z nothing yet, s, u, a) after a row of code x."""
    extra, sound = "5 * (x BETWEEN 'A' AND 'Z')::INT", "x <> '-'"
    keep = lambda source, initial: _edge(source, "K", extra, f"lower(x) = '{initial}'")
    rerole = lambda source, initial: _edge(source, "R", f"1 + {extra}", f"{sound} AND lower(x) <> '{initial}'")
    z, s = _best(_edge("z", "D", "2")), _best(_edge("s", "D", "2"), keep("z", "s"))
    u = _best(_edge("u", "D", "2"), *(f(q, "u") for f in (keep, rerole) for q in "zsa"))
    a = _best(_edge("a", "D", "2"), keep("u", "a"), rerole("u", "a"))
    return f"{{'z': {z}, 's': {s}, 'u': {u}, 'a': {a}}}"


def _after_inserts(state: str) -> str:
    """The four states after any inserts: two in a row at most are of use."""
    one = f"list_transform([{state}], lambda s: {{'z': s.z, 's': s.s, 'u': {_best('s.u', *(_edge(q, 'I', '5') for q in 'zsa'))}, 'a': {_best('s.a', _edge('u', 'I', '5'))}}})"
    return f"list_transform({one}, lambda s: {{'z': s.z, 's': s.s, 'u': {_best('s.u', *(_edge(q, 'I', '5') for q in 'zsa'))}, 'a': {_best('s.a', _edge('u', 'I', '5'))}}})[1]"


_NEVER = "{'c': 1000000000::BIGINT, 'a': ''}"
_START = "{'z': {'c': 0::BIGINT, 'a': ''}, 's': " + _NEVER + ", 'u': " + _NEVER + ", 'a': " + _NEVER + "}"

# tables of other columns than the pattern's states: a fold over each conversation's rows, then a fold over its edits
ORACLES["op12_conversation_repair"] = f"""
    WITH k AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                      xor({_CRC32.format(s="coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")}, 4294967295) % 20 AS f FROM conversations),
    d AS (SELECT conv_id, turn, CASE WHEN f = 4 THEN 'user' ELSE role END AS role,
                 CASE f WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
                 unnest(range(CASE WHEN f = 3 THEN 2 ELSE 1 END)) AS copy FROM k WHERE f <> 0),
    o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS i FROM d),
    m AS (SELECT *, CASE WHEN left(role, 1) IN ('s', 'u', 'a') THEN left(role, 1) ELSE 'x' END AS initial,
                 NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') AS blank,
                 row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
                 NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*\\z') AS open FROM o),
    c AS (SELECT *, CASE WHEN blank OR again THEN '-' WHEN open THEN upper(initial) ELSE initial END AS code FROM m),
    g AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
                 count(*) FILTER (blank) AS blank, count(*) FILTER (again AND NOT blank) AS duplicate, count(*) FILTER (open AND NOT blank AND NOT again) AS truncated,
                 list(code ORDER BY i) AS codes, list({{'role': role, 'text': text, 'initial': initial}} ORDER BY i) AS rows FROM c GROUP BY conv_id),
    r AS (SELECT *, len(list_filter(range(1, len(rows)), lambda j: NOT (rows[j].initial || rows[j + 1].initial IN ('su', 'ua', 'au')))) AS illegal,
                 list_reduce(codes, lambda s, x: {_after_inserts(_after_row())}, {_after_inserts(_START)}) AS ends FROM g),
    b AS (SELECT *, list_min([ends.z, ends.a]) AS best FROM r),
    t AS (SELECT *, list_reduce(string_split(best.a, ''), lambda s, e: CASE
                 WHEN e = 'D' THEN {{'at': s.at + 1, 'q': s.q, 'out': s.out}}
                 WHEN e = 'K' THEN {{'at': s.at + 1, 'q': rows[s.at].initial, 'out': s.out || [rows[s.at].role || ':' || rows[s.at].text]}}
                 WHEN e IN ('R', 'I') THEN {{'at': s.at + (e = 'R')::BIGINT, 'q': CASE WHEN s.q = 'u' THEN 'a' ELSE 'u' END,
                     'out': s.out || [CASE WHEN s.q = 'u' THEN 'assistant:' ELSE 'user:' END || CASE WHEN e = 'R' THEN rows[s.at].text ELSE '' END]}}
                 ELSE s END, {{'at': 1::BIGINT, 'q': 'z', 'out': []::VARCHAR[]}}).out AS kept FROM b)
    SELECT i.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
           coalesce(illegal, 0)::BIGINT AS illegal, coalesce(best.c, 0) AS cost, coalesce(best.a, '') AS audit, sha256(coalesce(array_to_string(kept, chr(10)), '')) AS repaired_sha256
    FROM (SELECT DISTINCT conv_id FROM conversations) AS i LEFT JOIN t ON t.conv_id IS NOT DISTINCT FROM i.conv_id"""
