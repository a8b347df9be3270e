"""Conversation structure repair by bidirectional Dijkstra over the edit lattice.

A conversation is repaired when its role initials read ``(s?(ua)+)?``.  The
lattice has a state for each place between rows and each state of that
pattern (nothing, after s, after u, after a).  Edges are edits: Keep (0),
Rerole to user or assistant (1), Delete (2), Insert an empty user or
assistant text (5); a truncated row that is not deleted adds 5, and blank
and repeated rows must be deleted.  A forward heap starts at the first row
and a reverse heap at the ends, each with the cheapest audit (the edits'
initials) of every state; once no cheaper path can be left, all crossings of
the two searches at the least cost are finished, and the one with the least
concatenated audit is taken.  Two audits of one cost never have one as the
beginning of the other between the same two states, so least parts make the
least whole.

Conversations of up to ``most`` rows and ``most_bytes`` bytes are dealt by
conv_id and searched one after another in sorted partitions.  Longer ones are
sorted over the whole cluster by range, cut into segments of up to ``most``
rows wherever they lie, and searched by segment from each state to each; the
costs of segments are chained forward and backward, only the segments' paths
that lie on a cheapest path are kept, and the least concatenation of these is
taken.  Only codes of rows and audits come together there; texts stay in
their segments, and the digest of the whole reads them in order, one at a time.

Order and defined cases: rows are taken by turn (nulls first), then role,
then the SHA-256 of the text.  Null conv_ids are one conversation.  In the
key of the damage a null is one space, and so are null roles and texts.  A
role that does not begin with s, u or a (an empty one too) cannot be kept.
Repeated rows of the input are damaged alike and stay repeated, so all but
one are duplicates.  An empty table gives no rows; columns besides conv_id,
turn, role and text are not read.  An audit is one cell of the result, so a
conversation may have up to 2**31 rows.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvid.llm.common import bounded_batches, written

MOST, MOST_BYTES = 512, 32 << 20
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: State after a role's initial: 0 nothing yet, 1 after s, 2 after u, 3 after a.
_NEXT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
#: The one role that may be put in at a state.
_WANTED = ("u", "u", "a", "u")
_ROLE = {"u": "user", "a": "assistant"}
_ENDS = (0, 3)
_GAP = r"\x20\x09-\x0D"

State = tuple[int, int]


def _steps(codes: str, state: State) -> list[tuple[str, State, int]]:
    """(edit, state, cost) of the edges from a state.

    A row's code is its role's initial (x: no initial of the pattern), in
    upper case if truncated, or - if it must be deleted.
    """
    i, q = state
    wanted = _WANTED[q]
    out = [("I", (i, _NEXT[q, wanted]), INSERT)]
    if i < len(codes):
        out.append(("D", (i + 1, q), DELETE))
        if (code := codes[i]) != "-":
            own, extra = code.lower(), TRUNCATED * code.isupper()
            if (q, own) in _NEXT:
                out.append(("K", (i + 1, _NEXT[q, own]), extra))
            if own != wanted:
                out.append(("R", (i + 1, _NEXT[q, wanted]), REROLE + extra))
    return out


def _back_steps(codes: str, state: State) -> list[tuple[str, State, int]]:
    """The edges into a state."""
    i, q = state
    before = [(i, p) for p in range(4)] + ([(i - 1, p) for p in range(4)] if i else [])
    return [(edit, b, cost) for b in before for edit, to, cost in _steps(codes, b) if to == state]


class _Search:
    """One direction: settled costs and least audits, nearest states first.

    Keeping costs nothing but always moves on by a row, so among equal costs
    the states that are more rows behind come first.
    """

    def __init__(self, codes: str, starts: list[State], back: bool):
        self.codes, self.back = codes, back
        self.best: dict[State, tuple[int, str]] = {s: (0, "") for s in starts}
        self.settled: dict[State, tuple[int, str]] = {}
        self.heap = [(0, self._rows(s), s) for s in starts]
        heapq.heapify(self.heap)

    def _rows(self, state: State) -> int:
        return len(self.codes) - state[0] if self.back else state[0]

    def low(self) -> int | None:
        while self.heap and self.heap[0][2] in self.settled:
            heapq.heappop(self.heap)
        return self.heap[0][0] if self.heap else None

    def settle(self) -> State:
        cost, _, state = heapq.heappop(self.heap)
        audit = self.best[state][1]
        self.settled[state] = cost, audit
        for edit, to, price in (_back_steps if self.back else _steps)(self.codes, state):
            if to in self.settled:
                continue
            got = cost + price, edit + audit if self.back else audit + edit
            if to not in self.best or got < self.best[to]:
                if to not in self.best or got[0] < self.best[to][0]:
                    heapq.heappush(self.heap, (got[0], self._rows(to), to))
                self.best[to] = got
        return state


@lru_cache(maxsize=1 << 16)
def cheapest(codes: str, start: int = 0, ends: tuple[int, ...] = _ENDS) -> tuple[int, str] | None:
    """(cost, least audit) from state ``start`` before the first row to one of ``ends`` after the last."""
    there = _Search(codes, [(0, start)], False)
    back = _Search(codes, [(len(codes), q) for q in ends], True)
    least: int | None = None
    while (a := there.low()) is not None and (b := back.low()) is not None and (least is None or a + b <= least):
        one, other = (there, back) if a <= b else (back, there)
        state = one.settle()
        cost = one.settled[state][0]
        for _, to, price in [("", state, 0), *(_back_steps if one.back else _steps)(codes, state)]:
            if to in other.settled and (least is None or cost + price + other.settled[to][0] < least):
                least = cost + price + other.settled[to][0]
    if least is None:
        return None
    crossings = []
    for state, (cost, audit) in there.settled.items():
        for edit, to, price in [("", state, 0), *_steps(codes, state)]:
            if to in back.settled and cost + price + back.settled[to][0] == least:
                crossings.append(audit + edit + back.settled[to][1])
    return least, min(crossings)


def lines(rows: list[tuple[str, str]], audit: str, state: int = 0) -> list[str]:
    """``role:text`` of the rows that ``audit`` leaves or puts in, from a state on."""
    out, at = [], 0
    for edit in audit:
        if edit == "D":
            at += 1
            continue
        initial = rows[at][0][:1] if edit == "K" else _WANTED[state]
        role = rows[at][0] if edit == "K" else _ROLE[initial]
        out.append(f"{role}:{'' if edit == 'I' else rows[at][1]}")
        at += edit != "I"
        state = _NEXT[state, initial]
    return out


def _same(a: Column | str, b: Column | str) -> Column:
    return (F.col(a) if isinstance(a, str) else a).eqNullSafe(F.col(b) if isinstance(b, str) else b)


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, digest, code) of every row after damage; ``code`` tells nothing of repeats yet."""
    space = F.lit(" ")
    rows = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"))
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    rows = rows.withColumn("fault", F.crc32(key.cast("binary")) % 20).where("fault <> 0")
    fault = F.col("fault")
    rows = rows.withColumn("text", F.when(fault == 1, "").when(fault == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")))
    rows = rows.withColumn("role", F.when(fault == 4, "user").otherwise(F.col("role")))
    rows = rows.withColumn("copy", F.explode(F.when(fault == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    initial = F.when(F.substring("role", 1, 1).isin("s", "u", "a"), F.substring("role", 1, 1)).otherwise("x")
    code = F.when(~F.col("text").rlike(f"[^{_GAP}]"), "-").when(F.col("text").rlike(f"[.!?][{_GAP}]*\\z"), initial).otherwise(F.upper(initial))
    return rows.select("conv_id", "turn", "role", "text", F.unhex(F.sha2("text", 256)).alias("digest"), code.alias("code"), F.when(code == "-", initial).otherwise(F.lower(code)).alias("initial"))


def _illegal(initials: str) -> int:
    return sum(initials[i : i + 2] not in ("su", "ua", "au") for i in range(len(initials) - 1))


_RESULT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_NAMES = [c.split()[0] for c in _RESULT.split(", ")]


def _whole(rows: list[tuple]) -> tuple:
    """The result of one conversation from its (turn, role, text, digest, code, initial) rows, in order."""
    seen, codes, faults = set(), [], {"blank": 0, "duplicate": 0}
    for _, role, _, digest, code, _ in rows:
        kind = "blank" if code == "-" else "duplicate" if (role, digest) in seen else ""
        seen.add((role, digest))
        if kind:
            faults[kind] += 1
        codes.append("-" if kind else code)
    codes = "".join(codes)
    turns = {int(r[0]) for r in rows if not pd.isna(r[0])}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    cost, audit = cheapest(codes) if len(codes) <= 64 else cheapest.__wrapped__(codes)
    text = "\n".join(lines([(r[1], r[2]) for r in rows], audit))
    return gaps, faults["blank"], faults["duplicate"], sum(c.isupper() for c in codes), _illegal("".join(r[5] for r in rows)), cost, audit, hashlib.sha256(text.encode()).hexdigest()


def _order() -> list[Column]:
    return [F.col("turn").asc_nulls_first(), F.col("role"), F.col("digest")]


def _short(rows: DataFrame) -> DataFrame:
    """Results of conversations that fit in a task; ``rows`` of all of them."""
    kind = rows.schema["conv_id"].dataType.simpleString()
    columns = ["turn", "role", "text", "digest", "code", "initial"]

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, own = [], None
        for pdf in batches:
            out = []
            for conv, name, *row in zip(pdf["conv_id"], pdf["name"], *(pdf[c] for c in columns)):
                if own is not None and own[0] != name:
                    out.append((own[1], *_whole(held)))
                    held = []
                own = name, conv
                held.append(row)
            yield pd.DataFrame(out, columns=["conv_id", *_NAMES])
        if own is not None:
            yield pd.DataFrame([(own[1], *_whole(held))], columns=["conv_id", *_NAMES])

    # conversations are told apart by a text, as pandas has no whole numbers with nulls
    named = rows.withColumn("name", F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("")))
    dealt = named.repartition("name").sortWithinPartitions("name", *_order())
    got = dealt.select(F.col("conv_id").cast("string").alias("conv_id"), "name", *columns).mapInPandas(solve, f"conv_id string, {_RESULT}")
    return got.withColumn("conv_id", F.col("conv_id").cast(kind))


def _long(rows: DataFrame, most: int) -> DataFrame:
    """Results of conversations of any length, by segments."""
    kind = rows.schema["conv_id"].dataType.simpleString()
    order = [F.col("conv_id").asc_nulls_first(), *_order(), F.col("salt")]
    # rows that are equal in all may lie in any order, so the salt may be random: it splits them
    ranged = rows.withColumn("salt", F.rand(0)).repartitionByRange(*order).sortWithinPartitions(*order).drop("salt")
    ranged = written(ranged.withColumn("id", F.monotonically_increasing_id()), "turns")
    ranged = ranged.withColumn("part", F.shiftright("id", 33)).withColumn("chunk", F.floor((F.col("id") - F.shiftleft("part", 33)) / most))
    place = ["part", "chunk"]

    first = written(ranged.groupBy("conv_id", "role", "digest").agg(F.min("id").alias("first"), F.count("*").alias("c")).where("c > 1").select(F.col("conv_id").alias("c0"), F.col("role").alias("r0"), F.col("digest").alias("d0"), "first"), "first-turns")
    light = ranged.select("conv_id", *place, "id", "turn", "role", "digest", "code", "initial")
    light = light.join(first, _same("conv_id", "c0") & (F.col("role") == F.col("r0")) & (F.col("digest") == F.col("d0")), "left")
    again = (F.col("code") != "-") & F.coalesce(F.col("id") > F.col("first"), F.lit(False))
    light = light.withColumn("again", again).withColumn("code", F.when(again, "-").otherwise(F.col("code")))
    light = written(light.select("conv_id", *place, "id", "turn", "code", "again", "initial"), "codes")
    count = lambda c: F.count(F.when(c, 1))
    figures = light.groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).alias("gaps"),
        count((F.col("code") == "-") & ~F.col("again")).alias("blank"), count(F.col("again")).alias("duplicate"), count(F.col("code").isin("S", "U", "A", "X")).alias("truncated"),
    )
    # a segment's rows are bounded by ``most``
    segment = light.groupBy("conv_id", *place).agg(F.sort_array(F.collect_list(F.struct("id", "code", "initial"))).alias("x"))
    segment = written(segment.select("conv_id", *place, F.expr("array_join(x.code, '')").alias("codes"), F.expr("array_join(x.initial, '')").alias("initials")), "segments")

    @F.udf("array<struct<p: int, q: int, cost: long, audit: string>>")
    def between(codes: str) -> list:
        return [(p, q, *got) for p in range(4) for q in range(4) if (got := cheapest.__wrapped__(codes, p, (q,)))]

    paths = written(segment.select("conv_id", *place, F.explode(between("codes")).alias("x")).select("conv_id", *place, "x.*"), "paths")

    def on_cheapest(pdf: pd.DataFrame) -> pd.DataFrame:
        """Of a conversation's (segment, p, q, cost), those on a cheapest path, with the whole cost and order."""
        pdf = pdf.sort_values(place)
        steps = [g[["p", "q", "cost"]].to_numpy().tolist() for _, g in pdf.groupby(place, sort=True)]
        there, back = [{0: 0}], [{q: 0 for q in _ENDS}]
        for own in steps:
            new: dict[int, int] = {}
            for p, q, c in own:
                if p in there[-1] and there[-1][p] + c < new.get(q, 1 << 62):
                    new[q] = there[-1][p] + c
            there.append(new)
        for own in reversed(steps):
            new = {}
            for p, q, c in own:
                if q in back[-1] and back[-1][q] + c < new.get(p, 1 << 62):
                    new[p] = back[-1][q] + c
            back.append(new)
        back.reverse()
        least = back[0][0]
        keep = [p in there[k] and q in back[k + 1] and there[k][p] + c + back[k + 1][q] == least for k, own in enumerate(steps) for p, q, c in own]
        return pdf[keep].assign(least=least)[["conv_id", *place, "p", "q", "least"]]

    ids = F.col("conv_id").cast("string").alias("conv_id")
    kept = paths.select(ids, *place, "p", "q", "cost").groupBy("conv_id").applyInPandas(on_cheapest, "conv_id string, part long, chunk long, p int, q int, least long")
    kept = written(kept.withColumnRenamed("conv_id", "c0"), "cheapest")

    def chosen(pdf: pd.DataFrame) -> pd.DataFrame:
        """The least audit among the cheapest paths, from the end: a rope (segment's audit, rest) for each state."""
        pdf = pdf.sort_values(place)
        ropes: dict[int, tuple | None] = dict.fromkeys(_ENDS)
        for _, g in reversed(list(pdf.groupby(place, sort=True))):
            new: dict[int, tuple] = {}
            for part, chunk, p, q, audit in g[[*place, "p", "q", "audit"]].itertuples(index=False):
                rope = ((part, chunk, p, audit), ropes[q])
                if p not in new or _less(rope, new[p]):
                    new[p] = rope
            ropes = new
        out, rope, illegal = [], ropes[0], 0
        while rope:
            out.append(rope[0])
            rope = rope[1]
        return pd.DataFrame(out, columns=[*place, "p", "audit"]).assign(conv_id=pdf["conv_id"].iat[0], least=pdf["least"].iat[0])

    joined = paths.join(kept, _same(ids, "c0") & (paths.part == kept.part) & (paths.chunk == kept.chunk) & (paths.p == kept.p) & (paths.q == kept.q))
    joined = joined.select(ids, paths.part, paths.chunk, paths.p, paths.q, "audit", "least")
    best = joined.groupBy("conv_id").applyInPandas(chosen, "part long, chunk long, p int, audit string, conv_id string, least long")
    best = written(best.withColumnRenamed("conv_id", "c0").withColumnRenamed("part", "p0").withColumnRenamed("chunk", "k0"), "best")

    texts = ranged.groupBy("conv_id", *place).agg(F.sort_array(F.collect_list(F.struct("id", "role", "text"))).alias("x"))
    texts = texts.join(best, _same(ids, "c0") & (F.col("part") == F.col("p0")) & (F.col("chunk") == F.col("k0")))

    @F.udf("array<string>")
    def repaired(rows: list, audit: str, state: int) -> list[str]:
        return lines([(r["role"], r["text"]) for r in rows], audit, state)

    texts = written(texts.select(ids, *place, repaired("x", "audit", "p").alias("lines")), "repaired")

    def digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own, held, begun = None, None, False
        for pdf in batches:
            out = []
            for name, conv, some in zip(pdf["name"], pdf["conv_id"], pdf["lines"]):
                if own is None or own[0] != name:
                    if own is not None:
                        out.append((own[1], held.hexdigest()))
                    own, held, begun = (name, conv), hashlib.sha256(), False
                for line in some:
                    held.update((("\n" if begun else "") + line).encode())
                    begun = True
            yield pd.DataFrame(out, columns=["conv_id", "repaired_sha256"])
        if own is not None:
            yield pd.DataFrame([(own[1], held.hexdigest())], columns=["conv_id", "repaired_sha256"])

    named = texts.withColumn("name", F.coalesce(F.concat(F.lit("="), "conv_id"), F.lit("")))
    sums = named.repartition("name").sortWithinPartitions("name", *place).select("name", "conv_id", "lines").mapInPandas(digests, "conv_id string, repaired_sha256 string")
    audits = best.groupBy("c0").agg(F.max("least").alias("cost"), F.expr("array_join(transform(sort_array(collect_list(struct(p0, k0, audit))), x -> x.audit), '')").alias("audit"))

    edges = segment.select("conv_id", *place, "initials")
    last = F.lag(F.substring("initials", -1, 1)).over(_window(place))
    inner = F.udf(_illegal, "long")("initials")
    edges = edges.withColumn("inner", inner).withColumn("pair", F.concat(last, F.substring("initials", 1, 1)))
    illegal = edges.groupBy("conv_id").agg((F.sum("inner") + count(~F.col("pair").isin("su", "ua", "au"))).alias("illegal"))

    got = figures.select(ids, "gaps", "blank", "duplicate", "truncated")
    got = got.join(illegal.select(ids.alias("c1"), "illegal"), _same("conv_id", "c1")).join(audits, _same("conv_id", "c0"))
    got = got.join(sums.withColumnRenamed("conv_id", "c2"), _same("conv_id", "c2"))
    return got.select(F.col("conv_id").cast(kind).alias("conv_id"), *_NAMES)


def _window(place: list[str]):
    from pyspark.sql import Window

    return Window.partitionBy("conv_id").orderBy(*place)


def _less(a: tuple, b: tuple) -> bool:
    """Whether one rope of audits reads less than another; they end as one where they share their rest."""
    (x, a), (y, b) = (a[0][3], a[1]), (b[0][3], b[1])
    while True:
        n = min(len(x), len(y))
        if x[:n] != y[:n]:
            return x[:n] < y[:n]
        x, y = x[n:], y[n:]
        if not x and not y and a is b:
            return False
        while not x and a:
            x, a = a[0][3], a[1]
        while not y and b:
            y, b = b[0][3], b[1]
        if not x or not y:
            return len(x) < len(y)


def repair(conversations: DataFrame, most: int = MOST, most_bytes: int = MOST_BYTES) -> DataFrame:
    """A row for each conv_id: gaps, faults, and the cheapest repair after damage."""
    bounded_batches(conversations.sparkSession)
    rows = damaged(conversations)
    large = rows.groupBy(F.col("conv_id").alias("c0")).agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("b")).where((F.col("n") > most) | (F.col("b") > most_bytes))
    large = written(large.select("c0"), "long")
    if large.isEmpty():
        solved = _short(rows)
    else:
        solved = _short(rows.join(large, _same("conv_id", "c0"), "left_anti")).union(_long(rows.join(large, _same("conv_id", "c0"), "left_semi"), most))
    solved = solved.withColumnRenamed("conv_id", "c0")
    every = conversations.select("conv_id").distinct().join(solved, _same("conv_id", "c0"), "left")
    nothing = {"audit": "", "repaired_sha256": hashlib.sha256(b"").hexdigest()}
    return every.select("conv_id", *(F.coalesce(c, F.lit(nothing.get(c, 0))).alias(c) for c in _NAMES))
