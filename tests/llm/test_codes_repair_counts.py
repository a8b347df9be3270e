"""Vector codes, conversation repair and token counts against brute force, and their defined cases."""

import collections
import hashlib
import heapq
import itertools
import math
import os
import random
import re
import zlib

import duckdb
import numpy as np
import pytest

from conftest import SF_SMALL
from corvid.llm import conversation_repair, queries, token_counts, vector_codes
from corvid.llm.oracles import ORACLES

VECTORS = "vec_id long, embedding array<float>, label int, e string, ids int, code string, of int"


def vectors(spark, rows):
    """Embeddings with extra columns whose names the operator might use itself."""
    return spark.createDataFrame([(i, v, label, "x", 1, "y", 2) for i, v, label in rows], VECTORS)


def _codes(rows, parts, entries, rounds):
    """Brute force, in Python's whole numbers."""
    sound = [(i, [float(np.float32(x)) for x in v], label) for i, v, label in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    sound.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    kept = [(i, [min(max(math.floor(1024 * x), -(1 << 27)), 1 << 27) for x in v], label) for i, v, label in sound if len(v) == len(sound[0][1])]
    if not kept:
        return []
    d = len(kept[0][1])
    cuts = [(d * p // parts, d * (p + 1) // parts) for p in range(parts)]
    books = [[v[a:b] for _, v, _ in kept[:entries]] for a, b in cuts]

    def nearest(x, book):
        return min((sum((p - q) ** 2 for p, q in zip(x, y)), k) for k, y in enumerate(book))

    for _ in range(rounds):
        for p, (a, b) in enumerate(cuts):
            own = collections.defaultdict(list)
            for _, v, _ in kept:
                own[nearest(v[a:b], books[p])[1]].append(v[a:b])
            books[p] = [[sum(c) // len(own[k]) for c in zip(*own[k])] if k in own else y for k, y in enumerate(books[p])]
    digest = hashlib.sha256(",".join(str(x) for book in books for y in book for x in y).encode()).hexdigest()
    out = []
    for i, v, label in kept:
        got = [nearest(v[a:b], books[p]) for p, (a, b) in enumerate(cuts)]
        out.append((i, "".join(f"{k:02x}" for _, k in got), sum(e for e, _ in got), label))
    total = collections.Counter()
    for *_, e, label in out:
        total[label] += e
    return sorted(((i, c, e, total[label], digest) for i, c, e, label in out), key=str)


@pytest.mark.parametrize("tree,length,entries", [(64, 16, 8), (2048, 16, 256), (7, 6, 3), (50, 3, 5)])
def test_vector_codes(spark, tree, length, entries):
    rng = random.Random(tree + length)
    centers = [[rng.uniform(-2, 2) for _ in range(length)] for _ in range(4)]
    rows = [(i, [x + rng.gauss(0, 0.1) for x in rng.choice(centers)], rng.choice([1, 2, None])) for i in range(120)]
    rows += [(200 + i, centers[0], 1) for i in range(60)]  # copies
    rows += [(5, rows[5][1], 1), (5, rows[6][1], 2), (None, rows[7][1], 2), (None, [0.0] * length, None), (300, [1e30] * length, 1), (301, [-0.0, *[1e-9] * (length - 1)], 1), (302, [-1e-9] * length, 1)]
    rows += [(-1, None, 1), (-2, [], 1), (-3, [float("nan")] * length, 1), (-4, [None, *[1.0] * (length - 1)], 1), (-5, [float("inf")] * length, 1), (400, [1.0] * (length + 1), 1)]
    got = vector_codes.compress(vectors(spark, rows), entries=entries, tree=tree)
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == _codes(rows, 4, entries, 4)


def test_vector_codes_empty_and_single(spark):
    assert vector_codes.compress(vectors(spark, [])).collect() == []
    assert vector_codes.compress(vectors(spark, [(1, None, 1)])).collect() == []
    assert [tuple(r)[:4] for r in vector_codes.compress(vectors(spark, [(1, [0.5] * 8, None)])).collect()] == [(1, "00000000", 0, 0)]


@pytest.mark.parametrize("spread", [0.01, 0.3, 5.0])
def test_metric_tree_owns_as_brute_force(spread):
    rng = np.random.default_rng(int(spread * 100))
    centers = rng.normal(0, 1, (20, 8))
    x = vector_codes.quantized(centers[rng.integers(0, 20, 1500)] + rng.normal(0, spread, (1500, 8)))
    x = np.concatenate([x, x[:300], np.repeat(x[:1], 200, axis=0)])
    tree = vector_codes.Tree(x)
    book = np.concatenate([vector_codes.quantized(centers), vector_codes.quantized(centers[:3])])  # the last three are ties
    d = ((x[:, None] - book) ** 2).sum(2)
    owner, error = tree.owners(book)
    assert (owner == d.argmin(1)).all() and (error == d.min(1)).all()
    n, total = tree.sums(book)
    assert (n == np.bincount(d.argmin(1), minlength=len(book))).all()
    assert (total == [x[d.argmin(1) == k].sum(0) for k in range(len(book))]).all()
    for ball in range(len(tree.center)):
        own = tree.points[tree.first[ball] : tree.last[ball]]
        assert np.sqrt(((own - tree.center[ball]) ** 2).sum(1)).max() <= tree.radius[ball] + 1e-6
    if spread == 0.01:  # whole balls are taken from their cached sums
        owned = [ball for ball, who in tree.walk(book[:20]) if isinstance(who, int)]
        assert sum(tree.count[b] for b in owned) > len(x) / 2


def _sql(name, **tables):
    con = duckdb.connect()
    for t, path in tables.items():
        con.execute(f"create view {t} as from '{path}'")
    rel = con.execute(ORACLES[name])
    names = [c[0] for c in rel.description]
    return names, sorted(map(tuple, rel.fetchall()), key=str)


@pytest.mark.parametrize("name,table", [("op11_vector_codes", "embeddings"), ("op12_conversation_repair", "conversations")])
def test_queries_equal_sql(spark, name, table):
    names, want = _sql(name, **{table: f"{SF_SMALL}/{table}.parquet"})
    got = queries.REGISTRY[name](spark, SF_SMALL).select(*names)
    assert sorted(map(tuple, got.collect()), key=str) == want


PATTERN = re.compile(r"(s?(ua)+)?")


def _cheapest(codes):
    """All audits by cost, with the role initials they give, until one fits; the least of the cheapest."""
    heap, found, least = [(0, "", 0, "")], [], None
    while heap:
        cost, audit, at, roles = heapq.heappop(heap)
        if least is not None and cost > least:
            break
        if at == len(codes) and PATTERN.fullmatch(roles):
            least = cost
            found.append(audit)
        if not PATTERN.fullmatch(roles) and not any(PATTERN.fullmatch(roles + x) for x in ("a", "ua")):
            continue
        for x in "ua":
            heapq.heappush(heap, (cost + 5, audit + "I", at, roles + x))
        if at < len(codes):
            heapq.heappush(heap, (cost + 2, audit + "D", at + 1, roles))
            if codes[at] != "-":
                more = 5 * codes[at].isupper()
                heapq.heappush(heap, (cost + more, audit + "K", at + 1, roles + codes[at].lower()))
                for x in "ua":
                    heapq.heappush(heap, (cost + 1 + more, audit + "R", at + 1, roles + x))
    return least, min(found)


def test_cheapest_audit():
    short = ["".join(c) for n in range(4) for c in itertools.product("suaxSUA-", repeat=n)]
    rng = random.Random(4)
    short += ["".join(rng.choice("suaxUA-") for _ in range(rng.randint(4, 7))) for _ in range(60)]
    for codes in short:
        assert conversation_repair.cheapest(codes) == _cheapest(codes), codes


TURNS = "conv_id long, turn long, role string, text string, code string, id long, fault int, copy string"


def _conversations(rows):
    """Brute force from the rows on."""
    held = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        f, role, text = zlib.crc32(key.encode()) % 20, " " if role is None else role, " " if text is None else text
        held[conv]
        if f == 0:
            continue
        role, text = "user" if f == 4 else role, "" if f == 1 else re.sub("[.!?]", "", text) if f == 2 else text
        held[conv] += [(turn, role, text)] * (2 if f == 3 else 1)
    out = []
    for conv, own in held.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()))
        faults, codes, seen = [], "", set()
        for _, role, text in own:
            bare = text.strip(" \t\n\v\f\r")
            kind = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else ""
            seen.add((role, text))
            faults.append(kind)
            initial = role[:1] if role[:1] in ("s", "u", "a") else "x"
            codes += "-" if kind in ("blank", "duplicate") else initial.upper() if kind else initial
        pairs = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        turns = {t for t, _, _ in own if t is not None}
        cost, audit = _cheapest(codes) if len(codes) < 7 else conversation_repair.cheapest(codes)
        text = "\n".join(conversation_repair.lines([r[1:] for r in own], audit))
        out.append((conv, max(turns) - min(turns) + 1 - len(turns) if turns else 0, *(faults.count(k) for k in ("blank", "duplicate", "truncated")), pairs, cost, audit, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=str)


def _turns(seed, convs, most):
    rng = random.Random(seed)
    rows = [(c, rng.choice([None, *range(9)]), rng.choice(["user", "assistant", "system", "user", "assistant", "tool", "", None, "User"]), rng.choice([None, "", " \n", "No end", "It ends.", "Ends? \n", "é!" + str(rng.random()), "x" * 3000, "a\nb."]))
            for c in [None, *range(convs)] for _ in range(rng.randint(1, most))]
    return rows + rows[:5]


@pytest.mark.parametrize("most", [512, 3])
def test_conversation_repair(spark, most):
    """Short conversations, and the same by segments of three rows."""
    rows = _turns(7, 40, 6) + [(1000, t, "user" if t % 2 else "assistant", f"Turn {t}.") for t in range(30)] + [(2000, 0, "user", "All gone.")]
    table = spark.createDataFrame([(*r, "c", 1, 2, "d") for r in rows], TURNS)
    got = conversation_repair.repair(table, most=most)
    assert sorted(map(tuple, got.collect()), key=str) == _conversations(rows)


def test_conversation_repair_long_equals_short(spark):
    """One long conversation with ties, by segments of several sizes and whole."""
    rng = random.Random(5)
    rows = [(1, rng.randrange(400), rng.choice(["user", "assistant", "system"]), rng.choice([f"Own {i}.", "Shared.", "Open end", ""])) for i in range(600)] + [(2, 1, "user", "Hello.")]
    table = spark.createDataFrame([(*r, "c", 1, 2, "d") for r in rows], TURNS)
    want = sorted(map(tuple, conversation_repair.repair(table, most=10_000).collect()), key=str)
    assert want == sorted(map(tuple, conversation_repair.repair(table, most=50).collect()), key=str)
    assert want == sorted(map(tuple, conversation_repair.repair(table, most_bytes=1000).collect()), key=str)


def test_conversation_repair_of_nothing(spark):
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    table = spark.createDataFrame([(gone, 0, "user", "Hi.", "c", 1, 2, "d")], TURNS)
    assert [tuple(r) for r in conversation_repair.repair(table).collect()] == [(gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
    assert conversation_repair.repair(table.limit(0)).collect() == []


TEXTS = [None, "", " ", "  ", "▁", "a▁b", "a b", " a", "a ", "a  b", "\n", "a\n b\t\tc ", "<s> </s> <unk> <0x0A>", "é ß 漢字 . . .", "é", "\x00", "x" * 50_000, "a " * 30_000, " a　b", "😀 👩‍👧", "one two three."]


@pytest.mark.parametrize("name", ["piece_bpe_32k.model", "byte_bpe_50k.json", "word_bpe_49k.json"])
def test_token_counts(spark, tmp_path, name):
    import public_tokenizers

    path = public_tokenizers.path(name)
    if name.endswith(".model"):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        count = lambda t: len(model.encode(t))
    else:
        from tokenizers import Tokenizer

        model = Tokenizer.from_file(path)
        count = lambda t: len(model.encode(t, add_special_tokens=False).ids)
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(1, "a b"), (None, "a b"), (3, "a b"), (3, "a b")]
    rows += duckdb.sql(f"select doc_id, text from '{SF_SMALL}/documents.parquet'").fetchall()
    table = spark.createDataFrame([(i, t, "x", 1, "y") for i, t in rows], "doc_id long, text string, digest string, n_tokens int, version string")

    def got(df):
        return sorted((tuple(r) for r in df.collect()), key=str)

    def batches():
        return sorted(os.listdir(cache / f"version={token_counts.version(path)}"))

    want = sorted(((i, len((t or "").encode()), count(t or ""), count(t or "") > 4096) for i, t in rows), key=str)
    cache = tmp_path / "cache"
    assert got(token_counts.count_tokens(table, path)) == want
    # a cache that knows some of the texts, then all of them
    half = table.where("doc_id < 10")
    assert got(token_counts.count_tokens(half, path, str(cache))) == [w for w in want if w[0] is not None and w[0] < 10]
    known = {bytes(r.digest) for r in token_counts.stored(spark, str(cache), token_counts.version(path)).collect()}
    assert got(token_counts.count_tokens(table, path, str(cache))) == want
    assert len(batches()) == 2
    new = spark.read.parquet(f"{cache}/*/{[b for b in batches()][0]}").union(spark.read.parquet(f"{cache}/*/{batches()[1]}"))
    assert new.count() == new.select("digest").distinct().count() > len(known)  # no text was encoded twice
    assert got(token_counts.count_tokens(table, path, str(cache))) == want and len(batches()) == 2


def test_token_counts_come_from_the_cache_of_their_version(spark, tmp_path):
    import public_tokenizers

    path, cache = public_tokenizers.path("piece_bpe_32k.model"), str(tmp_path / "c")
    table = spark.createDataFrame([(1, "known"), (2, "new")], "doc_id long, text string")
    own = token_counts.version(path)
    planted = spark.createDataFrame([(hashlib.sha256(b"known").digest(), 777, own, "a"), (hashlib.sha256(b"known").digest(), 777, own, "b"), (hashlib.sha256(b"new").digest(), 888, "other", "a")], "digest binary, n_tokens long, version string, batch string")
    planted.write.partitionBy("version", "batch").parquet(cache)
    got = {r.doc_id: r.n_tokens for r in token_counts.count_tokens(table, path, cache).collect()}
    assert got[1] == 777 and got[2] < 5
    assert token_counts.count_tokens(table.limit(0), path, cache).collect() == []
