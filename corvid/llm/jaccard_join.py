"""N-gram Jaccard join, size-aware.

A document's set is its distinct word n-grams, as 64-bit hashes.  Equal
sets are one class; a class's representative is its smallest doc_id.

* *Small sets* are joined by enumeration: a set posts itself and its
  subsets with one element less.  Two small sets link exactly if they share
  a subset that is large enough for their sizes, so nothing is verified.
* *Large sets* are joined by scanning inverted lists: with m = floor((1 -
  t) n), what a linked set may lack, a set of n posts its m + floor(m / 2) +
  1 first elements in an order that all documents share (rarest first, by a
  sketch of all documents' frequencies).  Linked sets share floor(m / 2) + 1
  of these for the smaller of them, so documents and pairs with fewer drop
  out.  Short lists count pairs; long lists only connect their members, in
  the same or the next band of sizes.

The boundary between the two is chosen by cost, of those where one element
less is enough.  Candidates that meet in lists are grouped into connected
components; small ones are verified whole, in packs of bounded size.  In a
large one each member is first verified against the head it shares most
lists with, and what that links is contracted.  What is left apart goes in
blocks of bounded documents and shingles, and only blocks that share a list
and are not of one linked group are verified with each other, with the whole
sets.  So a group of near copies costs its size, not its square.  Blocks
return a spanning forest of the links.

Defined cases: a null text, or one without words, has an empty set and
links with nothing; a text with fewer than n words has one element, all its
words; rows with a null doc_id are counted but link with nothing and have
a null component; repeated rows and rows of one doc_id share a component.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvid.llm.common import bounded_batches, connected_components, giving_back, joined, scratch_scope, slices, text_key, written
from corvid.llm.embedding_dedup import forest
from corvid.operators.ranks import ranked

WORDS, PERCENT = 3, 90
#: Documents of a block, and counters of the frequency sketch (a power of 2).
BLOCK, SKETCH = 256, 1 << 19
#: Lists up to this length give their pairs; longer ones give stars.
SHORT = 32
#: Shingles of a block's documents on average: a block is bounded by both.
SHINGLES = 1 << 10
#: Cost of verifying a candidate, in posted rows.
VERIFY = 40
_ODD = np.random.default_rng(3).integers(1 << 62, 1 << 63, 512, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_GAP = np.zeros(256, bool)
_GAP[[0x20, *range(0x09, 0x0E)]] = True
_BYTE = _ODD[:256].copy()
_BYTE[65:91] = _BYTE[97:123]  # A to Z count as a to z


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ x >> np.uint64(32)
    x = x * _ODD[300]
    x = x ^ x >> np.uint64(29)
    x = x * _ODD[301]
    return x ^ x >> np.uint64(32)


def shingle_sets(texts: list[bytes], words: int) -> Iterator[np.ndarray]:
    """The sorted distinct n-gram hashes of each text."""
    for lo, hi in slices(texts):
        b, _, lens = joined([t + b" " for t in texts[lo:hi]])
        gap = _GAP[b]
        inside = np.flatnonzero(~gap)
        if not len(inside):
            yield from (np.zeros(0, np.uint64) for _ in range(lo, hi))
            continue
        first = np.flatnonzero(~gap & np.concatenate([[True], gap[:-1]]))
        n_letters = np.diff(np.append(np.searchsorted(inside, first), len(inside)))
        place = np.arange(len(inside)) - np.repeat(np.cumsum(n_letters) - n_letters, n_letters)
        power = np.cumprod(np.full(int(n_letters.max()), _ODD[302], np.uint64))
        word = _mix(np.add.reduceat(_BYTE[b[inside]] * power[place], np.cumsum(n_letters) - n_letters))
        bounds = np.searchsorted(first, np.cumsum(lens))
        grams = sum(word[k : len(word) - words + 1 + k] * _ODD[310 + k] for k in range(words)) if len(word) >= words else np.zeros(0, np.uint64)
        grams = _mix(grams)
        at = 0
        for end in bounds.tolist():
            n = end - at
            if n >= words:
                yield np.unique(grams[at : end - words + 1])
            elif n:
                yield _mix(sum(word[at + k : at + k + 1] * _ODD[310 + k] for k in range(n)) + _ODD[320 + n : 321 + n])
            else:
                yield np.zeros(0, np.uint64)
            at = end


def _misses(n: np.ndarray, percent: int) -> np.ndarray:
    """How many elements of a set of n a linked set may lack."""
    return n * (100 - percent) // 100


def _describe(docs: DataFrame, words: int, sketch: int) -> tuple[DataFrame, np.ndarray]:
    """A row for each document (i, k, n, h1, h2, least), and the frequency sketch."""
    mask = np.uint64(sketch - 1)
    slots = 16

    @giving_back
    def describe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = np.zeros(sketch, np.int64)
        for pdf in batches:
            out = []
            for i, k, s in zip(pdf["i"], pdf["k"], shingle_sets(pdf["b"].tolist(), words), strict=True):
                h = xxhash.xxh3_128_intdigest(s.tobytes())
                np.add.at(seen, (s & mask).astype(np.int64), 1)
                out.append((i, k, len(s), (h >> 64) - (1 << 63), (h & (1 << 64) - 1) - (1 << 63), int(s[0]) - (1 << 63) if len(s) else 0, None))
            yield pd.DataFrame(out, columns=["i", "k", "n", "h1", "h2", "least", "seen"]).astype({"i": "Int64"})
        for j in range(slots):
            part = seen[j::slots].astype("<i8").tobytes()
            yield pd.DataFrame({"i": [None], "k": [0], "n": [-1 - j], "h1": [0], "h2": [0], "least": [0], "seen": [part]}).astype({"i": "Int64"})

    rows = docs.select(F.col("doc_id").cast("long").alias("i"), text_key(F.col("text")).alias("k"), F.coalesce("text", F.lit("")).cast("binary").alias("b"))
    got = written(rows.mapInPandas(describe, "i long, k long, n long, h1 long, h2 long, least long, seen binary"), "sets")

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(x, "<i8") for x in pdf["seen"])
        return pd.DataFrame({"n": [int(pdf["n"].iat[0])], "seen": [total.tobytes()]})

    parts = got.where("n < 0").select("n", "seen")
    tasks = max(1, got.where("n = -1").count())
    while tasks > 1:  # sums of at most 32 tasks' sketches at a time
        tasks = math.ceil(tasks / 32)
        parts = written(parts.withColumn("g", F.pmod(F.xxhash64("seen"), F.lit(tasks))).groupBy("n", "g").applyInPandas(lambda pdf: add(pdf), "n long, seen binary"), "sketch")
    df = np.zeros(sketch, np.int64)
    for r in parts.collect():  # sketch counters in all, at any input size
        df[-1 - r.n :: slots] += np.frombuffer(r.seen, "<i8")
    return got.where("n >= 0").drop("seen"), np.minimum(df, (1 << 31) - 1).astype(np.int32)


def boundary(small: dict[int, tuple[int, int]], percent: int) -> int:
    """Sets under this size are enumerated: the cheapest of the sizes where one element less is enough.

    ``small`` has, by size, the classes and those whose least element another
    class shares (an estimate of how many are candidates when scanned).
    """
    most = next(n for n in range(2, 10_000) if n * (100 - percent) // 100 > 1)
    cost = lambda x: sum(c * (n + 1) for n, (c, _) in small.items() if n < x) + sum(c * (n * (100 - percent) // 100 + 1) + VERIFY * r for n, (c, r) in small.items() if x <= n < most)
    return min(range(1, most + 1), key=lambda x: (cost(x), x))


def _enumerated(classes: DataFrame, most: int, percent: int) -> DataFrame:
    """Links (a, b) among the sets under ``most``, exactly: a star for each shared subset."""
    small = classes.where(F.col("n") < most)
    # the subset of all, or of all but one element, is named by its size and two sums of hashes
    keys = small.select("rep", "n", F.explode(F.arrays_zip("s1", "s2", "size")).alias("x")).select("rep", "n", "x.*")
    g = keys.groupBy("size", "s1", "s2").agg(F.min(F.when(F.col("n") == F.col("size"), F.col("rep"))).alias("whole"), F.min("rep").alias("any"), F.count("*").alias("c")).where("c > 1")
    g = written(g, "subsets")
    met = keys.join(g, ["size", "s1", "s2"])
    by_whole = met.where(f"whole is not null and whole <> rep and 100 * size >= {percent} * n").select(F.col("whole").alias("a"), F.col("rep").alias("b"))
    by_any = met.where(f"any <> rep and 100 * size >= {percent} * (size + 2)").select(F.col("any").alias("a"), F.col("rep").alias("b"))
    return by_whole.union(by_any)


def _links(texts: list[bytes], names: list[int], group: np.ndarray, side: np.ndarray | None, words: int, percent: int) -> tuple[list[int], list[int]]:
    """A spanning forest of the links within each group, between its two sides if given."""
    sets = list(shingle_sets(texts, words))
    out: tuple[list[int], list[int]] = ([], [])
    for g in np.unique(group):
        rows = np.flatnonzero(group == g)
        n = np.array([len(sets[r]) for r in rows])
        if len(rows) == 2:
            shared = np.array([[0, len(np.intersect1d(sets[rows[0]], sets[rows[1]], assume_unique=True))], [0, 0]], float)
        else:
            flat, own = np.concatenate([sets[r] for r in rows]), np.repeat(np.arange(len(rows)), n)
            order = np.argsort(flat, kind="stable")
            flat, own = flat[order], own[order]
            new = np.concatenate([[True], flat[1:] != flat[:-1]])
            column = np.cumsum(new) - 1
            often = np.bincount(column) > 1
            keep = often[column]
            column, own = (np.cumsum(often) - 1)[column[keep]], own[keep]
            shared = np.zeros((len(rows), len(rows)), np.float32)
            for lo in range(0, int(column[-1]) + 1 if len(column) else 0, 4096):
                a, b = np.searchsorted(column, [lo, lo + 4096])
                has = np.zeros((len(rows), 4096), np.float32)
                has[own[a:b], column[a:b] - lo] = 1
                shared += has @ has.T
        linked = 100 * shared >= percent * (n[:, None] + n[None, :] - shared)
        p, q = np.nonzero(np.triu(linked, 1))
        if side is not None:
            across = side[rows[p]] != side[rows[q]]
            p, q = p[across], q[across]
        a, b = forest(p, q)
        out[0].extend(names[rows[x]] for x in a)
        out[1].extend(names[rows[x]] for x in b)
    return out


def _overlap(n: Column, percent: int) -> Column:
    """How many of their first elements two linked sets share at least, if the smaller has ``n``.

    A set posts as many elements as it may lack, and so many more: the first
    that both have are among these in both.
    """
    return F.floor(F.floor(n * (100 - percent) / 100) / 2) + 1


def _repeated(posts: DataFrame, rows: int) -> DataFrame:
    return written(posts.groupBy("token").agg(F.count("*").alias("c")).where("c > 1").select("token"), "lists", rows)


def _texts(docs: DataFrame, members: DataFrame) -> DataFrame:
    """(rep, k, t) of the candidates: fetched by exchange at any size, as they grow with the documents."""
    texts = docs.select(F.col("doc_id").cast("long").alias("rep"), text_key(F.col("text")).alias("k"), F.col("text").alias("t"))
    return texts.join(members.select("rep", "k").hint("merge"), ["rep", "k"], "left_semi")


def _verified(texts: DataFrame, groups: DataFrame, words: int, percent: int) -> DataFrame:
    """Links (a, b) within groups (rep, k, group, i, j, side), a task for each (i, j), between the two sides if there are two."""
    to = groups.groupBy("rep", "k").agg(F.collect_list(F.struct("group", "i", "j", "side")).alias("to"))  # at most the blocks a block meets
    to = written(to.select(F.col("rep").alias("i0"), F.col("k").alias("k0"), "to"), "verify")
    texts = texts.join(to.hint("merge"), (F.col("rep") == F.col("i0")) & (F.col("k") == F.col("k0"))).select("rep", "k", "t", F.explode("to").alias("x")).select("rep", "k", "t", "x.*")

    def verify(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.drop_duplicates(["rep", "k", "side"])  # texts that share a doc_id are all compared
        one = pdf["side"].max() == 0
        a, b = _links([x.encode() for x in pdf["t"]], pdf["rep"].tolist(), pdf["group"].to_numpy(), None if one else pdf["side"].to_numpy(), words, percent)
        return pd.DataFrame({"a": a, "b": b}, dtype="int64")

    return texts.groupBy("i", "j").applyInPandas(verify, "a long, b long")


def _parts(block: int) -> Column:
    """How many blocks of bounded documents and bounded shingles a group of rows with ``n`` shingles makes."""
    return F.greatest(F.ceil(F.count("*") / block), F.ceil(F.sum("n") / (block * SHINGLES))).cast("long")


def _stars(members: DataFrame, met: DataFrame, block: int) -> DataFrame:
    """Groups of each member with the head it shares most lists with, cut where a head has many."""
    best = met.groupBy("rep", "head").agg(F.count("*").alias("c")).groupBy("rep").agg(F.max(F.struct("c", "head")).alias("x"))
    own = members.join(best.select("rep", F.col("x.head").alias("head")), "rep")
    parts = own.groupBy("head").agg(_parts(block).alias("parts"))
    parts = written(parts, "stars")
    sent = own.join(parts, "head").select("rep", "k", F.col("head").alias("group"), F.pmod(F.xxhash64("rep"), "parts").alias("j"), F.lit(0).alias("side"))
    heads = parts.join(members.select("rep", "k"), F.col("head") == F.col("rep")).select("rep", "k", F.col("head").alias("group"), F.explode(F.expr("sequence(0L, parts - 1)")).alias("j"), F.lit(1).alias("side"))
    return sent.union(heads).select("rep", "k", "group", F.xxhash64(F.lit("star"), "group").alias("i"), "j", "side")


def _scanned(docs: DataFrame, classes: DataFrame, least: int, words: int, percent: int, block: int) -> DataFrame:
    """Links (a, b) among the sets of ``least`` elements and more."""
    band = F.floor(F.log(F.col("n").cast("double")) / F.lit(-math.log(percent / 100 - 1e-9))).cast("int")
    posts = classes.where(F.col("n") >= least).select("rep", F.col("n").cast("int").alias("n"), F.explode("prefix").alias("token"))
    size = classes.where(F.col("n") >= least).agg(F.sum(F.size("prefix")).alias("c")).collect()[0].c or 0
    hot = written(posts.join(_repeated(posts, size), "token"), "postings", size)
    for step in range(2):  # documents with too few shared elements, for any partner, go; then lists of one
        size = hot.count()
        enough = hot.groupBy("rep", "n").agg(F.count("*").alias("c")).where(F.col("c") >= _overlap(F.ceil(F.col("n") * percent / 100), percent)).select("rep")
        left = written(hot.join(written(enough, f"enough-{step}", size), "rep"), f"left-{step}", size)
        hot = written(left.join(_repeated(left, size), "token"), f"postings-{step}", size)
    size = hot.count()
    sized = hot.join(written(hot.groupBy("token").agg(F.count("*").alias("c")), "list-sizes", size), "token")
    # short lists: pairs that share enough of their first elements
    short = written(sized.where(F.col("c") <= SHORT).select("token", "rep", "n"), "short", size)
    other = short.select("token", F.col("rep").alias("b"), F.col("n").alias("n2"))
    pairs = short.withColumnRenamed("rep", "a").join(other, "token").where(f"a < b and 100 * least(n, n2) >= {percent} * greatest(n, n2)")
    pairs = pairs.groupBy("a", "b", "n", "n2").agg(F.count("*").alias("c")).where(F.col("c") >= _overlap(F.least("n", "n2"), percent)).select("a", "b")
    # long lists: a star in each band of sizes, and their heads in neighbouring bands
    long_ = written(sized.where(F.col("c") > SHORT).select("token", "rep", "n").withColumn("band", band), "long", size)
    heads = written(long_.groupBy("token", "band").agg(F.min("rep").alias("head"), F.count("*").alias("c")), "heads", size)
    stars = long_.join(heads.where("c > 1").select("token", "band", "head"), ["token", "band"])
    above = heads.select("token", (F.col("band") - 1).alias("band"), F.col("head").alias("b"))
    near = heads.select("token", "band", F.col("head").alias("a")).join(above, ["token", "band"]).select("a", "b")
    component = connected_components(pairs.union(stars.select("rep", "head")).union(near), name="candidates", rows=size * SHORT)

    members = classes.select("rep", "k", "n").join(component.withColumnRenamed("node", "rep"), "rep").withColumn("band", band)
    members = written(members, "candidates", size)
    sizes = written(members.groupBy("component").agg(F.count("*").alias("c"), F.sum("n").alias("s"), _parts(block).alias("parts")), "component-sizes", size)
    total = sizes.agg(F.sum("s").alias("s")).collect()[0].s or 0
    packs = max(1, math.ceil(total / (block * SHINGLES)))
    light = members.join(sizes.where("parts = 1").select("component"), "component")
    light = light.select("rep", "k", F.col("component").alias("group"), F.pmod(F.xxhash64("component"), F.lit(packs)).alias("i"), F.lit(-1).cast("long").alias("j"), F.lit(0).alias("side"))
    if sizes.where("parts > 1").isEmpty():
        return _verified(_texts(docs, members), light, words, percent)

    texts = written(_texts(docs, members), "texts")  # of candidates only; read by both passes
    # Large components.  First each member against one head; what that links is one from here on.
    heavy = written(members.join(sizes.where("parts > 1").select("component"), "component"), "heavy", size)
    met = stars.where("rep <> head").select("rep", "head").join(heavy.select("rep"), "rep")
    first = written(_verified(texts, light.union(_stars(heavy.select("rep", "k", "n"), met, block)), words, percent), "star-links")
    linked = connected_components(first, name="stars").withColumnRenamed("node", "rep").withColumnRenamed("component", "one")
    heavy = heavy.join(linked, "rep", "left").withColumn("one", F.coalesce("one", "rep"))
    # A group that is linked already and fills blocks has blocks of its own, which do not meet each other; the rest are mixed.
    big = heavy.groupBy("one").agg(_parts(block).alias("own")).where("own > 1").select(F.col("one").alias("big"))
    heavy = written(heavy.join(big, F.col("one") == F.col("big"), "left").select("rep", "k", "n", "component", "band", "big"), "contracted", size)
    cut = heavy.groupBy("component", "band", "big").agg(_parts(block).alias("parts"))
    cut = cut.select(F.col("component").alias("c0"), F.col("band").alias("b0"), F.col("big").alias("g0"), "parts")
    blocks = heavy.join(cut, (F.col("component") == F.col("c0")) & (F.col("band") == F.col("b0")) & F.col("big").eqNullSafe(F.col("g0")))
    blocks = blocks.withColumn("u", F.xxhash64("component", "band", "big", F.pmod(F.xxhash64("rep"), "parts")))
    blocks = written(blocks.select("rep", "k", "component", "band", "big", "u"), "blocks", size)
    touched = sized.select("token", "rep").join(blocks.select("rep", "band", "big", "u"), "rep").select("token", "band", "big", "u").distinct()
    touched = written(touched, "touched", size)
    # lists whose members are all of one linked group have nothing left to find
    open_ = written(touched.groupBy("token").agg(F.min(F.coalesce("big", F.lit(0))).alias("x"), F.max(F.coalesce("big", F.lit(0))).alias("y"), F.count_if(F.col("big").isNull()).alias("z")).where("x <> y or z > 0").select("token"), "open-lists", size)
    touched = touched.join(open_, "token")
    other = touched.select("token", F.col("band").alias("band2"), F.col("big").alias("big2"), F.col("u").alias("j"))
    pair = touched.withColumnRenamed("u", "i").join(other, "token").where("(band2 = band and i <= j) or band2 = band + 1")
    pair = written(pair.where("big is null or big2 is null or big <> big2").select("i", "j").distinct(), "block-pairs")
    sides = pair.select(F.col("i").alias("u"), "i", "j", F.lit(0).alias("side")).union(pair.where("i <> j").select(F.col("j").alias("u"), "i", "j", F.lit(1).alias("side")))
    sent = blocks.join(sides, "u").select("rep", "k", F.col("component").alias("group"), "i", "j", "side")
    return first.union(_verified(texts, sent, words, percent))


def join(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, block: int = BLOCK, sketch: int = SKETCH) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs``.

    Two documents link when 100 * shared >= percent * all of their n-grams.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    rows, frequency = _describe(docs, words, sketch)
    real = rows.where("i is not null and n > 0")
    named = written(real.groupBy("h1", "h2", "n", "least").agg(F.min(F.struct("i", "k")).alias("r")).select("h1", "h2", "n", "least", F.col("r.i").alias("rep"), F.col("r.k").alias("k")), "classes")
    most = next(n for n in range(2, 10_000) if n * (100 - percent) // 100 > 1)
    small = named.where(F.col("n") < most).groupBy("n", "least").agg(F.count("*").alias("c")).groupBy("n").agg(F.sum("c").alias("c"), F.sum(F.when(F.col("c") > 1, F.col("c")).otherwise(0)).alias("r"))
    edge = boundary({r.n: (r.c, r.r) for r in small.collect()}, percent)  # a row for each size under ``most``
    least = max(1, math.ceil(edge * percent / 100))
    mask = np.uint64(sketch - 1)
    shared = spark.sparkContext.broadcast(frequency)  # sketch counters, 4 bytes each

    @giving_back
    def post(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            done: dict[bytes, int] = {}
            for i, k, s in zip(pdf["i"], pdf["k"], shingle_sets(pdf["b"].tolist(), words), strict=True):
                n, raw = len(s), s.tobytes()
                if not n:
                    continue
                if (h := xxhash.xxh3_128_digest(raw)) in done:
                    out[done[h]][2] = min(out[done[h]][2], (i, k))
                    continue
                done[h] = len(out)
                x = int.from_bytes(h)
                prefix, s1, s2, size = [], [], [], []
                if n >= least:
                    p = (m := n * (100 - percent) // 100) + m // 2 + 1
                    prefix = s[np.lexsort((s, shared.value[s & mask]))[:p]].view(np.int64).tolist()
                if n < edge:
                    other = _mix(s ^ _ODD[330])
                    s1 = np.append(s.sum() - s, s.sum())
                    s2 = np.append(other.sum() - other, other.sum())
                    keep = slice(n, n + 1) if n == 1 else slice(0, n + 1)
                    s1, s2, size = s1[keep].view(np.int64).tolist(), s2[keep].view(np.int64).tolist(), ([n - 1] * n + [n])[keep]
                out.append([(x >> 64) - (1 << 63), (x & (1 << 64) - 1) - (1 << 63), (i, k), n, prefix, s1, s2, size])
            frame = pd.DataFrame(out, columns=["h1", "h2", "ik", "n", "prefix", "s1", "s2", "size"])
            yield frame.assign(i=[x[0] for x in frame["ik"]], k=[x[1] for x in frame["ik"]])[["h1", "h2", "i", "k", "n", "prefix", "s1", "s2", "size"]]

    texts = docs.where("doc_id is not null and text is not null").select(F.col("doc_id").cast("long").alias("i"), text_key(F.col("text")).alias("k"), F.col("text").cast("binary").alias("b"))
    posted = texts.mapInPandas(post, "h1 long, h2 long, i long, k long, n long, prefix array<long>, s1 array<long>, s2 array<long>, size array<int>")
    one = posted.groupBy("h1", "h2", "n").agg(F.min(F.struct("i", "k")).alias("r"), *(F.first(c).alias(c) for c in ("prefix", "s1", "s2", "size")))
    with scratch_scope(spark) as made:  # postings and candidates are large, and of no use when the components are written
        classes = written(one.select(F.col("r.i").alias("rep"), F.col("r.k").alias("k"), "n", "prefix", "s1", "s2", "size"), "posted")
        edges = _scanned(docs, classes, least, words, percent, block).union(_enumerated(classes, edge, percent))
        component = connected_components(edges, name="links")
        of = named.join(component.withColumnRenamed("node", "rep"), "rep", "left").select("h1", "h2", F.coalesce("component", "rep").alias("c"))
        of = written(of, "components")
        made.pop()  # the table just written
    got = rows.join(of, ["h1", "h2"], "left")
    got = got.select(F.col("i").alias("doc_id"), F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("c")).otherwise(F.col("i")).alias("component_id"), "k")
    got = got.withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.col("component_id")))
    return got


def _told_apart(docs: DataFrame) -> DataFrame:
    """``docs`` plus ``__doc``: the doc_id, or a number of its own for every further text of a doc_id."""
    keyed = docs.withColumn("__key", text_key(F.col("text")))
    pairs = keyed.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("d"), F.col("__key").alias("t")).distinct()
    several = pairs.groupBy("d").agg(F.count("*").alias("c"), F.min("t").alias("first")).where("c > 1")
    extra = written(pairs.join(several, "d").where("t <> first").select("d", "t"), "further-texts")
    if extra.isEmpty():
        return keyed.withColumn("__doc", F.col("doc_id").cast("long"))
    top = docs.agg(F.max(F.col("doc_id").cast("long"))).collect()[0][0]
    numbered = ranked(extra, ["d", "t"], "r").select(F.col("d").alias("__d"), F.col("t").alias("__t"), (F.lit(top) + 1 + F.col("r")).alias("__n"))
    got = keyed.join(numbered, (F.col("doc_id").cast("long") == F.col("__d")) & (F.col("__key") == F.col("__t")), "left")
    return got.withColumn("__doc", F.coalesce("__n", F.col("doc_id").cast("long"))).drop("__d", "__t", "__n")


def one_of_each(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one row of each group of linked texts, that of the smallest doc_id.

    Rows with a null doc_id stay.  Different texts of one doc_id are
    documents of their own, so an unrelated one stays; of equal rows one does.
    """
    rows = _told_apart(docs)
    own = rows.select(F.col("__doc").alias("doc_id"), "text")
    keep = written(join(own, words, percent).where("doc_id = component_id").select(F.col("doc_id").alias("__first")).distinct(), "kept")
    named = rows.where("doc_id is not null").join(keep, F.col("__doc") == F.col("__first")).drop("__first").dropDuplicates(["__doc"])
    return named.union(rows.where("doc_id is null")).drop("__doc", "__key")
