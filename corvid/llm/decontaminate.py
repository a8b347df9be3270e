"""Benchmark decontamination by the q-gram lemma and banded alignment.

An item of n bytes that occurs in a text with at most k edits shares at
least n - q + 1 - k * q of its q-grams with the text, on diagonals (place
in the text minus place in the item) that differ by at most k.  Hits of
the items' q-grams are counted in overlapping bands of diagonals, 2k + 2
wide and k + 1 apart, so every such occurrence lies in one band whole.
Bands that reach the bound are verified by a banded edit distance.  k is
``rate`` of the item's length.

Texts are compared as UTF-8 bytes, without regard to case (Unicode's folding)
and composed (NFC), and each run of white space as one space.  The folded
benchmark is written in blocks of about ``block_bytes``; a task reads its
texts once and takes the blocks from there, one after another, so neither the
driver nor a task ever holds more than one block's index.

Defined cases: null and empty texts match nothing; null items and items
under ``least`` bytes (at least q) match nothing; repeated items match
each; repeated rows give the same matches once for each item.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvid.llm.common import bounded_batches, giving_back, joined, ranges, scratch_dir, slices, text_key, written
from corvid.sources.files import arrow_filesystem, qualified

Q, RATE, LEAST, BITS = 12, 0.05, 24, 20
#: Bytes of a block, bytes of texts for which a block is loaded, postings and pairs that are worked on at once.
BLOCK_BYTES, HELD, POSTINGS, ALIGNED = 4 << 20, 16 << 20, 4 << 20, 4096
#: Bytes of an item's end that are aligned before the whole.
TAIL = 32
_SPACE = re.compile(rb"[ \t-\r]+")
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], np.uint64)


def normal(text: str) -> bytes:
    if not text.isascii():
        text = unicodedata.normalize("NFC", unicodedata.normalize("NFC", text).casefold())
    return _SPACE.sub(b" ", text.encode("utf-8", "surrogatepass").translate(_LOWER)).strip()


def _grams(b: np.ndarray) -> np.ndarray:
    """A 64-bit code of the Q bytes at each place: the first 8 and the last 8 of them, mixed."""
    n = len(b) - Q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    eight = np.empty(len(b) - 7, np.uint64)
    for s in range(8):
        w = b[s : s + (len(b) - s) // 8 * 8].view("<u8")
        eight[s::8] = w[: len(eight[s::8])]
    code = eight[:n] * _MIX[0] ^ eight[Q - 8 : Q - 8 + n] * _MIX[1]
    return code ^ code >> np.uint64(29)


def aligned_many(items: list[bytes], texts: list[bytes], low: np.ndarray, band: int, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Least edits of each item against any part of its text, start before ``low + band``, with that part's start and end.

    All pairs go row by row together, only ``band`` diagonals from ``low`` on;
    the part may begin and end anywhere on them.  A pair leaves as soon as all
    its diagonals are over ``most`` edits, and then has ``most + 1``.
    """
    n_items, n_texts = np.array([len(x) for x in items]), np.array([len(x) for x in texts])
    first = np.concatenate([[0], np.cumsum(n_items)])
    a = np.frombuffer(b"".join(items), np.uint8)
    place = {}
    for x in texts:  # pairs of one text share its bytes
        place.setdefault(id(x), (x, len(place)))
    own = list(place.values())
    starts = np.concatenate([[0], np.cumsum([len(x) for x, _ in own])])
    t, base = np.frombuffer(b"".join(x for x, _ in own), np.uint8), starts[[place[id(x)][1] for x in texts]]
    edits, begin, end = np.full(len(items), most + 1), np.zeros(len(items), np.int64), np.zeros(len(items), np.int64)
    big, step = most + band + 2, np.arange(band + 1)
    live, col = np.arange(len(items)), low[:, None] + step  # end of the part for each diagonal, at row 0
    cost, start = np.where((col >= 0) & (col <= n_texts[:, None]), 0, big), col.copy()
    for i in range(int(n_items.max(initial=0))):
        size = n_texts[live][:, None]
        col = low[live][:, None] + i + 1 + step
        ok = (col >= 1) & (col <= size)
        match = t[np.where(ok, base[live][:, None] + col - 1, 0)] == a[first[live] + i][:, None]
        diag = np.where(ok, cost + ~match, big)
        up = np.full_like(cost, big)  # the item's byte has no partner
        up[:, :-1] = cost[:, 1:] + 1
        shifted = np.zeros_like(start)
        shifted[:, :-1] = start[:, 1:]
        take = up < diag
        new, from_ = np.where(take, up, diag), np.where(take, shifted, start)
        new = np.where((col >= 0) & (col <= size), new, big)
        # text bytes without a partner: the best of all diagonals below, plus the distance
        best = np.minimum.accumulate((new - step) * (band + 1) + step, axis=1)
        cost, start = np.minimum(best // (band + 1) + step, big), np.take_along_axis(from_, best % (band + 1), 1)
        done = n_items[live] == i + 1
        if done.any():
            k = cost[done].argmin(1)
            who, rows = live[done], np.arange(int(done.sum()))
            edits[who], begin[who], end[who] = cost[done][rows, k], start[done][rows, k], low[who] + i + 1 + k
        stay = ~done & (cost.min(1) <= most)
        if not stay.all():
            live, cost, start = live[stay], cost[stay], start[stay]
            if not len(live):
                break
    return np.minimum(edits, most + 1), begin, end


def aligned(item: bytes, text: bytes, low: int, band: int) -> tuple[int, int, int]:
    """(edits, start, end) of one pair, however many edits it takes."""
    got = aligned_many([item], [text], np.array([low]), band, len(item) + band)
    return int(got[0][0]), int(got[1][0]), int(got[2][0])


class _Index:
    """The q-grams of a block of items."""

    def __init__(self, items: list[tuple[object, bytes]], rate: float):
        self.ids, self.texts = [i for i, _ in items], [t for _, t in items]
        codes = [_grams(np.frombuffer(t, np.uint8)) for t in self.texts]
        n = np.array([len(c) for c in codes])
        code, item, at = np.concatenate(codes), np.repeat(np.arange(len(n)), n), ranges(np.zeros(len(n)), n)
        order = np.argsort(code, kind="stable")
        self.code, first, self.n = np.unique(code[order], return_index=True, return_counts=True)
        self.first, self.item, self.at = first, item[order], at[order]
        self.maybe = np.zeros(1 << BITS, bool)
        self.maybe[self.code >> np.uint64(64 - BITS)] = True
        self.edits = np.array([math.floor(rate * len(t)) for t in self.texts])
        self.least = np.maximum(1, n - self.edits * Q)

    def matches(self, texts: list[bytes]) -> Iterator[tuple[int, int, int, int, int]]:
        """(text, item, edits, start, end) of the best occurrence of each item in each text."""
        b, starts, lens = joined(texts)
        code = _grams(b)
        hit = np.flatnonzero(self.maybe[code >> np.uint64(64 - BITS)])
        k = np.minimum(np.searchsorted(self.code, code[hit]), len(self.code) - 1)
        same = self.code[k] == code[hit]
        hit, k = hit[same], k[same]
        doc = np.searchsorted(starts, hit, side="right") - 1
        inside = hit + Q <= starts[doc] + lens[doc]
        hit, k, doc = hit[inside], k[inside], doc[inside]
        n = self.n[k]
        # a q-gram that many items share has a posting for each: the items take turns if these are too many at once
        turns = max(1, -(-int(n.sum()) // POSTINGS))
        for turn in range(turns):
            got = [self._posted(hit[x:y], k[x:y], doc[x:y], starts, turn, turns) for x, y in _parts(n, POSTINGS)]
            post = [np.concatenate(x) for x in zip(*got)] if got else []
            if post and len(post[0]):
                yield from self._aligned(texts, *self._bands(*post))

    def _posted(self, hit: np.ndarray, k: np.ndarray, doc: np.ndarray, starts: np.ndarray, turn: int, turns: int) -> tuple[np.ndarray, ...]:
        """(text, item, place in the item, diagonal) of the hits' postings, of the items whose turn it is."""
        n = self.n[k]
        post = ranges(self.first[k], n)
        item = self.item[post]
        mine = np.flatnonzero(item % turns == turn) if turns > 1 else slice(None)
        item, at = item[mine], self.at[post][mine]
        doc = np.repeat(doc, n)[mine]
        return doc, item, at, np.repeat(hit, n)[mine] - starts[doc] - at

    def _bands(self, doc: np.ndarray, item: np.ndarray, at: np.ndarray, diagonal: np.ndarray) -> tuple[np.ndarray, ...]:
        """(text, item, band) whose different q-grams reach the item's bound."""
        width = self.edits[item] + 1
        band = (diagonal + (1 << 40) // width * width) // width  # above 0, in whole steps
        # a hit is in its own band and in that which began a step before; an item's q-gram counts once
        doc, item, at = np.tile(doc, 2), np.tile(item, 2), np.tile(at, 2)
        band = np.concatenate([band, band - 1])
        order = np.lexsort((at, band, item, doc))
        d, i, w, a = doc[order], item[order], band[order], at[order]
        new = np.concatenate([[True], (d[1:] != d[:-1]) | (i[1:] != i[:-1]) | (w[1:] != w[:-1])])
        fresh = new | np.concatenate([[True], a[1:] != a[:-1]])
        count = np.bincount(np.cumsum(new) - 1, fresh)
        heads = np.flatnonzero(new)
        kept = heads[count >= self.least[i[heads]]]
        return d[kept], i[kept], w[kept]

    def _aligned(self, texts: list[bytes], doc: np.ndarray, item: np.ndarray, band: np.ndarray) -> Iterator[tuple[int, int, int, int, int]]:
        """Bands verified by alignment, those of one number of edits together; the best of each text and item."""
        edits = self.edits[item]
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        for most in np.unique(edits).tolist():
            own, step = np.flatnonzero(edits == most), most + 1
            low = band[own] * step - (1 << 40) // step * step - most
            for x in range(0, len(own), ALIGNED):
                some, at = own[x : x + ALIGNED], low[x : x + ALIGNED]
                # the ends first: items that share an opening with the text only are done after a few rows
                ends = [self.texts[j][-TAIL:] for j in item[some]]
                shift = np.array([len(self.texts[j]) - len(t) for j, t in zip(item[some].tolist(), ends, strict=True)])
                left = aligned_many(ends, [texts[j] for j in doc[some]], at + shift, 4 * step, most)[0] <= most
                some, at = some[left], at[left]
                cost, start, end = aligned_many([self.texts[j] for j in item[some]], [texts[j] for j in doc[some]], at, 4 * step, most)
                for y in np.flatnonzero(cost <= most).tolist():
                    key, got = (int(doc[some[y]]), int(item[some[y]])), (int(cost[y]), int(start[y]), int(end[y]))
                    best[key] = min(best.get(key, got), got)
        for (x, y), got in sorted(best.items()):
            yield (x, y, *got)


def _parts(n: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of hits with at most ``most`` postings together, one hit at least."""
    total, x = np.cumsum(n), 0
    while x < len(n):
        y = max(x + 1, int(np.searchsorted(total, (total[x - 1] if x else 0) + most, side="right")))
        yield x, y
        x = y


_indexes: dict[str, _Index | None] = {}


def _index(folder: str, block: int, rate: float, least: int, keep: bool) -> _Index | None:
    """The index of a block of the written benchmark; a worker keeps the only one of a benchmark of one block."""
    if (name := f"{folder}/{rate}/{least}") in _indexes:
        return _indexes[name]
    import pyarrow.parquet as pq

    system, path = arrow_filesystem(f"{folder}/block={block}")
    table = pq.read_table(path, filesystem=system, columns=["item_id", "folded"])
    own = sorted({(i, t) for i, t in zip(table["item_id"].to_pylist(), table["folded"].to_pylist(), strict=True) if len(t) >= max(Q, least)})
    got = _Index(own, rate) if own else None
    if keep:
        _indexes.clear()
        _indexes[name] = got
    return got


def _found(docs: DataFrame, benchmark: DataFrame, rate: float, least: int, block_bytes: int) -> DataFrame:
    """(doc_id, key, item_id, edits, start, end), the ids as text."""
    spark = docs.sparkSession
    bounded_batches(spark)
    items = benchmark.where("item_id is not null and text is not null").select(F.col("item_id").cast("string").alias("item_id"), "text")
    size = items.agg(F.sum(F.octet_length("text")).alias("b")).collect()[0].b or 0
    blocks = max(1, math.ceil(size / block_bytes))

    @F.pandas_udf("binary")
    def fold(texts: pd.Series) -> pd.Series:
        return pd.Series([normal(t) for t in texts], dtype=object)

    folder = scratch_dir(spark, "benchmark")
    folded = items.select("item_id", fold("text").alias("folded"), F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)).alias("block"))
    folded.repartition(blocks, "block").write.partitionBy("block").parquet(folder)
    folder = qualified(spark, folder)
    there = sorted(r.block for r in spark.read.parquet(folder).select("block").distinct().collect()) if size else []

    @giving_back
    def match(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def flush() -> pd.DataFrame:
            out = []
            for block in there:
                if index := _index(folder, block, rate, least, len(there) == 1):
                    for a, b in slices([t for _, _, t in held]):
                        out += [(*held[a + x][:2], index.ids[y], *z) for x, y, *z in index.matches([t for _, _, t in held[a:b]])]
            return pd.DataFrame(out, columns=["doc_id", "key", "item_id", "edits", "start", "end"])

        held, size = [], 0
        for pdf in batches:
            for i, k, t in zip(pdf["i"], pdf["k"], pdf["t"], strict=True):
                held.append((i, k, normal(t)))
                size += len(held[-1][2])
                if size > HELD:  # every block is loaded once for so many bytes of texts
                    yield flush()
                    held, size = [], 0
        yield flush()

    rows = docs.where("length(text) > 0").select(F.col("doc_id").cast("string").alias("i"), text_key(F.col("text")).alias("k"), F.col("text").alias("t"))
    return rows.mapInPandas(match, "doc_id string, key long, item_id string, edits int, start long, end long")


def matches(docs: DataFrame, benchmark: DataFrame, rate: float = RATE, least: int = LEAST, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, item_id, edits, start, end) for every item that a text holds.

    start and end count bytes of the normal form, the occurrence of fewest
    edits, the first of equals.
    """
    d_type, i_type = docs.schema["doc_id"].dataType, benchmark.schema["item_id"].dataType
    found = _found(docs, benchmark, rate, least, block_bytes)
    return found.select(F.col("doc_id").cast(d_type).alias("doc_id"), F.col("item_id").cast(i_type).alias("item_id"), "edits", "start", "end").distinct()


def decontaminated(docs: DataFrame, benchmark: DataFrame, rate: float = RATE, least: int = LEAST, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` without the rows whose text holds an item; other texts of the same doc_id, or of none, stay."""
    found = _found(docs, benchmark, rate, least, block_bytes)
    bad = written(found.select(F.col("doc_id").cast(docs.schema["doc_id"].dataType).alias("__leak_id"), F.col("key").alias("__leak_key")).distinct(), "leaks")
    own = docs.withColumn("__own_key", text_key(F.col("text")))
    return own.join(bad, F.col("doc_id").eqNullSafe(F.col("__leak_id")) & (F.col("__own_key") == F.col("__leak_key")), "left_anti").drop("__own_key")
