"""Exact substring dedup with suffix arrays.

Every byte covered by a string of ``length`` bytes that starts more than
once in the corpus is removed.  Texts are UTF-8 bytes; matches never cross
documents.

1. *Candidates.*  Each window of ``length`` bytes has an anchor: its GRAM
   bytes of smallest hash.  Equal windows have equal anchors, so windows of
   an anchor that occurs once are unique.  Consecutive windows with one
   anchor are a span; equal spans (same anchor, same bytes) that occur
   twice repeat as a whole.
2. *Suffix arrays.*  The different spans of a repeated anchor are the
   places where a repeat begins or ends.  They are dealt to shards, and a
   shard sorts their suffixes by Larsson-Sadakane refinement and takes
   common prefixes by Kasai's recurrence; neighbours with ``length`` bytes
   in common are repeats.
3. *Merge.*  An anchor with more spans than a shard takes is dealt to
   several.  Their windows go, as sorted runs, to ranges of fingerprints,
   where every run is looked up in the others by binary search.

Defined cases: a null text is an empty one; texts shorter than ``length``
keep everything; repeated rows repeat each other, so whatever is long
enough goes from all; rows are told apart by doc_id and text, a null
doc_id included.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvid.llm.common import bounded_batches, joined, ranges, slices, written

LENGTH, GRAM = 200, 32
#: Spans of an anchor that one shard takes, bytes of a shard, and the
#: longest stretch of a text that is scanned at once.
SHARD_SPANS, SHARD_BYTES, STRETCH = 2000, 2 << 20, 4 << 20
#: Most windows of a span.
SPAN = 1024
#: Bits of a place in what is scanned at once (a stretch, or texts of half as much), below those of an anchor's hash.
PLACE_BITS = 23
_ODD = np.random.default_rng(1).integers(1 << 62, 1 << 63, 300, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ x >> np.uint64(32)
    x *= _ODD[280]
    x ^= x >> np.uint64(29)
    x *= _ODD[281]
    return x ^ x >> np.uint64(32)


def _gram_codes(b: np.ndarray) -> np.ndarray:
    """A hash of the GRAM bytes at every place, by doubling."""
    h, n = _ODD[b], 1
    while n < GRAM:
        h = h[: len(h) - n] * _ODD[256 + n.bit_length()] + h[n:]
        n *= 2
    return _mix(h)


def anchors(b: np.ndarray, starts: np.ndarray, lens: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """(text, first window, number of windows, anchor code, anchor's place) of each span; places in ``b``."""
    windows = np.maximum(lens - length + 1, 0)
    none = np.zeros(0, np.int64)
    if not windows.any():
        return none, none, none, none.astype(np.uint64), none
    code = _gram_codes(b)
    # a fixed number of bits: equal windows have equal anchors whatever the length of what they are scanned with
    bits = np.uint64(PLACE_BITS)
    if len(b) >> PLACE_BITS:
        raise ValueError("scanned bytes are more than places")
    low = code >> bits << bits | np.arange(len(code), dtype=np.uint64)  # of equal hashes the first
    width, n = length - GRAM + 1, 1
    while 2 * n <= width:
        low = np.minimum(low[: len(low) - n], low[n:])
        n *= 2
    if n < width:
        low = np.minimum(low[: len(low) - (width - n)], low[width - n :])
    at = ranges(starts, windows)
    doc = np.repeat(np.arange(len(starts)), windows)
    place = (low[at] & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    own = code[place]
    new = np.concatenate([[True], (own[1:] != own[:-1]) | (doc[1:] != doc[:-1])])
    # Runs of one byte, or of a few, have one anchor at many places: one span of up to SPAN windows.
    # As such a span may repeat itself, its first window is one of its own: then the anchor occurs twice.
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(at)) - 1
    size = last - first + 1
    run = np.arange(len(at)) - np.repeat(first, size)
    head = np.flatnonzero((run % SPAN == 0) | (run == 1) & np.repeat(place[last] != place[first], size))
    count = np.diff(np.append(head, len(at)))
    return doc[head], at[head], count, own[head], place[head]


def suffix_array(t: np.ndarray, depth: int) -> np.ndarray:
    """Places of ``t`` ordered by the suffixes' first ``depth`` bytes, by Larsson-Sadakane refinement.

    Starts from groups of equal 8 bytes; each round sorts only groups that
    are not yet single, by the rank of the suffix that follows, and doubles
    the depth.
    """
    n = len(t)
    pad = np.concatenate([t, np.zeros(8, np.uint8)]).astype(np.uint64)
    key = np.zeros(n, np.uint64)
    for s in range(8):
        key = key << np.uint64(8) | pad[s : s + n]
    sa = np.argsort(key, kind="stable")
    k = key[sa]
    new = np.concatenate([[True], k[1:] != k[:-1]])
    rank = np.empty(n, np.int64)
    rank[sa] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    todo, h = np.arange(n), 8
    while h < depth:
        single = new & np.append(new[1:], True)
        todo = todo[~single]
        if not len(todo):
            break
        own = sa[todo]
        after = own + h
        key2 = rank[own] * (n + 1) + np.where(after < n, rank[np.minimum(after, n - 1)] + 1, 0)
        order = np.argsort(key2, kind="stable")
        sa[todo], k = own[order], key2[order]
        new = np.concatenate([[True], k[1:] != k[:-1]])
        rank[sa[todo]] = np.maximum.accumulate(np.where(new, todo, 0))
        h *= 2
    return sa


def common_prefixes(t: np.ndarray, sa: np.ndarray, most: int, lane: int = 64) -> np.ndarray:
    """Bytes that each suffix has in common with the one before it in ``sa``, at most ``most``.

    Kasai's recurrence in text order, in lanes: stretches of ``lane`` places
    go on from place to place at the same time, each from one less than the
    place before it.
    """
    n = len(t)
    before = np.full(n, -1)
    before[sa[1:]] = sa[:-1]
    pad = np.concatenate([t, np.zeros(most + 16, np.uint8)])
    words = np.zeros(n + most + 8, np.uint64)
    for s in range(8):
        words |= pad[s : s + len(words)].astype(np.uint64) << np.uint64(8 * s)
    plcp = np.zeros(n, np.int64)
    for j in range(lane):
        i = np.arange(j, n, lane)
        p = before[i]
        got = np.maximum(plcp[i - 1] - 1, 0) if j else np.zeros(len(i), np.int64)
        got[p < 0] = 0
        live = np.flatnonzero((p >= 0) & (got < most))
        while len(live):
            a, q, g = i[live], p[live], got[live]
            x = words[a + g] ^ words[q + g]
            same = np.where(x == 0, 8, (x[:, None].view(np.uint8).reshape(-1, 8) != 0).argmax(1))
            g = np.minimum(np.minimum(g + same, most), n - np.maximum(a, q))
            got[live] = g
            live = live[(same == 8) & (g < most) & (g < n - np.maximum(a, q))]
        plcp[i] = got
    return plcp[sa]


_WINDOW = np.dtype([("h1", "<u8"), ("h2", "<u8"), ("k1", "<i8"), ("k2", "<i8"), ("at", "<i8")])


def _runs(k1: np.ndarray, k2: np.ndarray, at: np.ndarray) -> pd.DataFrame:
    """Single windows as runs of consecutive ones."""
    order = np.lexsort((at, k2, k1))
    k1, k2, at = k1[order], k2[order], at[order]
    new = np.concatenate([[True], (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1]) | (at[1:] != at[:-1] + 1)])[: len(at)]
    head = np.flatnonzero(new)
    return pd.DataFrame({"k1": k1[head], "k2": k2[head], "at": at[head], "n": np.diff(np.append(head, len(at))).astype(np.int64)})


def repeated_windows(texts: list[bytes], length: int) -> list[np.ndarray]:
    """For each text, which of its windows is repeated among the texts: one suffix array over them."""
    t, starts, lens = joined(texts)
    sa = suffix_array(t, len(t))  # in full: Kasai's recurrence needs the order of ties too
    group = np.cumsum(common_prefixes(t, sa, length) < length)
    window = np.zeros(len(t), bool)
    window[ranges(starts, np.maximum(lens - length + 1, 0))] = True
    real = window[sa]
    often = np.bincount(group[real], minlength=group[-1] + 1 if len(group) else 1) > 1
    repeated = np.zeros(len(t), bool)
    repeated[sa] = often[group] & real
    return [repeated[s : s + max(0, n - length + 1)] for s, n in zip(starts.tolist(), lens.tolist(), strict=True)]


def _shard(pdf: pd.DataFrame, length: int, buckets: int) -> pd.DataFrame:
    """Repeated windows of a shard's spans (kind 0), and the runs that other shards must see (kind 1)."""
    pdf = pdf.sort_values(["g", "s"])
    texts = pdf["b"].tolist()
    got = repeated_windows(texts, length)
    n = np.array([len(x) for x in got])
    flat, offset = np.concatenate(got), ranges(np.zeros(len(n)), n)
    col = lambda c: np.repeat(pdf[c].to_numpy(), n)
    k1, k2, at, once = col("k1"), col("k2"), col("at") + offset, col("c") == 1
    out = [_runs(k1[m], k2[m], at[m]).assign(kind=0, bucket=0, blob=None) for m in [flat & once]]
    if (split := np.flatnonzero(pdf["salts"].to_numpy() > 1)).size:
        ends = np.cumsum(n)
        rows = ranges(ends[split] - n[split], n[split])
        fp = b"".join(xxhash.xxh3_128_digest(texts[i][x : x + length]) for i in split.tolist() for x in range(n[i]))
        own = np.zeros(len(rows), _WINDOW)
        own["h1"], own["h2"] = np.frombuffer(fp, "<u8").reshape(-1, 2).T
        own["k1"], own["k2"], own["at"] = k1[rows], k2[rows], np.where(flat[rows] | ~once[rows], -1, at[rows])  # -1: marked already
        own = own[np.lexsort((own["h2"], own["h1"]))]
        own = own[np.concatenate([[True], (own["h1"][1:] != own["h1"][:-1]) | (own["h2"][1:] != own["h2"][:-1])])]
        bucket = (own["h1"] % np.uint64(buckets)).astype(int)
        blobs = [own[bucket == k].tobytes() for k in range(buckets)]
        out.append(pd.DataFrame({"kind": 1, "k1": 0, "k2": 0, "at": 0, "n": 0, "bucket": range(buckets), "blob": blobs}))
    return pd.concat(out)[["kind", "k1", "k2", "at", "n", "bucket", "blob"]]


def _merge(pdf: pd.DataFrame) -> pd.DataFrame:
    """Windows of a range of fingerprints that more than one shard has.

    Runs are merged pairwise, so that each is looked up in another of its
    size: what two runs share is repeated, and the merged run goes on.
    """
    runs = [np.frombuffer(x, _WINDOW) for x in pdf["blob"]]
    found = []
    while len(runs) > 1:
        merged = []
        for a, b in zip(runs[::2], [*runs[1::2], None][: len(runs[::2])], strict=True):
            if b is None:
                merged.append(a)
                continue
            if not len(b) or not len(a):
                merged.append(a if len(a) else b)
                continue
            key = lambda x: np.ascontiguousarray(np.stack([x["h1"], x["h2"]], 1).astype(">u8")).view("S16").ravel()
            ka, kb = key(a), key(b)
            place = np.searchsorted(ka, kb)
            same = ka[np.minimum(place, len(ka) - 1)] == kb
            a = a.copy()
            found += [b[same], a[place[same]]]
            a["at"][place[same]] = -1
            rest = np.concatenate([a, b[~same]])
            merged.append(rest[np.lexsort((rest["h2"], rest["h1"]))])
        runs = merged
    all_ = np.concatenate(found) if found else np.zeros(0, _WINDOW)
    all_ = all_[all_["at"] >= 0]
    return _runs(all_["k1"], all_["k2"], all_["at"])


def _cover(runs: list[tuple[int, int]], length: int) -> list[list[int]]:
    """Maximal byte ranges covered by runs of windows (first, number)."""
    out: list[list[int]] = []
    for a, n in sorted(runs):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], a + n - 1 + length)
        else:
            out.append([a, a + n - 1 + length])
    return out


def remove_repeats(docs: DataFrame, length: int = LENGTH, shard_spans: int = SHARD_SPANS, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept) for every row; kept is null where nothing goes."""
    spark = docs.sparkSession
    bounded_batches(spark)
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", text.alias("t")).withColumns({"k1": F.xxhash64("doc_id", "t"), "k2": F.xxhash64("t", F.lit(1), "doc_id")})

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts, k1, k2 = pdf["b"].tolist(), pdf["k1"].to_numpy(), pdf["k2"].to_numpy()
            # a very long text is scanned in stretches that share length - 1 bytes
            parts = [(i, a) for i, x in enumerate(texts) for a in range(0, max(1, len(x) - length + 1), STRETCH)]
            pieces = [texts[i][a : a + STRETCH + length - 1] for i, a in parts]
            row, base = np.array(parts, np.int64).reshape(-1, 2).T
            for lo, hi in slices(pieces):
                b, starts, lens = joined(pieces[lo:hi])
                doc, at, n, code, place = anchors(b, starts, lens, length)
                raw, own, end = b.tobytes(), at.tolist(), (at + n - 1 + length).tolist()
                s = np.fromiter((xxhash.xxh3_64_intdigest(raw[x:y], p) for x, y, p in zip(own, end, (place - at).tolist(), strict=True)), np.uint64, len(own))
                r = row[lo + doc]
                yield pd.DataFrame({"g": code.view(np.int64), "s": s.view(np.int64), "k1": k1[r], "k2": k2[r], "at": at - starts[doc] + base[lo + doc], "n": n})

    spans = rows.select("k1", "k2", F.col("t").cast("binary").alias("b")).where(F.octet_length("b") >= length)
    spans = spans.mapInPandas(scan, "g long, s long, k1 long, k2 long, at long, n long")
    often = written(spans.groupBy("g").agg(F.count("*").alias("c")).where("c > 1").select("g"), "anchors")
    hot = written(spans.join(often, "g"), "spans")
    kinds = written(hot.groupBy("g", "s").agg(F.count("*").alias("c"), F.min(F.struct("k1", "k2", "at", "n")).alias("o")), "kinds")
    whole = hot.join(kinds.where("c > 1").select("g", "s"), ["g", "s"]).select("k1", "k2", "at", "n")
    groups = kinds.groupBy("g").agg(F.count("*").alias("m")).where("m > 1")
    probes = written(kinds.join(groups, "g").select("g", "s", "c", "m", "o.*"), "probes")
    total = probes.agg(F.sum(F.col("n") + length).alias("b")).collect()[0].b or 0
    shards = max(1, math.ceil(total / shard_bytes))

    probe = F.struct("at", "n", "g", "s", "c", F.ceil(F.col("m") / F.lit(shard_spans)).alias("salts"))
    lists = whole.select("k1", "k2", F.struct("at", "n").alias("w"), F.lit(None).cast("struct<at:bigint,n:bigint,g:bigint,s:bigint,c:bigint,salts:bigint>").alias("p"))
    lists = lists.union(probes.select("k1", "k2", F.lit(None).cast("struct<at:bigint,n:bigint>"), probe))
    # both sets of a text are bounded by its own length, also where many rows are equal
    lists = written(lists.groupBy("k1", "k2").agg(F.collect_set("w").alias("w"), F.collect_set("p").alias("p")), "marks")
    held = rows.join(lists, ["k1", "k2"], "left").select(
        "doc_id", "k1", "k2", "w", "p", F.octet_length("t").cast("long").alias("n_bytes"),
        F.when(F.col("w").isNull(), F.sha2("t", 256)).alias("sha"), F.when(F.col("w").isNotNull(), F.col("t").cast("binary")).alias("b"),
    )
    held = written(held, "held")

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = [(x["g"], x["s"], x["c"], x["salts"], k1, k2, x["at"], b[x["at"] : x["at"] + x["n"] - 1 + length]) for k1, k2, p, b in zip(pdf["k1"], pdf["k2"], pdf["p"], pdf["b"], strict=True) for x in p]
            yield pd.DataFrame(out, columns=["g", "s", "c", "salts", "k1", "k2", "at", "b"])

    # rows that are equal in doc_id and text hold the same probes; one of them is enough
    bytes_ = held.where("size(p) > 0").select("k1", "k2", "p", "b").mapInPandas(cut, "g long, s long, c long, salts long, k1 long, k2 long, at long, b binary")
    shard = F.pmod(F.xxhash64("g", F.pmod("s", "salts")), F.lit(shards)).alias("shard")
    sorted_ = bytes_.select("*", shard).groupBy("shard").applyInPandas(lambda pdf: _shard(pdf.drop_duplicates(["g", "s"]), length, shards), "kind int, k1 long, k2 long, at long, n long, bucket int, blob binary")
    sorted_ = written(sorted_, "shards")
    merged = sorted_.where("kind = 1 and length(blob) > 0").select("bucket", "blob").groupBy("bucket").applyInPandas(_merge, "k1 long, k2 long, at long, n long")
    more = sorted_.where("kind = 0").select("k1", "k2", "at", "n").union(merged)
    more = more.groupBy("k1", "k2").agg(F.collect_list(F.struct("at", "n")).alias("more"))

    @F.pandas_udf("n_removed long, n_spans long, sha string, kept binary")
    def drop(b: pd.Series, w: pd.Series, more: pd.Series) -> pd.DataFrame:
        out = []
        for raw, x, y in zip(b, w, more, strict=True):
            if raw is None:
                out.append((0, 0, None, None))
                continue
            gone = _cover([(r["at"], r["n"]) for z in (x, y) if z is not None for r in z], length)
            kept = b"".join(raw[p:q] for p, q in zip([0, *(e for _, e in gone)], [*(s for s, _ in gone), len(raw)], strict=True))
            out.append((len(raw) - len(kept), len(gone), hashlib.sha256(kept).hexdigest(), kept))
        return pd.DataFrame(out, columns=["n_removed", "n_spans", "sha", "kept"])

    got = held.join(more, ["k1", "k2"], "left").withColumn("r", drop("b", "w", "more"))
    return got.select("doc_id", "n_bytes", "r.n_removed", "r.n_spans", F.coalesce("r.sha", "sha").alias("kept_sha256"), "r.kept")
