"""Embedding near-dedup on a pivot-permutation index.

Pivots are drawn for each vector length that more than ``block`` vectors
have: up to ``n_pivots`` of a sample of about ``SAMPLE`` times as many,
picked by hash, each with a cosine below ``APART`` to those before it.  So a
dense group has few pivots, however many of the vectors it holds, and the
order of its members' nearest pivots does not hang on small differences.
Every vector is described by its ``depth``
nearest pivots.  It is posted in the inverted lists, by label, of its
``posted`` rarest pivots among these: two vectors that share ``share`` or
more of their ``depth`` nearest pivots meet in a list (posted = depth -
share + 1).  A list counts the shared pivots of its pairs, and cosines of
pairs with ``share`` or more decide, in double precision.  A pair is
counted in one list only, that of the rarest pivot they share.  Vectors
of a length with fewer than ``depth`` pivots (one, a zero, where none are
drawn) are in one list for each label, and all their pairs are compared.

Equal vectors of a label are one vector with a count.  Lists over
``block`` vectors are cut into blocks, and the work goes out by pairs of
blocks, so no group meets in one task.  Lists return a count of links for
each vector and a spanning forest of the links, never the links.

Defined cases: vectors that are null, zero or hold null or non-finite
components, and those with a null label, link with nothing and are their
own component; vectors of different length never link; repeated rows of
one vec_id are one vector each, linked with each other; a null vec_id has
a null component.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvid.llm.common import bounded_batches, connected_components, written

SAMPLE, APART = 8, 0.9


def _dense(column: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(x, np.float64) for x in column]) if len(column) else np.zeros((0, 1))


def normalized(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(vec_id, l, h, e): the SHA-256 of each vector's components, and the vector at length 1.

    In one pass over the components: divided by the largest first, so that
    no square overflows or vanishes.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        e = batch.column("e")
        lens = pc.list_value_length(e).to_numpy(zero_copy_only=False)
        flat = e.flatten().to_numpy(zero_copy_only=False) + 0.0  # -0.0 is 0.0
        ends = np.cumsum(lens)
        starts = ends - lens
        raw = flat.tobytes()
        digests = [hashlib.sha256(raw[8 * a : 8 * b]).digest() for a, b in zip(starts.tolist(), ends.tolist())]
        flat = flat / np.repeat(np.maximum.reduceat(np.abs(flat), starts), lens)
        flat /= np.repeat(np.sqrt(np.add.reduceat(flat * flat, starts)), lens)
        whole = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(flat))
        yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("l"), pa.array(digests, pa.binary()), whole], ["vec_id", "l", "h", "e"])


def forest(a: np.ndarray, b: np.ndarray) -> tuple[list[int], list[int]]:
    """A spanning forest of the pairs (a, b)."""
    up: dict[int, int] = {}

    def root(x: int) -> int:
        while (y := up.get(x, x)) != x:
            up[x] = x = up.get(y, y)
        return x

    out: tuple[list[int], list[int]] = ([], [])
    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        if (p := root(x)) != (q := root(y)):
            up[max(p, q)] = min(p, q)
            out[0].append(x)
            out[1].append(y)
    return out


def spread(e: np.ndarray, most: int) -> np.ndarray:
    """The first ``most`` of the unit vectors whose cosine to each one taken before is below APART."""
    taken = np.zeros((0, e.shape[1]))
    for x in e:
        if len(taken) < most and not (taken @ x >= APART).any():
            taken = np.vstack([taken, x])
    return taken


def links(vectors: DataFrame, least: float = 0.98, n_pivots: int = 256, depth: int = 12, share: int = 4, block: int = 512) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Classes (vec_id, rep, n_equal), direct links of each class's representative
    counted in vectors (rep, n), and a spanning forest (a, b) of the classes' links."""
    spark = vectors.sparkSession
    bounded_batches(spark)
    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").alias("l"), F.col("embedding").cast("array<double>").alias("e"))
    sound = F.expr("e is not null and l is not null and vec_id is not null and size(e) > 0 and forall(e, x -> x is not null and not isnan(x) and abs(x) < double('inf')) and exists(e, x -> x <> 0)")
    v = v.where(sound)
    v = v.mapInArrow(normalized, f"vec_id long, l {v.schema['l'].dataType.simpleString()}, h binary, e array<double>")
    classes = v.groupBy("l", "h").agg(F.min("vec_id").alias("rep"), F.count("*").alias("n"), F.first("e").alias("e"))
    reps = written(classes.withColumn("dim", F.size("e")), "vectors")
    members = v.select("vec_id", "l", "h").join(reps.select("l", "h", "rep", "n"), ["l", "h"]).select("vec_id", "rep", F.col("n").alias("n_equal"))

    held = reps.groupBy("dim").agg(F.count("*").alias("held")).where(F.col("held") > block)  # a row a length
    sample = reps.select("dim", "e", F.xxhash64("h").alias("at")).join(F.broadcast(held), "dim").where(F.pmod("at", "held") < SAMPLE * n_pivots)
    drawn: dict[int, list] = {}
    for r in sorted(sample.select("dim", "e", "at").collect(), key=lambda r: r["at"]):
        drawn.setdefault(r.dim, []).append(r.e)
    pivots = {d: spread(np.array(x), n_pivots) for d, x in drawn.items()}
    posted = depth - share + 1

    def describe(batches):
        for pdf in batches:
            near: list = [None] * len(pdf)
            for d, rows in pdf.groupby("dim").indices.items():
                p = pivots.get(d, np.zeros((1, d)))
                cos = _dense(pdf["e"].iloc[rows]) @ p.T
                order = np.argsort(-cos, axis=1, kind="stable")[:, :depth]
                for i, o in zip(rows, order, strict=True):
                    near[i] = o.tolist()
            yield pd.DataFrame({"l": pdf["l"], "dim": pdf["dim"], "rep": pdf["rep"], "n": pdf["n"], "e": pdf["e"], "near": near})

    l_type = reps.schema["l"].dataType.simpleString()
    described = written(reps.select("l", "dim", "rep", "n", "e").mapInPandas(describe, f"l {l_type}, dim int, rep long, n long, e array<double>, near array<int>"), "described")
    # the lists' lengths: at most labels x pivots rows, joined by Spark
    sizes = described.select("l", "dim", F.explode("near").alias("pivot")).groupBy("l", "dim", "pivot").agg(F.count("*").alias("c"))
    ordered = described.select("l", "dim", "rep", F.explode("near").alias("pivot")).join(sizes, ["l", "dim", "pivot"])
    ordered = ordered.groupBy("l", "dim", "rep").agg(F.sort_array(F.collect_list(F.struct("c", "pivot"))).alias("near"))  # at most depth rows a vector
    rows = described.select("l", "dim", "rep", "n", "e").join(ordered, ["l", "dim", "rep"])
    rows = rows.withColumn("near", F.expr(f"transform(near, x -> x.c * {n_pivots} + x.pivot)"))
    post = rows.select("*", F.explode(F.expr(f"slice(near, 1, if(size(near) = {depth}, {posted}, 1))")).alias("list")).withColumn("c", F.floor(F.col("list") / n_pivots)).where("c > 1")
    blocks = post.withColumn("blocks", F.ceil(F.col("c") / F.lit(block)).cast("int")).withColumn("own", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    # each pair of blocks (i <= j) of a list is a group; a block goes to every pair that it is in
    sent = blocks.withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)"))).withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other"))

    def scan(pdf: pd.DataFrame) -> pd.DataFrame:
        i, j, key = int(pdf["i"].iat[0]), int(pdf["j"].iat[0]), int(pdf["list"].iat[0])
        own, e, n, rep = pdf["own"].to_numpy(), _dense(pdf["e"]), pdf["n"].to_numpy(), pdf["rep"].to_numpy()
        near = np.stack(pdf["near"].to_numpy())
        used, place = np.unique(near, return_inverse=True)
        has = np.zeros((len(pdf), len(used)), np.float32)
        has[np.repeat(np.arange(len(pdf)), near.shape[1]), place.ravel()] = 1
        left, right = np.flatnonzero(own == i), np.flatnonzero(own == j)
        least_shared = share if near.shape[1] == depth else near.shape[1]
        # the list that counts a pair is the first that both are posted in
        before = has[:, used < key]
        hit = (has[left] @ has[right].T >= least_shared) & (before[left] @ before[right].T == 0)
        hit &= e[left] @ e[right].T >= least
        p, q = np.nonzero(hit)
        p, q = left[p], right[q]
        keep = rep[p] < rep[q] if i == j else np.ones(len(p), bool)
        p, q = p[keep], q[keep]
        total = np.bincount(p, n[q], len(pdf)) + np.bincount(q, n[p], len(pdf))
        a, b = forest(np.minimum(rep[p], rep[q]), np.maximum(rep[p], rep[q]))
        k = np.flatnonzero(total)
        return pd.DataFrame({"a": [*rep[k].tolist(), *a], "b": [*rep[k].tolist(), *b], "n": [*total[k].astype(int).tolist(), *[0] * len(a)]})

    found = written(sent.select("l", "dim", "list", "i", "j", "own", "rep", "n", "e", "near").groupBy("l", "dim", "list", "i", "j").applyInPandas(scan, "a long, b long, n long"), "links")
    return members, found.where("a = b").groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("n")), found.where("a <> b").select("a", "b")


def near_dedup(vectors: DataFrame, least: float = 0.98, **index: int) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``vectors``."""
    members, counts, edges = links(vectors, least, **index)
    component = connected_components(edges)
    got = members.join(counts, "rep", "left").join(component.withColumnRenamed("node", "rep"), "rep", "left")
    got = got.select(F.col("vec_id").alias("v"), (F.col("n_equal") - 1 + F.coalesce("n", F.lit(0))).alias("n"), F.coalesce("component", "rep").alias("c"))
    got = got.groupBy("v").agg(F.max("n").alias("n"), F.min("c").alias("c"))  # rows that share a vec_id
    rows = vectors.select("vec_id").join(got, F.col("vec_id") == F.col("v"), "left")
    return rows.select("vec_id", F.coalesce("n", F.lit(0)).alias("n_links"), F.coalesce("c", "vec_id").cast("long").alias("component_id")).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
