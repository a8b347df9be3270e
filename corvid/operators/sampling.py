"""Reproducible sampling and splitting.

Every row's fate depends only on md5 of (seed, key): no dependence on
partitioning or retry order, disjoint parts by construction, one narrow
pass (no shuffle), and an exact SQL twin.  Thresholds are integers on the
32-bit hash so both engines compare the same numbers.  Samples, strata and
folds salt the seed, so a sample of a part of a split keeps its rate.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corvid.functions.hashing import MD5_SPACE, hash_key, hash_value, salted  # noqa: F401  (re-exported)
from corvid.operators import cuts, selection, setops
from corvid.session import cut_lineage


#: Classes up to this number are a table of a few MB at most.
BROADCAST_CLASSES = 100_000


def threshold(fraction: float) -> int:
    """Integer cut on the hash for a keep-rate (rows with hash < t are kept)."""
    return int(min(max(fraction, 0.0), 1.0) * MD5_SPACE)


def split_thresholds(weights: Sequence[float]) -> list[int]:
    total = float(sum(weights))
    acc, out = 0.0, []
    for w in weights:
        acc += w / total
        out.append(threshold(acc))
    out[-1] = MD5_SPACE
    return out


def hash_split(
    df: DataFrame,
    key_cols,
    weights: Sequence[float],
    seed: int | None = None,
    labels: Sequence[str] | None = None,
    out_col: str = "split",
) -> DataFrame:
    """Label every row with its part ('train'/'test' for two weights)."""
    labels = list(labels or (["train", "test"] if len(weights) == 2 else [str(i) for i in range(len(weights))]))
    h = hash_value(key_cols, seed)
    expr = None
    for t, lab in zip(split_thresholds(weights), labels):
        expr = F.when(h < F.lit(t), F.lit(lab)) if expr is None else expr.when(h < F.lit(t), F.lit(lab))
    return df.withColumn(out_col, expr)


def random_split(df: DataFrame, key_cols, weights: Sequence[float], seed: int | None = None) -> list[DataFrame]:
    """``randomSplit`` with stable, partition-independent membership."""
    marked = hash_split(df, key_cols, weights, seed, labels=[str(i) for i in range(len(weights))], out_col="_part")
    return [marked.filter(F.col("_part") == str(i)).drop("_part") for i in range(len(weights))]


def hash_sample(df: DataFrame, key_cols, fraction: float, seed: int | None = None) -> DataFrame:
    """Bernoulli sample: each row kept with probability ``fraction``."""
    return df.filter(hash_value(key_cols, salted(seed, "sample")) < F.lit(threshold(fraction)))


def stratified_sample(
    df: DataFrame, key_cols, strat_col: str, fractions: Mapping, seed: int | None = None
) -> DataFrame:
    """``sampleBy``: keep-rate per stratum; strata not listed are dropped."""
    rate = None
    for cls, f in fractions.items():
        cond = F.col(strat_col) == F.lit(cls)
        rate = F.when(cond, F.lit(threshold(f))) if rate is None else rate.when(cond, F.lit(threshold(f)))
    return df.filter(hash_value(key_cols, salted(seed, "strata")) < rate.otherwise(F.lit(0)))


def stratified_split(
    df: DataFrame,
    key_cols,
    strat_col: str,
    weights: Sequence[float],
    seed: int | None = None,
    exact: bool = False,
    out_col: str = "split",
) -> DataFrame:
    """Train/test split that keeps class shares.

    Default: the hash threshold within every class (shares exact in
    expectation, one narrow pass).  ``exact=True``: per class, exactly
    ``int(w * n_class)`` rows go to the first part, the ones with the
    smallest (hash, key), copies of a key being interchangeable.  Two
    histograms of the hash, grouped by class, find every class's cut at
    once (see ``_class_cuts``), whatever the number of classes; no window
    spans a class's rows, which would put a class in one task.
    """
    if not exact:
        return hash_split(df, key_cols, weights, seed, out_col=out_col)
    if len(weights) != 2:
        raise ValueError("exact stratified split takes two weights")
    frac = weights[0] / float(sum(weights))
    cols = [key_cols] if isinstance(key_cols, str) else list(key_cols)
    hashed = df.withColumn("_c", F.col(strat_col)).withColumn("_h", hash_value(cols, seed)).withColumn("_k", F.struct(*cols))
    keyed = hashed.select("_c", "_h", "_k").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        cuts, n_classes = _class_cuts(keyed, frac)
    finally:
        keyed.unpersist()
    marked = _with_class(hashed, cuts, n_classes)
    at = (F.col("_h") == F.col("_cut_h")) & F.col("_k").eqNullSafe(F.col("_cut_k"))
    tied = at & (F.col("_cut_r") < F.col("_cut_n"))
    first = (F.col("_h") < F.col("_cut_h")) | ((F.col("_h") == F.col("_cut_h")) & (F.col("_k") < F.col("_cut_k"))) | at
    rest = marked.filter(~tied).withColumn("_first", first)
    ties = selection.mark_first(marked.filter(tied), "_c", F.col("_cut_r"), "_first")
    out = rest.unionByName(ties).withColumn(out_col, F.when(F.col("_first"), "train").otherwise("test"))
    return out.select(*df.columns, out_col)


def _with_class(rows: DataFrame, table: DataFrame, n_classes: int) -> DataFrame:
    """``rows`` with the columns of a table of one row a class.

    Up to ``BROADCAST_CLASSES`` classes the table goes out, so the rows do
    not move; beyond, it is joined by exchange, with skew left to AQE.
    """
    table = table.withColumnRenamed("_c", "_table_c")
    table = F.broadcast(table) if n_classes <= BROADCAST_CLASSES else table
    return rows.join(table, rows["_c"].eqNullSafe(table["_table_c"])).drop("_table_c")


def _class_cuts(keyed: DataFrame, frac: float) -> tuple[DataFrame, int]:
    """(_c, _cut_h, _cut_k, _cut_n, _cut_r) per class, and the number of classes.

    The first ``int(frac * n)`` rows of a class in (hash, key) order are
    those below (_cut_h, _cut_k) and ``_cut_r`` of the ``_cut_n`` rows at
    it.  Three rounds narrow it down for all classes together: counts by
    the hash's upper 16 bits, by the lower 16 within the upper part found,
    and by key within the hash found.  Only counts are shuffled, at most
    65,536 a class and round; the last round holds the few keys of one hash.
    """

    def narrowed(counts: DataFrame, part: str) -> DataFrame:
        order = Window.partitionBy("_c").orderBy(part)
        upto = counts.withColumn("_upto", F.sum("_n").over(order))
        hit = (F.col("_upto") >= F.col("_r")) & (F.col("_upto") - F.col("_n") < F.col("_r"))
        return cut_lineage(upto.filter(hit).withColumn("_r", F.col("_r") - F.col("_upto") + F.col("_n")).drop("_upto"))

    def count_by(rows: DataFrame, part: Column, *carry: str) -> DataFrame:
        return rows.groupBy("_c", part.alias("_part"), *carry).agg(F.count(F.lit(1)).alias("_n"))

    upper, lower = F.shiftright("_h", 16), F.col("_h").bitwiseAND(F.lit(0xFFFF))
    counts = cut_lineage(count_by(keyed, upper))
    sizes = counts.groupBy("_c").agg(F.floor(F.lit(frac) * F.sum("_n")).cast("long").alias("_r"))
    n_classes = sizes.count()
    # a class of which no row goes to the first part has no cut row: it takes the cut -1
    one = narrowed(_with_class(counts, sizes, n_classes), "_part").withColumnRenamed("_part", "_up").drop("_n")
    two = narrowed(count_by(_with_class(keyed, one, n_classes).filter(upper == F.col("_up")), lower, "_up", "_r"), "_part")
    two = two.select("_c", (F.shiftleft("_up", 16) + F.col("_part")).alias("_cut_h"), "_r")
    three = narrowed(count_by(_with_class(keyed, two, n_classes).filter(F.col("_h") == F.col("_cut_h")), F.col("_k"), "_cut_h", "_r"), "_part")
    found = three.select(F.col("_c").alias("_cc"), "_cut_h", F.col("_part").alias("_cut_k"), F.col("_n").alias("_cut_n"), F.col("_r").alias("_cut_r"))
    cuts = sizes.join(found, sizes["_c"].eqNullSafe(found["_cc"]), "left")
    return cuts.select("_c", F.coalesce("_cut_h", F.lit(-1)).alias("_cut_h"), "_cut_k", F.coalesce("_cut_n", F.lit(0)).alias("_cut_n"), F.coalesce("_cut_r", F.lit(0)).alias("_cut_r")), n_classes


def kfold(df: DataFrame, key_cols, k: int, seed: int | None = None, out_col: str = "fold") -> DataFrame:
    """Fold number in [0, k) from the hash (usable as ``foldCol``)."""
    return df.withColumn(out_col, F.pmod(hash_value(key_cols, salted(seed, "fold")), F.lit(int(k))).cast("int"))


def class_counts(df: DataFrame, label: str) -> DataFrame:
    """(label, n)."""
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))


def _class_totals(counts: DataFrame) -> tuple[int, int]:
    """(rows, classes): one small aggregate job, two scalars on the driver."""
    row = counts.agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("classes")).first()
    return int(row["rows"] or 0), int(row["classes"] or 0)


def class_proportions(df: DataFrame, label: str) -> DataFrame:
    """(label, n, share): share of all rows per class.

    The total is a scalar folded into the plan as a literal, so no window
    or join spans the class table, whatever the number of classes.  The
    class table is checkpointed: the input is aggregated once.
    """
    counts = cut_lineage(class_counts(df, label))
    total, _ = _class_totals(counts)
    return counts.select(label, "n", (F.col("n") / F.lit(float(total))).alias("share"))


def class_weights(df: DataFrame, label: str, out_col: str = "classWeights") -> DataFrame:
    """Balanced weights n / (k * n_class) attached to every row.

    The class table (one row a class) is checkpointed and counted: up to
    ``BROADCAST_CLASSES`` classes it is broadcast, so the rows do not move;
    beyond that it is joined by exchange, where no class is hot.  A NULL
    class has a weight like any other.
    """
    counts = cut_lineage(class_counts(df, label))
    total, k = _class_totals(counts)
    weights = counts.select(label, (F.lit(float(total)) / (F.lit(float(k)) * F.col("n"))).alias(out_col))
    weights = weights.withColumnRenamed(label, "_class")
    if k <= BROADCAST_CLASSES:
        weights = F.broadcast(weights)
    weighted = df.join(weights, df[label].eqNullSafe(weights["_class"]), "left").drop("_class")
    return weighted.select(label, *[c for c in df.columns if c != label], out_col)


def flag_name(fraction: float, prefix: str = "train_") -> str:
    """``train_40`` for 0.4, ``train_40_5`` for 0.405: other fractions, other names."""
    return f"{prefix}{round(fraction * 100, 10):g}".replace(".", "_")


def chrono_split(
    df: DataFrame,
    order_cols: Sequence[str],
    fractions: Sequence[float],
    prefix: str = "train_",
    persist_keys: bool = True,
) -> DataFrame:
    """Mark the first ``int(f * n)`` rows in (time, tie-break...) order, per fraction.

    Adds one boolean column per fraction (``train_40`` for 0.4).  Exact and
    sort-free; all cuts are found in one search, whose passes do not grow
    with the number of fractions (see :mod:`corvid.operators.cuts`).  The
    order columns should make the order total, the remaining ties are
    identical rows.

    ``persist_keys`` caches the order columns for the search rounds.  For a
    source partitioned or clustered by time, ``False`` is cheaper at scale:
    every round after the first filters on a narrow time range, which
    prunes partitions and row groups at the scan.
    """
    keyed = selection.key_frame(df, order_cols)
    if persist_keys:
        keyed = keyed.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        n = keyed.count()
        ranks = {flag_name(f, prefix): selection.head_count(n, f) for f in fractions}
        _, found = cuts.search(keyed, list(ranks.values()))
    finally:
        if persist_keys:
            keyed.unpersist()
    return cuts.mark_cuts(df, order_cols, ranks, n, found)


def except_distinct(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of ``left`` not in ``right``, deduplicated (SQL EXCEPT DISTINCT)."""
    return left.subtract(right)


def except_digest(left: DataFrame, right: DataFrame) -> DataFrame:
    """:func:`except_distinct` by row digests: whole rows are compared only where a digest occurs on both sides."""
    return setops.except_digest(left, right)


def union_parts(parts: Sequence[DataFrame]) -> DataFrame:
    """Bag union by column name."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
