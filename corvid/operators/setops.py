"""EXCEPT by row digests.

``subtract`` shuffles the whole rows of both sides.  Here rows are compared by
128-bit digests first: a Bloom filter of the smaller side's digests, a table
of 64-bit words, is held against the other side; what passes is compared by
digest, 16 bytes a row; and only rows whose digest occurs on both sides are
compared in full.  Digests only decide that rows differ, never that they are
equal, so the result is that of EXCEPT DISTINCT whatever the hashes do.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvid.session import cut_lineage, persisted

#: Bits of the filter for each digest, and words (of 64 bits) at most: such a table is a few MB.
BITS, MOST_WORDS, SET_BITS = 16, 1 << 18, 3


def row_digest(columns: list[str]) -> list[Column]:
    """Two 64-bit hashes of a row, with different seeds; equal rows (NULL equal to NULL) have equal ones."""
    return [F.xxhash64(F.lit(seed), *columns).alias(f"_h{seed}") for seed in (1, 2)]


def _word(words: int) -> Column:
    return F.pmod("_h1", F.lit(words)).cast("int")


def _mask() -> Column:
    """``SET_BITS`` bits of a word, from the second hash."""
    out = F.lit(0).cast("long")
    for i in range(SET_BITS):
        bit = F.shiftrightunsigned("_h2", 6 * i).bitwiseAND(F.lit(63)).cast("int")
        out = out.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), bit))
    return out


def bloom(digests: DataFrame, words: int) -> DataFrame:
    """(word, bits): filters of parts of the rows merge by ``bit_or``."""
    return digests.groupBy(_word(words).alias("_word")).agg(F.bit_or(_mask()).alias("_bits"))


def may_match(rows: DataFrame, table: DataFrame, words: int) -> DataFrame:
    """The rows (with ``_h1``, ``_h2``) whose digest may be in the filter.

    The filter has ``words`` rows at most, whose number is bounded, so it goes
    out by broadcast and the rows do not move.
    """
    held = rows.withColumn("_at", _word(words)).join(F.broadcast(table), F.col("_at") == F.col("_word"))
    return held.where(F.col("_bits").bitwiseAND(_mask()) == _mask()).drop("_at", "_word", "_bits")


def except_digest(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of ``left`` not in ``right``, deduplicated: the same rows as ``left.subtract(right)``.

    Columns go by position, as in SQL.  Each side is read once for its
    distinct digests, which are kept until the shared ones are known; then
    ``left`` is read twice and ``right`` once.  ``left``'s distinct rows
    without a partner are shuffled once, by digest, after map-side
    deduplication, and ``right``'s rows only where a digest occurs in both.
    """
    names = left.columns
    right = right.toDF(*names)
    a, b = (d.select(*names, *row_digest(names)) for d in (left, right))
    pair = ["_h1", "_h2"]
    with persisted(a.select(*pair).distinct()) as own, persisted(b.select(*pair).distinct()) as other:
        n_own, n_other = own.count(), other.count()
        words = max(1, min(MOST_WORDS, min(n_own, n_other) * BITS // 64 + 1))
        small, large = (own, other) if n_own <= n_other else (other, own)
        passed = may_match(large, bloom(small, words), words)
        shared = cut_lineage(passed.join(small, pair, "left_semi").withColumnRenamed("_h1", "_s1").withColumnRenamed("_h2", "_s2"))
    is_shared = (F.col("_h1") == F.col("_s1")) & (F.col("_h2") == F.col("_s2"))
    # equal rows have equal digests: rows of digests that only one side has need no partner
    alone = a.join(shared, is_shared, "left_anti").dropDuplicates(names).select(*names)
    both = [d.join(shared, is_shared, "left_semi").select(*names) for d in (a, b)]
    return alone.union(both[0].subtract(both[1]))
