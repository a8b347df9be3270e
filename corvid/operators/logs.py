"""Access-log mining: per-country traffic, unique and top hosts, share with
rest, and day x hour visit grids.

All reports derive from one parse; callers that need several of them
should ``persist`` the parsed (or pre-aggregated) frame once instead of
rescanning the log per report.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvid.functions.logfmt import clf_columns, host_country, positional_columns
from corvid.operators.heavy import DEPTH, WIDTH, heavy_hitters
from corvid.operators.topk import add_rest_bucket, arg_max, top_n

# Fixed value: the countries of the reports (top-level DNS labels).
DEFAULT_COUNTRIES = ("de", "ca", "sg")
HOURS = 24


def parse(lines: DataFrame, value: str = "value") -> DataFrame:
    """CLF lines -> host, ts_text, day, hour, request, status, bytes, well_formed, country."""
    parsed = lines.select(*clf_columns(value))
    return parsed.withColumn("country", host_country("host"))


def parse_positional(lines: DataFrame, value: str = "value") -> DataFrame:
    """Split-on-space parse (fields by position) with the country label."""
    parsed = lines.select(*positional_columns(value))
    return parsed.withColumn("country", host_country("host"))


def _n(counts_col: str | None):
    """Row count, or the sum of a count column when the input is pre-aggregated."""
    return F.sum(counts_col) if counts_col else F.count(F.lit(1))


def hourly_counts(parsed: DataFrame, countries: Sequence[str] = DEFAULT_COUNTRIES) -> DataFrame:
    """(country, host, day, hour, requests): the one aggregate every report can reuse.

    Pass it with ``counts_col="requests"`` to the reports below; its size is
    bounded by hosts x days x 24, not by the number of log lines.
    """
    return by_country(parsed, countries).groupBy("country", "host", "day", "hour").agg(
        F.count(F.lit(1)).alias("requests")
    )


def write_parsed(
    parsed: DataFrame, path: str, mode: str = "errorifexists", countries: Sequence[str] = DEFAULT_COUNTRIES, other: str = "other"
) -> str:
    """Parse once, store as Parquet partitioned by country.

    Later country reports read only their partitions (partition pruning)
    and only the columns they use; text logs allow neither.  A host's last
    label can be anything, so hosts of no listed country share the
    partition ``other`` (the host itself is kept), and the rows are
    rebalanced by country first: adaptive execution splits the large
    partitions and joins the small ones by bytes, not one file a task.
    """
    listed = F.when(F.col("country").isin(list(countries)), F.col("country")).otherwise(F.lit(other))
    stored = parsed.withColumn("country", listed).hint("rebalance", F.col("country"))
    stored.write.mode(mode).partitionBy("country").parquet(path)
    return path


def store_bucketed(parsed: DataFrame, table: str, path: str, buckets: int = 256, countries: Sequence[str] = DEFAULT_COUNTRIES) -> DataFrame:
    """Store the listed countries' rows as a table in buckets by (country, host), sorted by them.

    Counts by host (C2, C3) and by host and hour (C4) then need no exchange
    of rows: equal hosts lie in one bucket, and a hot country in all of them.
    ``path`` is the table's folder; the session's catalog holds its name.
    Rows are dealt by the buckets' key first, so a bucket is one file.
    """
    rows = by_country(parsed, countries).repartition(buckets, "country", "host")
    rows.write.option("path", path).bucketBy(buckets, "country", "host").sortBy("country", "host").saveAsTable(table)
    return parsed.sparkSession.table(table)


def by_country(parsed: DataFrame, countries: Sequence[str] = DEFAULT_COUNTRIES) -> DataFrame:
    """Rows whose host ends in one of the country labels (classified once)."""
    return parsed.filter(F.col("country").isin(list(countries)))


def country_requests(
    parsed: DataFrame, countries: Sequence[str] = DEFAULT_COUNTRIES, counts_col: str | None = None
) -> DataFrame:
    """(country, requests): one aggregate instead of one count per country."""
    return by_country(parsed, countries).groupBy("country").agg(_n(counts_col).alias("requests"))


def country_unique_hosts(
    parsed: DataFrame, countries: Sequence[str] = DEFAULT_COUNTRIES, approx_rsd: float | None = None
) -> DataFrame:
    """(country, unique_hosts): exact by default.

    Exact counting shuffles the distinct (country, host) pairs once (map-side
    deduplicated); ``approx_rsd`` switches to HyperLogLog++ sketches that
    merge in fixed memory per country.
    """
    if approx_rsd is not None:
        agg = F.approx_count_distinct("host", rsd=approx_rsd)
    else:
        agg = F.count_distinct("host")
    return by_country(parsed, countries).groupBy("country").agg(agg.alias("unique_hosts"))


def country_summary(
    parsed: DataFrame, countries: Sequence[str] = DEFAULT_COUNTRIES, counts_col: str | None = None
) -> DataFrame:
    """(country, requests, unique_hosts) from the per-host aggregate."""
    hc = host_counts(parsed, countries, counts_col=counts_col)
    return hc.groupBy("country").agg(
        F.sum("requests").alias("requests"), F.count(F.lit(1)).alias("unique_hosts")
    )


def host_counts(
    parsed: DataFrame, countries: Sequence[str] = DEFAULT_COUNTRIES, dedup: bool = False, counts_col: str | None = None
) -> DataFrame:
    """(country, host, requests).  ``dedup`` counts distinct parsed rows."""
    rows = by_country(parsed, countries)
    if dedup:
        if counts_col:
            raise ValueError("dedup needs the parsed rows, not pre-aggregated counts")
        rows = rows.distinct()
    return rows.groupBy("country", "host").agg(_n(counts_col).alias("requests"))


def top_hosts(
    parsed: DataFrame,
    n: int = 9,
    countries: Sequence[str] = DEFAULT_COUNTRIES,
    dedup: bool = False,
    counts_col: str | None = None,
) -> DataFrame:
    """(country, rank, host, requests): n busiest hosts per country, host asc on ties."""
    hc = host_counts(parsed, countries, dedup, counts_col)
    return top_n(hc, n, ["requests", "host"], [True, False], ["country"]).select(
        "country", "rank", "host", "requests"
    )


def host_share(
    parsed: DataFrame, n: int = 9, countries: Sequence[str] = DEFAULT_COUNTRIES, counts_col: str | None = None
) -> DataFrame:
    """Top-n hosts and a 'Rest' slice per country with percentages."""
    hc = host_counts(parsed, countries, counts_col=counts_col)
    return add_rest_bucket(hc, n, "country", "host", "requests")


def top_host(
    parsed: DataFrame, countries: Sequence[str] = DEFAULT_COUNTRIES, counts_col: str | None = None
) -> DataFrame:
    """(country, host, requests) of the busiest host per country."""
    return arg_max(host_counts(parsed, countries, counts_col=counts_col), ["country"], "requests", "host")


def top_hosts_sketch(
    parsed: DataFrame,
    n: int = 9,
    countries: Sequence[str] = DEFAULT_COUNTRIES,
    counts_col: str | None = None,
    width: int = WIDTH,
    depth: int = DEPTH,
) -> DataFrame:
    """:func:`top_hosts`, by a frequency sketch: only hosts that may be among the first n are counted.

    For logs of many hosts; ``parsed`` is read three times, so it should be
    a stored table rather than text.
    """
    rows = by_country(parsed, countries)
    return heavy_hitters(rows, n, ["country"], "host", "requests", counts_col, width, depth)


#: Nominal entries of a host sketch, as a power of 2: up to so many hosts its count is exact.
SKETCH_LG = 16


def host_sketches(parsed: DataFrame, countries: Sequence[str] = DEFAULT_COUNTRIES, lg_entries: int = SKETCH_LG) -> DataFrame:
    """(country, day, hour, hosts): a theta sketch of the distinct hosts of every hour, to be stored.

    Up to ``2 ** lg_entries`` distinct hosts a union counts exactly; beyond,
    its relative standard error is about ``2 ** (-lg_entries / 2)``.
    """
    rows = by_country(parsed, countries).where(F.col("day").isNotNull() & F.col("hour").isNotNull())
    return rows.groupBy("country", "day", "hour").agg(F.theta_sketch_agg("host", lg_entries).alias("hosts"))


def unique_hosts_in_ranges(sketches: DataFrame, ranges: DataFrame, lg_entries: int = SKETCH_LG) -> DataFrame:
    """(country, first_day, last_day, unique_hosts) from stored sketches, without the log.

    ``ranges`` has a row (first_day, last_day) for each report.  A day meets
    the ranges that hold it; a country's hours are at most 31 x 24 sketches,
    united by partial aggregates.
    """
    days = sketches.groupBy("country", "day").agg(F.theta_union_agg("hosts", lg_entries).alias("hosts"))
    # (country, day) is 31 rows a country, ranges are the caller's list: the join is by range of days
    in_range = days.join(ranges, (F.col("day") >= F.col("first_day")) & (F.col("day") <= F.col("last_day")))
    united = in_range.groupBy("country", "first_day", "last_day").agg(F.theta_union_agg("hosts", lg_entries).alias("hosts"))
    return united.select("country", "first_day", "last_day", F.theta_sketch_estimate("hosts").cast("long").alias("unique_hosts"))


def _scope(
    parsed: DataFrame, countries: Sequence[str], by: str, counts_col: str | None = None
) -> tuple[DataFrame, list[str]]:
    rows = by_country(parsed, countries).filter(F.col("day").isNotNull() & F.col("hour").isNotNull())
    if by == "country":
        return rows, ["country"]
    if by == "top_host":
        # Semi-join on the one-row-per-country arg-max: no driver round trip.
        best = top_host(parsed, countries, counts_col).select("country", "host")
        return rows.join(best, ["country", "host"], "left_semi"), ["country", "host"]
    raise ValueError(f"by must be 'country' or 'top_host', not {by!r}")


def day_range(
    parsed: DataFrame, countries: Sequence[str] = DEFAULT_COUNTRIES, by: str = "country", counts_col: str | None = None
) -> DataFrame:
    """(group..., min_day, max_day) in one aggregate."""
    rows, keys = _scope(parsed, countries, by, counts_col)
    return rows.groupBy(*keys).agg(F.min("day").alias("min_day"), F.max("day").alias("max_day"))


def heatmap(
    parsed: DataFrame,
    countries: Sequence[str] = DEFAULT_COUNTRIES,
    by: str = "country",
    dense: bool = False,
    counts_col: str | None = None,
) -> DataFrame:
    """Visits per (group, day, hour), server-local day and hour.

    ``dense`` fills every hour 0-23 of every day between the group's first
    and last day with 0: the grid is generated per group from its day range
    (at most 31 x 24 cells) and left-joined to the counts.
    """
    rows, keys = _scope(parsed, countries, by, counts_col)
    counts = rows.groupBy(*keys, "day", "hour").agg(_n(counts_col).alias("visits"))
    if not dense:
        return counts
    grid = (
        counts.groupBy(*keys)
        .agg(F.min("day").alias("_lo"), F.max("day").alias("_hi"))
        .select(
            *keys,
            F.explode(F.sequence("_lo", "_hi")).alias("day"),
        )
        .select(*keys, "day", F.explode(F.sequence(F.lit(0), F.lit(HOURS - 1))).alias("hour"))
    )
    return (
        grid.join(counts, [*keys, "day", "hour"], "left")
        .select(*keys, "day", "hour", F.coalesce("visits", F.lit(0)).cast("long").alias("visits"))
    )


def pivot_grid(
    grid: DataFrame,
    index: Sequence[str],
    column: str,
    values: Sequence[int] | None = None,
    value: str = "visits",
    prefix: str = "d",
) -> DataFrame:
    """Matrix form: one row per index, one column per value (NULL = none).

    ``values=None`` takes the values present in the grid, found by Spark's
    own pivot (its limit is ``spark.sql.pivotMaxValues``); passing them
    explicitly saves that job.
    """
    if values is None:
        wide = grid.groupBy(*index).pivot(column).agg(F.sum(value))
        values = [c for c in wide.columns if c not in index and c != "null"]
    else:
        wide = grid.groupBy(*index).pivot(column, list(values)).agg(F.sum(value))
    return wide.select(*index, *[F.col(f"`{v}`").alias(f"{prefix}{v}") for v in values])
