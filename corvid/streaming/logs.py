"""Access-log totals over a stream of log files (same operators as batch)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from corvid.operators import logs


def log_line_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming ``value`` lines from files arriving under ``path``."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def country_requests_stream(lines: DataFrame, countries: Sequence[str] = logs.DEFAULT_COUNTRIES) -> DataFrame:
    """Running (country, requests); write with outputMode 'complete' or 'update'."""
    return logs.country_requests(logs.parse(lines), countries)
