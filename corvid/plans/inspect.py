"""Plan inspection helpers used by tests and the scale review."""

from __future__ import annotations

from pyspark.sql import DataFrame


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    """The physical plan as a string (``explain`` without printing)."""
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString(mode)
    )


def count_exchanges(df: DataFrame) -> int:
    """Number of shuffle exchanges in the executed plan (before AQE re-planning)."""
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.count("Exchange hashpartitioning") + text.count("Exchange rangepartitioning") + text.count(
        "Exchange SinglePartition"
    )
