"""One-row verdicts: counters side by side, reason maps, and the only place that raises."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


class CheckFailed(ValueError):
    """A verdict row did not pass."""


def side_by_side(spark: SparkSession, *frames: DataFrame) -> DataFrame:
    """Columns of several one-row aggregates as one row, through scalar subqueries."""
    parts = [f.select(F.struct(*f.columns).alias("s")).scalar().alias(f"_{i}")
             for i, f in enumerate(frames)]
    return spark.range(1).select(*parts).select(*[f"_{i}.*" for i in range(len(frames))])


def reason_counts(df: DataFrame, column: str = "rejection_reason") -> DataFrame:
    """Rows per reason; the aggregate is partial before the shuffle."""
    return df.groupBy(column).agg(F.count("*").alias("reason_count"))


def reason_map(df: DataFrame, column: str = "rejection_reason",
               name: str = "rejection_reasons") -> DataFrame:
    """One row holding reason -> count, empty when nothing was rejected.

    Reasons come from a fixed list, so the collected entries are bounded.
    """
    entries = F.sort_array(F.collect_list(F.struct(column, "reason_count")))
    return (reason_counts(df.filter(F.col(column).isNotNull()), column)
            .agg(F.map_from_entries(entries).alias(name)))


def passed(*conditions: Column) -> Column:
    """All conditions hold; an unknown one counts as failed."""
    result = F.lit(True)
    for condition in conditions:
        result = result & condition
    return F.coalesce(result, F.lit(False))


def with_verdict(df: DataFrame, *conditions: Column) -> DataFrame:
    return df.select(passed(*conditions).alias("passed"), "*")


def enforce(verdict: DataFrame, message: str = "check failed") -> DataFrame:
    """Raise when any verdict row failed; shows at most ten of them."""
    failed = verdict.filter(~F.col("passed")).limit(10).collect()
    if failed:
        raise CheckFailed(f"{message}: {[row.asDict() for row in failed]}")
    return verdict


def require_rows(df: DataFrame, what: str) -> DataFrame:
    """Raise when a frame that must hold something is empty."""
    if not df.limit(1).count():
        raise CheckFailed(f"{what} is empty")
    return df


def offenders(df: DataFrame, order_by, limit: int = 10) -> DataFrame:
    """First offenders in order, for a report."""
    return df.orderBy(order_by).limit(limit)
