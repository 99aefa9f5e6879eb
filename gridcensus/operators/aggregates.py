"""Aggregates: weighted means, one-pass counters, descriptions, exact medians."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def count_if(condition: Column) -> Column:
    return F.count_if(F.coalesce(condition, F.lit(False)))


def weighted_mean(value: Column, weight: Column) -> Column:
    """Missing-preserving: any missing value or weight, or no weight at all, gives NULL."""
    missing = F.count_if(value.isNull() | weight.isNull()) > 0
    return (F.when(missing | (F.sum(weight) <= 0), None)
            .otherwise(F.sum(value * weight) / F.sum(weight)))


def weighted_sum(value: Column, weight: Column) -> Column:
    return F.sum(value * weight)


def max_where(value: Column, condition: Column) -> Column:
    """Conditional maximum, the building block of a fixed pivot."""
    return F.max(F.when(condition, value))


def null_counts(columns: Sequence[str], suffix: str = "_null_count") -> list[Column]:
    return [F.count_if(F.col(c).isNull()).alias(c + suffix) for c in columns]


def is_constant(column: str) -> Column:
    """Minimum equals maximum; a group without any value is not constant."""
    return F.coalesce(F.min(column) == F.max(column), F.lit(False))


def duplicate_count(df: DataFrame, keys: Sequence[str], name: str = "duplicate_count"
                    ) -> DataFrame:
    """Rows beyond the first of each key, NULL counting as a value."""
    groups = df.groupBy(*keys).agg(F.count("*").alias("_n"))
    return groups.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias(name))


def value_counts(df: DataFrame, column: str, missing: str) -> DataFrame:
    """Rows per value with missing as its own value."""
    return (df.groupBy(F.coalesce(F.col(column), F.lit(missing)).alias(column))
            .agg(F.count("*").alias("row_count")))


def latest_by(df: DataFrame, key: str, stamp: str) -> DataFrame:
    """The key last loaded; the key breaks ties so that reruns agree."""
    return (df.groupBy(key).agg(F.max(stamp).alias(stamp))
            .orderBy(F.desc(stamp), F.asc(key)).limit(1))


def current_version(df: DataFrame, version: str = "geography_version",
                    stamp: str = "reference_date") -> DataFrame:
    """Version with the newest date, undated ones last, larger label first among equals."""
    return (df.groupBy(version).agg(F.max(stamp).alias(stamp))
            .orderBy(F.desc_nulls_last(stamp), F.desc(version)).limit(1))


def weight_deviation(df: DataFrame, keys: Sequence[str], weight: str, tolerance: float) -> DataFrame:
    """Groups whose weights do not sum to one, and the largest deviation."""
    sums = df.groupBy(*keys).agg(F.sum(weight).alias("_w"))
    deviation = F.abs(F.col("_w") - 1.0)
    return sums.agg(count_if(deviation > tolerance).alias("weight_failure_count"),
                    F.coalesce(F.max(deviation), F.lit(0.0)).alias("max_weight_error"))


def top_ranked(df: DataFrame, order: Sequence[Column], limit: int = 10,
               name: str = "rank") -> DataFrame:
    """The first ``limit`` rows with their position; only those rows are numbered."""
    top = df.orderBy(*order).limit(limit)
    return top.withColumn(name, F.row_number().over(Window.orderBy(*order)))


def long_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Numeric columns as (column, value) rows; missing values are dropped, infinite ones kept."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column"),
                               F.col(c).cast("double").alias("value")) for c in columns])
    return (df.select(F.explode(pairs).alias("p")).select("p.column", "p.value")
            .filter(F.col("value").isNotNull() & ~F.isnan("value")))


_BUCKETS = 65536
_MEDIAN_STATE = "column string, middle int, rank long, lo double, hi double"


def exact_medians(values: DataFrame) -> DataFrame:
    """Interpolated median per column of (column, value) rows, without gathering them.

    The two middle ranks of each column are narrowed down pass by pass: first by sign and
    binary exponent, then by 65,536 equal steps of what remains, until one value is left.
    That takes a few passes for any distribution, at most six. A pass is a scan with a
    partial aggregate into a bounded number of buckets; the driver sees two rows per column.
    """
    value = F.col("value")
    magnitude = F.least(F.abs(value), F.lit(1e308))
    exponent = F.when(value == 0, 0.0).when(
        F.abs(value) == float("inf"), F.signum(value) * 4000.0).otherwise(
        F.signum(value) * (F.floor(F.log2(magnitude)) + 1100.0))
    buckets = values.groupBy("column", exponent.alias("bucket")).agg(
        F.count("*").alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi"))
    total = F.sum("n").over(Window.partitionBy("column"))
    ranks = F.array(F.floor((F.col("total") + 1) / 2), F.floor((F.col("total") + 2) / 2))
    ranked = buckets.withColumn("total", total).select(
        "*", F.posexplode(ranks).alias("middle", "rank"))
    target = _holding_rank(ranked).collect()

    spark = values.sparkSession
    while any(row["lo"] < row["hi"] for row in target):
        known = F.broadcast(spark.createDataFrame(target, _MEDIAN_STATE).select(
            F.col("column").alias("_c"), "middle", "rank", F.col("lo").alias("_lo"),
            F.col("hi").alias("_hi")))
        # Halves before the difference, so that the width cannot overflow.
        part = (value / 2 - F.col("_lo") / 2) / (F.col("_hi") / 2 - F.col("_lo") / 2)
        step = F.when(F.col("_hi") > F.col("_lo"), F.floor(part * (_BUCKETS - 1))).otherwise(0)
        inside = values.join(known, (F.col("column") == F.col("_c")) & value.between(
            F.col("_lo"), F.col("_hi")))
        buckets = inside.groupBy("column", "middle", "rank", step.alias("bucket")).agg(
            F.count("*").alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi"))
        target = _holding_rank(buckets).collect()
    both_same = F.min("lo") == F.max("lo")
    return spark.createDataFrame(target, _MEDIAN_STATE).groupBy("column").agg(
        F.when(both_same, F.min("lo")).otherwise(F.avg("lo")).alias("median"))


def _holding_rank(buckets: DataFrame) -> DataFrame:
    """The bucket each rank falls into, and the rank inside it."""
    upto = F.sum("n").over(Window.partitionBy("column", "middle").orderBy("bucket"))
    before = F.col("upto") - F.col("n")
    return (buckets.withColumn("upto", upto)
            .filter((F.col("upto") >= F.col("rank")) & (before < F.col("rank")))
            .select("column", F.col("middle").cast("int").alias("middle"),
                    (F.col("rank") - before).cast("long").alias("rank"), "lo", "hi"))


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column: count, minimum, exact median, mean, maximum, sum, sample std.

    Columns without any value keep a row of NULLs. The median takes several passes, so an
    expensive frame should be stored or checkpointed first.
    """
    values = long_values(df, columns)
    moments = values.groupBy("column").agg(
        F.count("*").alias("value_count"), F.min("value").alias("min"),
        F.avg("value").alias("mean"), F.max("value").alias("max"), F.sum("value").alias("sum"),
        F.stddev_samp("value").alias("std"))
    names = df.sparkSession.createDataFrame([(c,) for c in columns], "column string")
    return (names.join(F.broadcast(moments), "column", "left")
            .join(F.broadcast(exact_medians(values)), "column", "left")
            .fillna({"value_count": 0})
            .select("column", "value_count", "min", "median", "mean", "max", "sum", "std"))
