"""Data behind the exposure report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridcensus.functions import text
from gridcensus.operators.aggregates import count_if, top_ranked, value_counts
from gridcensus.operators.verdict import passed


def hottest_zones(final: DataFrame, limit: int = 10) -> DataFrame:
    """Warmest zones first, missing temperatures last, zone id breaking ties."""
    order = [F.desc_nulls_last("temperature_c"), F.asc("plr_id")]
    return top_ranked(final, order, limit).select(
        "rank", "plr_id", "run_time_utc", "lead_time", "temperature_c",
        "relative_humidity_percent", "population_total", "population_65plus", "share_65plus",
        "population_status")


def formatted(hottest: DataFrame) -> DataFrame:
    """The ranking as report text, ``NA`` for missing numbers."""
    return hottest.select(
        "rank", "plr_id", text.fixed(F.col("temperature_c")).alias("temperature_c"),
        text.fixed(F.col("relative_humidity_percent")).alias("relative_humidity_percent"),
        text.thousands(F.col("population_total")).alias("population_total"),
        text.thousands(F.col("population_65plus")).alias("population_65plus"),
        text.percent(F.col("share_65plus")).alias("share_65plus"), "population_status")


def status_counts(final: DataFrame) -> DataFrame:
    return value_counts(final, "population_status", "missing").orderBy("population_status")


def rejection_reason_counts(final: DataFrame) -> DataFrame:
    rejected = final.filter(F.col("population_status") != "available")
    return (value_counts(rejected, "population_rejection_reason", "unspecified")
            .orderBy("population_rejection_reason"))


def exceptions(final: DataFrame) -> DataFrame:
    return final.filter(F.col("population_status") != "available").select(
        "plr_id", "population_status", "population_rejection_reason")


def report_header(final: DataFrame) -> DataFrame:
    """Counts and the forecast identity, which must be the only one."""
    status = F.col("population_status")
    times = ("run_time_utc", "valid_time_utc", "lead_time")
    counts = final.agg(
        F.count("*").alias("row_count"), F.count_distinct("plr_id").alias("unique_plr_count"),
        count_if(status == "available").alias("available_count"),
        count_if(status == "rejected_source_record").alias("rejected_count"),
        *[F.min(t).alias(t) for t in times],
        *[F.count_distinct(t).alias(f"_{t}") for t in times])
    one = passed(*[F.col(f"_{t}") == 1 for t in times])
    return (counts.withColumn("passed", one).drop(*[f"_{t}" for t in times])
            .withColumn("run_time_utc", F.date_format("run_time_utc", "yyyy-MM-dd HH:mm"))
            .withColumn("valid_time_utc", F.date_format("valid_time_utc", "yyyy-MM-dd HH:mm")))
