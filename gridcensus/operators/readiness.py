"""Which forecasts are complete, which are pending, and which attempts to launch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridcensus import schemas
from gridcensus.functions.forecast import partition_key, run_label
from gridcensus.operators.verdict import side_by_side

KEY = ("run_time_utc", "lead_time")
# Run states after which nothing is launched, and those that allow a retry.
BLOCKING = ("NOT_STARTED", "QUEUED", "STARTING", "STARTED", "CANCELING", "SUCCESS")
RETRYABLE = ("FAILURE", "CANCELED")


def _names(values: Sequence[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def forecast_calendar(spark: SparkSession, start: str | Column, end: str | Column,
                      leads: Sequence[str] = schemas.LEAD_TIMES) -> DataFrame:
    """Hourly runs from ``start`` up to but excluding ``end``, times the lead list."""
    first, stop = (F.to_timestamp(F.lit(x)) if isinstance(x, str) else x for x in (start, end))
    hour = F.expr("interval 1 hour")
    runs = F.when(first < stop, F.sequence(first, stop - F.expr("interval 1 second"), hour))
    return (spark.range(1).select(F.explode(runs).alias("run_time_utc"))
            .withColumn("lead_time", F.explode(_names(leads))))


def recent_runs(runs: DataFrame, minimum: str | Column | None = None,
                limit: int = schemas.CANDIDATE_RUNS) -> DataFrame:
    """Newest distinct runs not before ``minimum``."""
    kept = runs.select("run_time_utc")
    if minimum is not None:
        kept = kept.filter(F.col("run_time_utc") >= (
            F.to_timestamp(F.lit(minimum)) if isinstance(minimum, str) else minimum))
    return kept.distinct().orderBy(F.desc("run_time_utc")).limit(limit)


def with_leads(runs: DataFrame, leads: Sequence[str] = schemas.LEAD_TIMES) -> DataFrame:
    """Each run once per lead, with the lead's place in the list."""
    return runs.select("run_time_utc", F.posexplode(_names(leads)).alias("lead_order", "lead_time"))


def availability(forecasts: DataFrame, observed: DataFrame,
                 indicators: Sequence[str] = schemas.INDICATORS) -> DataFrame:
    """Missing indicators per forecast, in contract order.

    Observations collapse to one set per forecast, never larger than the indicator list,
    so the expected grid is not multiplied by indicator.
    """
    wanted = _names(indicators)
    seen = (observed.filter(F.col("indicator").isin(*indicators)).groupBy(*KEY)
            .agg(F.collect_set("indicator").alias("_seen")))
    joined = forecasts.join(seen, list(KEY), "left")
    missing = F.array_except(wanted, F.coalesce("_seen", F.array().cast("array<string>")))
    return (joined.withColumn("missing_indicators", missing)
            .withColumn("complete", F.size("missing_indicators") == 0).drop("_seen"))


def completed_partitions(fields: DataFrame, indicators: Sequence[str] = schemas.INDICATORS
                         ) -> DataFrame:
    """Forecasts for which every expected indicator has rows."""
    return (fields.filter(F.col("indicator").isin(*indicators)).groupBy(*KEY)
            .agg(F.count_distinct("indicator").alias("n"))
            .filter(F.col("n") == len(indicators)).select(*KEY))


def pending_availability(runs: DataFrame, observed: DataFrame, completed: DataFrame,
                         minimum: str | Column | None = None,
                         limit: int = schemas.CANDIDATE_RUNS,
                         leads: Sequence[str] = schemas.LEAD_TIMES,
                         indicators: Sequence[str] = schemas.INDICATORS) -> DataFrame:
    """Every candidate of the recent window with its state: done, ready or incomplete.

    The window is bounded by ``limit`` runs, so it is broadcast to reduce the observations
    before they are grouped. An incomplete newest run does not hold back older ones.
    """
    candidates = with_leads(recent_runs(runs, minimum, limit), leads)
    bounded = F.broadcast(candidates.select(*KEY))
    seen = observed.join(bounded, list(KEY), "left_semi")
    done = (completed.join(bounded, list(KEY), "left_semi").select(*KEY).distinct()
            .withColumn("_done", F.lit(True)))
    judged = availability(candidates, seen, indicators).join(done, list(KEY), "left")
    state = (F.when(F.col("_done"), "already_complete").when(F.col("complete"), "ready")
             .otherwise("incomplete"))
    return judged.withColumn("state", state).drop("_done", "complete")


def ready_set(pending: DataFrame) -> DataFrame:
    """Ready forecasts, newest run first, leads in list order."""
    return (pending.filter(F.col("state") == "ready")
            .orderBy(F.desc("run_time_utc"), "lead_order").select(*KEY, "lead_order"))


def latest_incomplete(pending: DataFrame) -> DataFrame:
    return (pending.filter(F.col("state") == "incomplete")
            .orderBy(F.desc("run_time_utc"), "lead_order").limit(1)
            .select(*KEY, "missing_indicators"))


def decision(pending: DataFrame) -> DataFrame:
    """One row: counts, the newest incomplete forecast and why nothing is launched, if so."""
    count = lambda s: F.count_if(F.col("state") == s)
    counts = pending.agg(
        count("ready").alias("ready_forecasts"),
        (count("ready") + count("incomplete")).alias("checked_forecasts"),
        count("already_complete").alias("already_complete_forecasts"))
    newest = latest_incomplete(pending).agg(
        F.max("run_time_utc").alias("latest_incomplete_run"),
        F.max("lead_time").alias("latest_incomplete_lead"),
        F.max("missing_indicators").alias("latest_missing_indicators"))
    skip = (F.when(F.col("ready_forecasts") > 0, None)
            .when(F.col("latest_incomplete_run").isNotNull(), F.concat(
                F.lit("latest incomplete candidate: "), run_label(F.col("latest_incomplete_run")),
                F.lit(" x "), F.col("latest_incomplete_lead"), F.lit("; missing: "),
                F.array_join("latest_missing_indicators", ", ")))
            .when(F.col("already_complete_forecasts") > 0,
                  "checked candidates are already complete")
            .otherwise("no eligible forecast candidate"))
    return side_by_side(pending.sparkSession, counts, newest).withColumn("skip_reason", skip)


def launchable(ready: DataFrame, run_log: DataFrame, source: str = "forecast",
               max_attempts: int = schemas.MAX_ATTEMPTS, status_order: Sequence[str] = ("ts",)
               ) -> DataFrame:
    """Ready forecasts that may start now, with attempt number and idempotency key.

    ``run_log``: run_time_utc, lead_time, status and the columns that order attempts.
    """
    order = F.struct(*status_order)
    attempts = run_log.groupBy(*KEY).agg(F.count("*").alias("prior"),
                                         F.max_by("status", order).alias("last_status"))
    joined = ready.join(attempts, list(KEY), "left").withColumn(
        "attempt", F.coalesce(F.col("prior"), F.lit(0)) + 1)
    status = F.col("last_status")
    allowed = status.isNull() | (~status.isin(*BLOCKING) & (
        ~status.isin(*RETRYABLE) | (F.col("attempt") <= max_attempts)))
    label = run_label(F.col("run_time_utc"))
    return (joined.filter(allowed)
            .withColumn("run_key", F.concat_ws(":", F.lit(source), label, "lead_time", F.concat(
                F.lit("attempt_"), F.col("attempt").cast("string"))))
            .withColumn("partition_key", partition_key(F.col("lead_time"), F.col("run_time_utc")))
            .select(*KEY, "last_status", "attempt", "run_key", "partition_key"))
