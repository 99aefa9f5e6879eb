"""Forecast completion from a stream of arriving fields.

Per forecast the stream keeps one bit per indicator. Setting a bit twice changes nothing,
so repeated arrivals need no deduplicating state, and the partial aggregate before the
shuffle shrinks any hot forecast to one row per task.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridcensus.functions.fields import indicator_bit
from gridcensus.schemas import INDICATORS
from gridcensus.session import shared_folder


def completion_state(arrivals: DataFrame, lateness: str = "2 days",
                     indicators: Sequence[str] = INDICATORS) -> DataFrame:
    """Streaming aggregate: arrived indicators per (run, lead), late arrivals dropped.

    ``arrivals``: run_time_utc, lead_time, indicator. Works on a batch frame as well.
    """
    bits = F.bit_or(indicator_bit(F.col("indicator"), indicators))
    runs = (arrivals.withWatermark("run_time_utc", lateness) if arrivals.isStreaming
            else arrivals)
    return runs.groupBy("run_time_utc", "lead_time").agg(bits.alias("arrived"))


def complete_forecasts(state: DataFrame, indicators: Sequence[str] = INDICATORS) -> DataFrame:
    full = (1 << len(indicators)) - 1
    return state.filter(F.col("arrived") == full)


def run_available(arrivals: DataFrame, name: str, lateness: str = "2 days",
                  indicators: Sequence[str] = INDICATORS) -> DataFrame:
    """Process what has arrived and return the forecasts found complete, each once.

    Every micro-batch overwrites its own directory, so a repeated batch leaves no duplicate.
    State and output live in the shared folder, a new one per call.
    """
    spark: SparkSession = arrivals.sparkSession
    folder = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    out = f"{folder}/complete"

    def emit(batch: DataFrame, batch_id: int) -> None:
        (complete_forecasts(batch, indicators).withColumn("batch_id", F.lit(batch_id))
         .write.mode("overwrite").parquet(f"{out}/part={batch_id}"))

    schema = "run_time_utc timestamp, lead_time string, arrived int, batch_id int"
    # Keeps the output readable when nothing has arrived yet.
    spark.createDataFrame([], schema).write.parquet(f"{out}/part=none")
    query = (completion_state(arrivals, lateness, indicators).writeStream.outputMode("update")
             .option("checkpointLocation", f"{folder}/state").trigger(availableNow=True)
             .foreachBatch(emit).start())
    query.awaitTermination()
    found = spark.read.schema(schema).parquet(f"{out}/*")
    return found.groupBy("run_time_utc", "lead_time").agg(F.min("batch_id").alias("batch_id"))


def outcomes(expected: DataFrame, arrivals: DataFrame, patience: str = "48 hours",
             lateness: str = "30 minutes", indicators: Sequence[str] = INDICATORS) -> DataFrame:
    """Streaming outer join of expected forecasts with arrived fields: what came, and what did not.

    ``expected``: run_time_utc, lead_time. ``arrivals``: run_time_utc, lead_time, indicator,
    arrived_at. One row per expected field: with ``arrived_at`` as soon as it is there, or with
    NULL once the watermarks of both streams have passed the run's time by ``patience``. Arrivals
    after that are dropped, and so are repeated ones while they are within ``lateness``. The state
    holds the fields of the runs that are still open.
    """
    keys = ["run_time_utc", "lead_time", "indicator"]
    wait = F.expr(f"interval {patience}")
    e = (expected.select("run_time_utc", "lead_time", F.explode(F.array(
        *[F.lit(i) for i in indicators])).alias("indicator")).withColumn(
        "expected_at", F.col("run_time_utc")).withWatermark("expected_at", lateness).alias("e"))
    in_time = (F.col("arrived_at") >= F.col("run_time_utc")) & (
        F.col("arrived_at") <= F.col("run_time_utc") + wait)
    a = (arrivals.select(*keys, "arrived_at").filter(in_time)
         .withWatermark("arrived_at", lateness).dropDuplicatesWithinWatermark(keys).alias("a"))
    met = (F.col("a.arrived_at") >= F.col("e.expected_at")) & (
        F.col("a.arrived_at") <= F.col("e.expected_at") + wait)
    for key in keys:
        met = met & (F.col(f"e.{key}") == F.col(f"a.{key}"))
    return e.join(a, met, "leftOuter").select(*[f"e.{k}" for k in keys], "a.arrived_at")


def run_outcomes(expected: DataFrame, arrivals: DataFrame, patience: str = "48 hours",
                 lateness: str = "30 minutes", indicators: Sequence[str] = INDICATORS) -> DataFrame:
    """Process what is there and return the forecasts that were decided.

    run_time_utc, lead_time, missing_indicators in contract order, complete. A forecast is decided
    once each of its fields has arrived or has been given up.
    """
    spark: SparkSession = arrivals.sparkSession
    folder = f"{shared_folder(spark)}/outcomes-{uuid.uuid4().hex}"
    rows = outcomes(expected, arrivals, patience, lateness, indicators)
    query = (rows.writeStream.format("parquet").outputMode("append").trigger(availableNow=True)
             .option("checkpointLocation", f"{folder}/state").option("path", f"{folder}/rows").start())
    query.awaitTermination()
    found = spark.read.schema(rows.schema).parquet(f"{folder}/rows")
    bit = indicator_bit(F.col("indicator"), indicators)
    judged = found.groupBy("run_time_utc", "lead_time").agg(
        F.bit_or(bit).alias("_decided"),
        F.coalesce(F.bit_or(F.when(F.col("arrived_at").isNotNull(), bit)), F.lit(0)).alias("_arrived"))
    names = F.array(*[F.when(F.col("_arrived").bitwiseAND(1 << n) == 0, F.lit(i))
                      for n, i in enumerate(indicators)])
    missing = F.filter(names, lambda name: name.isNotNull())
    return judged.filter(F.col("_decided") == (1 << len(indicators)) - 1).select(
        "run_time_utc", "lead_time", missing.alias("missing_indicators"),
        (F.size(missing) == 0).alias("complete"))
