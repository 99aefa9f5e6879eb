"""Delimited population snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridcensus.functions.text import blank_to_null, month_end
from gridcensus.schemas import require_columns

# Source header names.
REQUIRED = ("RAUMID", "E_E", "E_E65U80", "E_E80U110", "ZEIT")


def read_population(spark: SparkSession, path: str, required=REQUIRED,
                    separator: str = ";") -> DataFrame:
    """All columns as text, byte-order mark removed from the header, blanks as NULL."""
    raw = (spark.read.option("sep", separator).option("header", True)
           .option("encoding", "UTF-8").option("inferSchema", False).csv(path))
    named = raw.toDF(*[c.lstrip("﻿").strip() for c in raw.columns])
    require_columns(named, required, "population source")
    return named.select(*[blank_to_null(F.col(c), any_whitespace=True).alias(c)
                          for c in required])


def raw_population(frame: DataFrame, source_sha256: str, source_path: str,
                   publication_date: str | None = None, source_url: str | None = None,
                   publisher: str | None = None) -> DataFrame:
    """Rows of the raw population table, stamped with their provenance."""
    return frame.select(
        F.col("RAUMID").alias("plr_id_source"), F.col("E_E").alias("population_total_source"),
        F.col("E_E65U80").alias("population_65_79_source"),
        F.col("E_E80U110").alias("population_80plus_source"),
        F.col("ZEIT").alias("reference_code_source"),
        month_end(F.col("ZEIT")).alias("reference_date"),
        F.lit(publication_date).cast("date").alias("publication_date"),
        F.lit(source_path).alias("source_path"), F.lit(source_sha256).alias("source_sha256"),
        F.lit(source_url).alias("source_url"), F.lit(publisher).alias("publisher"),
        F.current_timestamp().alias("loaded_at_utc"))
