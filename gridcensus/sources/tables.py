"""Partitioned tables: pruned reads, atomic partition writes, reload, slice replace, upsert."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from gridcensus.operators.skew import lookup_join
from gridcensus.operators.weather import with_partition_labels

PARTITION_COLUMNS = ("run_label", "lead_label")


def write_partitions(df: DataFrame, path: str,
                     partition_by: Sequence[str] = PARTITION_COLUMNS) -> None:
    """Replace exactly the partitions present in ``df``.

    Files appear with the job commit, so readers never see half a partition. The rebalance
    hint lets adaptive execution split a large partition over several files instead of
    sending it to one task.
    """
    labelled = df if all(c in df.columns for c in partition_by) else with_partition_labels(df)
    (labelled.hint("rebalance", *partition_by).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path))


def read_partitions(spark: SparkSession, path: str, run_labels: Sequence[str] | None = None,
                    lead_labels: Sequence[str] | None = None) -> DataFrame:
    """Forecast partitions; the label filters prune directories before any file is opened."""
    df = spark.read.option("recursiveFileLookup", False).parquet(path)
    for column, wanted in zip(PARTITION_COLUMNS, (run_labels, lead_labels)):
        if wanted is not None:
            df = df.filter(F.col(column).isin(*wanted))
    return df


def latest_label(df: DataFrame, label: str = "run_label") -> DataFrame:
    """Rows under the lexicographically last label."""
    return df.filter(F.col(label) == df.agg(F.max(label)).scalar())


def load_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Project a bulk load onto its column list, which must be non-empty and free of repeats."""
    if not columns:
        raise ValueError("a load needs at least one column")
    if len(set(columns)) != len(columns):
        raise ValueError("load columns repeat")
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"load rows lack columns {missing}")
    return df.select(*columns)


def load_rows(df: DataFrame, columns: Sequence[str], path: str, mode: str = "append"):
    """Append projected rows and return the row count seen while writing."""
    seen = Observation("load")
    rows = load_columns(df, columns).observe(seen, F.count(F.lit(1)).alias("row_count"))
    rows.write.mode(mode).parquet(path)
    return seen.get["row_count"]


def reload_snapshot(stored: DataFrame, incoming: DataFrame, key: str = "source_sha256"
                    ) -> DataFrame:
    """Drop stored rows of the incoming source hashes, then add the incoming rows."""
    return replace_slice(stored, incoming, [key], incoming.select(key).distinct())


def replace_slice(stored: DataFrame, incoming: DataFrame, keys: Sequence[str],
                  slices: DataFrame | None = None) -> DataFrame:
    """Rows outside the slices plus the recomputed ones.

    ``slices`` names slices explicitly, so that one can be emptied.
    """
    gone = (slices if slices is not None else incoming).select(*keys).distinct()
    kept = lookup_join(stored, gone, keys, "left_anti",
                       [c for c in stored.columns if c not in keys])
    return kept.unionByName(incoming)


def upsert(stored: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Whole-row upsert: an update replaces the stored row of its key."""
    kept = lookup_join(stored, updates.select(*keys).distinct(), keys, "left_anti",
                       [c for c in stored.columns if c not in keys])
    return kept.unionByName(updates)


def upsert_columns(stored: DataFrame, updates: DataFrame, keys: Sequence[str],
                   columns: Sequence[str]) -> DataFrame:
    """Column-level upsert: listed columns come from the update, others stay."""
    new = updates.select(*keys, *[F.col(c).alias(f"_new_{c}") for c in columns],
                         F.lit(True).alias("_hit"))
    joined = stored.join(new, list(keys), "full_outer")

    def pick(c: str) -> Column:
        if c in keys:
            return F.col(c)
        if c in columns:
            return F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c)
        return F.col(c)

    return joined.select(*[pick(c) for c in stored.columns])


def write_summary(summary: DataFrame, path: str) -> None:
    """One JSON object per row with the columns in sorted order."""
    ordered = summary.select(F.to_json(F.struct(*sorted(summary.columns))).alias("value"))
    ordered.write.mode("overwrite").text(path)
