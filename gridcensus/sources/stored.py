"""Stored tables that are replaced slice by slice, upserted bucket by bucket, published by rename.

A table is a folder of Parquet files partitioned by its slice columns. A publication is written
to a staging folder inside the table's folder, which readers skip, is read back and checked, and
only then moved into place, one partition at a time; what was there before is kept aside until
all partitions are in place and is put back if a move fails. Files of other partitions are
neither read nor written.

Moves are renames: atomic per partition on HDFS and local file systems. One writer per table at a
time; the driver handles directory names only, as many as a publication changes.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridcensus.operators.verdict import enforce

BUCKET = "bucket"
Check = Callable[[DataFrame], DataFrame]


class Folder:
    """Names, moves and deletions below one folder of any file system that Spark knows."""

    def __init__(self, spark: SparkSession, path: str):
        self._jvm = spark.sparkContext._jvm
        self.path = path.rstrip("/")
        configuration = spark.sparkContext._jsc.hadoopConfiguration()
        self._files = self._at("").getFileSystem(configuration)

    def _at(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def exists(self, name: str) -> bool:
        return self._files.exists(self._at(name))

    def partitions(self, name: str, depth: int) -> list[str]:
        """Partition directories ``depth`` levels below ``name``, relative to it."""
        if not self.exists(name):
            return []
        found = [""]
        for _ in range(depth):
            below = []
            for parent in found:
                at = self._at(f"{name}/{parent}".rstrip("/"))
                below += [f"{parent}/{s.getPath().getName()}".lstrip("/")
                          for s in self._files.listStatus(at)
                          if s.isDirectory() and "=" in s.getPath().getName()]
            found = below
        return sorted(found)

    def files(self, name: str) -> list[str]:
        """Names of the files directly in ``name`` that readers see."""
        found = [s.getPath().getName() for s in self._files.listStatus(self._at(name)) if s.isFile()]
        return sorted(f for f in found if not f.startswith(("_", ".")))

    def move(self, source: str, target: str) -> None:
        self._files.mkdirs(self._at(target).getParent())
        if not self._files.rename(self._at(source), self._at(target)):
            raise OSError(f"cannot move {source} to {target} in {self.path}")

    def delete(self, name: str) -> None:
        self._files.delete(self._at(name), True)


def publish(df: DataFrame, path: str, by: Sequence[str], check: Check | None = None,
            slices: DataFrame | None = None) -> list[str]:
    """Replace the partitions of ``df`` in the table at ``path``; returns the changed directories.

    ``check`` gets the written rows and returns verdict rows; a failed one raises and leaves the
    table as it was. ``slices`` (columns ``by``) names partitions that go if ``df`` has no row of
    them.
    """
    spark, by = df.sparkSession, list(by)
    table, staging = Folder(spark, path), f"_staging-{uuid.uuid4().hex}"
    done: list[tuple[str, bool]] = []
    try:
        df.hint("rebalance", *by).write.partitionBy(*by).parquet(f"{table.path}/{staging}/new")
        if check is not None:
            enforce(check(spark.read.schema(df.schema).parquet(f"{table.path}/{staging}/new")),
                    f"rows for {path}")
        new = table.partitions(f"{staging}/new", len(by))
        gone: list[str] = []
        if slices is not None:
            slices.select(*by).distinct().withColumn("_n", F.lit(1)).coalesce(1).write.partitionBy(
                *by).parquet(f"{table.path}/{staging}/slices")
            gone = [s for s in table.partitions(f"{staging}/slices", len(by))
                    if s not in new and table.exists(s)]
        try:
            for name in new + gone:
                held = table.exists(name)
                if held:
                    table.move(name, f"{staging}/old/{name}")
                done.append((name, held))
                if name not in gone:
                    table.move(f"{staging}/new/{name}", name)
        except Exception:
            for name, held in reversed(done):
                table.delete(name)
                if held:
                    table.move(f"{staging}/old/{name}", name)
            raise
        return new + gone
    finally:
        table.delete(staging)


def read_stored(spark: SparkSession, path: str) -> DataFrame | None:
    """The table, or None where nothing was published yet."""
    if not Folder(spark, path).exists(""):
        return None
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if "UNABLE_TO_INFER_SCHEMA" in str(error):
            return None
        raise


def stored_files(spark: SparkSession, path: str) -> DataFrame:
    """Files of the table with their time of modification, from the hidden metadata columns."""
    return spark.read.parquet(path).select(
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_modification_time").alias("modified")).distinct()


def kept_files(before: DataFrame, after: DataFrame) -> DataFrame:
    """Of the files before, which are there afterwards with the same time."""
    return before.join(after.withColumn("kept", F.lit(True)), ["file_path", "modified"], "left").select(
        "file_path", F.coalesce("kept", F.lit(False)).alias("kept"))


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def upsert_stored(path: str, updates: DataFrame, keys: Sequence[str], buckets: int,
                  columns: Sequence[str] | None = None, check: Check | None = None) -> list[str]:
    """Upsert into a table laid out by a hash bucket of its keys; rewrites only updated buckets.

    Whole rows are replaced, or only ``columns`` where given. The updates must not repeat a key.
    Which buckets have updates is read first (at most ``buckets`` numbers), and prunes the read.
    """
    spark, keys = updates.sparkSession, list(keys)
    placed = updates.withColumn(BUCKET, bucket_of(keys, buckets))
    stored = read_stored(spark, path)
    if stored is not None:
        touched = [r[0] for r in placed.select(BUCKET).distinct().collect()]
        stored = stored.where(F.col(BUCKET).isin(*touched)).withColumn(
            BUCKET, F.col(BUCKET).cast("int"))
        on = [BUCKET, *keys]
        if columns is None:
            kept = stored.join(placed.select(*on), on, "left_anti")
            placed = kept.unionByName(placed, allowMissingColumns=True)
        else:
            new = placed.select(*on, F.lit(True).alias("_hit"),
                                *[F.col(c).alias(f"_new_{c}") for c in columns])
            met = stored.join(new, on, "full_outer")
            placed = met.select(*[
                F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c)
                if c in columns else F.col(c) for c in stored.columns])
    return publish(placed, path, [BUCKET], check)
