"""Slices, buckets and staged publication of stored tables."""

import os

import pytest
from pyspark.sql import functions as F

from gridcensus.operators.verdict import CheckFailed, with_verdict
from gridcensus.sources import stored


def rows(spark, *values):
    return spark.createDataFrame(list(values), "day string, k int, v int")


def listing(path):
    return {os.path.join(at, f): os.stat(os.path.join(at, f)).st_mtime_ns
            for at, _, files in os.walk(path) for f in files if f.endswith(".parquet")}


def content(spark, path):
    return sorted((r["day"], r["k"], r["v"]) for r in spark.read.parquet(path).collect())


def test_only_the_slice_is_written(spark, tmp_path):
    path = str(tmp_path / "t")
    stored.publish(rows(spark, ("a", 1, 1), ("b", 2, 2), ("c d/e", 3, 3)), path, ["day"])
    before = listing(path)
    assert stored.publish(rows(spark, ("b", 9, 9)), path, ["day"]) == ["day=b"]
    after = listing(path)
    kept = {f for f in before if "day=b" not in f}
    assert all(after[f] == before[f] for f in kept) and len(kept) == 2
    assert content(spark, path) == [("a", 1, 1), ("b", 9, 9), ("c d/e", 3, 3)]
    files = stored.kept_files(stored.stored_files(spark, path), stored.stored_files(spark, path))
    assert files.count() == 3 and files.filter("NOT kept").isEmpty()


def test_a_slice_can_be_emptied(spark, tmp_path):
    path = str(tmp_path / "t")
    stored.publish(rows(spark, ("a", 1, 1), ("c d/e", 3, 3)), path, ["day"])
    none = rows(spark, ("x", 1, 1)).limit(0)
    gone = spark.createDataFrame([("c d/e",), ("never",)], "day string")
    stored.publish(none, path, ["day"], slices=gone)
    assert content(spark, path) == [("a", 1, 1)]


def test_a_failed_check_leaves_the_table_and_no_staging(spark, tmp_path):
    path = str(tmp_path / "t")
    stored.publish(rows(spark, ("a", 1, 1), ("b", 2, 2)), path, ["day"])
    before = listing(path)

    def none_negative(written):
        return with_verdict(written.agg(F.count_if(F.col("v") < 0).alias("n")), F.col("n") == 0)

    with pytest.raises(CheckFailed):
        stored.publish(rows(spark, ("a", 1, 5), ("b", 2, -2)), path, ["day"], none_negative)
    assert listing(path) == before
    assert not [f for f in os.listdir(path) if f.startswith("_staging")]
    stored.publish(rows(spark, ("a", 1, 5)), path, ["day"], none_negative)
    assert content(spark, path) == [("a", 1, 5), ("b", 2, 2)]


def test_a_failed_move_puts_everything_back(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    stored.publish(rows(spark, ("a", 1, 1), ("b", 2, 2)), path, ["day"])
    before, plain = listing(path), stored.Folder.move

    def stuck(self, source, target):
        if source.endswith("new/day=b"):
            raise OSError("no space")
        plain(self, source, target)

    monkeypatch.setattr(stored.Folder, "move", stuck)
    with pytest.raises(OSError, match="no space"):
        stored.publish(rows(spark, ("a", 7, 7), ("b", 8, 8), ("n", 9, 9)), path, ["day"])
    assert listing(path) == before
    assert not [f for f in os.listdir(path) if f.startswith("_staging")]


def test_upsert_rewrites_only_updated_buckets(spark, tmp_path):
    path = str(tmp_path / "t")
    first = spark.range(400).select(F.col("id").alias("k"), F.lit(1).alias("v"), F.lit("n").alias("name"))
    stored.upsert_stored(path, first, ["k"], 32)
    before = listing(path)
    updates = spark.createDataFrame([(5, 7, "x"), (1000, 8, "y")], "k long, v int, name string")
    changed = stored.upsert_stored(path, updates, ["k"], 32)
    after = listing(path)
    assert len(changed) <= 2
    assert all(after.get(f) == t for f, t in before.items() if not any(c in f for c in changed))
    table = {r["k"]: (r["v"], r["name"]) for r in spark.read.parquet(path).collect()}
    assert len(table) == 401 and table[5] == (7, "x") and table[1000] == (8, "y") and table[6] == (1, "n")
    stored.upsert_stored(path, updates.withColumn("v", F.lit(0)), ["k"], 32, columns=["v"])
    table = {r["k"]: (r["v"], r["name"]) for r in spark.read.parquet(path).collect()}
    assert len(table) == 401 and table[5] == (0, "x") and table[1000] == (0, "y")


def test_nothing_stored_yet(spark, tmp_path):
    assert stored.read_stored(spark, str(tmp_path / "none")) is None
    empty = rows(spark, ("a", 1, 1)).limit(0)
    assert stored.publish(empty, str(tmp_path / "t"), ["day"]) == []
    assert stored.read_stored(spark, str(tmp_path / "t")) is None
