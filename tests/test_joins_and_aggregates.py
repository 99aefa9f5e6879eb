import random
import statistics

import pytest
from pyspark.errors import SparkRuntimeException
from pyspark.sql import functions as F

from gridcensus.operators import aggregates, joins, profiles, report, skew
from gridcensus.operators.verdict import CheckFailed, enforce


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_plain_join(spark, how):
    left = spark.range(3000).select(
        F.col("id").alias("row"), F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 50)
        .cast("long").alias("k"))
    right = spark.createDataFrame([(k, f"v{k}") for k in range(0, 40, 2)] + [(7, "a"), (7, "b")],
                                  "k long, v string")
    plain = left.join(right, ["k"], how)
    salted = skew.salted_join(left, right, ["k"], how, ["row"], share=0.1, rows_per_task=5)
    columns = plain.columns
    assert sorted(map(tuple, salted.select(*columns).collect())) == \
        sorted(map(tuple, plain.collect()))


def test_hot_keys_are_bounded(spark):
    df = spark.range(1000).select(F.when(F.col("id") < 400, 1).otherwise(F.col("id")).alias("k"))
    assert [r["k"] for r in skew.hot_keys(df, ["k"], 0.3).collect()] == [1]


def test_lookup_join_beyond_the_broadcast_limit(spark):
    left = spark.range(200).select(F.col("id").alias("row"), (F.col("id") % 7).alias("k"))
    right = spark.range(7).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    both = [skew.lookup_join(left, right, ["k"], "inner", ["row"], max_rows=n) for n in (3, 100)]
    assert sorted(map(tuple, both[0].collect())) == sorted(map(tuple, both[1].collect()))


def test_conditions_beyond_equality(spark):
    left = spark.range(100).select(F.col("id").alias("row"), (F.col("id") % 2).alias("k"))
    right = spark.range(20).select((F.col("id") % 2).alias("k"), F.col("id").alias("v"))
    near = F.abs(F.col("l.row") - F.col("r.v")) <= 2
    got = skew.salted_join(left, right, ["k"], "inner", ["row"], condition=near, share=0.1, rows_per_task=7)
    want = {(r, v) for r in range(100) for v in range(20) if r % 2 == v % 2 and abs(r - v) <= 2}
    assert {(r["row"], r["v"]) for r in got.collect()} == want and got.count() == len(want)


def test_duplicates_flag_all_members_and_nulls_group(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, None), (4, None), (5, "b"), (6, "")],
                               "id int, k string")
    got = {r["id"]: r["is_duplicate"] for r in joins.flag_duplicates(df, ["k"]).collect()}
    assert got == {1: True, 2: True, 3: True, 4: True, 5: False, 6: False}


def test_checked_join_refuses_repeats(spark):
    left = spark.createDataFrame([(1, "x"), (1, "y")], "k int, a string")
    right = spark.createDataFrame([(1, "z"), (1, "w")], "k int, b string")
    assert joins.checked_join(right, left.limit(1), ["k"], "left").count() == 2
    # Nothing runs while the join is built; reading it fails.
    refused = joins.checked_join(left, right, ["k"])
    with pytest.raises(SparkRuntimeException, match=r'right side.*"k":1'):
        refused.collect()
    with pytest.raises(SparkRuntimeException, match="left side"):
        joins.checked_join(left, right.limit(1), ["k"], validate="one_to_one").collect()


def test_building_checked_joins_and_flags_starts_no_job(spark):
    tracker = spark.sparkContext.statusTracker()
    df = spark.range(10).withColumnRenamed("id", "k")
    spark.sparkContext.setJobGroup("building", "")
    joined = joins.flag_duplicates(joins.checked_join(df, df, ["k"], "left"), ["k"])
    assert not tracker.getJobIdsForGroup("building")
    assert joined.count() == 10
    assert tracker.getJobIdsForGroup("building")


def explained(spark, registry):
    weather = spark.createDataFrame([(f"{i:08d}", 25.0) for i in range(542)],
                                    "plr_id string, temperature_c double")
    accepted = spark.createDataFrame([(f"{i:08d}", 100, 20, 0.2) for i in range(540)],
                                     "plr_id string, population_total long, "
                                     "population_65plus long, share_65plus double")
    rejected = spark.createDataFrame([(f"{i:08d}", "missing_population_total") for i in registry],
                                     "plr_id string, rejection_reason string")
    return weather, accepted, rejected


def test_explained_join(spark):
    weather, accepted, rejected = explained(spark, [540, 541])
    out = joins.explained_join(weather, accepted, rejected, "plr_id",
                               ("population_total", "population_65plus", "share_65plus"),
                               ["temperature_c"])
    counts = {r["population_status"]: r["row_count"] for r in report.status_counts(out).collect()}
    assert counts == {"available": 540, "rejected_source_record": 2}
    enforce(joins.explained_audit(weather, accepted, rejected, "plr_id"))


def test_explained_join_needs_the_whole_registry(spark):
    frames = explained(spark, [540])
    with pytest.raises(CheckFailed, match="unexplained_key_count': 1"):
        enforce(joins.explained_audit(*frames, "plr_id"))


def test_expected_set_is_zero_filled(spark):
    expected = spark.createDataFrame([("a",), ("b",)], "k string")
    seen = spark.createDataFrame([("a", 3), ("z", 9)], "k string, n long")
    got = dict(map(tuple, joins.with_expected(expected, seen, ["k"], {"n": 0}).collect()))
    assert got == {"a": 3, "b": 0}


@pytest.mark.parametrize("rows,mean", [
    ([(20.0, 0.25), (24.0, 0.75)], 23.0), ([(20.0, 0.25), (None, 0.75)], None),
    ([(20.0, None), (24.0, 0.75)], None), ([(20.0, 0.0)], None), ([(10.0, 2.0), (40.0, 1.0)], 20.0)])
def test_weighted_mean(spark, rows, mean):
    df = spark.createDataFrame(rows, "v double, w double")
    assert df.agg(aggregates.weighted_mean(F.col("v"), F.col("w"))).first()[0] == mean


DISTRIBUTIONS = {
    "odd": [3.0, 1.0, 2.0], "even": [4.0, 1.0, 3.0, 2.0], "single": [-7.5],
    "equal": [2.0] * 9, "signs": [-1e300, -2.0, 0.0, 5e-324, 1e300, 1.0],
    "skewed": [1.0] * 400 + [1e12, -1e-9, 3.5] + [2.0] * 401,
    "close": [1.0 + i * 2.0**-52 for i in range(200)],
    "wide": [-1.7e308, 1.7e308, 1.6e308, -1.6e308, 1.5e308],
    "random": [random.Random(5).gauss(0, 1) * 10 ** random.Random(i).randint(-12, 12)
               for i in range(2000)],
}


def test_exact_medians(spark):
    rows = [(name, v) for name, values in DISTRIBUTIONS.items() for v in values]
    df = spark.createDataFrame(rows, "column string, value double").repartition(5)
    got = dict(map(tuple, aggregates.exact_medians(df).collect()))
    assert got == {n: statistics.median(v) for n, v in DISTRIBUTIONS.items()}


def test_describe_skips_missing_and_keeps_empty_columns(spark):
    df = spark.createDataFrame([(1.0, None), (3.0, None), (None, None), (float("nan"), None)],
                               "a double, b double")
    got = {r["column"]: r for r in aggregates.describe(df, ("a", "b")).collect()}
    assert (got["a"]["value_count"], got["a"]["median"], got["a"]["sum"]) == (2, 2.0, 4.0)
    assert got["b"]["value_count"] == 0 and got["b"]["median"] is None


def test_duplicate_count_counts_null_as_a_value(spark):
    df = spark.createDataFrame([(None,), (None,), ("a",)], "k string")
    assert aggregates.duplicate_count(df, ["k"]).first()[0] == 1


def test_current_version_prefers_dated(spark):
    df = spark.createDataFrame([("b", None), ("a", "2023-01-01"), ("c", "2023-01-01")],
                               "geography_version string, reference_date string")
    assert aggregates.current_version(df).first()["geography_version"] == "c"


def test_hottest_puts_missing_last_and_breaks_ties(spark):
    final = spark.createDataFrame(
        [("c", 5.0), ("b", 9.0), ("a", 9.0), ("d", None)], "plr_id string, temperature_c double"
    ).withColumns({n: F.lit(None).cast("double") for n in (
        "relative_humidity_percent", "population_total", "population_65plus", "share_65plus")}
    ).withColumns({"population_status": F.lit("available"), "lead_time": F.lit("PT000H00M"),
                   "run_time_utc": F.lit("2026-01-01").cast("timestamp")})
    top = report.hottest_zones(final, 3).orderBy("rank").collect()
    assert [(r["rank"], r["plr_id"]) for r in top] == [(1, "a"), (2, "b"), (3, "c")]
    text = report.formatted(report.hottest_zones(final, 1)).first()
    assert (text["temperature_c"], text["population_total"]) == ("9.0", "NA")


def test_bridge_profile_and_references(spark):
    schema = ("plr_id string, cell_index long, intersection_area_m2 double, plr_area_m2 double, "
              "icon_cell_area_m2 double, fraction_of_plr double, fraction_of_icon_cell double")
    good = spark.createDataFrame([("A", 10, 25.0, 100.0, 50.0, 0.25, 0.5),
                                  ("A", 11, 75.0, 100.0, 100.0, 0.75, 0.75)], schema)
    p = profiles.bridge_profile(good).first()
    assert (p["row_count"], p["distinct_plr_count"], p["distinct_icon_cell_count"],
            p["duplicate_plr_cell_pair_count"], p["max_weight_error"]) == (2, 1, 2, 0, 0.0)
    assert profiles.bridge_profile(good.union(good.limit(1))).first()[
        "duplicate_plr_cell_pair_count"] == 1
    other = spark.createDataFrame([("A", 10), ("B", 99)], "plr_id string, cell_index long")
    zones = spark.createDataFrame([("A",), ("B",), ("C",)], "plr_id string")
    cells = spark.createDataFrame([(10,), (11,)], "cell_index long")
    got = {tuple(r) for r in profiles.bridge_references(other, zones, cells).collect()}
    assert got == {("zone", "C", "missing_from_bridge"), ("cell", "99", "missing_from_source")}
