import datetime as dt

import pytest
from pyspark.sql import functions as F

from gridcensus import schemas
from gridcensus.operators import checks, weather
from gridcensus.operators.verdict import CheckFailed, enforce

RUN = dt.datetime(2026, 8, 19, 12)
FIELD = ("run_time_utc timestamp, lead_time string, valid_time_utc timestamp, indicator string, "
         "cell_index int, source_value double")
VALUES = {"T_2M": (293.15, 294.15), "RELHUM_2M": (50.0, 55.0), "TD_2M": (283.15, 284.15),
          "U_10M": (3.0, 5.0), "V_10M": (4.0, 12.0)}


def field(spark, drop=(), runs=(RUN,)):
    rows = [(r, "PT000H00M", r, i, c, v) for r in runs for i, vs in VALUES.items()
            for c, v in enumerate(vs) if (i, c) not in drop]
    return spark.createDataFrame(rows, FIELD)


def bridge(spark):
    return spark.createDataFrame(
        [("A", "v", 0, 0.25), ("A", "v", 1, 0.75), ("B", "v", 1, 1.0)],
        "plr_id string, geography_version string, cell_index int, fraction_of_plr double")


def test_decoded_arrays_become_rows(spark):
    decoded = spark.createDataFrame([("T_2M", [273.15, 280.0, float("nan")])],
                                    "indicator string, values array<double>")
    rows = weather.explode_fields(decoded).orderBy("cell_index").collect()
    assert [(r["cell_index"], r["source_value"]) for r in rows] == [
        (0, 273.15), (1, 280.0), (2, None)]


def test_combine_and_wind(spark):
    rows = weather.combine_fields(field(spark)).orderBy("cell_index").collect()
    assert [r["wind_speed_10m_ms"] for r in rows] == [5.0, 13.0]
    assert [round(r["temperature_c"], 9) for r in rows] == [20.0, 21.0]
    enforce(weather.field_identity_audit(field(spark)))


def test_incomplete_fields_fail_the_audit(spark):
    broken = field(spark, drop={("U_10M", 1)})
    assert weather.combine_fields(broken).count() == 1
    with pytest.raises(CheckFailed):
        enforce(weather.field_identity_audit(broken))


def test_zone_means_for_several_runs(spark):
    runs = (RUN, RUN + dt.timedelta(hours=1))
    rows = weather.plr_weather(field(spark, runs=runs), bridge(spark)).collect()
    assert len(rows) == 4
    a = [r for r in rows if r["plr_id"] == "A"][0]
    assert a["temperature_c"] == pytest.approx(0.25 * 20 + 0.75 * 21)
    assert a["wind_speed_10m_ms"] == pytest.approx(0.25 * 5 + 0.75 * 13)


def test_a_forecast_without_an_indicator_comes_out_missing(spark):
    later = RUN + dt.timedelta(hours=1)
    whole = field(spark, runs=(RUN, later))
    lost = whole.filter((F.col("run_time_utc") == RUN) | (F.col("indicator") != "V_10M"))
    rows = weather.plr_weather(lost, bridge(spark)).collect()
    assert sorted((r["plr_id"], r["run_time_utc"]) for r in rows) == [
        (z, r) for z in "AB" for r in (RUN, later)]
    for r in rows:
        assert all((r[v] is None) == (r["run_time_utc"] == later) for v in schemas.WEATHER_VALUES)


def test_zone_with_an_uncovered_cell_is_missing(spark):
    broken = field(spark, drop={(i, 0) for i in VALUES})
    rows = {r["plr_id"]: r["temperature_c"]
            for r in weather.plr_weather(broken, bridge(spark)).collect()}
    assert rows["A"] is None and rows["B"] == pytest.approx(21.0)
    cover = weather.bridge_coverage(broken, bridge(spark)).first()
    assert (cover["missing_cell_count"], cover["passed"]) == (1, False)
    assert [r[0] for r in weather.missing_bridge_cells(broken, bridge(spark)).collect()] == [0]


def test_temperature_and_audit(spark):
    t = spark.createDataFrame([(0, RUN, RUN, 293.15, 20.0), (1, RUN, RUN, 297.15, 24.0)],
                              "cell_index int, run_time_utc timestamp, valid_time_utc timestamp, "
                              "temperature_k double, temperature_c double")
    rows = {r["plr_id"]: r for r in weather.plr_temperature(t, bridge(spark)).collect()}
    assert rows["A"]["temperature_c"] == 23.0 and rows["A"]["icon_cells_used"] == 2
    enforce(weather.temperature_audit(t, bridge(spark)))
    with pytest.raises(CheckFailed):
        enforce(weather.temperature_audit(t.union(t.limit(1)), bridge(spark)))


def test_final_table_and_checks(spark):
    accepted = spark.createDataFrame([("A", 100, 20, 0.2)], "plr_id string, population_total long, "
                                     "population_65plus long, share_65plus double")
    rejected = spark.createDataFrame([("B", "zero_population_total")],
                                     "plr_id string, rejection_reason string")
    final = weather.plr_weather_population(weather.plr_weather(field(spark), bridge(spark)),
                                           accepted, rejected)
    enforce(checks.coverage_check(final, 2))
    enforce(checks.exceptions_check(final, rejected))
    enforce(checks.identity_check(weather.with_partition_labels(final)))
    summary = weather.partition_summary(final).first()
    assert (summary["row_count"], summary["available_count"],
            summary["rejected_source_record_count"]) == (2, 1, 1)
    with pytest.raises(CheckFailed):
        enforce(checks.coverage_check(final, 3))
    with pytest.raises(CheckFailed):
        enforce(checks.exceptions_check(final, rejected.filter("false")))
    unreasoned = final.withColumn("population_rejection_reason", F.lit(None).cast("string"))
    assert not checks.exceptions_check(unreasoned, rejected).first()["passed"]
    shifted = weather.with_partition_labels(final).withColumn("lead_label", F.lit("PT001H00M"))
    assert not checks.identity_check(shifted).first()["passed"]
    stored = schemas.conform(final, schemas.PLR_WEATHER_POPULATION)
    assert stored.schema.simpleString() == schemas.PLR_WEATHER_POPULATION.simpleString()
    assert stored.count() == 2


def test_current_partition_is_newest_run_first_lead(spark):
    f = field(spark, runs=(RUN, RUN + dt.timedelta(hours=2)))
    later = f.withColumn("lead_time", F.lit("PT006H00M")).withColumn(
        "valid_time_utc", F.col("run_time_utc") + F.expr("interval 6 hours"))
    out = weather.current_exposure(weather.plr_weather(f.union(later), bridge(spark)))
    assert {(r["run_time_utc"], r["lead_time"]) for r in out.collect()} == {
        (RUN + dt.timedelta(hours=2), "PT000H00M")}


def test_observed_write(spark, tmp_path):
    out, seen = weather.observe_partition(weather.plr_weather(field(spark), bridge(spark)), "o")
    out.write.parquet(str(tmp_path / "o"))
    assert seen.get["row_count"] == 2 and seen.get["temperature_c_null_count"] == 0


def scoped(spark):
    mask = spark.createDataFrame([("v", "g", 5000, 0)], "geography_version string, "
                                 "source_grid_id string, mask_buffer_m int, cell_index int")
    kept, manifest = weather.mask_fields(field(spark), mask)
    scope = {"geography_version": F.lit("v"), "source_grid_id": F.lit("g"),
             "mask_buffer_m": F.lit(5000)}
    return mask, kept, manifest.withColumns(scope)


def test_scoped_partition(spark):
    mask, kept, manifest = scoped(spark)
    good = checks.scoped_partition_check(manifest, kept, mask, 2).first()
    assert good["passed"] and good["expected_retained_row_count"] == 5
    assert good["per_indicator_row_counts"]["T_2M"] == 1
    lost = checks.scoped_partition_check(manifest.filter("indicator <> 'T_2M'"), kept, mask, 2).first()
    assert not lost["passed"] and lost["missing_indicator_count"] == 1
    stray = checks.scoped_partition_check(manifest, field(spark), mask, 2).first()
    assert not stray["passed"] and stray["outside_mask_row_count"] == 5
    odd = manifest.withColumn("mask_buffer_m", F.when(F.col("indicator") == "T_2M", 1).otherwise(5000))
    assert checks.scoped_partition_check(odd, kept, mask, 2).first()["inconsistent_scope_count"] == 1
    none = checks.scoped_partition_check(manifest.filter("false"), kept, mask, 2).first()
    assert not none["passed"] and none["source_indicator_count"] == 0


def test_full_partition(spark):
    full = field(spark).withColumn("source_unit", F.lit("u"))
    good = checks.full_partition_check(full, 2, ("source_unit",)).first()
    assert good["passed"] and good["per_indicator_row_counts"] == {i: 2 for i in VALUES}
    late = full.withColumn("valid_time_utc", F.col("valid_time_utc") + F.expr("interval 1 hour"))
    assert checks.full_partition_check(late, 2, ("source_unit",)).first()[
        "wrong_valid_time_row_count"] == 10
    few = checks.full_partition_check(full.filter("indicator <> 'V_10M'"), 2, ("source_unit",)).first()
    assert (few["passed"], few["missing_indicator_count"],
            few["wrong_row_count_indicator_count"]) == (False, 1, 1)
