"""Bad and unusual input: it is reported or refused, never silently part of a result."""

import datetime
import math

import pytest
from pyspark.sql import functions as F

from gridcensus.operators import aggregates, joins, weather
from gridcensus.operators.verdict import CheckFailed
from gridcensus.plans import refresh
from gridcensus.schemas import INDICATORS
from gridcensus.sources import manifests, mesh

RUN, LATER = datetime.datetime(2026, 8, 19, 12), datetime.datetime(2026, 8, 19, 13)
FIELD = ("run_time_utc timestamp, lead_time string, valid_time_utc timestamp, indicator string, "
         "cell_index int, source_value double")


def field(spark, cells, run=RUN, skip=(), extra=()):
    rows = [(run, "PT000H00M", run, i, c, 280.0 if i in ("T_2M", "TD_2M") else 3.0)
            for i in INDICATORS for c in cells if (i, c) not in skip]
    return spark.createDataFrame(rows + [(run, "PT000H00M", run, *e) for e in extra], FIELD)


def bridge(spark, rows):
    return spark.createDataFrame(
        [(z, "v", "G", c, w) for z, c, w in rows],
        "plr_id string, geography_version string, source_grid_id string, cell_index int, "
        "fraction_of_plr double")


def population(spark, accepted, rejected):
    return (spark.createDataFrame([(a, 100.0, 20.0, 0.2) for a in accepted],
                                  "plr_id string, population_total double, "
                                  "population_65plus double, share_65plus double"),
            spark.createDataFrame([(r, "missing_population_total") for r in rejected],
                                  "plr_id string, rejection_reason string"))


def test_every_zone_of_the_bridge_appears(spark):
    links = bridge(spark, [("A", 1, 1.0), ("B", 99, 1.0)])
    got = {r.plr_id: r.temperature_c for r in weather.plr_weather(field(spark, [1, 2]), links).collect()}
    assert got == {"A": pytest.approx(6.85), "B": None}


@pytest.mark.parametrize("broken", [
    {"skip": {("V_10M", 1)}}, {"extra": [("T_2M", 1, 310.0)]}])
def test_publish_refuses_incomplete_and_repeated_cells(spark, broken):
    accepted, rejected = population(spark, ["A"], [])
    links = bridge(spark, [("A", 1, 1.0)])
    refresh.publish_exposure(field(spark, [1]), links, accepted, rejected, expected_zones=1)
    with pytest.raises(CheckFailed):
        refresh.publish_exposure(field(spark, [1], **broken), links, accepted, rejected,
                                 expected_zones=1)


@pytest.mark.parametrize("accepted, rejected", [(["A", "A"], ["B"]), (["A"], ["B", "B"])])
def test_repeated_population_keys_fail_the_audit(spark, accepted, rejected):
    left = spark.createDataFrame([("A",), ("B",)], "plr_id string")
    sound = joins.explained_audit(left, *population(spark, ["A"], ["B"]), "plr_id").first()
    found = joins.explained_audit(left, *population(spark, accepted, rejected), "plr_id").first()
    assert sound.passed and not found.passed
    assert found.repeated_accepted_key_count + found.repeated_registry_key_count == 1


def test_temperature_audit_keeps_an_uncovered_forecast(spark):
    rows = [(1, RUN, RUN, 280.0, 6.85), (7, LATER, LATER, 280.0, 6.85)]
    audit = weather.temperature_audit(spark.createDataFrame(
        rows, "cell_index int, run_time_utc timestamp, valid_time_utc timestamp, "
              "temperature_k double, temperature_c double"), bridge(spark, [("A", 1, 1.0)]))
    got = {r.run_time_utc: (r.missing_cell_count, r.passed) for r in audit.collect()}
    assert got == {RUN: (0, True), LATER: (1, False)}


def test_newest_forecast_is_the_last_run_at_its_first_lead(spark):
    both = field(spark, [1]).unionByName(field(spark, [1, 2], LATER)).unionByName(
        field(spark, [1], LATER).withColumn("lead_time", F.lit("PT001H00M")))
    rows = weather.newest_forecast(both).collect()
    assert len(rows) == 10 and {(r.run_time_utc, r.lead_time) for r in rows} == {(LATER, "PT000H00M")}
    assert weather.newest_forecast(both.limit(0)).count() == 0


def test_two_versions_of_a_bridge_are_weighed_apart(spark):
    one = bridge(spark, [("A", 1, 0.25), ("A", 2, 0.75)])
    two = one.unionByName(one.withColumn("geography_version", F.lit("w")))
    keys = ["geography_version", "source_grid_id", "plr_id"]
    assert aggregates.weight_deviation(two, keys, "fraction_of_plr", 1e-9).first()[0] == 0


def test_describe_keeps_infinite_values(spark):
    values = [1.0, 2.0, math.inf, math.inf, math.inf, None, math.nan]
    row = aggregates.describe(spark.createDataFrame([(v,) for v in values], "v double"), ["v"]).first()
    assert (row.value_count, row.min, row.median, row.max) == (5, 1.0, math.inf, math.inf)


def test_payload_after_many_blanks_is_still_a_page(spark):
    df = spark.createDataFrame([(bytearray(b" \n" * 2000 + b"<!DOCTYPE html>"),),
                                (bytearray(b"GRIB" + b"<html"),)], "content binary")
    got = [r[0] for r in df.select(manifests.payload_problem(F.col("content"))).collect()]
    assert got == ["html_payload", None]


def test_grids_of_different_shape_are_read_each_by_its_own(spark):
    rows = [("one", i, x) for i, x in enumerate([[1, 2], [2, 4], [3, 3]])]
    rows += [("zero", i, x) for i, x in enumerate([[0, 1, 2], [1, 3, 2], [0, 1, 3], [0, 2, 3]])]
    topology, verdict = mesh.topology_rows(spark.createDataFrame(
        rows, "source_grid_id string, row int, indexes array<int>"), 4)
    assert all(r.passed for r in verdict.collect()) and verdict.count() == 2
    cells = {(r.source_grid_id, r.cell_index, r.vertex_order): r.vertex_index
             for r in topology.collect()}
    assert [cells["one", 0, k] for k in range(3)] == [0, 1, 2]
    assert [cells["zero", 1, k] for k in range(3)] == [1, 3, 2]


def test_stream_reads_a_table_that_is_a_folder(spark, tmp_path):
    from gridcensus.plans.catalogue import QUERIES

    source = "/root/testdata/sf0.001"
    spark.read.parquet(f"{source}/events.parquet").repartition(3).write.parquet(
        str(tmp_path / "events.parquet"))
    rows = [sorted(map(tuple, QUERIES["stream_completion"](spark, d).collect()))
            for d in (source, str(tmp_path))]
    assert rows[0] == rows[1] and rows[0]
