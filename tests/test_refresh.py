import datetime as dt

import pytest
from pyspark.sql import functions as F

from gridcensus.operators import checks, weather
from gridcensus.operators.verdict import CheckFailed, enforce, require_rows
from gridcensus.plans import refresh
from gridcensus.sources import tables
from tests.test_gates_and_checks import RAW, ZONE, zone_row

X, Y = 390000.0, 5819000.0


def square(x, y, side):
    return [[[(x, y), (x + side, y), (x + side, y + side), (x, y + side), (x, y)]]]


def snapshot(spark, rows, sha="s1"):
    return spark.createDataFrame([(i, *r, "202512", dt.date(2026, 4, 2), sha)
                                  for i, r in enumerate(rows)], RAW)


def test_from_sources_to_published_partitions(spark, tmp_path):
    raw = snapshot(spark, [("A", "100", "15", "5"), ("B", "0", "0", "0")])
    people = refresh.refresh_population(raw, expected_rows=2)
    again = refresh.refresh_population(raw, people.table, people.rejected, 2)
    assert again.table.count() == 1 and again.rejected.count() == 1
    with pytest.raises(CheckFailed):
        refresh.refresh_population(raw, expected_rows=3)

    zones = refresh.refresh_zones(spark.createDataFrame(
        [zone_row(1, "A", square(X, Y, 100.0)), zone_row(2, "B", square(X + 100, Y, 100.0)),
         zone_row(3, " ", square(X, Y, 5.0))], ZONE))
    moved = refresh.refresh_zones(spark.createDataFrame(
        [zone_row(1, "B", square(X + 100, Y, 50.0))], ZONE), zones.table, zones.rejected)
    assert zones.summary.first()["rejection_reasons"] == {"missing_plr_id": 1}
    assert moved.table.count() == 2 and moved.rejected.count() == 0

    corners = [(13.37, 52.50), (13.41, 52.50), (13.41, 52.53), (13.37, 52.53)]
    vertices = spark.createDataFrame([("G", i, *c) for i, c in enumerate(corners)],
                                     "source_grid_id string, vertex_index int, "
                                     "longitude_deg double, latitude_deg double")
    topology = spark.createDataFrame(
        [("G", c, o, v) for c, t in enumerate([(0, 1, 2), (0, 2, 3)]) for o, v in enumerate(t)],
        "source_grid_id string, cell_index int, vertex_order int, vertex_index int")
    cells = refresh.refresh_cells(topology, vertices)
    assert cells.table.count() == 2 and cells.rejected.count() == 0

    bridge = refresh.refresh_bridge(zones.table, cells.table)
    enforce(checks.bridge_check(bridge.table, zones.table, cells.table, 2))
    rebuilt = refresh.refresh_bridge(zones.table, cells.table, bridge.table)
    assert rebuilt.table.count() == bridge.table.count()
    mask = refresh.refresh_mask(zones.table, cells.table, bridge.table, buffer_m=5000)
    summary = mask.summary.first()
    assert summary["missing_bridge_cell_count"] == 0 and summary["mask_cell_count"] == 2
    enforce(checks.mask_check(mask.table, bridge.table, zones.table, cells.table, 2))

    run = dt.datetime(2026, 8, 19, 12)
    values = {"T_2M": 293.15, "RELHUM_2M": 50.0, "TD_2M": 283.15, "U_10M": 3.0, "V_10M": 4.0}
    field = spark.createDataFrame(
        [(run, "PT000H00M", run, i, c, v) for i, v in values.items() for c in (0, 1)],
        "run_time_utc timestamp, lead_time string, valid_time_utc timestamp, indicator string, "
        "cell_index int, source_value double")
    path = str(tmp_path / "exposure")
    out = refresh.publish_exposure(field, bridge.table, people.table, people.rejected, path, 2)
    assert out.summary.first()["available_count"] == 1
    stored = tables.read_partitions(spark, path, ["20260819T1200"], ["PT000H00M"])
    rows = {r["plr_id"]: r for r in stored.collect()}
    assert rows["A"]["temperature_c"] == pytest.approx(20.0)
    assert rows["A"]["wind_speed_10m_ms"] == pytest.approx(5.0)
    assert rows["B"]["population_rejection_reason"] == "zero_population_total"
    with pytest.raises(CheckFailed, match="bridge cells"):
        refresh.publish_exposure(field.filter("cell_index = 0"), bridge.table, people.table,
                                 people.rejected, None, 2)


def test_exposure_joins_the_fields_to_the_cells_once(spark, monkeypatch):
    calls, restrict = [], weather.restrict_to_cells
    monkeypatch.setattr(weather, "restrict_to_cells", lambda *args: calls.append(1) or restrict(*args))
    run = dt.datetime(2026, 8, 19, 12)
    field = spark.createDataFrame(
        [(run, "PT000H00M", run, i, c, 280.0) for i in ("T_2M", "RELHUM_2M", "TD_2M", "U_10M", "V_10M")
         for c in (0, 1)], "run_time_utc timestamp, lead_time string, valid_time_utc timestamp, "
        "indicator string, cell_index int, source_value double")
    bridge = spark.createDataFrame([("A", "v", "G", 0, 1.0)], "plr_id string, geography_version string, "
                                   "source_grid_id string, cell_index int, fraction_of_plr double")
    people = spark.createDataFrame([("A", 10, 4, 0.4)], "plr_id string, population_total bigint, "
                                   "population_65plus bigint, share_65plus double")
    refused = spark.createDataFrame([], "plr_id string, rejection_reason string")
    out = refresh.publish_exposure(field, bridge, people, refused, None, 1)
    assert len(calls) == 1 and out.summary.first()["available_count"] == 1
    assert out.table._jdf.queryExecution().analyzed().collectLeaves().size() == 1


def test_mask_lookup_fails_when_empty(spark):
    empty = spark.createDataFrame([], "geography_version string, mask_buffer_m int")
    zones = spark.createDataFrame([("v", dt.date(2023, 1, 1))],
                                  "geography_version string, reference_date date")
    with pytest.raises(CheckFailed, match="is empty"):
        require_rows(checks.current_mask(empty, zones, 5000), "weather mask")


def test_buffer_from_environment(monkeypatch):
    assert checks.mask_buffer_from_env() == 5000
    monkeypatch.setenv("WEATHER_MASK_BUFFER_M", "700")
    assert checks.mask_buffer_from_env() == 700
    monkeypatch.setenv("WEATHER_MASK_BUFFER_M", "-1")
    with pytest.raises(ValueError):
        checks.mask_buffer_from_env()


def test_shared_folder_falls_back_to_the_warehouse(spark):
    from gridcensus.session import shared_folder

    class Conf(dict):
        def set(self, key, value):
            self[key] = value

    class Session:
        conf = Conf({"spark.sql.warehouse.dir": "hdfs:///warehouse", "spark.master": "yarn"})

    class Own:
        conf = Conf({"spark.sql.warehouse.dir": "file:/home/me/warehouse", "spark.master": "yarn"})

    with pytest.raises(ValueError, match="all executors share"):
        shared_folder(Own())

    assert shared_folder(Session()) == "hdfs:///warehouse/_checkpoints"
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def test_stored_tables_keep_rows_and_can_be_released(spark):
    from gridcensus.session import cut_lineage, release_stored, stored_paths

    stored = cut_lineage(spark.range(7))
    assert stored.count() == 7 and stored.dtypes == spark.range(7).dtypes
    other = cut_lineage(spark.range(3))
    assert release_stored(spark, stored_paths()[-1:]) == 1 and stored.count() == 7
    with pytest.raises(Exception):
        other.count()
    assert release_stored(spark) >= 1 and not stored_paths()
