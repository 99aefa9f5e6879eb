import datetime as dt

import pytest
from pyspark.sql import functions as F

from gridcensus import schemas
from gridcensus.functions import geom
from gridcensus.operators import checks, gates, joins, profiles
from gridcensus.operators.verdict import CheckFailed, enforce

RAW = ("source_row_id bigint, plr_id_source string, population_total_source string, "
       "population_65_79_source string, population_80plus_source string, "
       "reference_code_source string, publication_date date, source_sha256 string")


def raw_population(spark, rows):
    return spark.createDataFrame(
        [(i, *r, "209912", dt.date(2100, 1, 1), "abc") for i, r in enumerate(rows)], RAW)


ABC = [("A", "100", "15", "5"), ("B", "200", "20", "10"), ("C", None, None, None)]


def test_population_split(spark):
    raw = raw_population(spark, ABC)
    enforce(gates.population_preconditions(raw, 3))
    split = gates.population_gate(raw)
    report = split.report().first()
    assert (report["source_row_count"], report["accepted_row_count"],
            report["rejected_row_count"]) == (3, 2, 1)
    assert report["rejection_reasons"] == {"missing_population_total": 1}
    accepted = {r["plr_id"]: r for r in split.accepted.collect()}
    assert (accepted["A"]["population_65plus"], accepted["A"]["share_65plus"]) == (20, 0.20)
    assert (accepted["B"]["population_65plus"], accepted["B"]["share_65plus"]) == (30, 0.15)
    assert accepted["A"]["reference_date"] == dt.date(2099, 12, 31)
    verdict = checks.population_check(raw, split.accepted, split.rejected).first()
    assert verdict["passed"] and verdict["accepted_rejected_overlap"] == 0
    assert verdict["rejection_reasons"] == {"missing_population_total": 1}


@pytest.mark.parametrize("row,reason", [
    (("x", "", "1", "1"), "missing_population_total"),
    (("x", "ten", None, "1"), "invalid_population_total"),
    (("x", "10", " ", "zz"), "missing_population_65plus_component"),
    (("x", "10", "1", "zz"), "invalid_population_65plus_component"),
    (("x", "-1", "1", "1"), "negative_population_total"),
    (("x", "0", "0", "0"), "zero_population_total"),
    (("x", "10", "6", "5"), "invalid_population_65plus"),
    (("x", "10", "-1", "5"), "invalid_population_65plus"),
    (("x", "10", "5", "5"), None)])
def test_population_reasons(spark, row, reason):
    got = gates.classify_population(raw_population(spark, [row])).first()
    assert got["rejection_reason"] == reason
    assert (got["share_65plus"] is None) == (reason is not None)


@pytest.mark.parametrize("rows,expected", [
    ([], 0), (ABC, 4), ([*ABC, (" ", "1", "1", "0")], 4), ([*ABC, ("A", "1", "1", "0")], 4)])
def test_population_preconditions_fail(spark, rows, expected):
    raw = raw_population(spark, rows) if rows else spark.createDataFrame([], RAW)
    with pytest.raises(CheckFailed):
        enforce(gates.population_preconditions(raw, expected))


def test_lenient_split_of_a_full_snapshot(spark):
    rows = [(f"{i:08d}", "100", "15", "5", "202512") for i in range(540)]
    rows += [("00000540", None, None, None, "202512"), ("00000541", "100", "15", None, "202512")]
    frame = gates.normalise_population(spark.createDataFrame(
        rows, "RAUMID string, E_E string, E_E65U80 string, E_E80U110 string, ZEIT string"))
    split = gates.lenient_population_gate(frame)
    enforce(gates.lenient_preconditions(split, 542))
    report = split.report().first()
    assert (report["accepted_row_count"], report["rejected_row_count"]) == (540, 2)
    assert report["rejection_reasons"] == {"missing_population_total": 1,
                                           "missing_population_65plus_component": 1}
    enforce(checks.artefact_contract(split.accepted, split.rejected, 542))
    enforce(joins.split_accounting(split.classified, split.accepted, split.rejected, ["plr_id"]))


SOURCE = "RAUMID string, E_E string, E_E65U80 string, E_E80U110 string, ZEIT string"


@pytest.mark.parametrize("second,passes", [
    (("B", "200", "20", "10", "202512"), True), (("B", "200", "20", None, "202512"), True),
    (("A", "200", "20", "10", "202512"), False), (("B", None, "20", "10", "202512"), False),
    (("B", "100", "101", "0", "202512"), False), (("B", "200", "20", "10", "202411"), False)])
def test_population_contract(spark, second, passes):
    frame = spark.createDataFrame([("A", "100", "15", "5", "202512"), second], SOURCE)
    verdict = gates.population_contract(gates.normalise_population(frame), 2, "202512").first()
    assert verdict["passed"] is passes


def test_population_profile(spark):
    frame = gates.normalise_population(spark.createDataFrame(
        [("A", "100", "15", "5", "202512"), ("B", "200", "20", None, "202512")], SOURCE))
    p = profiles.population_profile(frame).first()
    assert (p["row_count"], p["population_80plus_null_count"],
            p["population_65plus_null_count"]) == (2, 1, 1)
    assert [r["plr_id"] for r in profiles.incomplete_population(frame).collect()] == ["B"]


def zone_row(i, plr, geometry, kind="POLYGON", srid=25833, version="v1"):
    return (i, plr, kind, geometry, srid, version, dt.date(2023, 1, 1), "sha")


ZONE = ("source_row_id bigint, plr_id_source string, geometry_type string, geometry "
        "array<array<array<struct<x:double,y:double>>>>, srid int, geography_version string, "
        "reference_date date, source_sha256 string")


def ring(*points):
    return [(float(x), float(y)) for x, y in points]


SQUARE = [[ring((390000, 5819000), (390100, 5819000), (390100, 5819100), (390000, 5819100),
                (390000, 5819000))]]


def test_one_square_is_normalised(spark):
    raw = spark.createDataFrame([zone_row(1, "A", SQUARE)], ZONE)
    enforce(gates.zone_preconditions(raw))
    split = gates.zone_gate(raw)
    assert split.accepted.select(geom.area("geometry")).first()[0] == 10000.0
    assert checks.zone_check(raw, split.accepted, split.rejected, 1).first()["passed"]


def test_zone_reasons(spark):
    bow = [[ring((0, 0), (4, 3), (4, 0), (0, 4), (0, 0))]]
    open_ring = [[ring((0, 0), (4, 0), (4, 4), (0, 4))]]
    spike = [[ring((0, 0), (4, 0), (4, 4), (4, 8), (4, 4), (0, 4), (0, 0))]]
    bad_hole = [[ring((0, 0), (10, 0), (10, 10), (0, 10), (0, 0)),
                 ring((8, 2), (12, 2), (12, 4), (8, 4), (8, 2))]]
    lonlat = [[ring((13.40, 52.50), (13.41, 52.50), (13.405, 52.51), (13.40, 52.50))]]
    rows = [zone_row(1, " ", SQUARE), zone_row(2, "B", SQUARE, version=None),
            zone_row(3, "C", SQUARE), zone_row(4, "C", None), zone_row(5, "D", None),
            zone_row(6, "E", []), zone_row(7, "F", SQUARE, srid=0),
            zone_row(8, "G", SQUARE, kind="LINESTRING"), zone_row(9, "H", bow),
            zone_row(10, "I", open_ring), zone_row(11, "J", spike), zone_row(12, "K", bad_hole),
            zone_row(13, "L", lonlat, srid=4326), zone_row(14, "M", SQUARE),
            zone_row(15, "N", SQUARE, srid=2056)]
    split = gates.zone_gate(spark.createDataFrame(rows, ZONE))
    got = {r["source_row_id"]: r["rejection_reason"] for r in split.classified.collect()}
    assert got == {
        1: "missing_plr_id", 2: "missing_geography_version", 3: "duplicate_plr_id",
        4: "duplicate_plr_id", 5: "missing_geometry", 6: "empty_geometry", 7: "missing_srid",
        8: "non_polygonal_geometry", 9: "invalid_geometry", 10: "invalid_geometry",
        11: "invalid_geometry", 12: "invalid_geometry", 13: None, 14: None,
        15: "unsupported_srid"}


def mesh(spark, corners=((0, 0), (1, 1), (2, 2)), lat=52.51):
    vertices = spark.createDataFrame(
        [("G", 0, 13.40, 52.50), ("G", 1, 13.41, 52.50), ("G", 2, 13.405, lat)],
        "source_grid_id string, vertex_index int, longitude_deg double, latitude_deg double")
    topology = spark.createDataFrame(
        [("G", 0, o, v) for o, v in corners],
        "source_grid_id string, cell_index int, vertex_order int, vertex_index int")
    return topology, vertices


def test_one_triangle_is_normalised(spark):
    topology, vertices = mesh(spark)
    split = gates.cell_gate(topology, vertices)
    cell = split.accepted.select("*", geom.exterior_point_count("geometry").alias("n")).first()
    assert cell["n"] == 4 and cell["icon_cell_area_m2"] > 0
    verdict = checks.cell_check(vertices, topology, split.accepted, split.rejected, 3, 1).first()
    assert verdict["passed"] and verdict["topology_row_count"] == 3


@pytest.mark.parametrize("corners,lat,reason", [
    (((0, 0), (1, 1)), 52.51, "invalid_vertex_count"),
    (((0, 0), (1, 1), (2, 1)), 52.51, "repeated_vertex"),
    (((0, 0), (1, 1), (2, 2)), None, "missing_vertex_coordinate"),
    (((0, 0), (1, 1), (3, 2)), 52.51, "missing_vertex_coordinate"),
    (((0, 0), (1, 1), (2, 2)), 95.0, "invalid_vertex_coordinate"),
    (((0, 0), (1, 1), (2, 2)), 52.50, None)])
def test_cell_reasons(spark, corners, lat, reason):
    topology, vertices = mesh(spark, corners, lat)
    assert gates.cell_gate(topology, vertices).classified.first()["rejection_reason"] == reason


HEAD = ("run_time_utc timestamp, lead_time string, indicator string, edition int, discipline int, "
        "parameterCategory int, parameterNumber int, typeOfFirstFixedSurface int, "
        "scaledValueOfFirstFixedSurface int, numberOfPoints int, numberOfMissing int, "
        "bitmapPresent int, units string, source_run_time_utc string, source_valid_time_utc string")
GOOD = (dt.datetime(2026, 8, 19, 12), "PT012H00M", "T_2M", 2, 0, 0, 0, 103, 2, 542040, 0, 0, "K",
        "2026-08-19T12:00:00Z", "2026-08-20T00:00:00Z")


@pytest.mark.parametrize("column,changed,reason", [
    (None, None, None), ("edition", 1, "wrong_edition"), ("discipline", None, "wrong_discipline"),
    ("parameterCategory", 5, "wrong_parameter_category"),
    ("parameterNumber", 6, "wrong_parameter_number"),
    ("typeOfFirstFixedSurface", 1, "wrong_surface_type"),
    ("scaledValueOfFirstFixedSurface", 10, "wrong_surface_value"),
    ("units", "degC", "unexpected_units"), ("units", " Kelvin ", None),
    ("numberOfPoints", 3, "wrong_point_count"), ("numberOfPoints", None, None),
    ("numberOfMissing", 4, "missing_without_bitmap"),
    ("source_run_time_utc", None, "missing_run_time"),
    ("source_valid_time_utc", None, "missing_valid_time"),
    ("source_run_time_utc", "2026-08-19T11:00:00Z", "run_time_mismatch"),
    ("source_valid_time_utc", "2026-08-19T12:00:00Z", "valid_time_mismatch"),
    ("indicator", "PMSL", "unsupported_indicator")])
def test_field_metadata(spark, column, changed, reason):
    names = [f.split()[0] for f in HEAD.split(", ")]
    row = tuple(changed if n == column else v for n, v in zip(names, GOOD))
    got = gates.field_metadata_gate(spark.createDataFrame([row], HEAD),
                                    schemas.indicator_contract(spark), 542040).first()
    assert got["rejection_reason"] == reason


T2M = ("cell_index long, run_time_utc timestamp, valid_time_utc timestamp, temperature_k double, "
       "temperature_c double")
T0 = dt.datetime(2026, 8, 13, 16)


def temperature(spark, **change):
    rows = [[i, T0, T0, k, k - 273.15] for i, k in enumerate((273.15, 280.15, 290.15))]
    for key, v in change.items():
        rows[1][{"cell": 0, "k": 3, "c": 4}[key]] = v
    return spark.createDataFrame([tuple(r) for r in rows], T2M)


@pytest.mark.parametrize("change,passes", [
    ({}, True), ({"k": 9999.0, "c": 9725.85}, True), ({"k": 9999.0}, False),
    ({"c": 9725.85}, False), ({"cell": 0}, False), ({"k": float("inf"), "c": 7.0}, False),
    ({"k": 320.0, "c": 320.0 - 273.15}, False), ({"k": 250.0, "c": 250.0 - 273.15}, False),
    ({"c": 8.0}, False), ({"cell": None}, False)])
def test_temperature_contract(spark, change, passes):
    assert gates.temperature_contract(temperature(spark, **change), 3).first()["passed"] is passes


def test_temperature_profile(spark):
    field = temperature(spark, k=9999.0, c=9725.85)
    p = profiles.temperature_profile(field).first()
    assert (p["missing_row_count"], p["lead_time_minutes"], p["row_count"]) == (1, 0, 3)
    seen = {r["column"]: r for r in profiles.observed_temperature(field).collect()}
    assert seen["temperature_k"]["max"] == 290.15 and seen["temperature_c"]["max"] == 17.0
    marked = spark.createDataFrame([(0, T0, T0, 273.15, 0.0), (2, T0, T0, 9999.0, 9725.85)], T2M)
    subset = profiles.bridge_subset_profile(
        marked, spark.createDataFrame([("A", 0), ("A", 2)], "plr_id string, cell_index long")).first()
    assert (subset["expected_relevant_cell_count"], subset["matched_cell_count"],
            subset["missing_temperature_row_count"]) == (2, 2, 1)


def test_evolution_guard(spark):
    old = spark.createDataFrame([("a", None), ("b", "h")], "plr_id string, source_sha256 string")
    new = spark.createDataFrame([("c", "h")], "plr_id string, source_sha256 string")
    got = {r["table_name"]: r["passed"] for r in checks.evolution_guard(
        {"old": old, "new": new}, "source_sha256").collect()}
    assert got == {"old": False, "new": True}
    wider = checks.add_missing_columns(old, new.withColumn("publisher", F.lit("p")))
    assert wider.columns == ["plr_id", "source_sha256", "publisher"] and wider.count() == 3


def test_constraint_audit_of_bridge(spark):
    bridge = spark.createDataFrame(
        [("A", 1, 0.5), ("A", 1, -0.1), (None, 2, 1.0), ("B", 9, 0.2)],
        "plr_id string, cell_index int, fraction_of_plr double")
    cells = spark.createDataFrame([(1,), (2,)], "cell int")
    got = {r["constraint"]: r["violation_count"] for r in checks.constraint_audit(
        bridge, ["plr_id", "cell_index"], ["plr_id"], {"positive": F.col("fraction_of_plr") > 0},
        {"cell": (["cell_index"], cells, ["cell"])}).collect()}
    assert got == {"not_null:plr_id": 1, "check:positive": 1, "primary_key": 1,
                   "foreign_key:cell": 1}


def test_schema_projection(spark):
    frame = spark.createDataFrame([("v", "A", "x")], "geography_version string, plr_id string, z string")
    with pytest.raises(ValueError, match="missing required columns"):
        schemas.conform(frame, schemas.BRIDGE)
    mask = spark.createDataFrame([(5, "v", "g", 7, None)],
                                 "cell_index bigint, geography_version string, "
                                 "source_grid_id string, mask_buffer_m bigint, created_at_utc timestamp")
    assert schemas.conform(mask, schemas.MASK).schema.names == schemas.MASK.names
