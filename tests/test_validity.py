"""Simple-feature validity, other UTM zones, accents, and the byte bound of broadcasts."""

import math
import random
import time

import pytest
from pyspark.sql import functions as F

from gridcensus.functions import geom, projection, text
from gridcensus.operators import gates, skew, spatial
from tests.test_functions import value

SCHEMA = "id string, geometry array<array<array<struct<x:double,y:double>>>>"


def box(x0, y0, x1, y1):
    return [(x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0)]


SHELL, FAR = box(0.0, 0.0, 10.0, 10.0), box(20.0, 0.0, 30.0, 10.0)
SHAPES = {
    "plain": ([[SHELL]], False),
    "hole": ([[SHELL, box(2.0, 2.0, 4.0, 4.0)]], False),
    "two_holes": ([[SHELL, box(2.0, 2.0, 4.0, 4.0), box(5.0, 5.0, 6.0, 6.0)]], False),
    "island_in_hole": ([[SHELL, box(2.0, 2.0, 8.0, 8.0)], [box(3.0, 3.0, 4.0, 4.0)]], False),
    "two_parts": ([[SHELL], [FAR]], False),
    "parts_touch_in_a_point": ([[SHELL], [box(10.0, 10.0, 12.0, 12.0)]], False),
    "hole_touches_in_a_point": ([[SHELL, [(0.0, 5.0), (3.0, 4.0), (3.0, 6.0), (0.0, 5.0)]]], False),
    "hole_outside": ([[SHELL, box(12.0, 2.0, 14.0, 4.0)]], True),
    "hole_in_hole": ([[SHELL, box(2.0, 2.0, 8.0, 8.0), box(3.0, 3.0, 4.0, 4.0)]], True),
    "nested_part": ([[SHELL], [box(3.0, 3.0, 4.0, 4.0)]], True),
    "same_part_twice": ([[SHELL], [SHELL]], True),
    "hole_on_the_edge": ([[SHELL, box(0.0, 2.0, 3.0, 4.0)]], True),
    "parts_share_an_edge": ([[SHELL], [box(10.0, 0.0, 20.0, 10.0)]], True),
    "hole_across_the_edge": ([[SHELL, box(8.0, 2.0, 12.0, 4.0)]], True),
    "bow": ([[[(0.0, 0.0), (10.0, 8.0), (10.0, 0.0), (0.0, 10.0), (0.0, 0.0)]]], True),
    "open": ([[SHELL[:-1]]], True),
}


@pytest.mark.parametrize("shift,scale", [(0.0, 1.0), (370000.0, 137.0), (13.0, 0.001)])
def test_validity(spark, shift, scale):
    moved = [(name, [[[(x * scale + shift, y * scale + shift) for x, y in ring] for ring in poly]
                     for poly in shape]) for name, (shape, _) in SHAPES.items()]
    got = spatial.flag_invalid(spark.createDataFrame(moved, SCHEMA), ["id"]).collect()
    assert {r["id"]: r["is_invalid"] for r in got} == {k: bad for k, (_, bad) in SHAPES.items()}


def test_missing_and_empty_shapes(spark):
    rows = spark.createDataFrame([("null", None), ("empty", []), ("ok", [[SHELL]])], SCHEMA)
    got = {r["id"]: r["is_invalid"] for r in spatial.flag_invalid(rows, ["id"]).collect()}
    assert got == {"null": False, "empty": True, "ok": False}
    none = spatial.flag_invalid(rows.filter("false"), ["id"])
    assert none.count() == 0
    counts = rows.select("id", geom.exterior_point_count("geometry").alias("n")).collect()
    assert {r["id"]: r["n"] for r in counts} == {"null": 0, "empty": 0, "ok": 5}


def test_crossings_agree_with_brute_force(spark):
    random.seed(3)
    rings = []
    for k in range(40):
        points = [(random.uniform(0, 10), random.uniform(0, 10)) for _ in range(6)]
        rings.append((str(k), [[points + points[:1]]]))

    def turn(a, b, c):
        return (b[0] - a[0]) * (c[1] - a[1]) - (b[1] - a[1]) * (c[0] - a[0])

    def crosses(ring):
        sides = list(zip(ring[:-1], ring[1:]))
        return any(turn(a, b, c) * turn(a, b, d) < 0 and turn(c, d, a) * turn(c, d, b) < 0
                   for i, (a, b) in enumerate(sides) for c, d in sides[i + 1:])

    want = {k for k, shape in rings if crosses(shape[0][0])}
    got = spatial.self_crossings(spark.createDataFrame(rings, SCHEMA), ["id"]).collect()
    assert {r["id"] for r in got} == want and 0 < len(want) < len(rings)


def test_a_tall_side_is_no_crowd(spark):
    def seconds(n):
        left = [(0.0, float(i)) for i in range(n, 0, -1)]
        right = [(5.0, float(i)) for i in range(1, n + 1)]
        ring = [(0.0, 0.0), *right, *left, (0.0, 0.0)]
        df = spark.createDataFrame([("tall", [[ring]])], SCHEMA)
        started = time.time()
        assert spatial.self_crossings(df, ["id"]).count() == 0
        return time.time() - started

    seconds(100)
    assert seconds(8000) < 20


@pytest.mark.parametrize("srid,meridian", [(25832, 9.0), (25834, 21.0), (32632, 9.0), (32633, 15.0)])
def test_other_zones_reach_the_planar_one(spark, srid, meridian):
    lon, lat = F.lit(13.4), F.lit(52.5)
    there = projection.to_planar(lon, lat, meridian)
    moved = projection.reproject(F.array(F.array(F.array(there))), F.lit(srid))[0][0][0]
    want = projection.to_planar(lon, lat)
    row = spark.range(1).select(moved.alias("got"), want.alias("want")).first()
    assert row["got"]["x"] == pytest.approx(row["want"]["x"], abs=1e-3)
    assert row["got"]["y"] == pytest.approx(row["want"]["y"], abs=1e-3)


def test_southern_zones_and_web_mercator_reach_the_planar_one(spark):
    """Control points worked out in plain Python from the closed formulas."""
    lon, lat = 13.4, -33.25
    web = (math.radians(lon) * 6378137.0, math.asinh(math.tan(math.radians(lat))) * 6378137.0)
    want = spark.range(1).select(projection.to_planar(F.lit(lon), F.lit(lat)).alias("p")).first()["p"]
    south = spark.range(1).select(projection.to_planar(F.lit(lon), F.lit(lat), 9.0).alias("p")).first()["p"]
    for srid, x, y in ((3857, *web), (32732, south["x"], south["y"] + 1e7)):
        point = F.struct(F.lit(x).alias("x"), F.lit(y).alias("y"))
        got = spark.range(1).select(projection.reproject(
            F.array(F.array(F.array(point))), F.lit(srid))[0][0][0].alias("p")).first()["p"]
        assert (got["x"], got["y"]) == pytest.approx((want["x"], want["y"]), abs=1e-3)
    known = spark.range(1).select(*[projection.is_supported(F.lit(s)).alias(str(s)) for s in (
        4326, 25833, 32760, 3857, 31466, 32761)]).first()
    assert list(known) == [True, True, True, True, False, False]


def test_systems_without_a_transform_are_quarantined(spark):
    rows = [(1, "A", 31466), (2, "B", 25833), (3, "C", 0), (4, "D", 25832)]
    raw = spark.createDataFrame(rows, "source_row_id bigint, plr_id_source string, srid int").select(
        "*", F.lit("MULTIPOLYGON").alias("geometry_type"),
        geom.promote(geom.polygon(geom.rectangle(
            *[F.lit(v) for v in (400000.0, 5800000.0, 409000.0, 5809000.0)])))
        .alias("geometry"), F.lit("v").alias("geography_version"),
        F.lit("2023-01-01").cast("date").alias("reference_date"), F.lit("s").alias("source_sha256"))
    got = {r["plr_id"]: r["rejection_reason"] for r in gates.zone_gate(raw).classified.collect()}
    assert got == {"A": "unsupported_srid", "B": None, "C": "missing_srid", "D": None}


def test_accents_by_rule(spark):
    assert value(spark, text.transliterate(F.lit("Łódź Čeština Žižkov ő ễ ñ é"))) == \
        "łodz cestina zizkov o e n e"


def test_small_counts_bytes(spark):
    rows = spark.range(100).withColumn("wide", F.repeat(F.lit("x"), 1000))
    assert skew.is_small(rows)
    assert not skew.is_small(rows, max_bytes=50_000)
    assert not skew.is_small(rows, max_rows=99)
    assert skew.is_small(rows.filter("false"))
