"""Tile index and tile slabs against plain Python, on borders, corners and long rings."""

import math
import random

import pytest
from pyspark.sql import functions as F

from gridcensus.operators import spatial, tiling
from tests.test_spatial import CELL, GEOMETRY, ZONE, clip, close, edges, frames, mesh, shoelace, star


def held(p, rings):
    """Even-odd rule over all rings; a point on an edge counts as held."""
    odd = False
    for ring in rings:
        for a, b in edges(ring):
            if (min(a[0], b[0]) <= p[0] <= max(a[0], b[0]) and min(a[1], b[1]) <= p[1] <= max(a[1], b[1])
                    and (b[0] - a[0]) * (p[1] - a[1]) == (b[1] - a[1]) * (p[0] - a[0])):
                return True
            if (a[1] > p[1]) != (b[1] > p[1]) and p[0] < a[0] + (b[0] - a[0]) * (p[1] - a[1]) / (b[1] - a[1]):
                odd = not odd
    return odd


def polygons(rng):
    """Shapes whose corners and edges fall on tile borders as often as not."""
    out = []
    for i in range(40):
        x, y = rng.randint(-3, 6) * 5.0, rng.randint(-3, 6) * 5.0
        ring = rng.choice([
            [(x, y), (x + 20, y), (x + 20, y + 20), (x, y + 20)],
            [(x, y), (x + 15, y + 15), (x, y + 30), (x - 15, y + 15)],
            [(x, y), (x + 20, y), (x + 20, y + 10), (x + 10, y + 10), (x + 10, y + 20), (x, y + 20)],
            [(x, y), (x + 7, y + 1), (x + 3, y + 9)],
            star(rng, x, y, 25, 9)])
        rings = [ring if i % 2 else ring[::-1]]
        if len(ring) == 4 and ring[1][1] == y:
            rings.append([(x + 5, y + 5), (x + 10, y + 5), (x + 10, y + 15), (x + 5, y + 15)])
        out.append(rings)
    return out


@pytest.mark.parametrize("size", [10.0, 5.0, 3.7, 400.0])
def test_points_on_borders_and_corners(spark, size):
    rng = random.Random(5)
    shapes = polygons(rng)
    points = [(float(x), float(y)) for x in range(-40, 60, 3) for y in range(-40, 60, 5)]
    points += [(5.0 * x, 5.0 * y) for x in range(-8, 12) for y in range(-8, 12)]
    zones, _ = frames(spark, shapes, mesh(1, 1, 10))
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(points)], "id int, x double, y double")
    got = spatial.points_in_polygons(df, zones.select("plr_id", "geometry"), size, ["id"])
    found = {(r["id"], int(r["plr_id"])) for r in got.collect()}
    want = {(i, j) for i, p in enumerate(points) for j, rings in enumerate(shapes) if held(p, rings)}
    assert found == want


def test_no_geometry_crosses_the_join_of_points(spark):
    zones, _ = frames(spark, polygons(random.Random(1)), mesh(1, 1, 10))
    points = spark.createDataFrame([(1, 2.0, 3.0)], "id int, x double, y double")
    plan = spatial.points_in_union(points, zones, ["id"], 10.0)._jdf.queryExecution().optimizedPlan()
    join = plan.toString().split("Join LeftSemi")[1]
    assert "geometry" not in join.split("\n")[0]
    assert plan.children().apply(0).schema().simpleString().count("geometry") == 0


def test_a_long_ring_gives_each_point_a_few_edges(spark):
    n, radius = 100_000, 50_000.0
    ring = [(radius * math.cos(2 * math.pi * i / n), radius * math.sin(2 * math.pi * i / n))
            for i in range(n)]
    zones = spark.createDataFrame([("z", "v", [[close(ring)]])], ZONE)
    size = 1000.0
    index = tiling.tile_index(zones, ["plr_id"], size).cache()
    assert index.agg(F.max(F.size("edges"))).first()[0] < 1500
    assert index.filter("size(edges) = 0").count() > 7000
    rng = random.Random(4)
    points = [(i, rng.uniform(-1, 1) * radius, rng.uniform(-1, 1) * radius) for i in range(2000)]
    df = spark.createDataFrame(points, "id int, x double, y double")
    got = {r["id"] for r in spatial.points_in_union(df, zones, ["id"], size).collect()}
    assert got == {i for i, x, y in points if math.hypot(x, y) < radius * math.cos(math.pi / n)}


@pytest.mark.parametrize("size", [10.0, 5.0, 7.3, 300.0])
def test_slabs_on_borders_add_up(spark, size):
    shapes = polygons(random.Random(8))
    triangles = [[(10.0 * c, 10.0 * r), (10.0 * c + 10, 10.0 * r), (10.0 * c + 10, 10.0 * r + 10)]
                 for c in range(-4, 6) for r in range(-4, 6)]
    zones, _ = frames(spark, shapes, mesh(1, 1, 10))
    cells = spark.createDataFrame(
        [("g", i, [[close(t)]], abs(shoelace(t))) for i, t in enumerate(triangles)], CELL)
    got = {(int(r["plr_id"]), r["cell_index"]): r["intersection_area_m2"]
           for r in spatial.area_bridge(zones, cells, size).collect()}
    for i, rings in enumerate(shapes):
        for j, t in enumerate(triangles):
            want = clip(rings[0], t) - sum(clip(h, t) for h in rings[1:])
            assert got.get((i, j), 0.0) == pytest.approx(want, abs=1e-6)


def test_slab_pairs_grow_with_overlaps_not_with_all_edges(spark):
    """A ring of n edges around many cells: pairs follow the edges near a cell."""
    counts = {}
    for n in (400, 1600):
        ring = [(1000 * math.cos(2 * math.pi * i / n), 1000 * math.sin(2 * math.pi * i / n))
                for i in range(n)]
        zones = spark.createDataFrame([("z", "v", [[close(ring)]])], ZONE)
        cells = spark.createDataFrame(
            [("g", i, [[close([(x, y), (x + 50, y), (x + 50, y + 50)])]], 1250.0)
             for i, (x, y) in enumerate((50.0 * a, 50.0 * b) for a in range(-20, 20) for b in range(-20, 20))],
            CELL)
        pairs = spatial.slab_pairs(zones, cells, ["plr_id"], ["cell_index"], 50.0)
        counts[n] = pairs.count()
        all_pairs = n * 1600 * 2
        assert counts[n] < all_pairs / 30
    assert counts[1600] < 4 * counts[400]


def test_polygons_that_repeat_count_once(spark):
    ring = [(0.0, 0.0), (9.0, 0.0), (9.0, 9.0), (0.0, 9.0)]
    twice = spark.createDataFrame([("a", [[close(ring)]]), ("a", [[close(ring)]]), ("b", None)],
                                  f"plr_id string, geometry {GEOMETRY}")
    points = spark.createDataFrame([(1, 3.0, 3.0), (2, None, 3.0)], "id int, x double, y double")
    assert [tuple(r) for r in spatial.points_in_polygons(points, twice, 4.0, ["id"]).collect()] == [
        (1, 3.0, 3.0, "a")]


def test_slabs_come_from_one_pass_over_the_tiles(spark):
    rings = spark.createDataFrame([(1, [[close([(0.0, 0.0), (25.0, 3.0), (9.0, 31.0)])]])],
                                  f"id int, geometry {GEOMETRY}")
    found = tiling.tile_slabs(rings, ["id"], 5.0)
    assert found._jdf.queryExecution().analyzed().collectLeaves().size() == 2
    height = F.col("y") - F.col("tile_y") * 5.0 + (F.col("hi") - F.col("lo")) * F.col("m") / 2
    area = found.agg(F.sum(F.col("sign") * (F.col("hi") - F.col("lo")) * height)).first()[0]
    assert area == pytest.approx(shoelace([(0.0, 0.0), (25.0, 3.0), (9.0, 31.0)]))
