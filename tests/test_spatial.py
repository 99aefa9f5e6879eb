"""Spatial jobs against brute force on small fixtures."""

import math
import random

import pytest
from pyspark.sql import functions as F

from gridcensus.functions import geom
from gridcensus.operators import checks, spatial
from gridcensus.operators.verdict import CheckFailed, enforce

GEOMETRY = "array<array<array<struct<x:double,y:double>>>>"
ZONE = f"plr_id string, geography_version string, geometry {GEOMETRY}"
CELL = f"source_grid_id string, cell_index int, geometry {GEOMETRY}, icon_cell_area_m2 double"
X0, Y0 = 390000.0, 5819000.0


def close(points):
    return [*points, points[0]]


def shoelace(points):
    x, y = points[0]
    return sum((a[0] - x) * (b[1] - y) - (b[0] - x) * (a[1] - y)
               for a, b in zip(points, [*points[1:], points[0]])) / 2


def clip(subject, triangle):
    """Part of a polygon inside a counter-clockwise triangle, by half-planes."""
    out = subject
    for a, b in zip(triangle, [*triangle[1:], triangle[0]]):
        side = lambda p: (b[0] - a[0]) * (p[1] - a[1]) - (b[1] - a[1]) * (p[0] - a[0])
        source, out = out, []
        for p, q in zip(source, [*source[1:], *source[:1]]):
            if side(p) >= 0:
                out.append(p)
            if side(p) * side(q) < 0:
                t = side(p) / (side(p) - side(q))
                out.append((p[0] + t * (q[0] - p[0]), p[1] + t * (q[1] - p[1])))
    return abs(shoelace(out)) if out else 0.0


def star(rng, cx, cy, radius, n):
    """A concave ring around a centre."""
    reach = [radius * rng.uniform(0.3, 1) for _ in range(n)]
    return [(cx + reach[i] * math.cos(2 * math.pi * i / n),
             cy + reach[i] * math.sin(2 * math.pi * i / n)) for i in range(n)]


def mesh(columns, rows, side):
    cells = []
    for r in range(rows):
        for c in range(columns):
            x, y = X0 + c * side, Y0 + r * side
            cells += [[(x, y), (x + side, y), (x + side, y + side)],
                      [(x, y), (x + side, y + side), (x, y + side)]]
    return cells


def frames(spark, polygons, triangles):
    zones = spark.createDataFrame(
        [(f"{i:03d}", "v", [[close(r) for r in rings]]) for i, rings in enumerate(polygons)], ZONE)
    cells = spark.createDataFrame(
        [("g", i, [[close(t)]], abs(shoelace(t))) for i, t in enumerate(triangles)], CELL)
    return zones, cells


@pytest.fixture(scope="module")
def world(spark):
    rng = random.Random(11)
    polygons = []
    for i in range(24):
        cx, cy = X0 + rng.uniform(900, 3100), Y0 + rng.uniform(900, 3100)
        outer = star(rng, cx, cy, rng.uniform(60, 500), rng.randint(5, 14))
        rings = [outer if i % 2 else outer[::-1]]
        if i % 4 == 0:
            rings.append([(cx - 5, cy - 5), (cx + 5, cy - 5), (cx + 5, cy + 5), (cx - 5, cy + 5)])
        polygons.append(rings)
    triangles = mesh(10, 10, 400)
    return polygons, triangles, *frames(spark, polygons, triangles)


def test_bridge_against_clipping(world):
    polygons, triangles, zones, cells = world
    want = {}
    for i, rings in enumerate(polygons):
        for j, t in enumerate(triangles):
            a = clip(rings[0], t) - sum(clip(h, t) for h in rings[1:])
            if a > 1e-6:
                want[f"{i:03d}", j] = a
    for size in (None, 150.0, 5000.0):
        got = {(r["plr_id"], r["cell_index"]): r["intersection_area_m2"]
               for r in spatial.area_bridge(zones, cells, size).collect()}
        assert got.keys() == want.keys()
        assert all(got[k] == pytest.approx(want[k], abs=1e-5) for k in want)


def test_bridge_passes_its_checks(world):
    _, _, zones, cells = world
    bridge = spatial.area_bridge(zones, cells).cache()
    enforce(checks.bridge_preconditions(zones, cells))
    enforce(checks.bridge_check(bridge, zones, cells, 24))
    enforce(checks.bridge_contract(bridge, 24))
    with pytest.raises(CheckFailed):
        enforce(checks.bridge_check(bridge.filter("plr_id <> '003'"), zones, cells, 24))
    with pytest.raises(CheckFailed):
        enforce(checks.bridge_check(bridge, zones, cells.filter("cell_index % 3 > 0"), 24))
    with pytest.raises(CheckFailed, match="plr_weight_failure_count': 24"):
        enforce(checks.bridge_check(bridge.withColumn(
            "fraction_of_plr", F.col("fraction_of_plr") * 0.9), zones, cells, 24))
    with pytest.raises(CheckFailed, match="duplicate_pair_count"):
        enforce(checks.bridge_contract(bridge.union(bridge.limit(1)), 24))


def test_square_into_two_triangles(spark):
    square = [(X0, Y0), (X0 + 100, Y0), (X0 + 100, Y0 + 100), (X0, Y0 + 100)]
    zones, cells = frames(spark, [[square]], mesh(1, 1, 100))
    rows = spatial.area_bridge(zones, cells).collect()
    assert len(rows) == 2
    for r in rows:
        assert r["intersection_area_m2"] == pytest.approx(5000, abs=1e-3)
        assert r["fraction_of_plr"] == pytest.approx(0.5)
        assert r["fraction_of_icon_cell"] == pytest.approx(1.0)


def edges(ring):
    return list(zip(ring, [*ring[1:], ring[0]]))


def point_gap(p, a, b):
    dx, dy = b[0] - a[0], b[1] - a[1]
    t = max(0, min(1, ((p[0] - a[0]) * dx + (p[1] - a[1]) * dy) / (dx * dx + dy * dy)))
    return math.hypot(p[0] - a[0] - t * dx, p[1] - a[1] - t * dy)


def gap(rings, triangle):
    """Distance of a polygon with holes and a triangle."""
    if clip(rings[0], triangle) - sum(clip(h, triangle) for h in rings[1:]) > 1e-9:
        return 0.0
    return min(min(point_gap(a, c, d), point_gap(b, c, d), point_gap(c, a, b), point_gap(d, a, b))
               for ring in rings for a, b in edges(ring) for c, d in edges(triangle))


@pytest.mark.parametrize("buffer_m", [0, 90, 700])
def test_mask_against_distances(world, buffer_m):
    polygons, triangles, zones, cells = world
    want = {j for j, t in enumerate(triangles)
            if min(gap(rings, t) for rings in polygons) <= buffer_m}
    got = [r["cell_index"] for r in spatial.weather_mask(zones, cells, buffer_m).collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_mask_holds_a_zone_inside_one_cell_and_cells_inside_one_zone(spark):
    tiny = [(X0 + 300, Y0 + 100), (X0 + 301, Y0 + 100), (X0 + 301, Y0 + 101)]
    huge = [(X0 - 5000, Y0 - 5000), (X0 + 9000, Y0 - 5000), (X0 + 9000, Y0 + 9000),
            (X0 - 5000, Y0 + 9000)]
    zones, cells = frames(spark, [[tiny]], mesh(1, 1, 400))
    assert [r["cell_index"] for r in spatial.weather_mask(zones, cells, 0).collect()] == [0]
    zones, cells = frames(spark, [[huge], [huge]], mesh(2, 2, 400))
    assert spatial.weather_mask(zones, cells, 0).count() == 8
    with pytest.raises(ValueError):
        spatial.weather_mask(zones, cells, -1)


def test_mask_check(world):
    _, _, zones, cells = world
    bridge, mask = spatial.area_bridge(zones, cells).cache(), spatial.weather_mask(
        zones, cells, 90).cache()
    enforce(checks.mask_check(mask, bridge, zones, cells, 24))
    used = {r[0] for r in bridge.select("cell_index").distinct().collect()}
    lost = mask.filter(F.col("cell_index") != min(used))
    assert checks.mask_check(lost, bridge, zones, cells, 24).first()["missing_bridge_cell_count"] == 1
    dated = zones.withColumn("reference_date", F.lit("2023-01-01").cast("date"))
    assert checks.current_mask(mask, dated, 90).count() == mask.count()
    assert checks.current_mask(mask, dated, 91).count() == 0


def test_outline_of_neighbours_and_copies(spark):
    left = [(0.0, 0.0), (10.0, 0.0), (10.0, 10.0), (0.0, 10.0)]
    right = [(10.0, 0.0), (20.0, 0.0), (20.0, 10.0), (10.0, 10.0)]
    zones, _ = frames(spark, [[left], [right[::-1]], [left]], mesh(1, 1, 10))
    assert spatial.outline(zones).count() == 6


def test_points_in_union(world, spark):
    polygons, _, zones, _ = world
    rng = random.Random(3)
    points = [(i, rng.uniform(X0, X0 + 4000), rng.uniform(Y0, Y0 + 4000)) for i in range(400)]

    def inside(p, ring):
        return sum((a[1] > p[1]) != (b[1] > p[1]) and
                   p[0] < a[0] + (b[0] - a[0]) * (p[1] - a[1]) / (b[1] - a[1])
                   for a, b in edges(ring)) % 2 == 1

    want = {i for i, x, y in points if any(
        inside((x, y), r[0]) and not any(inside((x, y), h) for h in r[1:]) for r in polygons)}
    df = spark.createDataFrame(points, "id int, x double, y double")
    for size in (100.0, 3000.0):
        got = [r["id"] for r in spatial.points_in_union(df, zones, ["id"], size).collect()]
        assert sorted(got) == sorted(want)


def nearest_by_hand(points, targets):
    out = set()
    for p, x, y in points:
        best = min(math.hypot(x - tx, y - ty) for _, tx, ty in targets)
        out |= {(p, t) for t, tx, ty in targets if math.hypot(x - tx, y - ty) == best}
    return out


def test_nearest_with_clusters_copies_and_outsiders(spark):
    rng = random.Random(7)
    targets = [(i, float(rng.randint(0, 10000)), float(rng.randint(0, 300))) for i in range(500)]
    targets += [(500 + i, 77.0 + rng.randint(0, 40) / 64, 88.0 + rng.randint(0, 40) / 64)
                for i in range(900)]
    targets += [(1400 + i, 5000.0, 5000.0) for i in range(30)]
    points = [(f"p{i}", float(rng.randint(-3000, 12000)), float(rng.randint(-3000, 6000)))
              for i in range(60)] + [(f"c{i}", 77.0 + i / 64, 88.0) for i in range(20)]
    got = spatial.nearest(spark.createDataFrame(points, "plr_id string, x double, y double"),
                          spark.createDataFrame(targets, "cell_index int, x double, y double"),
                          "plr_id", ["cell_index"])
    pairs = [(r["plr_id"], r["cell_index"]) for r in got.collect()]
    assert len(pairs) == len(set(pairs)) and set(pairs) == nearest_by_hand(points, targets)


def test_nearest_with_one_or_no_target(spark):
    points = spark.createDataFrame([("a", 0.0, 0.0)], "plr_id string, x double, y double")
    one = spark.createDataFrame([(1, 3.0, 4.0)], "cell_index int, x double, y double")
    assert spatial.nearest(points, one, "plr_id", ["cell_index"]).first()["distance_m"] == 5.0
    left = spatial.nearest(points, one.filter("false"), "plr_id", ["cell_index"]).collect()
    assert [tuple(r) for r in left] == [("a", None, None)]


def test_nearest_keeps_points_without_position_and_passes_over_such_targets(spark):
    points = spark.createDataFrame([("a", 0.0, 0.0), ("b", None, 1.0), ("c", 1.0, None)],
                                   "plr_id string, x double, y double")
    targets = spark.createDataFrame([(1, 3.0, 4.0), (2, None, 0.0), (3, 30.0, 40.0)],
                                    "cell_index int, x double, y double")
    got = spatial.nearest(points, targets, "plr_id", ["cell_index"]).collect()
    assert sorted(map(tuple, got)) == [("a", 1, 5.0), ("b", None, None), ("c", None, None)]


def test_only_the_crowded_part_of_the_tree_is_deep(spark):
    rng = random.Random(2)
    spots = [(rng.uniform(0, 1), rng.uniform(0, 1)) for _ in range(3000)]
    spots += [(1000.0 * rng.randint(1, 60), 1000.0 * rng.randint(1, 60)) for _ in range(800)]
    places = spark.createDataFrame(spots, "tx double, ty double").distinct()
    size = {"x0": 0.0, "y0": 0.0, "x1": 60000.0, "y1": 60000.0}
    nodes, held = spatial._tree(places, size)
    assert held.count() == places.count()
    leaves = {r["level"]: r["count"] for r in nodes.filter("leaf").groupBy("level").count().collect()}
    assert max(leaves) >= 4 and nodes.filter("level > 2 AND minx > 8000").isEmpty()
    assert nodes.filter("leaf AND n > 256").isEmpty()


def test_self_crossings(world, spark):
    _, _, zones, _ = world
    assert spatial.self_crossings(zones, ["plr_id"]).count() == 0
    comb = [(0.0, 0.0), (50.0, 0.0)] + [(50.0 - i, 5.0 + 40 * (i % 2)) for i in range(1, 50)]
    crossed = list(comb)
    crossed[10], crossed[30] = crossed[30], crossed[10]
    rings, _ = frames(spark, [[comb], [crossed]], mesh(1, 1, 10))
    assert [r["plr_id"] for r in spatial.self_crossings(rings, ["plr_id"]).collect()] == ["001"]


def test_overlap_expression_agrees_with_the_job(world):
    _, _, zones, cells = world
    a, b = zones.limit(3), cells.filter("cell_index between 40 and 130")
    direct = (a.crossJoin(b.withColumnRenamed("geometry", "cell")).select(
        "plr_id", "cell_index", geom.overlap_area("geometry", "cell").alias("a"))
        .filter("a > 1e-6"))
    job = spatial.area_bridge(a, b)
    want = {(r["plr_id"], r["cell_index"]): r["intersection_area_m2"] for r in job.collect()}
    got = {(r["plr_id"], r["cell_index"]): r["a"] for r in direct.collect()}
    assert got.keys() == want.keys()
    assert all(got[k] == pytest.approx(want[k], abs=1e-5) for k in want)


def test_rings_that_touch_in_a_circle_cut_the_interior(spark):
    """Against a search for a circle in the graph of rings and touching points."""
    shell = [(0.0, 0.0), (90.0, 0.0), (90.0, 90.0), (0.0, 90.0)]
    rng, shapes, want = random.Random(12), [], set()
    for i in range(60):
        spots = rng.sample(range(0, 9), rng.randint(1, 5))  # holes between points of a lattice line
        holes, ends = [], []
        for a in sorted(spots):
            x = a * 10.0
            holes.append([(x, 45.0), (x + 5, 47.0), (x + 10, 45.0), (x + 5, 43.0)])
            ends += [(a, a), (a, a + 1)]
        ends += [("s", p) for p in {p for _, p in ends} if p in (0, 9)]
        links = set(ends)
        while True:  # rings or points met once are on no circle
            met = [v for e in links for v in (("r", e[0]), ("p", e[1]))]
            less = {e for e in links if met.count(("r", e[0])) > 1 and met.count(("p", e[1])) > 1}
            if less == links:
                break
            links = less
        if links:
            want.add(f"{i:03d}")
        shapes.append([shell, *holes])
    shapes.append([shell, *[[(a * 10.0, 45.0), (a * 10.0 + 5, 47.0), (a * 10.0 + 10, 45.0),
                             (a * 10.0 + 5, 43.0)] for a in range(9)]])
    want.add("060")
    zones, _ = frames(spark, shapes, mesh(1, 1, 10))
    found = spatial.flag_invalid(zones, ["plr_id"]).filter("is_invalid")
    assert {r["plr_id"] for r in found.collect()} == want


def leaves(df):
    return df._jdf.queryExecution().analyzed().collectLeaves().size()


def test_nearest_reads_every_level_once(spark):
    rng = random.Random(5)
    targets = [(i, 1000.0 + rng.random() * 0.01, 1000.0 + rng.random() * 0.01) for i in range(900)]
    targets += [(900, 0.0, 0.0), (901, 2000.0, 0.0), (902, 1000.5, 1000.5), (903, 1000.5, 1000.5)]
    points = [("a", 1000.2, 1000.1), ("b", 1000.0, 0.0), ("c", 1000.005, 1000.005), ("c", 1900.0, 3.0),
              ("d", None, 1.0)]
    got = spatial.nearest(spark.createDataFrame(points, "plr_id string, x double, y double"),
                          spark.createDataFrame(targets, "cell_index int, x double, y double"),
                          "plr_id", ["cell_index"])
    assert leaves(got) <= 16  # ten levels at most; twice as many per level before
    rows = [(r["plr_id"], r["cell_index"]) for r in got.collect()]
    gap = lambda p, t: math.hypot(p[1] - t[1], p[2] - t[2])
    best = {p: min(gap(p, t) for t in targets) for p in points[:4]}
    least = {"a": best[points[0]], "b": best[points[1]], "c": min(best[points[2]], best[points[3]])}
    for p in points[:2]:
        assert {c for i, c in rows if i == p[0]} == {
            t[0] for t in targets if gap(p, t) == pytest.approx(least[p[0]], rel=1e-12)}
    assert {c for i, c in rows if i == "c"} == {
        t[0] for p in points[2:4] for t in targets if gap(p, t) == least["c"]}
    assert rows.count(("d", None)) == 1


def test_leaf_on_the_last_level_is_searched_in_lists(spark):
    step = 2.0**-40
    targets = spark.range(1200).select(F.col("id").cast("int").alias("cell_index"),
                                       (F.lit(1.0) + F.col("id") * step).alias("x"), F.lit(1.0).alias("y"))
    far = spark.createDataFrame([(1200, 1e9, 1e9)], "cell_index int, x double, y double")
    points = spark.createDataFrame([("a", 1.0 + 700 * step, 1.0), ("b", 0.0, 1.0)],
                                   "plr_id string, x double, y double")
    got = spatial.nearest(points, targets.union(far), "plr_id", ["cell_index"]).collect()
    assert {(r["plr_id"], r["cell_index"]) for r in got} == {("a", 700), ("b", 0)}


def test_rings_are_dealt_by_their_number(spark, monkeypatch):
    from gridcensus.operators import skew
    monkeypatch.setattr(skew, "ROWS_PER_TASK", 3)
    square = lambda x, y, m: close([(x, y), (x + m, y), (x + m, y + m), (x, y + m)])
    shapes = [(1, [[square(0.0, 0.0, 9.0), square(1.0, 1.0, 2.0), square(5.0, 5.0, 2.0)]]),
              (2, [[square(0.0, 0.0, 9.0), square(1.0, 1.0, 6.0), square(3.0, 3.0, 2.0)]]),
              (3, [[square(0.0, 0.0, 9.0), square(20.0, 1.0, 2.0)]]), (4, [[square(0.0, 0.0, 9.0)]]),
              (5, [[square(0.0, 0.0, 9.0)], [square(2.0, 2.0, 3.0)]])]
    df = spark.createDataFrame(shapes, f"id int, geometry {GEOMETRY}")
    assert skew.dealt(df, 60, "id").rdd.getNumPartitions() == 20
    marked = spatial.flag_invalid(df, ["id"])
    assert "RepartitionByExpression" in marked._jdf.queryExecution().analyzed().toString()
    assert {r["id"] for r in marked.collect() if r["is_invalid"]} == {2, 3, 5}
