"""Spatial joins as equi-joins on square tiles, followed by exact geometry.

Frames carry a ``geometry`` column (see ``functions.geom``) and a ``box`` struct. A pair
of boxes is met in every tile both cover; it is kept only in the tile that holds the lower
left corner of their common box, so pairs need no deduplicating shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridcensus.functions import geom
from gridcensus.functions.projection import reproject
from gridcensus.operators.joins import flag_duplicates
from gridcensus.operators.skew import dealt, lookup_join, spread
from gridcensus.operators.tiling import in_tile, tile_index, tile_slabs
from gridcensus.session import cut_lineage

TILE_KEYS = ("tile_x", "tile_y")


def with_box(df: DataFrame, geometry: str = "geometry") -> DataFrame:
    return df.withColumn("box", geom.bounds(geometry))


def suggest_tile_size(df: DataFrame, factor: float = 2.0) -> float:
    """A multiple of the mean box extent of the meshed side; one aggregate."""
    extent = F.greatest(F.col("box.maxx") - F.col("box.minx"),
                        F.col("box.maxy") - F.col("box.miny"))
    mean = df.agg(F.avg(extent)).first()[0]
    return max(float(mean or 1.0) * factor, 1e-6)


def _tile(c: Column, size: float) -> Column:
    return F.floor(c / size).cast("long")


def with_tiles(df: DataFrame, size: float, margin: float = 0.0) -> DataFrame:
    """One row per covered tile of the box, grown by ``margin`` on every side."""
    box = F.col("box")
    xs = F.sequence(_tile(box.minx - margin, size), _tile(box.maxx + margin, size))
    ys = F.sequence(_tile(box.miny - margin, size), _tile(box.maxy + margin, size))
    # The outer form drops nothing here: a missing box has no tile and meets nobody. Plain
    # explode would make the optimizer evaluate the boxes once more as a filter.
    return (df.withColumn("tile_x", F.explode_outer(xs))
            .withColumn("tile_y", F.explode_outer(ys)))


def shuffled(df: DataFrame) -> DataFrame:
    """A side of a tile join that must not be broadcast.

    The planner takes rows cut from geometries to be as small as the keys they were made from;
    sent whole they would fill the driver.
    """
    return df.hint("merge")


def candidate_pairs(left: DataFrame, right: DataFrame, size: float, margin: float = 0.0
                    ) -> DataFrame:
    """Pairs whose boxes come within ``margin``, each once.

    ``right`` columns get the prefix ``r_``. Crowded tiles are split by adaptive execution.
    """
    l = with_tiles(left, size)
    r = (with_tiles(right, size, margin)
         .select(*TILE_KEYS, *[F.col(c).alias(f"r_{c}") for c in right.columns]))
    a, b = F.col("l.box"), F.col("r.r_box")
    corner = ((_tile(F.greatest(a.minx, b.minx - margin), size) == F.col("l.tile_x"))
              & (_tile(F.greatest(a.miny, b.miny - margin), size) == F.col("l.tile_y")))
    same = (F.col("l.tile_x") == F.col("r.tile_x")) & (F.col("l.tile_y") == F.col("r.tile_y"))
    met = l.alias("l").join(shuffled(r.alias("r")), same & geom.boxes_overlap(a, b, margin) & corner)
    return met.drop(*[F.col(f"{side}.{k}") for side in "lr" for k in TILE_KEYS])


def area_bridge(zones: DataFrame, cells: DataFrame, tile_size: float | None = None,
                min_area: float = 1e-6) -> DataFrame:
    """Weighted zone-cell table: shared area and its share of either side.

    ``zones``: plr_id, geography_version, geometry. ``cells``: source_grid_id, cell_index,
    geometry, icon_cell_area_m2. Pairs that share no more than ``min_area`` square metres
    only touch and are left out.

    Both sides are cut along tiles, and the area of a pair is a sum over the pairs of their slabs
    that lie in one tile and share a part of its width.
    """
    zone, cell = ["plr_id", "geography_version"], ["source_grid_id", "cell_index"]
    size = tile_size or suggest_tile_size(with_box(cells.select("geometry")))
    measured = slab_pairs(zones, cells, zone, cell, size).groupBy(*zone, *cell).agg(
        F.sum("share").alias("intersection_area_m2")).filter(
        F.col("intersection_area_m2") > min_area)
    sized = measured.join(zones.select(*zone, geom.area("geometry").alias("plr_area_m2")), zone).join(
        cells.select(*cell, "icon_cell_area_m2"), cell)
    return sized.select(
        *zone, *cell, "intersection_area_m2", "plr_area_m2", "icon_cell_area_m2",
        (F.col("intersection_area_m2") / F.col("plr_area_m2")).alias("fraction_of_plr"),
        (F.col("intersection_area_m2") / F.col("icon_cell_area_m2")).alias("fraction_of_icon_cell"))


def slab_pairs(zones: DataFrame, cells: DataFrame, zone: Sequence[str], cell: Sequence[str],
               size: float) -> DataFrame:
    """Both keys and ``share`` for every pair of slabs of one tile that overlap in width."""
    slab = F.struct("lo", "hi", "y", "m", "sign")
    z = tile_slabs(zones, zone, size).select(*TILE_KEYS, *zone, slab.alias("e"))
    c = tile_slabs(cells, cell, size).select(*TILE_KEYS, *cell, slab.alias("f"))
    l, r = c.alias("l"), z.alias("r")
    met = (F.col("l.tile_x") == F.col("r.tile_x")) & (F.col("l.tile_y") == F.col("r.tile_y")) & (
        F.col("e.lo") < F.col("f.hi")) & (F.col("f.lo") < F.col("e.hi"))
    return _slab_shares(l.join(shuffled(r), met).select(
        *zone, *cell, (F.col("l.tile_y") * size).alias("floor"), "e", "f"))


def _slab_shares(edges: DataFrame) -> DataFrame:
    """What each pair of slabs ``e`` and ``f`` adds to the area shared by their geometries.

    Heights are taken above ``floor``, the lower border of their tile. The
    steps are columns of their own: one deep expression would repeat its parts and outgrow
    the size of method the JVM compiles.
    """
    e, f = F.col("e"), F.col("f")
    height = lambda s, at: s.y - F.col("floor") + (F.col(at) - s.lo) * s.m
    return (edges.withColumns({"_lo": F.greatest(e.lo, f.lo), "_hi": F.least(e.hi, f.hi)})
            .withColumns({"_ea": height(e, "_lo"), "_eb": height(e, "_hi"),
                          "_fa": height(f, "_lo"), "_fb": height(f, "_hi"),
                          "_w": e.sign * f.sign * F.greatest(F.col("_hi") - F.col("_lo"),
                                                             F.lit(0.0))})
            .withColumn("share", F.col("_w") * geom.lower_mean(
                F.col("_ea"), F.col("_eb"), F.col("_fa"), F.col("_fb"))))


def _with_segment_terms(df: DataFrame) -> DataFrame:
    """For segments ``e`` and ``f``: whether they properly cross, and their squared distance.

    Adds ``crosses`` and ``d2``, plus the turns ``_o1`` to ``_o4`` of every end seen from the
    other segment. As with areas, every step is a column of its own.
    """
    e, f = F.col("e"), F.col("f")
    c = F.col
    cross = lambda a, b: c(f"_{a}x") * c(f"_{b}y") - c(f"_{a}y") * c(f"_{b}x")
    dot = lambda a, b: c(f"_{a}x") * c(f"_{b}x") + c(f"_{a}y") * c(f"_{b}y")

    def along(p: str, s: str) -> Column:
        part = F.coalesce(dot(p, s) / F.nullif(c(f"_{s}{s}"), F.lit(0.0)), F.lit(0.0))
        return F.greatest(F.lit(0.0), F.least(F.lit(1.0), part))

    def off(p: str, s: str, t: str) -> Column:
        x, y = (c(f"_{p}{k}") - c(t) * c(f"_{s}{k}") for k in "xy")
        return x * x + y * y

    # u and v run along the segments; w, q, r, s point from one start to the other's ends.
    steps = (
        {"_ux": e.b.x - e.a.x, "_uy": e.b.y - e.a.y, "_vx": f.b.x - f.a.x, "_vy": f.b.y - f.a.y,
         "_wx": f.a.x - e.a.x, "_wy": f.a.y - e.a.y, "_qx": f.b.x - e.a.x, "_qy": f.b.y - e.a.y,
         "_rx": e.a.x - f.a.x, "_ry": e.a.y - f.a.y, "_sx": e.b.x - f.a.x, "_sy": e.b.y - f.a.y},
        {"_uu": dot("u", "u"), "_vv": dot("v", "v"), "_o1": F.signum(cross("u", "w")),
         "_o2": F.signum(cross("u", "q")), "_o3": F.signum(cross("v", "r")),
         "_o4": F.signum(cross("v", "s"))},
        {"_t1": along("w", "u"), "_t2": along("q", "u"), "_t3": along("r", "v"),
         "_t4": along("s", "v"),
         "crosses": (c("_o1") * c("_o2") < 0) & (c("_o3") * c("_o4") < 0)},
        {"_d1": off("w", "u", "_t1"), "_d2": off("q", "u", "_t2"), "_d3": off("r", "v", "_t3"),
         "_d4": off("s", "v", "_t4")},
        {"d2": F.when(c("crosses"), 0.0).otherwise(F.least("_d1", "_d2", "_d3", "_d4"))})
    for step in steps:
        df = df.withColumns(step)
    return df


def weather_mask(zones: DataFrame, cells: DataFrame, buffer_m: int,
                 tile_size: float | None = None) -> DataFrame:
    """Cells within ``buffer_m`` metres of any zone, touching included.

    The zones are neither merged nor buffered. A cell is near their union exactly when one
    of its corners lies in a zone, a zone lies in the cell, or its edges come within the
    buffer of the union's outline. The last test runs on edge pairs as generated code.
    """
    if buffer_m < 0:
        raise ValueError("the mask buffer must not be negative")
    key = ["geography_version", "source_grid_id", "cell_index"]
    z = zones.select("geography_version", "geometry")
    c = with_box(cells.select("source_grid_id", "cell_index", "geometry"))
    size = tile_size or max(suggest_tile_size(c), float(buffer_m))

    def first_corners(df: DataFrame) -> DataFrame:
        parts = df.select(*df.columns, F.explode("geometry").alias("_part"))
        return parts.select(*[k for k in df.columns if k not in ("geometry", "box")],
                            F.col("_part")[0][0]["x"].alias("x"),
                            F.col("_part")[0][0]["y"].alias("y"))

    # Tiles several cells and buffers wide: a row goes to every tile that it reaches.
    wide = 6.0 * size
    corner_in_zone = points_in_polygons(first_corners(c), z, wide, ["source_grid_id", "cell_index"])
    rim = outline(z, ["geography_version"]).select("geography_version", *_flat(
        F.col("a"), F.col("b")), F.lit(False).alias("corner"))
    at = F.struct("x", "y")
    inner = first_corners(z).select("geography_version", *_flat(at, at), F.lit(True).alias("corner"))
    near = _shape_gaps(c, rim.union(inner), max(wide, 8.0 * buffer_m), float(buffer_m))
    # The smallest distance per cell is known before the shuffle; a filter ahead of it would
    # be pushed under the steps and repeat them.
    hits = near.select(*key, "d2").union(corner_in_zone.select(*key, F.lit(0.0)))
    return (hits.groupBy(*key).agg(F.min("d2").alias("d2"))
            .filter(F.col("d2") <= float(buffer_m) ** 2)
            .select("geography_version", "source_grid_id",
                    F.lit(buffer_m).alias("mask_buffer_m"), "cell_index"))


def _flat(a: Column, b: Column) -> list[Column]:
    """The ends of a segment as four numbers, which are shuffled in half the bytes."""
    return [p[axis].alias(f"{end}{axis}") for end, p in (("a", a), ("b", b)) for axis in "xy"]


def _nested(e: Column | None = None) -> Column:
    """The segment that ``_flat`` took apart, from a structure or from columns."""
    part = (lambda k: F.col(k)) if e is None else (lambda k: e[k])
    return F.struct(*[F.struct(part(f"{end}x").alias("x"), part(f"{end}y").alias("y")).alias(end)
                      for end in "ab"])


def _shape_gaps(shapes: DataFrame, segments: DataFrame, size: float, margin: float) -> DataFrame:
    """Shapes (``geometry``, ``box``) with the segments whose boxes come within ``margin``: the
    other columns of both and the squared distance ``d2`` of the segment to each of the shape's edges.

    A segment marked ``corner`` is a point that counts, at distance 0, where the shape holds it or
    has it on an edge, and nowhere else. The shapes are sent once for both kinds of segments, and
    of the boxes only those of the shapes.
    """
    carried = [k for k in shapes.columns if k not in ("geometry", "box")]
    named = [k for k in segments.columns if k not in ("ax", "ay", "bx", "by", "corner")]
    edges = F.transform(geom.all_edges("geometry"), lambda e: F.struct(*_flat(e["a"], e["b"])))
    l = with_tiles(shapes.select(*carried, "box", edges.alias("edges")), size)
    reach = F.when(F.col("corner"), 0.0).otherwise(margin)
    minx, miny = F.least("ax", "bx") - reach, F.least("ay", "by") - reach
    maxx, maxy = F.greatest("ax", "bx") + reach, F.greatest("ay", "by") + reach
    r = (segments
         .withColumn("r_tile_x", F.explode_outer(F.sequence(_tile(minx, size), _tile(maxx, size))))
         .withColumn("r_tile_y", F.explode_outer(F.sequence(_tile(miny, size), _tile(maxy, size)))))
    box = F.col("box")
    met = ((F.col("tile_x") == F.col("r_tile_x")) & (F.col("tile_y") == F.col("r_tile_y"))
           & (box.minx <= maxx) & (minx <= box.maxx) & (box.miny <= maxy) & (miny <= box.maxy)
           & (_tile(F.greatest(box.minx, minx), size) == F.col("tile_x"))
           & (_tile(F.greatest(box.miny, miny), size) == F.col("tile_y")))
    pairs = l.join(shuffled(r), met)
    held = F.when(F.col("corner"), geom.flat_edges_hold("edges", "ax", "ay"))
    # One row is enough for a point. The outer form as in ``with_tiles``.
    own = F.when(F.col("corner"), F.slice("edges", 1, 1)).otherwise(F.col("edges"))
    each = pairs.select(*carried, *named, _nested().alias("e"), "corner", held.alias("_held"),
                        F.explode_outer(own).alias("_f"))
    gaps = _with_segment_terms(each.withColumn("f", _nested(F.col("_f"))))
    return gaps.select(*carried, *named, F.when(F.col("corner"), F.when(F.col("_held"), 0.0)).otherwise(
        F.col("d2")).alias("d2"))


def _in_tiles(points: DataFrame, size: float) -> DataFrame:
    return points.withColumn("tile_x", _tile(F.col("x"), size)).withColumn(
        "tile_y", _tile(F.col("y"), size))


def points_in_polygons(points: DataFrame, polygons: DataFrame, tile_size: float,
                       point_id: Sequence[str], how: str = "inner") -> DataFrame:
    """Points (columns ``x``, ``y``) with the polygons they lie in or on the edge of.

    A point meets the polygons' index rows of its own tile, with the edges in that tile only.
    ``how`` may be ``left_semi`` to keep each point once. Polygons that repeat count once.
    """
    carried = [c for c in polygons.columns if c not in (*points.columns, "geometry")]
    index = tile_index(polygons, carried, tile_size)
    l, r = _in_tiles(spread(points, *point_id), tile_size).alias("l"), index.alias("r")
    tile_x, tile_y = F.col("l.tile_x"), F.col("l.tile_y")
    x, y, box = F.col("l.x"), F.col("l.y"), F.col("r._box")
    met = ((tile_x == F.col("r.tile_x")) & (tile_y == F.col("r.tile_y"))
           & x.between(box.minx, box.maxx) & y.between(box.miny, box.maxy) & in_tile(
               F.col("r.edges"), F.col("r.corner_inside"), x, y, tile_x, tile_y, tile_size))
    return l.join(shuffled(r), met, how).select(
        *[F.col(f"l.{c}") for c in points.columns],
        *([] if how == "left_semi" else [F.col(f"r.{c}") for c in carried]))


def points_in_union(points: DataFrame, zones: DataFrame, point_id: Sequence[str],
                    tile_size: float) -> DataFrame:
    """Points inside or on the edge of any zone, each once."""
    return points_in_polygons(points, zones.select("geometry"), tile_size, point_id, "left_semi")


def outline(zones: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """Edges of the dissolved zones, per group: those that only one side runs along.

    With all rings turned the same way, neighbours run along a shared edge in opposite
    directions. Copies of a zone run along it in the same direction and leave it once.
    """
    rings = zones.select(*group, F.explode("geometry").alias("poly")).select(
        *group, F.posexplode("poly").alias("i", "ring"))
    turned = rings.withColumn("turn", geom.turning("ring") * F.when(
        F.col("i") == 0, 1.0).otherwise(-1.0))
    e = turned.select(*group, "turn", F.explode(geom.edges("ring")).alias("e")).select(
        *group, F.when(F.col("turn") > 0, F.col("e.a")).otherwise(F.col("e.b")).alias("from"),
        F.when(F.col("turn") > 0, F.col("e.b")).otherwise(F.col("e.a")).alias("to"))
    upward = F.col("from") < F.col("to")
    return (e.filter(F.col("from") != F.col("to"))
            .select(*group, F.when(upward, F.col("from")).otherwise(F.col("to")).alias("a"),
                    F.when(upward, F.col("to")).otherwise(F.col("from")).alias("b"),
                    upward.alias("upward"))
            .groupBy(*group, "a", "b")
            .agg(F.min("upward").alias("low"), F.max("upward").alias("high"))
            .filter(F.col("low") == F.col("high")).drop("low", "high"))


def _ring_edges(df: DataFrame, key: Sequence[str], strip_factor: float) -> DataFrame:
    """Edges of all rings with their extent and the vertical strips they reach into.

    A strip is as wide as a few mean edges of the geometry.
    """
    extents = F.filter(F.transform(geom.all_edges("geometry"), lambda e: F.greatest(
        F.abs(e.b.x - e.a.x), F.abs(e.b.y - e.a.y))), lambda v: v > 0)
    mean = geom.let(extents, lambda v: F.try_divide(
        F.aggregate(v, F.lit(0.0), lambda total, one: total + one), F.size(v)))
    width = F.greatest(mean * strip_factor, F.lit(1e-6))
    return (df.select(*key, width.alias("width"), F.posexplode("geometry").alias("part", "poly"))
            .select(*key, "width", "part", F.posexplode("poly").alias("hole", "pts"))
            .select(*key, "width", F.struct("part", "hole").alias("ring"),
                    (F.size("pts") - 1).alias("steps"),
                    F.posexplode(geom.edges("pts")).alias("pos", "e"))
            .filter(F.col("e.a") != F.col("e.b"))
            .withColumn("lo", F.least("e.a.x", "e.b.x")).withColumn("hi", F.greatest("e.a.x", "e.b.x"))
            .withColumn("bot", F.least("e.a.y", "e.b.y")).withColumn("top", F.greatest("e.a.y", "e.b.y"))
            .withColumn("strip", F.explode(F.sequence(
                F.floor(F.col("lo") / F.col("width")), F.floor(F.col("hi") / F.col("width"))))))


def _crossings(strips: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys with two edges that cross, touch where they must not, or run along each other, and
    keys whose rings touch in a circle, which cuts the interior in two.

    Within its strip an edge takes the square tiles that it passes, so a long vertical side is
    no crowd and a long slanting edge takes as many tiles as it is long. Edges that share several
    tiles are judged in each; the verdict is the same.
    """
    e, w = F.col("e"), F.col("width")
    slope = F.coalesce(F.try_divide(e.b.y - e.a.y, e.b.x - e.a.x), F.lit(0.0))
    at = lambda x: F.greatest("bot", F.least("top", e.a.y + (x - e.a.x) * slope))
    left, right = at(F.greatest(F.col("lo"), F.col("strip") * w)), at(
        F.least(F.col("hi"), (F.col("strip") + 1) * w))
    upright = F.col("lo") == F.col("hi")
    low = F.when(upright, F.col("bot")).otherwise(F.least(left, right))
    high = F.when(upright, F.col("top")).otherwise(F.greatest(left, right))
    tiled = strips.withColumn("level", F.explode(F.sequence(
        F.floor(low / w - 1e-6), F.floor(high / w + 1e-6))))
    l, r = tiled.alias("l"), tiled.alias("r")
    same = (F.col("l.strip") == F.col("r.strip")) & (F.col("l.level") == F.col("r.level"))
    for k in key:
        same = same & (F.col(f"l.{k}") == F.col(f"r.{k}"))
    order = F.struct("l.ring", "l.pos") < F.struct("r.ring", "r.pos")
    overlap = ((F.col("l.bot") <= F.col("r.top")) & (F.col("r.bot") <= F.col("l.top"))
               & (F.col("l.lo") <= F.col("r.hi")) & (F.col("r.lo") <= F.col("l.hi")))
    pairs = l.join(r, same & order & overlap)
    neighbours = (F.col("l.ring") == F.col("r.ring")) & (
        (F.col("r.pos") - F.col("l.pos") == 1)
        | ((F.col("l.pos") == 0) & (F.col("r.pos") == F.col("l.steps") - 1)))
    shared = ((F.greatest("l.lo", "r.lo") < F.least("l.hi", "r.hi"))
              | (F.greatest("l.bot", "r.bot") < F.least("l.top", "r.top")))
    judged = _with_segment_terms(pairs.select(
        *[F.col(f"l.{k}").alias(k) for k in key], F.col("l.e").alias("e"),
        F.col("r.e").alias("f"), neighbours.alias("_neighbours"),
        F.col("l.ring").alias("_ring"), F.col("r.ring").alias("_other"),
        (F.col("l.ring") != F.col("r.ring")).alias("_rings"), shared.alias("_shared")))
    parallel = F.col("_ux") * F.col("_vy") == F.col("_uy") * F.col("_vx")
    folded = parallel & (F.col("_ux") * F.col("_vx") + F.col("_uy") * F.col("_vy") < 0)
    alongside = parallel & F.col("_shared") & (F.col("d2") == 0)
    bad = (F.when(F.col("_neighbours"), folded)
           .when(F.col("_rings"), F.col("crosses") | alongside).otherwise(F.col("d2") == 0))
    on = F.filter(F.array(*[F.when(F.col(d) == 0, end) for d, end in (
        ("_d1", F.col("f.a")), ("_d2", F.col("f.b")), ("_d3", F.col("e.a")), ("_d4", F.col("e.b")))]),
        lambda p: p.isNotNull())
    touching = F.col("_rings") & (F.col("_ring.part") == F.col("_other.part")) & (F.col("d2") == 0)
    meets = F.struct("_ring", "_other", on.alias("points"))
    found = judged.groupBy(*key).agg(
        F.max(bad).alias("_bad"), F.collect_set(F.when(touching, meets)).alias("_meets"))
    return found.filter(F.col("_bad") | (
        (F.size("_meets") > 0) & _touch_in_a_circle(F.col("_meets")))).select(*key)


def _touch_in_a_circle(meets: Column) -> Column:
    """Whether the graph of rings and the points where they touch has a circle.

    The rings' ends of points are taken one after the other; one whose ring and point are joined
    already closes a circle. There are as few groups as rings that touch.
    """
    def name(*parts: Column) -> Column:
        return F.concat_ws(",", *[p.cast("string") for p in parts])

    def links(m: Column) -> Column:
        spots = F.transform(m["points"], lambda p: name(m["_ring"]["part"], p["x"], p["y"]))
        rings = F.array(*[name(m[r]["part"], m[r]["hole"]) for r in ("_ring", "_other")])
        return F.flatten(F.transform(spots, lambda p: F.transform(
            rings, lambda r: F.struct(r.alias("ring"), p.alias("point")))))

    def join(state: Column, link: Column) -> Column:
        one = F.coalesce(F.get(F.filter(state["groups"], lambda g: F.array_contains(
            g, link["ring"])), F.lit(0)), F.array(link["ring"]))
        holds = F.array_contains(one, link["point"])
        other = F.coalesce(F.get(F.filter(state["groups"], lambda g: F.array_contains(
            g, link["point"])), F.lit(0)), F.array(link["point"]))
        rest = F.filter(state["groups"], lambda g: ~F.array_contains(
            g, link["ring"]) & ~F.array_contains(g, link["point"]))
        return F.struct(
            F.when(holds, state["groups"]).otherwise(
                F.concat(rest, F.array(F.concat(one, other)))).alias("groups"),
            (state["circle"] | holds).alias("circle"))

    start = F.struct(F.array().cast("array<array<string>>").alias("groups"), F.lit(False).alias("circle"))
    every = F.array_distinct(F.flatten(F.transform(meets, links)))
    return F.aggregate(every, start, join)["circle"]


def self_crossings(df: DataFrame, key: Sequence[str], strip_factor: float = 2.0) -> DataFrame:
    """Keys whose rings cross themselves or each other, share more than points, or touch in a
    circle."""
    return _crossings(_ring_edges(df, key, strip_factor), key)


def _misplaced(strips: DataFrame, key: Sequence[str], rows: int) -> DataFrame:
    """Keys with a hole outside its shell or in another hole, or a part inside another part.

    Rings that do not cross lie wholly inside or outside each other, so one point of each ring,
    the middle of its first edge, stands for it. A ring holds the point if an odd number of its
    edges lies above it; these edges are in the point's strip. Rings that the point lies on are
    not judged by it. ``rows`` counts the strips: no task gets more of them as they grow.
    """
    rings = dealt(strips.select(*key, "ring", "e", "pos", "width"), rows, *key, "ring").groupBy(
        *key, "ring").agg(
        F.min_by("e", "pos").alias("e"), F.any_value("width").alias("width")).select(
        *key, "ring", "width", ((F.col("e.a.x") + F.col("e.b.x")) / 2).alias("x"),
        ((F.col("e.a.y") + F.col("e.b.y")) / 2).alias("y"))
    several = rings.groupBy(*key).agg(F.count("*").alias("_n")).filter("_n > 1").select(*key)
    points = rings.join(several, list(key)).withColumn("strip", F.floor(F.col("x") / F.col("width")))
    l = dealt(points, rows, *key, "strip").alias("l")
    r = dealt(strips.select(*key, "strip", "ring", "e", "lo", "hi", "bot", "top"), rows, *key,
              "strip").alias("r")
    same = F.col("l.strip") == F.col("r.strip")
    for k in key:
        same = same & (F.col(f"l.{k}") == F.col(f"r.{k}"))
    x, y, e = F.col("l.x"), F.col("l.y"), F.col("r.e")
    upright = (F.col("r.lo") == F.col("r.hi")) & (F.col("r.lo") == x)
    over = (F.col("r.lo") <= x) & (x < F.col("r.hi"))
    height = e.a.y + (x - e.a.x) * F.coalesce(F.try_divide(e.b.y - e.a.y, e.b.x - e.a.x), F.lit(0.0))
    near = F.abs(height - y) <= (F.abs(y) + 1) * 1e-12
    on = F.when(upright, y.between(F.col("r.bot"), F.col("r.top"))).otherwise(near)
    held = (l.join(r, same & (F.col("l.ring") != F.col("r.ring")) & (over | upright))
            .groupBy(*[F.col(f"l.{k}").alias(k) for k in key], F.col("l.ring").alias("ring"),
                     F.col("r.ring").alias("by"))
            .agg((F.count_if(over & (height > y)) % 2 == 1).alias("inside"),
                 F.max(on).alias("on")))
    hole, own = F.col("ring.hole") > 0, F.col("ring.part") == F.col("by.part")
    shell = F.col("by.hole") == 0
    sure = F.col("inside") & ~F.col("on")
    # Every ring is there once without another that could hold it.
    alone = points.select(*key, "ring", *[F.lit(None).cast(held.schema[c].dataType).alias(c)
                                          for c in ("by", "inside", "on")])
    found = dealt(held.unionByName(alone), rows, *key, "ring").groupBy(*key, "ring").agg(
        F.max(F.when(own & shell, F.col("inside") | F.col("on"))).alias("_home"),
        F.max(own & ~shell & sure).alias("_nested"),
        F.sum(F.when(~own & sure, F.when(shell, 1).otherwise(-1)).otherwise(0)).alias("_depth"))
    bad = F.when(hole, ~F.coalesce("_home", F.lit(False)) | F.coalesce("_nested", F.lit(False))
                 ).otherwise(F.coalesce("_depth", F.lit(0)) > 0)
    return found.groupBy(*key).agg(F.max(bad).alias("_bad")).filter("_bad").select(*key)


def flag_invalid(df: DataFrame, key: Sequence[str], name: str = "is_invalid") -> DataFrame:
    """Mark geometries that are no simple feature.

    Rings must be closed and have area, must not cross or run along each other, holes lie in
    their shell and not in each other, no part lies in another, and the interior of a part is
    not cut in two by rings that touch each other in a circle.
    """
    closed = geom.rings_are_closed("geometry")
    sound = F.coalesce(closed & (geom.area("geometry") > 0), F.lit(False))
    marked = df.withColumn("_sound", sound)
    strips = cut_lineage(_ring_edges(marked.filter("_sound"), key, 2.0))
    crossed = (_crossings(strips, key).union(_misplaced(strips, key, strips.count())).distinct()
               .withColumn("_crossed", F.lit(True)))
    return (marked.join(crossed, list(key), "left")
            .withColumn(name, F.col("geometry").isNotNull()
                        & (~F.col("_sound") | F.coalesce("_crossed", F.lit(False))))
            .drop("_sound", "_crossed"))


def triangles(topology: DataFrame, vertices: DataFrame) -> DataFrame:
    """Three ordered vertices per cell, one row per cell, through a conditional pivot."""
    joined = topology.join(vertices, ["source_grid_id", "vertex_index"], "inner")
    picks = [F.max(F.when(F.col("vertex_order") == k, F.col(column))).alias(f"{short}_{k}")
             for k in range(3)
             for column, short in (("longitude_deg", "lon"), ("latitude_deg", "lat"))]
    # Three corners are distinct when the one between the smallest and the largest differs
    # from both. That needs no set, so a cell with any number of rows stays one small state.
    low, high, total = (f("vertex_index") for f in (F.min, F.max, F.sum))
    middle = total - low - high
    return joined.groupBy("source_grid_id", "cell_index").agg(
        F.count("*").alias("vertex_count"),
        ((low < middle) & (middle < high)).alias("corners_differ"), *picks)


def triangle_geometry() -> Column:
    corners = [geom.point(F.col(f"lon_{k}"), F.col(f"lat_{k}")) for k in range(3)]
    ring = geom.closed_ring(*corners)
    return reproject(geom.promote(geom.polygon(ring)), F.lit(4326))


#: Levels of the tree, eight by eight children to a node, and places up to which one is a leaf.
_LEVELS, _CROWD = 10, 256


def _tree(places: DataFrame, size) -> tuple[DataFrame, DataFrame]:
    """Nodes of a tree over the places, refined only where they are crowded, and the places of its
    leaves.

    Nodes: level, nx, ny, their box and whether they are a leaf. One pass counts the places of
    all levels' tiles; a tile is a node if the tile around it is crowded. Places
    come with their leaf and its number of places.
    """
    side = max(size["x1"] - size["x0"], size["y1"] - size["y0"], 1e-9) * (1 + 1e-9)
    step = side / 8**_LEVELS
    last = F.lit(8**_LEVELS - 1)
    fine = places.select(
        "tx", "ty", F.least(F.floor((F.col("tx") - size["x0"]) / step), last).alias("cx"),
        F.least(F.floor((F.col("ty") - size["y0"]) / step), last).alias("cy"))
    tiled = fine.withColumn("level", F.explode(F.sequence(F.lit(1), F.lit(_LEVELS)))).select(
        "tx", "ty", "level", F.expr(f"shiftright(cx, 3 * ({_LEVELS} - level))").alias("nx"),
        F.expr(f"shiftright(cy, 3 * ({_LEVELS} - level))").alias("ny"))
    counted = cut_lineage(tiled.groupBy("level", "nx", "ny").agg(
        F.count("*").alias("n"), F.min("tx").alias("minx"), F.max("tx").alias("maxx"),
        F.min("ty").alias("miny"), F.max("ty").alias("maxy")))
    crowded = counted.filter(F.col("n") > _CROWD).select(
        (F.col("level") + 1).alias("level"), F.col("nx").alias("cx"), F.col("ny").alias("cy"))
    child = counted.withColumn("cx", F.shiftright("nx", 3)).withColumn("cy", F.shiftright("ny", 3))
    inner = child.join(crowded, ["level", "cx", "cy"], "left_semi")
    nodes = cut_lineage(inner.unionByName(child.filter("level = 1")).withColumn(
        "leaf", (F.col("n") <= _CROWD) | (F.col("level") == _LEVELS)))
    held = tiled.filter(F.col("level") <= nodes.agg(F.max("level")).scalar()).join(
        nodes.filter("leaf").select("level", "nx", "ny", "n"), ["level", "nx", "ny"])
    return nodes, held


def nearest(points: DataFrame, targets: DataFrame, point_id: str,
            target_columns: Sequence[str]) -> DataFrame:
    """Every point with its nearest target and the distance; all targets tied for it are kept.

    Points without position, and all points where no target has one, come out with NULL.

    Targets are reduced to distinct places, and places to a tree of occupied tiles that is deep
    only where places are crowded. Points descend the tree one level per join and keep only
    nodes that can still hold a nearest place: those not farther at their closest than the least
    farthest corner among the kept ones, which is carried along as the point's bound. Every level
    is stored: its leaves wait there for the end, and the next level starts from the others. A leaf
    is searched where it meets a point, and only its nearest places leave that task.
    """
    points = cut_lineage(points.select(point_id, "x", "y"))
    named = cut_lineage(targets.select(F.col("x").alias("tx"), F.col("y").alias("ty"), *target_columns))
    places = cut_lineage(named.where("tx IS NOT NULL AND ty IS NOT NULL").groupBy("tx", "ty").agg(
        F.count("*").alias("_n")).drop("_n"))
    size = places.agg(F.min("tx").alias("x0"), F.min("ty").alias("y0"),
                      F.max("tx").alias("x1"), F.max("ty").alias("y1")).first()
    ids = points.select(point_id)
    if size["x0"] is None:
        return ids.join(named.limit(0).select(*target_columns), F.lit(False), "left").withColumn(
            "distance_m", F.lit(None).cast("double"))
    nodes, held = _tree(places, size)
    depth = nodes.agg(F.max("level")).first()[0]

    px, py = F.col("px"), F.col("py")
    gap_x = F.greatest(F.col("minx") - px, px - F.col("maxx"), F.lit(0.0))
    gap_y = F.greatest(F.col("miny") - py, py - F.col("maxy"), F.lit(0.0))
    far_x = F.greatest(F.abs(F.col("minx") - px), F.abs(F.col("maxx") - px))
    far_y = F.greatest(F.abs(F.col("miny") - py), F.abs(F.col("maxy") - py))
    columns = [point_id, "px", "py", "level", "nx", "ny", "leaf", "_gap", "_best"]
    root = F.lit(0).cast("long")
    inner = points.where("x IS NOT NULL AND y IS NOT NULL").select(
        point_id, F.col("x").alias("px"), F.col("y").alias("py"), root.alias("nx"), root.alias("ny"),
        F.lit(float("inf")).alias("_best"))
    leaves = None
    for level in range(1, depth + 1):
        below = nodes.filter(F.col("level") == level).drop("n")
        open_ = inner.select(point_id, "px", "py", F.col("nx").alias("cx"), F.col("ny").alias("cy"),
                             "_best")
        # The first two levels have at most 64 and 4096 nodes.
        met = open_.join(F.broadcast(below) if level < 3 else below, ["cx", "cy"]).withColumns({
            "_gap": gap_x * gap_x + gap_y * gap_y, "_far": far_x * far_x + far_y * far_y}).filter(
            F.col("_gap") <= F.col("_best")).withColumn("_far", F.least("_far", "_best")).drop("_best")
        kept = cut_lineage(_within_best(met, point_id, "_gap", "_far").select(columns))
        ended = kept.filter("leaf")
        leaves = ended if leaves is None else leaves.unionByName(ended)
        inner = kept.filter("NOT leaf")
    last = _within_best(leaves.withColumnRenamed("_best", "_far"), point_id, "_gap", "_far")
    # Lists of about ``_CROWD`` places; only a leaf on the last level may have several.
    chunk = F.pmod(F.xxhash64("tx", "ty"), F.ceil(F.col("n") / _CROWD)).alias("_chunk")
    listed = held.groupBy("level", "nx", "ny", chunk).agg(
        F.collect_list(F.struct("tx", "ty")).alias("places")).drop("_chunk")
    apart = lambda p: F.sqrt(F.pow(px - p.tx, 2) + F.pow(py - p.ty, 2))
    best = geom.let(F.array_min(F.transform("places", apart)), lambda d: F.struct(
        d.alias("distance_m"), F.filter("places", lambda p: apart(p) == d).alias("at")))
    met = last.select(point_id, "px", "py", "level", "nx", "ny").join(
        listed, ["level", "nx", "ny"]).select(point_id, best.alias("_found"))
    winners = _within_best(met, point_id, "_found.distance_m", "_found.distance_m").select(
        point_id, F.col("_found.distance_m").alias("distance_m"),
        F.explode("_found.at").alias("_at")).select(
        point_id, F.col("_at.tx").alias("tx"), F.col("_at.ty").alias("ty"), "distance_m")
    return ids.join(winners.join(named, ["tx", "ty"]).drop("tx", "ty"), point_id, "left").select(
        point_id, *target_columns, "distance_m")


def _within_best(df: DataFrame, point_id: str, low: str, high: str) -> DataFrame:
    """Rows whose ``low`` does not exceed their point's smallest ``high``.

    A point never has more rows than a few tiles' children.
    """
    best = F.min(high).over(Window.partitionBy(point_id))
    return df.withColumn("_best", best).filter(F.col(low) <= F.col("_best"))


def duplicate_zone_flags(raw: DataFrame) -> DataFrame:
    """Every member of a repeated (id, version) group; NULL ids group together."""
    return flag_duplicates(raw, ["plr_id", "geography_version"])
