"""Geometries cut along square tiles, so that a tile's work needs only what lies in the tile.

Edges are turned so that the interior is on their left. A point is judged by the tile it lies in:
whether the tile's lower left corner is inside, and which of the tile's own edges lie between the
corner and the point, first along the tile's lower border, then straight up. Areas are sums over
slabs: pieces of edges within a tile, and the strip's full height where the inside goes on above
the tile. A tile wholly inside has one such slab and no edge.

Two tests place a point against an edge: ``below`` (the edge lies above the point) and
``left_of`` (the edge lies left of it). Both take the same sign of one product within the edge's
box and compare exactly outside, so they agree on every point however the product is rounded, and
the walk from a corner to a point crosses what the corner's own test counted.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridcensus.functions import geom


class _Point(NamedTuple):
    x: Column
    y: Column


TILE = ("tile_x", "tile_y")
#: An edge belongs to the tiles it passes within this share of a tile's side.
_SLACK = 1e-6


def directed_edges(df: DataFrame, key: Sequence[str], geometry: str = "geometry") -> DataFrame:
    """key and edges a, b with the interior on their left; those without length are left out."""
    rings = df.select(*key, F.explode(geometry).alias("poly")).select(
        *key, F.posexplode("poly").alias("hole", "ring"))
    turned = rings.withColumn("_turn", geom.turning("ring") * F.when(
        F.col("hole") == 0, 1.0).otherwise(-1.0))
    e = turned.select(*key, "_turn", F.explode(geom.edges("ring")).alias("e"))
    swap = F.col("_turn") < 0
    return e.select(*key, F.when(swap, F.col("e.b")).otherwise(F.col("e.a")).alias("a"),
                    F.when(swap, F.col("e.a")).otherwise(F.col("e.b")).alias("b")).where("a <> b")


def with_extent(edges: DataFrame) -> DataFrame:
    """Ends p and q from left to right, and the box lo, hi, bot, top."""
    forth = (F.col("a.x") < F.col("b.x")) | (
        (F.col("a.x") == F.col("b.x")) & (F.col("a.y") < F.col("b.y")))
    return (edges.withColumn("p", F.when(forth, F.col("a")).otherwise(F.col("b")))
            .withColumn("q", F.when(forth, F.col("b")).otherwise(F.col("a")))
            .withColumn("lo", F.col("p.x")).withColumn("hi", F.col("q.x"))
            .withColumn("bot", F.least("p.y", "q.y")).withColumn("top", F.greatest("p.y", "q.y")))


def _over(p: Column, q: Column, x: Column, y: Column) -> Column:
    """Positive above the line from p to q, negative below."""
    return (q.x - p.x) * (y - p.y) - (q.y - p.y) * (x - p.x)


def below(e: Column | dict[str, Column], x: Column, y: Column) -> Column:
    """Whether the edge runs strictly above the point; its right end does not count."""
    return (e["lo"] <= x) & (x < e["hi"]) & ((y < e["bot"]) | (
        (y < e["top"]) & (_over(e["p"], e["q"], x, y) < 0)))


def left_of(e: Column | dict[str, Column], x: Column, y: Column) -> Column:
    """Whether the edge, where it passes the point's height, lies left; its upper end does not
    count. On a point it lies where a point slightly higher sees it."""
    over = _over(e["p"], e["q"], x, y)
    beside = F.when(e["p"].y < e["q"].y, over < 0).otherwise(over >= 0)
    return (e["bot"] <= y) & (y < e["top"]) & ((x >= e["hi"]) | ((x >= e["lo"]) & beside))


def _parts() -> dict[str, Column]:
    return {c: F.col(c) for c in ("p", "q", "lo", "hi", "bot", "top")}


def _height(x: Column) -> Column:
    """Height of the edge at x, within its box; the lower end of an upright edge."""
    p, q = F.col("p"), F.col("q")
    slope = F.coalesce(F.try_divide(q.y - p.y, q.x - p.x), F.lit(0.0))
    return F.greatest("bot", F.least("top", p.y + (x - p.x) * slope))


def edge_tiles(extents: DataFrame, size: float) -> DataFrame:
    """One row per tile that an edge passes; a long slanting edge takes as many as it is long."""
    at = F.col("tile_x")
    columns = extents.withColumn("tile_x", F.explode(F.sequence(
        F.floor(F.col("lo") / size - _SLACK), F.floor(F.col("hi") / size + _SLACK))))
    left, right = (_height(F.greatest("lo", at * size)), _height(F.least("hi", (at + 1) * size)))
    upright = F.col("lo") == F.col("hi")
    low = F.when(upright, F.col("bot")).otherwise(F.least(left, right))
    high = F.when(upright, F.col("top")).otherwise(F.greatest(left, right))
    return columns.withColumn("tile_y", F.explode(F.sequence(
        F.floor(low / size - _SLACK), F.floor(high / size + _SLACK))))


def inside_corners(extents: DataFrame, key: Sequence[str], size: float) -> DataFrame:
    """key, tile_x, tile_y of tiles whose lower left corner lies inside.

    Per column of corners the edges above are counted from the top: the corner is inside if an
    odd number of them lies above it. ``reach`` is the highest corner below an edge.
    """
    columns = extents.where("lo < hi").withColumn("tile_x", F.explode(F.sequence(
        F.floor(F.col("lo") / size), F.floor(F.col("hi") / size)))).where(
        (F.col("lo") <= F.col("tile_x") * size) & (F.col("tile_x") * size < F.col("hi")))
    x = F.col("tile_x") * size
    near = columns.withColumn("_near", F.floor(_height(x) / size))
    under = lambda up: below(_parts(), x, (F.col("_near") + up) * size)
    reach = near.select(*key, "tile_x", F.when(under(1), F.col("_near") + 1).when(
        under(0), F.col("_near")).otherwise(F.col("_near") - 1).alias("reach"))
    column = Window.partitionBy(*key, "tile_x").orderBy("reach")
    runs = reach.withColumn("_n", F.row_number().over(column)).withColumn(
        "_end", F.lead("reach").over(column)).where("_n % 2 = 1 AND _end > reach")
    return runs.select(*key, "tile_x", F.explode(F.sequence(
        F.col("reach") + 1, F.col("_end"))).alias("tile_y"))


def tile_index(polygons: DataFrame, key: Sequence[str], size: float) -> DataFrame:
    """key, tile_x, tile_y, edges in the tile, corner_inside, and _box of the polygon; tiles wholly
    outside are left out.

    Polygons that agree in ``key`` and geometry count once. An edge is its two ends from left to
    right: what follows from them is not sent along.
    """
    shape = F.xxhash64("geometry").alias("_shape")
    once = polygons.select(*key, shape, "geometry").groupBy(*key, "_shape").agg(
        F.any_value("geometry").alias("geometry")).withColumn("_box", geom.extent("geometry"))
    keyed = [*key, "_shape", "_box"]
    extents = with_extent(directed_edges(once, keyed))
    edge = F.struct(*[F.col(f"{end}.{axis}").alias(f"{end}{axis}") for end in "pq" for axis in "xy"])
    local = edge_tiles(extents, size).select(*keyed, *TILE, edge.alias("e"), F.lit(False).alias("_in"))
    corners = inside_corners(extents, keyed, size).select(
        *keyed, *TILE, F.lit(None).cast(local.schema["e"].dataType).alias("e"), F.lit(True).alias("_in"))
    return local.unionByName(corners).groupBy(*keyed, *TILE).agg(
        F.collect_list("e").alias("edges"), F.max("_in").alias("corner_inside")).drop("_shape")


def _ends(e: Column) -> dict[str, Column | _Point]:
    """The parts of an edge of ``tile_index``."""
    p, q = _Point(e["px"], e["py"]), _Point(e["qx"], e["qy"])
    return {"p": p, "q": q, "lo": p.x, "hi": q.x, "bot": F.least(p.y, q.y),
            "top": F.greatest(p.y, q.y)}


def in_tile(edges: Column, corner_inside: Column, x: Column, y: Column, tile_x: Column,
            tile_y: Column, size: float) -> Column:
    """Whether a point of a tile lies in the geometry that the tile's index row describes, or on
    an edge of it."""
    x0, y0 = tile_x * size, tile_y * size

    def flips(edge: Column) -> Column:
        e = _ends(edge)
        along = left_of(e, x, y0) != left_of(e, x0, y0)
        return along != (below(e, x, y) != below(e, x, y0))

    def touches(edge: Column) -> Column:
        e = _ends(edge)
        return (x.between(e["lo"], e["hi"]) & y.between(e["bot"], e["top"])
                & (_over(e["p"], e["q"], x, y) == 0))

    odd = F.size(F.filter(edges, flips)) % 2 == 1
    return (odd != corner_inside) | F.exists(edges, touches)


def tile_slabs(shapes: DataFrame, key: Sequence[str], size: float) -> DataFrame:
    """key, tile_x, tile_y and slabs: lines ``y + (x - lo) * m`` over lo..hi with a sign.

    Within a tile the half-strips between its lower border and the slabs, taken with their signs,
    add up to the geometry. An edge gives the piece that lies in the tile. Above the tile's upper
    border only the inside counts: it starts as the upper left corner is, and changes where an
    edge crosses the border. Every slab lies in its tile.
    """
    extents = with_extent(directed_edges(shapes, key))
    # The slab of an edge that runs right to left has the interior below it.
    tiles = edge_tiles(extents, size).withColumn(
        "sign", F.when(F.col("a.x") > F.col("b.x"), 1.0).otherwise(-1.0)).withColumn(
        "x0", F.col("tile_x") * size).withColumn("y0", F.col("tile_y") * size).withColumn(
        "x1", (F.col("tile_x") + 1) * size).withColumn("y1", (F.col("tile_y") + 1) * size)
    p, q = F.col("p"), F.col("q")
    at = lambda y: F.greatest("lo", F.least("hi", F.coalesce(
        p.x + (F.col(y) - p.y) * F.try_divide(q.x - p.x, q.y - p.y), F.col("lo"))))
    rising, level = p.y < q.y, p.y == q.y
    enter, leave = at("y0"), at("y1")
    first = F.greatest("lo", "x0", F.when(level, F.col("lo")).when(rising, F.when(
        F.col("bot") < F.col("y0"), enter).otherwise(F.col("lo"))).otherwise(F.when(
            F.col("top") > F.col("y1"), leave).otherwise(F.col("lo"))))
    last = F.least("hi", "x1", F.when(level, F.col("hi")).when(rising, F.when(
        F.col("top") > F.col("y1"), leave).otherwise(F.col("hi"))).otherwise(F.when(
            F.col("bot") < F.col("y0"), enter).otherwise(F.col("hi"))))
    inside = (F.col("top") >= F.col("y0")) & (F.col("bot") <= F.col("y1")) & ~(
        level & (F.col("bot") == F.col("y0")))
    slope = F.coalesce(F.try_divide(q.y - p.y, q.x - p.x), F.lit(0.0))
    e = _parts()
    crosses = left_of(e, F.col("x1"), F.col("y1")) & ~left_of(e, F.col("x0"), F.col("y1"))
    # Both kinds of slab come from one pass over the tiles. A filter on the exploded columns stays
    # where it is; on computed ones it would be moved down and repeat what they are computed from.
    spans = F.array(
        F.struct(inside.alias("kept"), F.lit(True).alias("piece"), first.alias("lo"), last.alias("hi")),
        F.struct(crosses.alias("kept"), F.lit(False).alias("piece"),
                 F.greatest("x0", leave).alias("lo"), F.col("x1").alias("hi")))
    piece = F.col("s.piece")
    local = tiles.withColumn("s", F.explode(spans)).where("s.kept AND s.lo < s.hi").select(
        *key, *TILE, "s.lo", "s.hi",
        F.when(piece, p.y + (F.col("s.lo") - p.x) * slope).otherwise(F.col("y1")).alias("y"),
        F.when(piece, slope).otherwise(0.0).alias("m"),
        F.when(piece, F.col("sign")).otherwise(
            F.when(F.col("a.y") < F.col("b.y"), -1.0).otherwise(1.0)).alias("sign"))
    corners = inside_corners(extents, key, size).select(
        *key, "tile_x", (F.col("tile_y") - 1).alias("tile_y"), (F.col("tile_x") * size).alias("lo"),
        ((F.col("tile_x") + 1) * size).alias("hi"), (F.col("tile_y") * size).alias("y"),
        F.lit(0.0).alias("m"), F.lit(1.0).alias("sign"))
    return local.unionByName(corners)
