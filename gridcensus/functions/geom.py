"""Planar geometry as Column expressions.

A geometry is ``array<polygon>``, a polygon ``array<ring>`` (exterior first, then holes),
a ring a closed ``array<struct<x,y>>``. Constructors take Columns; measures take the name of
a geometry column (qualified where a join needs it) and are Spark SQL array lambdas, run
inside the JVM. Coordinates are shifted to a local origin before products are taken, because
planar coordinates of several million metres would otherwise lose digits.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it several times in ``body``."""
    return F.transform(F.array(value), body).getItem(0)


def point(x: Column, y: Column) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def closed_ring(*points: Column) -> Column:
    return F.array(*points, points[0])


def rectangle(minx: Column, miny: Column, maxx: Column, maxy: Column) -> Column:
    return closed_ring(point(minx, miny), point(maxx, miny), point(maxx, maxy),
                       point(minx, maxy))


def polygon(*rings: Column) -> Column:
    return F.array(*rings)


def promote(poly: Column) -> Column:
    """A polygon as a one-part geometry."""
    return F.array(poly)


def is_polygonal(geometry_type: Column) -> Column:
    return F.upper(geometry_type).isin("POLYGON", "MULTIPOLYGON")


def is_empty(geometry: str) -> Column:
    return F.expr(f"size(flatten(flatten({geometry}))) = 0")


def exterior_point_count(geometry: str) -> Column:
    """Points of the first shell; 0 where there is none."""
    return F.expr(f"coalesce(size(get(get({geometry}, 0), 0)), 0)")


# SQL text of the building blocks.

def _bind(name: str, value: str, body: str) -> str:
    return f"transform(array({value}), {name} -> {body})[0]"


def _sum(values: str) -> str:
    return f"aggregate({values}, 0D, (_s, _v) -> _s + _v)"


def _edges(ring: str) -> str:
    steps = f"greatest(size({ring}) - 1, 0)"
    return (f"zip_with(slice({ring}, 1, {steps}), slice({ring}, 2, {steps}), "
            "(_a, _b) -> named_struct('a', _a, 'b', _b))")


def _all_edges(geometry: str) -> str:
    return f"flatten(transform(flatten({geometry}), _r -> {_edges('_r')}))"


def _twice_area(ring: str) -> str:
    return _sum(f"transform({_edges(ring)}, _e -> "
                f"(_e.a.x - {ring}[0].x) * (_e.b.y - {ring}[0].y) "
                f"- (_e.b.x - {ring}[0].x) * (_e.a.y - {ring}[0].y))")


def _area(geometry: str) -> str:
    ring = f"if(_i = 0, 0.5D, -0.5D) * abs({_twice_area('_ring')})"
    polygon_area = _sum(f"transform(_poly, (_ring, _i) -> {ring})")
    return _sum(f"transform({geometry}, _poly -> {polygon_area})")


def edges(ring: str) -> Column:
    """Consecutive point pairs ``struct<a,b>`` of a closed ring."""
    return F.expr(_edges(ring))


def all_edges(geometry: str) -> Column:
    return F.expr(_all_edges(geometry))


def turning(ring: str) -> Column:
    """1 for counter-clockwise rings, -1 for clockwise ones."""
    return F.expr(f"signum({_twice_area(ring)})")


def area(geometry: str) -> Column:
    """Planar area; holes subtract."""
    return F.expr(_area(geometry))


def _bounds(points: str) -> Column:
    xs, ys = ("transform(_pts, _p -> _p.x)", "transform(_pts, _p -> _p.y)")
    box = (f"named_struct('minx', array_min({xs}), 'miny', array_min({ys}), "
           f"'maxx', array_max({xs}), 'maxy', array_max({ys}))")
    return F.expr(_bind("_pts", points, box))


def bounds(geometry: str) -> Column:
    """``struct<minx,miny,maxx,maxy>`` over the exterior rings."""
    return _bounds(f"flatten(transform({geometry}, _poly -> get(_poly, 0)))")


def extent(geometry: str) -> Column:
    """As ``bounds``, over all rings."""
    return _bounds(f"flatten(flatten({geometry}))")


def centroid(geometry: str) -> Column:
    """Area-weighted centroid ``struct<x,y>``; holes subtract. NULL without area."""
    moments = (
        f"aggregate({_edges('_loc')}, named_struct('s', 0D, 'mx', 0D, 'my', 0D), (_t, _e) -> "
        + _bind("_c", "_e.a.x * _e.b.y - _e.b.x * _e.a.y",
                "named_struct('s', _t.s + _c, 'mx', _t.mx + (_e.a.x + _e.b.x) * _c, "
                "'my', _t.my + (_e.a.y + _e.b.y) * _c)") + ")")
    local = "transform(_ring, _p -> named_struct('x', _p.x - _o.x, 'y', _p.y - _o.y))"
    signed = _bind("_loc", local, _bind("_m", moments, _bind(
        "_k", "signum(_m.s) * if(_i = 0, 1D, -1D)",
        "named_struct('s', _k * _m.s, 'mx', _k * _m.mx, 'my', _k * _m.my)")))
    rings = f"flatten(transform({geometry}, _poly -> transform(_poly, (_ring, _i) -> {signed})))"
    centre = _bind("_ms", rings, _bind("_total", _sum("transform(_ms, _m -> _m.s)"), (
        f"named_struct('x', _o.x + {_sum('transform(_ms, _m -> _m.mx)')} / (_total * 3), "
        f"'y', _o.y + {_sum('transform(_ms, _m -> _m.my)')} / (_total * 3))")))
    return F.expr(f"CASE WHEN {_area(geometry)} > 0 THEN "
                  f"{_bind('_o', f'{geometry}[0][0][0]', centre)} END")


def boxes_overlap(a: Column, b: Column, margin: float = 0.0) -> Column:
    return ((a.minx <= b.maxx + margin) & (b.minx - margin <= a.maxx)
            & (a.miny <= b.maxy + margin) & (b.miny - margin <= a.maxy))


def _slabs(geometry: str) -> str:
    slab = ("named_struct('lo', least(_e.a.x, _e.b.x), 'hi', greatest(_e.a.x, _e.b.x), "
            "'y', if(_e.a.x < _e.b.x, _e.a.y, _e.b.y), "
            "'m', (_e.b.y - _e.a.y) / (_e.b.x - _e.a.x), "
            "'sign', if(_e.a.x < _e.b.x, -_k, _k))")
    sloped = f"filter({_edges('_ring')}, _e -> _e.a.x <> _e.b.x)"
    turn = f"signum({_twice_area('_ring')}) * if(_i = 0, 1D, -1D)"
    ring = _bind("_k", turn, f"transform({sloped}, _e -> {slab})")
    return f"flatten(flatten(transform({geometry}, _poly -> transform(_poly, (_ring, _i) -> {ring}))))"


def slabs(geometry: str) -> Column:
    """Non-vertical edges as lines ``y + (x - lo) * m`` over ``lo``..``hi`` with a sign.

    The half-strips below the edges, taken with these signs, add up to the geometry: 1
    inside, 0 outside and in holes, whatever way the rings run.
    """
    return F.expr(_slabs(geometry))


def lower_mean(e_lo: Column, e_hi: Column, f_lo: Column, f_hi: Column) -> Column:
    """Mean over an interval of the lower of two lines, given their heights at its ends."""
    gap_lo, gap_hi = e_lo - f_lo, e_hi - f_hi
    under = F.least(gap_lo, F.lit(0.0)) + F.least(gap_hi, F.lit(0.0))
    dip = F.when(gap_lo * gap_hi < 0, -(under * under) / (
        (F.abs(gap_lo) + F.abs(gap_hi)) * 2)).otherwise(under / 2)
    return (f_lo + f_hi) / 2 + dip


def overlap_area(a: str, b: str) -> Column:
    """Area shared by two geometries; rings may be concave and may have holes.

    The indicator of an overlap is the product of two signed sums of half-strips, so its
    area is the sum over edge pairs of the signed integral of the lower line. Nothing is
    clipped. For many pairs ``operators.spatial.area_bridge`` is faster: it evaluates the
    same sum as generated code over exploded edges, while array lambdas are interpreted.
    """
    gaps = ("named_struct('w', _h.w, 'base', (_h.fa + _h.fb) / 2, 'da', _h.ea - _h.fa, "
            "'db', _h.eb - _h.fb, 'u', least(_h.ea - _h.fa, 0D) + least(_h.eb - _h.fb, 0D))")
    height = "_{s}.y - _floor + (_t.{at} - _{s}.lo) * _{s}.m"
    ends = ", ".join(f"'{s}{at}', {height.format(s='e' if s == 'e' else 'f', at=at)}"
                     for s in "ef" for at in "ab")
    heights = f"named_struct('w', _e.sign * _f.sign * (_t.b - _t.a), {ends})"
    mean = ("_g.w * (_g.base + if(_g.da * _g.db < 0, "
            "-(_g.u * _g.u) / ((abs(_g.da) + abs(_g.db)) * 2), _g.u / 2))")
    span = "named_struct('a', greatest(_e.lo, _f.lo), 'b', least(_e.hi, _f.hi))"
    share = _bind("_t", span, f"if(_t.b > _t.a, {_bind('_h', heights, _bind('_g', gaps, mean))}, 0D)")
    pairs = _sum(f"transform({_slabs(a)}, _e -> {_sum(f'transform(_fs, _f -> {share})')})")
    return F.expr("greatest(0D, " + _bind("_floor", f"{b}[0][0][0].y",
                                          _bind("_fs", _slabs(b), pairs)) + ")")


def _on_segment(x: str, y: str) -> str:
    return (f"((_e.b.x - _e.a.x) * ({y} - _e.a.y) = (_e.b.y - _e.a.y) * ({x} - _e.a.x) "
            f"AND {x} BETWEEN least(_e.a.x, _e.b.x) AND greatest(_e.a.x, _e.b.x) "
            f"AND {y} BETWEEN least(_e.a.y, _e.b.y) AND greatest(_e.a.y, _e.b.y))")


def _hold(edges: str, x: str, y: str) -> str:
    crossed = (f"if((_e.a.y > {y}) <> (_e.b.y > {y}), {x} < _e.a.x + (_e.b.x - _e.a.x) "
               f"* ({y} - _e.a.y) / (_e.b.y - _e.a.y), false)")
    return (f"exists({edges}, _e -> {_on_segment(x, y)}) "
            f"OR size(filter({edges}, _e -> {crossed})) % 2 = 1")


def _contains(geometry: str, x: str, y: str) -> str:
    return _bind("_es", _all_edges(geometry), _hold("_es", x, y))


def contains_or_touches(geometry: str, x: str, y: str) -> Column:
    """Even-odd rule over all rings; points on an edge count as touching."""
    return F.expr(_contains(geometry, x, y))


def edges_hold(edges: str, x: str, y: str) -> Column:
    """As ``contains_or_touches``, for a column of all edges."""
    return F.expr(_hold(edges, x, y))


def flat_edges_hold(edges: str, x: str, y: str) -> Column:
    """As ``edges_hold``, for edges as ``struct<ax,ay,bx,by>``."""
    nested = (f"transform({edges}, _f -> named_struct('a', named_struct('x', _f.ax, 'y', _f.ay), "
              "'b', named_struct('x', _f.bx, 'y', _f.by)))")
    return F.expr(_bind("_es", nested, _hold("_es", x, y)))


def _point_gap(p: str, s: str) -> str:
    dx, dy = f"({s}.b.x - {s}.a.x)", f"({s}.b.y - {s}.a.y)"
    along = (f"(({p}.x - {s}.a.x) * {dx} + ({p}.y - {s}.a.y) * {dy}) "
             f"/ nullif({dx} * {dx} + {dy} * {dy}, 0D)")
    return _bind("_t", f"greatest(0D, least(1D, coalesce({along}, 0D)))",
                 f"power({p}.x - {s}.a.x - _t * {dx}, 2) + power({p}.y - {s}.a.y - _t * {dy}, 2)")


def _turn(a: str, b: str, c: str) -> str:
    return f"signum(({b}.x - {a}.x) * ({c}.y - {a}.y) - ({b}.y - {a}.y) * ({c}.x - {a}.x))"


def _segment_gap() -> str:
    """Squared distance of the segments ``_e`` and ``_f``."""
    proper = (f"{_turn('_e.a', '_e.b', '_f.a')} * {_turn('_e.a', '_e.b', '_f.b')} < 0 AND "
              f"{_turn('_f.a', '_f.b', '_e.a')} * {_turn('_f.a', '_f.b', '_e.b')} < 0")
    return (f"if({proper}, 0D, least({_point_gap('_e.a', '_f')}, {_point_gap('_e.b', '_f')}, "
            f"{_point_gap('_f.a', '_e')}, {_point_gap('_f.b', '_e')}))")


def distance(a: str, b: str) -> Column:
    """Exact distance; 0 when the geometries touch or overlap.

    For many pairs ``operators.spatial.weather_mask`` is faster, for the reason given at
    ``overlap_area``.
    """
    gaps = (f"transform({_all_edges(a)}, _e -> "
            f"array_min(transform(_fs, _f -> {_segment_gap()})))")
    least_gap = _bind("_fs", _all_edges(b), f"sqrt(array_min({gaps}))")

    def starts_inside(inner: str, outer: str) -> str:
        return (f"exists({inner}, _part -> "
                f"{_contains(outer, '_part[0][0].x', '_part[0][0].y')})")

    return F.expr(f"if({starts_inside(b, a)} OR {starts_inside(a, b)}, 0D, {least_gap})")


def within_distance(a: str, b: str, radius: float) -> Column:
    """True when the two geometries are at most ``radius`` apart; touching counts."""
    return distance(a, b) <= radius


def intersects(a: str, b: str) -> Column:
    """True when the geometries share at least a point."""
    return distance(a, b) == 0


def rings_are_closed(geometry: str) -> Column:
    """Every ring has at least four points, finite coordinates and ends where it starts."""
    return F.expr(
        f"forall(flatten({geometry}), _r -> size(_r) >= 4 AND get(_r, 0) = get(_r, size(_r) - 1) "
        "AND forall(_r, _p -> _p.x IS NOT NULL AND _p.y IS NOT NULL "
        "AND NOT isnan(_p.x) AND NOT isnan(_p.y)))")
