"""Transverse Mercator (UTM zones of both hemispheres on GRS80) and back, Web Mercator to degrees,
as Column expressions.

Krueger series to the fourth power of the third flattening, accurate to micrometres
inside the zone.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from gridcensus.functions.geom import let

# GRS80 ellipsoid and the UTM zone 33 grid.
SEMI_MAJOR = 6378137.0
FLATTENING = 1 / 298.257222101
SCALE = 0.9996
CENTRAL_MERIDIAN = 15.0
FALSE_EASTING = 500000.0

_n = FLATTENING / (2 - FLATTENING)
RADIUS = SCALE * SEMI_MAJOR / (1 + _n) * (1 + _n**2 / 4 + _n**4 / 64)
ECCENTRICITY = 2 * math.sqrt(_n) / (1 + _n)
# Series coefficients of the conformal and rectifying latitudes.
ALPHA = (_n / 2 - 2 * _n**2 / 3 + 5 * _n**3 / 16 + 41 * _n**4 / 180,
         13 * _n**2 / 48 - 3 * _n**3 / 5 + 557 * _n**4 / 1440,
         61 * _n**3 / 240 - 103 * _n**4 / 140, 49561 * _n**4 / 161280)
BETA = (_n / 2 - 2 * _n**2 / 3 + 37 * _n**3 / 96 - _n**4 / 360,
        _n**2 / 48 + _n**3 / 15 - 437 * _n**4 / 1440, 17 * _n**3 / 480 - 37 * _n**4 / 840,
        4397 * _n**4 / 161280)
DELTA = (2 * _n - 2 * _n**2 / 3 - 2 * _n**3 + 116 * _n**4 / 45,
         7 * _n**2 / 3 - 8 * _n**3 / 5 - 227 * _n**4 / 45, 56 * _n**3 / 15 - 136 * _n**4 / 35,
         4279 * _n**4 / 630)


def to_degrees(c: Column, unit: Column | None, largest: Column) -> Column:
    """Radians become degrees when the unit says so or no value exceeds a full turn."""
    in_radians = largest <= 2 * math.pi + 0.1
    if unit is not None:
        in_radians = F.coalesce(F.lower(unit).contains("radian"), F.lit(False)) | in_radians
    return F.when(in_radians, F.degrees(c)).otherwise(c)


def to_planar(lon: Column, lat: Column, meridian: float | Column = CENTRAL_MERIDIAN) -> Column:
    """Longitude and latitude in degrees to ``struct<x,y>`` in metres."""
    lam, sine = F.radians(lon - meridian), F.sin(F.radians(lat))
    t = F.sinh(F.atanh(sine) - F.atanh(sine * ECCENTRICITY) * ECCENTRICITY)

    def series(s: Column) -> Column:
        x, y = s.eta, s.xi
        for j, a in enumerate(ALPHA, start=1):
            x = x + F.cos(s.xi * (2 * j)) * F.sinh(s.eta * (2 * j)) * a
            y = y + F.sin(s.xi * (2 * j)) * F.cosh(s.eta * (2 * j)) * a
        return F.struct((x * RADIUS + FALSE_EASTING).alias("x"), (y * RADIUS).alias("y"))

    return let(t, lambda q: let(
        F.struct(F.atan2(q, F.cos(lam)).alias("xi"),
                 F.atanh(F.sin(lam) / F.sqrt(q * q + 1)).alias("eta")), series))


def to_geographic(x: Column, y: Column, meridian: float | Column = CENTRAL_MERIDIAN) -> Column:
    """Planar metres back to ``struct<x,y>`` holding longitude and latitude in degrees."""
    start = F.struct((y / RADIUS).alias("xi"), ((x - FALSE_EASTING) / RADIUS).alias("eta"))

    def undo(s: Column) -> Column:
        xi, eta = s.xi, s.eta
        for j, b in enumerate(BETA, start=1):
            xi = xi - F.sin(s.xi * (2 * j)) * F.cosh(s.eta * (2 * j)) * b
            eta = eta - F.cos(s.xi * (2 * j)) * F.sinh(s.eta * (2 * j)) * b
        return F.struct(xi.alias("xi"), eta.alias("eta"))

    def unfold(s: Column) -> Column:
        return let(F.asin(F.sin(s.xi) / F.cosh(s.eta)), lambda chi: F.struct(
            (F.degrees(F.atan2(F.sinh(s.eta), F.cos(s.xi))) + meridian).alias("x"),
            F.degrees(sum((F.sin(chi * (2 * j)) * d for j, d in enumerate(DELTA, start=1)),
                          chi)).alias("y")))

    return let(let(start, undo), unfold)


def _map_points(geometry: Column, convert) -> Column:
    return F.transform(geometry, lambda poly: F.transform(
        poly, lambda ring: F.transform(ring, lambda p: convert(p.x, p.y))))


# Reference systems by number. Geographic ones (WGS 84, ETRS89), Web Mercator, and
# ranges of transverse Mercator zones as (first, last, zone of the first, false northing).
GEOGRAPHIC, WEB_MERCATOR = (4326, 4258), 3857
ZONES = ((25828, 25838, 28, 0.0), (32601, 32660, 1, 0.0), (32701, 32760, 1, 10_000_000.0))


def zone_of(srid: Column) -> Column:
    """``struct<meridian,north>`` of a transverse Mercator system, else NULL.

    The datums ETRS89 and WGS 84 are taken as one, as they differ by less than a metre.
    """
    found = F.lit(None).cast("struct<meridian:double,north:double>")
    for first, last, number, north in ZONES:
        meridian = ((srid - first + number) * 6 - 183).cast("double")
        found = F.when(srid.between(first, last), F.struct(
            meridian.alias("meridian"), F.lit(north).alias("north"))).otherwise(found)
    return found


def is_supported(srid: Column) -> Column:
    """Whether ``reproject`` knows the system."""
    return srid.isin(*GEOGRAPHIC, WEB_MERCATOR) | zone_of(srid).isNotNull()


def from_web_mercator(x: Column, y: Column) -> Column:
    """Metres of the spherical web projection to ``struct<x,y>`` in degrees."""
    return F.struct(F.degrees(x / SEMI_MAJOR).alias("x"),
                    F.degrees(F.atan(F.sinh(y / SEMI_MAJOR))).alias("y"))


def reproject(geometry: Column, srid: Column, planar_srid: int = 25833) -> Column:
    """Geometry of a supported system in one northern UTM zone; other systems give NULL."""
    there = float(planar_srid % 100 * 6 - 183)
    here = zone_of(srid)
    return (F.when(srid == planar_srid, geometry)
            .when(srid.isin(*GEOGRAPHIC), _map_points(
                geometry, lambda x, y: to_planar(x, y, there)))
            .when(srid == WEB_MERCATOR, _map_points(geometry, lambda x, y: let(
                from_web_mercator(x, y), lambda p: to_planar(p.x, p.y, there))))
            .when(here.isNotNull(), _map_points(geometry, lambda x, y: let(
                to_geographic(x, y - here.north, here.meridian),
                lambda p: to_planar(p.x, p.y, there)))))


def to_geographic_geometry(geometry: Column) -> Column:
    return _map_points(geometry, to_geographic)
