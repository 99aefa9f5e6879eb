"""Expressions on field values: units, missing markers, derived quantities."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from gridcensus.schemas import INDICATORS

# Zero Celsius in Kelvin and the paired missing markers.
KELVIN_OFFSET = 273.15
MISSING_KELVIN = 9999.0
MISSING_CELSIUS = 9725.85
CELSIUS_INDICATORS = ("T_2M", "TD_2M")


def nan_to_null(c: Column) -> Column:
    """NULL is the only missing value past ingest."""
    return F.when(~F.isnan(c), c)


def finite_or_null(c: Column) -> Column:
    return F.when(is_finite(c), c)


def is_finite(c: Column) -> Column:
    return ~F.isnan(c) & (F.abs(c) < float("inf"))


def celsius(kelvin: Column) -> Column:
    return kelvin - KELVIN_OFFSET


def output_value(indicator: Column, value: Column) -> Column:
    """Temperatures leave Kelvin, other indicators stay as decoded."""
    return F.when(indicator.isin(*CELSIUS_INDICATORS), celsius(value)).otherwise(value)


def wind_speed(u: Column, v: Column) -> Column:
    return F.sqrt(u * u + v * v)


def unmark_missing(value: Column, marker: Column, missing_count: Column,
                   bitmap_present: Column) -> Column:
    """The marker means missing only where the field's bitmap reports missing points."""
    marked = (missing_count > 0) & (bitmap_present == 1) & (value == marker)
    return F.when(~F.coalesce(marked, F.lit(False)), nan_to_null(value))


def is_missing_pair(kelvin: Column, degrees: Column) -> Column:
    return (F.coalesce(kelvin == MISSING_KELVIN, F.lit(False))
            & F.coalesce(degrees == MISSING_CELSIUS, F.lit(False)))


def is_half_missing(kelvin: Column, degrees: Column) -> Column:
    """Only one of the two markers is used."""
    return (F.coalesce(kelvin == MISSING_KELVIN, F.lit(False))
            != F.coalesce(degrees == MISSING_CELSIUS, F.lit(False)))


def indicator_bit(indicator: Column, indicators: Sequence[str] = INDICATORS) -> Column:
    """A power of two per expected indicator, 0 for any other."""
    bit = F.lit(0)
    for position, name in enumerate(indicators):
        bit = F.when(indicator == name, 1 << position).otherwise(bit)
    return bit
