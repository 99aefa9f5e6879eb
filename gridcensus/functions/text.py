"""Text, number and report-formatting expressions."""

from __future__ import annotations

import unicodedata
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

_INTEGER = r"\A-?[0-9]+\z"


def blank_to_null(c: Column, any_whitespace: bool = False) -> Column:
    """Trim and turn empty text into NULL; by default only spaces are trimmed."""
    trimmed = F.regexp_replace(c, r"\A\s+|\s+\z", "") if any_whitespace else F.btrim(c)
    return F.nullif(trimmed, F.lit(""))


def strict_bigint(c: Column) -> Column:
    """Optional minus and digits only; anything else, overflow included, is NULL."""
    text = F.btrim(c)
    return F.when(text.rlike(_INTEGER), text.try_cast("bigint"))


def is_unparsable(c: Column) -> Column:
    """True when text is present but holds no representable integer."""
    present = blank_to_null(c)
    return present.isNotNull() & strict_bigint(c).isNull()


def lenient_number(c: Column, to: str = "double") -> Column:
    """Coercing parse: text that is no number becomes missing, as does NaN."""
    number = blank_to_null(c.cast("string"), any_whitespace=True).try_cast("double")
    return F.when(~F.isnan(number), number).try_cast(to)


def is_month_code(c: Column) -> Column:
    return c.rlike(r"\A[0-9]{6}\z")


def month_end(code: Column) -> Column:
    """``YYYYMM`` to the last day of that month; malformed codes give NULL."""
    first = F.try_to_timestamp(F.concat(code, F.lit("01")), F.lit("yyyyMMdd"))
    return F.when(is_month_code(code), F.last_day(first.cast("date")))


def unit_key(c: Column) -> Column:
    """Unit text reduced for comparison: lower case, no blanks, no middle dots."""
    return F.lower(F.translate(F.btrim(c), " ·", ""))


def first_match(*rules: tuple[Column, str]) -> Column:
    """The label of the first rule that holds, else NULL. The order is the contract."""
    chain = None
    for condition, label in rules:
        chain = F.when(condition, label) if chain is None else chain.when(condition, label)
    return chain.otherwise(F.lit(None).cast("string"))


def outside(c: Column, low, high) -> Column:
    return ~c.between(low, high)


def directory_label(c: Column) -> Column:
    """Lower-case label restricted to letters, digits and underscores, else NULL."""
    label = F.lower(F.btrim(c))
    return F.when(label.rlike(r"\A[a-z0-9_]+\z"), label)


def epsg_code(crs: Column) -> Column:
    """Trailing number of a coordinate system name, e.g. ``urn:ogc:def:crs:EPSG::25833``."""
    return F.regexp_extract(crs, r"(\d+)\s*$", 1).try_cast("int")


def ewkt(srid: Column, wkt: Column) -> Column:
    return F.when(srid.isNull(), wkt).otherwise(
        F.concat(F.lit("SRID="), srid.cast("string"), F.lit(";"), wkt))


def fixed(c: Column, digits: int = 1) -> Column:
    """Fixed decimals without grouping, ``NA`` for missing."""
    return F.when(c.isNull(), "NA").otherwise(F.format_string(f"%.{digits}f", c.cast("double")))


def thousands(c: Column) -> Column:
    return F.when(c.isNull(), "NA").otherwise(F.format_number(c.cast("bigint"), 0))


def percent(c: Column, digits: int = 1) -> Column:
    return F.when(c.isNull(), "NA").otherwise(
        F.format_string(f"%.{digits}f%%", c.cast("double") * 100))


def transliterate(c: Column) -> Column:
    """Lower case with German umlauts spelled out and accents of Latin letters removed.

    A letter loses the marks it decomposes into; marks that stand alone go as well.
    """
    text = c
    # Spelled-out letters.
    for letter, spelled in (("ä", "ae"), ("ö", "oe"), ("ü", "ue"),
                            ("Ä", "Ae"), ("Ö", "Oe"), ("Ü", "Ue"), ("ß", "ss")):
        text = F.replace(text, F.lit(letter), F.lit(spelled))
    lower = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), "[\u0300-\u036f]", "")
    return F.translate(lower, *_accents())


def _accents() -> tuple[str, str]:
    """Lower-case letters of the Latin blocks that carry marks, and the letters below the marks."""
    marked = [chr(c) for block in (range(0xC0, 0x250), range(0x1E00, 0x1F00)) for c in block
              if unicodedata.decomposition(chr(c)) and not chr(c).isupper()]
    plain = {m: "".join(c for c in unicodedata.normalize("NFD", m) if not unicodedata.combining(c))
             for m in marked}
    single = [m for m in marked if len(plain[m]) == 1 and plain[m] != m]
    return "".join(single), "".join(plain[m] for m in single)


def decode_percent(c: Column) -> Column:
    """One pass of percent-decoding for ASCII bytes; malformed escapes stay as they are."""
    pieces = F.split(c, "%")
    escape = r"\A[0-7][0-9A-Fa-f]"

    def piece(part: Column, index: Column) -> Column:
        code = F.conv(F.substring(part, 1, 2), 16, 10).cast("int")
        decoded = F.concat(F.char(code), F.substr(part, F.lit(3)))
        return (F.when(index == 0, part)
                .when(part.rlike(escape), decoded)
                .otherwise(F.concat(F.lit("%"), part)))

    return F.array_join(F.transform(pieces, piece), "")
