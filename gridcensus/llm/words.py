"""Word and shingle columns, and small shared choices of the text operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SHINGLE, SIMILARITY = 5, 0.8
#: A side is broadcast up to so many rows of a few numbers each (some tens of MB).
BROADCAST_ROWS = 1_000_000


def words(text: Column) -> Column:
    """Lower-case runs of letters and digits; NULL text has none."""
    parts = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+")
    return F.array_remove(parts, "")


def word_hashes(text: Column) -> Column:
    return F.transform(words(text), lambda w: F.xxhash64(w))


def shingle_rows(df: DataFrame, keep: list[str], hashes: str = "_words",
                 length: int = SHINGLE) -> DataFrame:
    """One row per shingle position: ``keep`` and the shingle's hash; shorter texts have none.

    Only a position is exploded; the hash is taken from the array in the same generated code.
    """
    last = F.size(hashes) - length
    at = F.explode(F.when(last >= 0, F.sequence(F.lit(0), last)))
    rows = df.select(*keep, hashes, at.alias("_at"))
    return rows.select(*keep, F.xxhash64(*[
        F.col(hashes)[F.col("_at") + i] for i in range(length)]).alias("shingle"))


def small(df: DataFrame, rows: int, most: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast if ``rows``, which were counted, are few; else the join shuffles."""
    return F.broadcast(df) if rows <= most else df


def hot_join(left: DataFrame, keyed: DataFrame, key: str, how: str, most: int = 1000) -> DataFrame:
    """Join stored ``left`` with stored ``keyed`` (``key`` once each, with its rows ``_n``).

    Keys with more than one in ``most`` of all rows are at most ``most``: they are broadcast, and
    their left rows stay where they are. The others are shuffled.
    """
    total = left.count()
    hot = keyed.where(F.col("_n") * most > total).drop("_n")
    cold = keyed.where(F.col("_n") * most <= total).drop("_n")
    rest = left.join(F.broadcast(hot.select(key)), key, "left_anti")
    return left.join(F.broadcast(hot), key, how).unionByName(rest.join(cold, key, how))
