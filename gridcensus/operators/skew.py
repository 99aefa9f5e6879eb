"""Joins that stay balanced when one key holds a large share of the rows.

A small side is broadcast only after its rows and bytes have been counted against limits. Beyond
them the join shuffles, and keys that hold a large share of the left side are spread:
their left rows get a salt, their right rows are repeated once per salt.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridcensus.session import cut_lineage

BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 256 << 20
HOT_SHARE = 0.002
ROWS_PER_TASK = 250_000


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Hash rows over as many partitions as a shuffle uses, by keys that are nearly unique.

    For steps that do far more work per row than the row has bytes: small inputs come as a
    few large splits, and adaptive execution would merge small shuffle partitions. The condition
    always holds; filters on what is computed from the rows would else be moved ahead of the
    shuffle and do that work in the few splits.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, *keys).where(F.spark_partition_id() >= 0)


def dealt(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """Hash rows over all task slots, and over more partitions where one would get more than
    ``ROWS_PER_TASK`` of ``rows``.

    Rows that compress well make adaptive execution merge partitions until a task holds many times
    the bytes it was sent; what it sorts and keeps would grow with the table.
    """
    slots = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(max(slots, -(-rows // ROWS_PER_TASK)), *keys)


def is_small(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
             ) -> bool:
    """Whether ``df`` has at most so many rows and bytes; reads at most ``max_rows + 1`` rows.

    Numbers count 16 bytes. Text, lists and structures count their length as JSON, which is
    about what they take in memory.
    """
    fixed = ("int", "bigint", "smallint", "tinyint", "float", "double", "boolean", "date",
             "timestamp")
    size = F.lit(16 * len(df.columns))
    long = [c for c, t in df.dtypes if t not in fixed]
    if long:
        size = size + F.octet_length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in long])))
    seen = df.limit(max_rows + 1).agg(
        F.count("*").alias("n"), F.coalesce(F.sum(size), F.lit(0)).alias("bytes")).first()
    return seen["n"] <= max_rows and seen["bytes"] <= max_bytes


def hot_keys(df: DataFrame, keys: Sequence[str], share: float = HOT_SHARE,
             rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Keys with at least ``share`` of all rows or more than four tasks' worth, and their rows."""
    counted = df.groupBy(*keys).agg(F.count("*").alias("_rows"))
    total = counted.agg(F.sum("_rows").alias("n")).scalar()
    return counted.filter(F.col("_rows") >= F.least(total * share, F.lit(4.0 * rows_per_task)))


def salted_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str,
                salt_by: Sequence[str | Column], condition=None, share: float = HOT_SHARE,
                rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Shuffle join with hot keys spread by their own row counts, ``rows_per_task`` to a salt.

    ``salt_by`` must vary between the left rows of one key (a row id, say). The salt is a
    hash of those columns, so a task that runs again places every row where it was. Rows
    with a missing key match nothing and are spread as well.
    The left side is read three times, for the counts of its keys, for their sum and for the join,
    so it is kept in the shared folder: joins that follow each other would compute it over again
    three times each.
    ``condition`` may be a function of the two aliased sides for an extra predicate.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"a join of type {how} cannot repeat its right side")
    left = cut_lineage(left)
    salts = F.greatest(F.lit(2), F.ceil(F.col("_rows") / rows_per_task)).cast("int")
    hot = F.broadcast(hot_keys(left.dropna(subset=list(keys)), keys, share, rows_per_task)
                      .select(*keys, salts.alias("_hot")))
    unkeyed = F.lit(False)
    for key in keys:
        unkeyed = unkeyed | F.col(key).isNull()
    number = F.xxhash64(*salt_by)
    spread = F.when(unkeyed, F.pmod(number, F.lit(2**30)).cast("int")).when(
        F.col("_hot").isNotNull(), F.pmod(number, F.col("_hot")).cast("int"))
    l = (left.join(hot, list(keys), "left")
         .withColumn("_salt", F.coalesce(spread, F.lit(0))).drop("_hot"))
    r = (right.join(hot, list(keys), "left")
         .withColumn("_salt", F.explode(F.when(
             F.col("_hot").isNotNull(), F.sequence(F.lit(0), F.col("_hot") - 1)).otherwise(
                 F.array(F.lit(0)))))
         .drop("_hot"))
    return _equi_join(l, r, [*keys, "_salt"], how, condition).drop("_salt")


def lookup_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str,
                salt_by: Sequence[str | Column], condition=None, small: bool | None = None,
                max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast the right side if ``is_small`` finds it so, else a salted join.

    A caller that has counted the rows behind ``right`` passes the outcome as ``small``.
    """
    if is_small(right, max_rows) if small is None else small:
        return _equi_join(left, F.broadcast(right), list(keys), how, condition)
    return salted_join(left, right, keys, how, salt_by, condition)


def _equi_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str,
               condition) -> DataFrame:
    if condition is None:
        return left.join(right, list(keys), how)
    l, r = left.alias("l"), right.alias("r")
    on = condition
    for key in keys:
        on = (F.col(f"l.{key}") == F.col(f"r.{key}")) & on
    joined = l.join(r, on, how)
    if how in ("left_semi", "left_anti"):
        return joined
    return joined.drop(*[F.col(f"r.{key}") for key in keys])
