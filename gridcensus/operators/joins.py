"""Audited and explained joins, set accounting."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridcensus.operators.skew import is_small, lookup_join
from gridcensus.operators.verdict import side_by_side, with_verdict

_SIDES = {"one_to_one": ("left", "right"), "many_to_one": ("right",),
          "one_to_many": ("left",), "many_to_many": ()}


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return (df.groupBy(*keys).agg(F.count("*").alias("row_count"))
            .filter(F.col("row_count") > 1))


def flag_duplicates(df: DataFrame, keys: Sequence[str], name: str = "is_duplicate") -> DataFrame:
    """Mark every member of a duplicated key group, NULL keys grouping together.

    Counting goes through a partial aggregate and the few duplicated keys are joined back in the
    same job; adaptive execution broadcasts them if they are few, else splits a crowded key.
    """
    marks = [F.coalesce(F.col(k).cast("string"), F.lit("")).alias(f"_k{i}")
             for i, k in enumerate(keys)]
    nulls = [F.col(k).isNull().alias(f"_n{i}") for i, k in enumerate(keys)]
    safe = [f"_k{i}" for i in range(len(keys))] + [f"_n{i}" for i in range(len(keys))]
    keyed = df.select("*", *marks, *nulls)
    repeated = duplicate_keys(keyed, safe).select(*safe, F.lit(True).alias(name))
    return (keyed.join(repeated, safe, "left")
            .withColumn(name, F.coalesce(name, F.lit(False))).drop(*safe))


def refuse_repeats(df: DataFrame, keys: Sequence[str], what: str) -> DataFrame:
    """The rows of ``df``; a query that reads them fails if the keys repeat, and names some.

    The count is a subquery of the job that reads the rows, not a job of its own.
    """
    some = duplicate_keys(df, keys).limit(10).agg(
        F.count("*").alias("n"), F.to_json(F.collect_list(F.struct(*keys))).alias("keys"))
    found = some.select(F.when(F.col("n") > 0, F.col("keys"))).scalar()
    fault = F.raise_error(F.concat(F.lit(f"{what} repeats keys: "), found)).cast("boolean")
    return df.filter(F.when(found.isNull(), True).otherwise(fault))


def checked_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner",
                 validate: str = "many_to_one") -> DataFrame:
    """Join that refuses duplicate keys on the sides that must be unique, when it is run."""
    sides = {"left": left, "right": right}
    for side in _SIDES[validate]:
        sides[side] = refuse_repeats(sides[side], keys, f"{side} side of a {validate} join")
    return sides["left"].join(sides["right"], list(keys), how)


def join_with_match(left: DataFrame, right: DataFrame, keys: Sequence[str],
                    salt_by: Sequence[str], name: str = "is_matched",
                    small: bool | None = None) -> DataFrame:
    """Left join that keeps whether the right side had the key."""
    marked = right.withColumn(name, F.lit(True))
    return (lookup_join(left, marked, keys, "left", salt_by, small=small)
            .withColumn(name, F.coalesce(name, F.lit(False))))


def unmatched_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct left keys without a right row; both sides are reduced before the join."""
    return (left.select(*keys).distinct()
            .join(right.select(*keys).distinct(), list(keys), "left_anti"))


def orphans(child: DataFrame, parent: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Child rows whose parent key is absent, rows counted per key."""
    counted = child.groupBy(*keys).agg(F.count("*").alias("row_count"))
    return counted.join(parent.select(*keys).distinct(), list(keys), "left_anti")


def with_expected(expected: DataFrame, observed: DataFrame, keys: Sequence[str],
                  fill: dict[str, int]) -> DataFrame:
    """Every expected key once, zero-filled where nothing was observed."""
    return expected.join(observed, list(keys), "left").fillna(fill)


def explained_join(left: DataFrame, accepted: DataFrame, rejected: DataFrame, key: str,
                   values: Sequence[str], salt_by: Sequence[str],
                   status: str = "population_status",
                   reason: str = "population_rejection_reason",
                   small: bool | None = None) -> DataFrame:
    """Left join that says, for every unmatched row, which registry entry explains it.

    Unmatched rows without a registry entry keep a NULL reason; ``explained_audit`` counts
    them and the registry entries nothing refers to. One count of both halves' keys decides
    how they are joined, unless the caller has counted their source.
    """
    if small is None:
        small = is_small(accepted.select(key).union(rejected.select(key)))
    found = join_with_match(left, accepted.select(key, *values), [key], salt_by, "_found", small)
    registry = rejected.select(key, F.col("rejection_reason").alias(reason))
    return (lookup_join(found, registry, [key], "left", salt_by, small=small)
            .withColumn(status, F.when(F.col("_found"), "available")
                        .otherwise("rejected_source_record")).drop("_found"))


def explained_audit(left: DataFrame, accepted: DataFrame, rejected: DataFrame,
                    key: str) -> DataFrame:
    """The unmatched keys must be exactly the registry keys, and no side may repeat a key."""
    unmatched = unmatched_keys(left, accepted, [key])
    registry = rejected.select(key).distinct()
    counts = side_by_side(
        left.sparkSession,
        unmatched.agg(F.count("*").alias("unmatched_key_count")),
        registry.agg(F.count("*").alias("registry_key_count")),
        unmatched.join(registry, key, "left_anti")
        .agg(F.count("*").alias("unexplained_key_count")),
        registry.join(unmatched, key, "left_anti")
        .agg(F.count("*").alias("unused_registry_key_count")),
        *[duplicate_keys(side, [key]).agg(F.count("*").alias(f"repeated_{name}_key_count"))
          for name, side in (("accepted", accepted), ("registry", rejected))])
    return with_verdict(counts, *[F.col(c) == 0 for c in (
        "unexplained_key_count", "unused_registry_key_count", "repeated_accepted_key_count",
        "repeated_registry_key_count")])


def compare_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Each key that only one side has, with ``missing_right`` or ``missing_left``."""
    l = left.select(*keys).distinct().withColumn("_l", F.lit(True))
    r = right.select(*keys).distinct().withColumn("_r", F.lit(True))
    side = (F.when(F.col("_r").isNull(), "missing_right")
            .when(F.col("_l").isNull(), "missing_left"))
    return (l.join(r, list(keys), "full_outer").withColumn("difference", side)
            .filter(F.col("difference").isNotNull()).drop("_l", "_r"))


def split_accounting(source: DataFrame, accepted: DataFrame, rejected: DataFrame,
                     keys: Sequence[str]) -> DataFrame:
    """Accepted and rejected must be disjoint, rebuild the source keys and add up."""
    spark = source.sparkSession

    def tally(df: DataFrame, name: str) -> DataFrame:
        return df.agg(F.count("*").alias(name))

    rebuilt = accepted.select(*keys).union(rejected.select(*keys))
    counts = side_by_side(
        spark,
        tally(source, "source_row_count"),
        tally(accepted, "accepted_row_count"),
        tally(rejected, "rejected_row_count"),
        tally(accepted.select(*keys).intersect(rejected.select(*keys)),
              "accepted_rejected_overlap"),
        tally(compare_keys(source, rebuilt, keys), "key_difference_count"))
    return with_verdict(
        counts,
        F.col("source_row_count") == F.col("accepted_row_count") + F.col("rejected_row_count"),
        F.col("accepted_rejected_overlap") == 0, F.col("key_difference_count") == 0,
        F.col("source_row_count") > 0)


def latest_partition(df: DataFrame, order: Sequence[Column], keys: Sequence[str]) -> DataFrame:
    """Rows of the first partition in ``order``; the key frame is one row by its limit."""
    newest = df.groupBy(*keys).agg(F.count("*").alias("_n")).orderBy(*order).limit(1)
    return df.join(F.broadcast(newest.select(*keys)), list(keys), "inner")
