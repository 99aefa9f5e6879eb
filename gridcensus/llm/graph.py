"""Connected components of links, as joins and minima.

Each round every vertex learns the smallest grandparent among its neighbours, and so do its
parent and itself (hooking and shortcutting in one step); the number of rounds grows with the
logarithm of a component's diameter. Minima are partial aggregates, and a vertex with very many
links is only ever one side of a join, which adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridcensus.session import cut_lineage


def components(links: DataFrame) -> DataFrame:
    """Links a, b (any order, repeats allowed) to id, component (the smallest id reachable).

    Only vertices with a link to another appear.
    """
    pairs = links.where("a <> b")
    edges = cut_lineage(pairs.select("a", "b").unionByName(
        pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    parents = cut_lineage(edges.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("parent")).select(
        "id", F.least("id", "parent").alias("parent")))
    while True:
        above = parents.select(F.col("id").alias("parent"), F.col("parent").alias("grand"))
        known = parents.join(above, "parent").select("id", "parent", "grand")
        near = edges.join(known.select(F.col("id").alias("b"), "grand"), "b").groupBy(
            F.col("a").alias("id")).agg(F.min("grand").alias("best"))
        met = known.join(near, "id")
        offers = met.select("id", F.explode(F.array(
            F.struct(F.col("id").alias("to"), F.least("best", "grand").alias("parent")),
            F.struct(F.col("parent").alias("to"), F.least("best", "grand").alias("parent")))).alias("o"))
        best = offers.groupBy(F.col("o.to").alias("id")).agg(F.min("o.parent").alias("parent"))
        new = cut_lineage(best.join(parents.withColumnRenamed("parent", "_old"), "id").select(
            "id", F.least("parent", "_old").alias("parent"), "_old"))
        if new.where("parent <> _old").isEmpty():
            return new.select("id", F.col("parent").alias("component"))
        parents = new.select("id", "parent")
