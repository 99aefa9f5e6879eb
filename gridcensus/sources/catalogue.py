"""Pick catalogue layers by scoring their names against alias lists."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridcensus.functions.text import transliterate
from gridcensus.operators.verdict import passed

# Aliases of the three zone levels.
LAYER_ALIASES = {
    "prognoseraum": ("prognoseraum", "prognoseraeume", "prg", "pgr"),
    "bezirksregion": ("bezirksregion", "bezirksregionen", "bzr"),
    "planungsraum": ("planungsraum", "planungsraeume", "plr"),
}


def layer_score(name: Column, title: Column, aliases: Sequence[str]) -> Column:
    """Per alias: 10 for a whole word or else 3 for a substring, and 10 for the local name."""
    plain_name, plain_title = transliterate(name), transliterate(title)
    combined = F.concat_ws(" ", plain_name, plain_title)
    local = F.element_at(F.split(plain_name, ":"), -1)
    score = F.lit(0)
    for alias in aliases:
        word = rf"(^|[^a-z0-9]){re.escape(alias)}([^a-z0-9]|$)"
        score = (score + F.when(combined.rlike(word), 10).when(combined.contains(alias), 3)
                 .otherwise(0) + F.when(local == alias, 10).otherwise(0))
    return score


def score_layers(layers: DataFrame, targets: Mapping[str, Sequence[str]] = LAYER_ALIASES
                 ) -> DataFrame:
    """Layers (``name``, ``title``) times targets with a positive score.

    The target list is part of the expression, so nothing is joined.
    """
    scored = F.array(*[F.struct(F.lit(t).alias("target"),
                                layer_score(F.col("name"), F.col("title"), a).alias("score"))
                       for t, a in targets.items()])
    return (layers.select("name", "title", F.explode(scored).alias("s"))
            .select("s.target", "name", "title", "s.score").filter(F.col("score") > 0))


def best_layers(scored: DataFrame) -> DataFrame:
    """Per target the best score, how many layers reach it, and the first of them."""
    best = scored.groupBy("target").agg(F.max("score").alias("score"))
    return (scored.join(F.broadcast(best), ["target", "score"]).groupBy("target", "score")
            .agg(F.count("*").alias("tied_layers"), F.min("name").alias("name")))


def layer_verdict(scored: DataFrame, targets: Mapping[str, Sequence[str]] = LAYER_ALIASES
                  ) -> DataFrame:
    """Per target: found, unambiguous, and not the layer another target chose too.

    There is one row per target here, so the comparison among targets is tiny.
    """
    best = best_layers(scored)
    shared = best.groupBy("name").agg(F.count("*").alias("uses"))
    wanted = scored.sparkSession.createDataFrame([(t,) for t in targets], "target string")
    judged = (wanted.join(F.broadcast(best), "target", "left")
              .join(F.broadcast(shared), "name", "left"))
    return judged.select(
        "target", "name", "score", F.coalesce("tied_layers", F.lit(0)).alias("tied_layers"),
        passed(F.col("tied_layers") == 1, F.col("uses") == 1).alias("passed"))
