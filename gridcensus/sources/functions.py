"""Frames as parameterised table functions of SQL, for sessions that ask in SQL text."""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame


def table_function(name: str, parameters: Mapping[str, str], df: DataFrame, condition: str) -> None:
    """Register ``name(parameters)``: the rows of ``df`` for which ``condition`` holds.

    ``parameters`` maps names to SQL types; ``condition`` is SQL over them and the columns. The
    function is the session's own. Nothing runs until it is called, and a call is planned like any
    other query, so the condition is pushed into whatever ``df`` reads.
    """
    spark, view = df.sparkSession, f"{name}_rows_{uuid.uuid4().hex[:8]}"
    df.createOrReplaceTempView(view)
    taken = ", ".join(f"{p} {t}" for p, t in parameters.items())
    given = ", ".join(f"`{c}` {t}" for c, t in df.dtypes)
    columns = ", ".join(f"t.`{c}`" for c in df.columns)
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({taken}) RETURNS TABLE ({given}) "
              f"RETURN SELECT {columns} FROM {view} AS t WHERE {condition}")
