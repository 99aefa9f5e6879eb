"""Triangular meshes from decoded coordinate and connectivity arrays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridcensus.functions.geom import let
from gridcensus.functions.projection import to_degrees
from gridcensus.operators.joins import orphans
from gridcensus.operators.verdict import with_verdict


def vertex_rows(coordinates: DataFrame, unit: str | None = None) -> DataFrame:
    """``source_grid_id``, ``longitude`` and ``latitude`` arrays to one row per vertex.

    Values are radians when the unit text says so or no value of the axis exceeds a full turn.
    """
    text = F.lit(unit) if unit is not None else None

    def axis(name: str) -> Column:
        known = F.filter(name, lambda v: ~F.isnan(v))
        return let(F.array_max(F.transform(known, lambda v: F.abs(v))), lambda largest:
                   F.transform(name, lambda v: to_degrees(v, text, largest)))

    return (coordinates.select("source_grid_id", axis("longitude").alias("lon"),
                               axis("latitude").alias("lat"))
            .select("source_grid_id", F.posexplode(F.arrays_zip("lon", "lat"))
                    .alias("vertex_index", "p"))
            .select("source_grid_id", "vertex_index", F.col("p.lon").alias("longitude_deg"),
                    F.col("p.lat").alias("latitude_deg")))


def connectivity_rows(matrix: DataFrame) -> DataFrame:
    """Rows of a 2-D index matrix (``source_grid_id``, ``row``, ``indexes``) as long entries."""
    return matrix.select("source_grid_id", "row",
                         F.posexplode("indexes").alias("column", "value"))


def topology_rows(matrix: DataFrame, vertex_count: int) -> tuple[DataFrame, DataFrame]:
    """Zero-based cell corners, and per grid the verdict on shape and index range.

    Three rows mean one row per corner, otherwise three columns mean one row per cell. The
    smallest index decides whether counting starts at one.
    """
    entries = connectivity_rows(matrix)
    grid = "source_grid_id"
    shape = matrix.groupBy(grid).agg(F.count("*").alias("row_count"),
                       F.min(F.size("indexes")).alias("min_width"),
                       F.max(F.size("indexes")).alias("max_width"))
    span = entries.groupBy(grid).agg(F.min("value").alias("min_index"), F.max("value").alias("max_index"))
    facts = shape.join(span, grid, "left")
    by_corner = F.col("row_count") == 3
    base = F.when(F.col("min_index") == 1, 1).otherwise(0)
    topology = entries.join(facts, grid).select(
        "source_grid_id",
        F.when(by_corner, F.col("column")).otherwise(F.col("row")).cast("int").alias("cell_index"),
        F.when(by_corner, F.col("row")).otherwise(F.col("column")).cast("int")
        .alias("vertex_order"), (F.col("value") - base).cast("int").alias("vertex_index"))
    even = F.col("min_width") == F.col("max_width")
    first = F.when(F.col("min_index") == 1, 1).otherwise(0)
    verdict = with_verdict(facts, even, (F.col("row_count") == 3) | (F.col("max_width") == 3),
                           F.col("min_index").isin(0, 1),
                           F.col("max_index") - first < vertex_count)
    return topology, verdict


def dangling_corners(topology: DataFrame, vertices: DataFrame) -> DataFrame:
    """Corner references without a vertex, counted per reference."""
    return orphans(topology, vertices, ["source_grid_id", "vertex_index"])


def mesh_lengths(coordinates: DataFrame) -> DataFrame:
    """Longitude and latitude arrays must have equal lengths."""
    sizes = coordinates.select("source_grid_id", F.size("longitude").alias("longitude_count"),
                               F.size("latitude").alias("latitude_count"))
    return sizes.withColumn("passed", F.col("longitude_count") == F.col("latitude_count"))
