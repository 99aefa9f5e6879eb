"""Profilers: observations about a dataset, as rows. They judge nothing.

Lists that a report would print (incomplete rows, unknown ids) are returned as frames, not
packed into one cell, because nothing bounds their length.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridcensus.functions import fields, geom
from gridcensus.operators.aggregates import (count_if, describe, duplicate_count, null_counts,
                                             value_counts)
from gridcensus.operators.joins import compare_keys, unmatched_keys
from gridcensus.operators.skew import lookup_join
from gridcensus.operators.spatial import flag_invalid, with_box
from gridcensus.operators.verdict import side_by_side


def population_profile(frame: DataFrame) -> DataFrame:
    """Identity, reference codes and missing counts of a coerced snapshot, one row."""
    return side_by_side(
        frame.sparkSession,
        frame.agg(F.count("*").alias("row_count"),
                  F.count_distinct("plr_id").alias("distinct_id_count"),
                  count_if(F.col("plr_id").isNull()).alias("null_id_count"),
                  F.count_distinct("ZEIT").alias("reference_code_count"),
                  F.min("ZEIT").alias("first_reference_code"),
                  F.max("ZEIT").alias("last_reference_code"),
                  *null_counts(("population_total", "population_65_79", "population_80plus",
                                "population_65plus", "share_65plus"))),
        duplicate_count(frame, ["plr_id"], "duplicate_id_count"))


def population_description(frame: DataFrame) -> DataFrame:
    return describe(frame, ("population_total", "population_65_79", "population_80plus",
                            "population_65plus", "share_65plus"))


def incomplete_population(frame: DataFrame) -> DataFrame:
    return frame.filter(F.col("population_65plus").isNull()).select(
        "plr_id", "population_65_79", "population_80plus")


def zone_profile(raw: DataFrame, id_column: str = "plr_id_source") -> DataFrame:
    """Feature, id and geometry counters, one row."""
    g = F.col("geometry")
    flagged = flag_invalid(raw, ["source_row_id"])
    return side_by_side(
        raw.sparkSession,
        flagged.agg(
            F.count("*").alias("input_feature_count"),
            F.count_distinct(id_column).alias("distinct_plr_id_count"),
            count_if(F.col(id_column).isNull()).alias("null_plr_id_count"),
            F.min("srid").alias("first_srid"), F.max("srid").alias("last_srid"),
            count_if(g.isNull()).alias("null_geometry_count"),
            count_if(geom.is_empty("geometry")).alias("empty_geometry_count"),
            count_if(F.col("is_invalid") & ~geom.is_empty("geometry")).alias("invalid_geometry_count")),
        duplicate_count(raw, [id_column], "duplicate_plr_id_count"))


def geometry_types(raw: DataFrame) -> DataFrame:
    return value_counts(raw, "geometry_type", "<NULL>").orderBy("geometry_type")


def area_profile(zones: DataFrame) -> DataFrame:
    """Total bounds and the area distribution, one row."""
    boxed = with_box(zones).withColumn("area_m2", geom.area("geometry"))
    bounds = boxed.agg(F.count("*").alias("zone_count"), F.min("box.minx").alias("minx"),
                       F.min("box.miny").alias("miny"), F.max("box.maxx").alias("maxx"),
                       F.max("box.maxy").alias("maxy"))
    areas = describe(boxed, ["area_m2"]).select(
        F.col("min").alias("area_min"), F.col("median").alias("area_median"),
        F.col("max").alias("area_max"), F.col("sum").alias("area_sum"))
    return side_by_side(zones.sparkSession, bounds, areas)


def union_share(inside: DataFrame, cells: DataFrame) -> DataFrame:
    """Cells whose centre lies in the union, and their share of the grid, one row."""
    counts = side_by_side(cells.sparkSession,
                          inside.agg(F.count("*").alias("inside_cell_count")),
                          cells.agg(F.count("*").alias("grid_cell_count")))
    return counts.withColumn("grid_share", F.try_divide("inside_cell_count", "grid_cell_count"))


def mesh_profile(vertices: DataFrame, topology: DataFrame) -> DataFrame:
    """Sizes, referenced vertices, corners per cell and coordinate ranges, one row."""
    corners = topology.groupBy("cell_index").agg(F.count("*").alias("n")).agg(
        F.count("*").alias("cell_count"), F.min("n").alias("min_vertices_per_cell"),
        F.max("n").alias("max_vertices_per_cell"))
    lon, lat = F.col("longitude_deg"), F.col("latitude_deg")
    return side_by_side(
        vertices.sparkSession, corners,
        topology.agg(F.count_distinct("vertex_index").alias("unique_vertices_referenced")),
        vertices.agg(F.count("*").alias("vertex_count"),
                     F.min(lon).alias("min_longitude"), F.max(lon).alias("max_longitude"),
                     F.min(lat).alias("min_latitude"), F.max(lat).alias("max_latitude"),
                     count_if(lon.isNull() | F.isnan(lon) | lat.isNull() | F.isnan(lat))
                     .alias("missing_coordinate_count")))


def temperature_profile(field: DataFrame) -> DataFrame:
    """Counters of one temperature field, markers counted apart, one row."""
    k, c = F.col("temperature_k"), F.col("temperature_c")
    missing = fields.is_missing_pair(k, c)
    run, valid = F.min("run_time_utc"), F.min("valid_time_utc")
    return side_by_side(
        field.sparkSession,
        field.agg(F.count("*").alias("row_count"),
                  F.count_distinct("cell_index").alias("distinct_cell_count"),
                  *null_counts(("cell_index", "run_time_utc", "valid_time_utc",
                                "temperature_k", "temperature_c")),
                  run.alias("run_time_utc"), valid.alias("valid_time_utc"),
                  F.count_distinct("run_time_utc").alias("distinct_run_time_count"),
                  F.count_distinct("valid_time_utc").alias("distinct_valid_time_count"),
                  ((F.unix_timestamp(valid) - F.unix_timestamp(run)) / 60).cast("int")
                  .alias("lead_time_minutes"),
                  count_if(missing).alias("missing_row_count"),
                  F.avg(missing.cast("int")).alias("missing_share")),
        duplicate_count(field, ["cell_index"], "duplicate_cell_index_count"))


def observed_temperature(field: DataFrame) -> DataFrame:
    """Distribution of observed Kelvin and Celsius values."""
    k, c = F.col("temperature_k"), F.col("temperature_c")
    seen = ~fields.is_missing_pair(k, c)
    return describe(field.select(
        F.when(seen, fields.finite_or_null(k)).alias("temperature_k"),
        F.when(seen, fields.finite_or_null(c)).alias("temperature_c")),
        ("temperature_k", "temperature_c"))


def bridge_subset_profile(field: DataFrame, bridge: DataFrame) -> DataFrame:
    """How far the field covers the bridge cells, one row."""
    wanted = bridge.filter(F.col("cell_index").isNotNull()).select("cell_index").distinct()
    kept = lookup_join(field, wanted, ["cell_index"], "left_semi",
                       ["run_time_utc", "valid_time_utc"])
    missing = fields.is_missing_pair(F.col("temperature_k"), F.col("temperature_c"))
    celsius = F.when(~missing, F.col("temperature_c"))
    counts = side_by_side(
        field.sparkSession, wanted.agg(F.count("*").alias("expected_relevant_cell_count")),
        kept.agg(F.count_distinct("cell_index").alias("matched_cell_count"),
                 count_if(missing).alias("missing_temperature_row_count"),
                 F.min(celsius).alias("min_c"), F.avg(celsius).alias("mean_c"),
                 F.max(celsius).alias("max_c")))
    return counts.withColumn("missing_relevant_cell_count", F.col("expected_relevant_cell_count")
                             - F.col("matched_cell_count"))


def zone_rollup(bridge: DataFrame) -> DataFrame:
    """Cells, weight and covered area per zone of a geography version on a grid."""
    keys = [c for c in ("geography_version", "source_grid_id", "plr_id") if c in bridge.columns]
    rolled = bridge.groupBy(*keys).agg(
        F.count_distinct("cell_index").alias("icon_cells_used"),
        F.sum("fraction_of_plr").alias("weight_sum"),
        F.sum("intersection_area_m2").alias("intersection_area_sum_m2"),
        F.max("plr_area_m2").alias("plr_area_m2"))
    return rolled.withColumn("coverage_ratio",
                             F.col("intersection_area_sum_m2") / F.col("plr_area_m2"))


def bridge_profile(bridge: DataFrame) -> DataFrame:
    """Sizes, duplicates, missing values and the largest deviations from one."""
    rolled = zone_rollup(bridge)
    return side_by_side(
        bridge.sparkSession,
        bridge.agg(F.count("*").alias("row_count"),
                   F.count_distinct("plr_id").alias("distinct_plr_count"),
                   F.count_distinct("cell_index").alias("distinct_icon_cell_count"),
                   *null_counts(("plr_id", "cell_index", "intersection_area_m2", "plr_area_m2",
                                 "icon_cell_area_m2", "fraction_of_plr",
                                 "fraction_of_icon_cell"))),
        duplicate_count(bridge, ["plr_id", "cell_index"], "duplicate_plr_cell_pair_count"),
        rolled.agg(F.max(F.abs(F.col("weight_sum") - 1)).alias("max_weight_error"),
                   F.max(F.abs(F.col("coverage_ratio") - 1)).alias("max_coverage_error")))


def bridge_description(bridge: DataFrame) -> DataFrame:
    """Distributions over bridge rows and over the per-zone rollup."""
    rows = describe(bridge, ("intersection_area_m2", "fraction_of_plr", "fraction_of_icon_cell"))
    return rows.unionByName(describe(zone_rollup(bridge),
                                     ("icon_cells_used", "weight_sum", "coverage_ratio")))


def bridge_references(bridge: DataFrame, zones: DataFrame, cells: DataFrame) -> DataFrame:
    """Ids only one side has: (kind, id, difference) rows."""
    zone = compare_keys(zones, bridge, ["plr_id"]).select(
        F.lit("zone").alias("kind"), F.col("plr_id").alias("id"),
        F.when(F.col("difference") == "missing_right", "missing_from_bridge")
        .otherwise("unexpected_in_bridge").alias("difference"))
    cell = unmatched_keys(bridge, cells, ["cell_index"]).select(
        F.lit("cell").alias("kind"), F.col("cell_index").cast("string").alias("id"),
        F.lit("missing_from_source").alias("difference"))
    return zone.union(cell)


def nearest_summary(mapping: DataFrame) -> DataFrame:
    """Distances and zones per assigned cell, one row; zones without a cell count nowhere."""
    mapping = mapping.where("cell_index IS NOT NULL")
    loads = mapping.groupBy("cell_index").agg(F.count("*").alias("zones_per_cell"))
    d = describe(mapping, ["distance_m"]).select(
        F.col("value_count").alias("mapped_count"), F.col("mean").alias("mean_distance_m"),
        F.col("median").alias("median_distance_m"), F.col("max").alias("max_distance_m"))
    z = describe(loads, ["zones_per_cell"]).select(
        F.col("value_count").alias("cells_used"), F.col("min").alias("min_zones_per_cell"),
        F.col("median").alias("median_zones_per_cell"), F.col("mean").alias("mean_zones_per_cell"),
        F.col("max").alias("max_zones_per_cell"))
    return side_by_side(mapping.sparkSession, d, z)
