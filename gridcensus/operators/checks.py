"""One-row verdicts over stored tables. Expected counts are parameters."""

from __future__ import annotations

import os
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridcensus import schemas
from gridcensus.functions import geom
from gridcensus.functions.fields import is_finite
from gridcensus.functions.forecast import parse_run_label, valid_time
from gridcensus.operators.aggregates import (count_if, current_version, duplicate_count,
                                             is_constant, weight_deviation)
from gridcensus.operators.joins import compare_keys, orphans, unmatched_keys
from gridcensus.operators.skew import lookup_join
from gridcensus.operators.verdict import passed, reason_map, side_by_side, with_verdict


def _tally(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.count("*").alias(name))


def _orphan_rows(child: DataFrame, parent: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    return orphans(child, parent, keys).agg(
        F.coalesce(F.sum("row_count"), F.lit(0)).alias(name))


def constraint_audit(df: DataFrame, primary_key: Sequence[str] = (),
                     not_null: Sequence[str] = (), checks: Mapping[str, Column] | None = None,
                     foreign_keys: Mapping[str, tuple[Sequence[str], DataFrame, Sequence[str]]]
                     | None = None) -> DataFrame:
    """Violation counts as (constraint, violation_count) rows.

    NOT NULL and CHECK clauses share one aggregate; a CHECK is violated when it is false,
    not when it is unknown. The key and each reference cost one aggregate of their own.
    """
    clauses = {f"not_null:{c}": F.col(c).isNull() for c in not_null}
    clauses |= {f"check:{n}": ~condition for n, condition in (checks or {}).items()}
    parts = []
    if clauses:
        entries = F.array(*[F.struct(F.lit(name).alias("constraint"),
                                     count_if(bad).alias("violation_count"))
                            for name, bad in clauses.items()])
        parts.append(df.agg(entries.alias("e")).select(F.inline("e")))
    if primary_key:
        parts.append(duplicate_count(df, primary_key, "violation_count")
                     .select(F.lit("primary_key").alias("constraint"), "violation_count"))
    for name, (columns, parent, parent_columns) in (foreign_keys or {}).items():
        target = parent.select(*[F.col(p).alias(c) for c, p in zip(columns, parent_columns)])
        present = df.dropna(subset=list(columns))
        parts.append(_orphan_rows(present, target, columns, "violation_count")
                     .select(F.lit(f"foreign_key:{name}").alias("constraint"), "violation_count"))
    result = parts[0]
    for part in parts[1:]:
        result = result.union(part)
    return result


def population_check(raw: DataFrame, accepted: DataFrame, rejected: DataFrame) -> DataFrame:
    """Source = accepted + rejected, no overlap, source not empty."""
    key = ["reference_date", "plr_id"]
    both = (accepted.select(*key).withColumn("_a", F.lit(1)).unionByName(
        rejected.select(*key).withColumn("_a", F.lit(0))).groupBy(*key).agg(
        F.sum("_a").alias("a"), F.count("*").alias("n")))
    overlap = both.filter(F.col("reference_date").isNotNull() & F.col("plr_id").isNotNull()).agg(
        F.coalesce(F.sum(F.col("a") * (F.col("n") - F.col("a"))), F.lit(0))
        .alias("accepted_rejected_overlap"))
    counts = side_by_side(
        raw.sparkSession, _tally(raw, "source_row_count"),
        _tally(accepted, "accepted_row_count"), _tally(rejected, "rejected_row_count"),
        overlap, reason_map(rejected))
    return with_verdict(
        counts,
        F.col("source_row_count") == F.col("accepted_row_count") + F.col("rejected_row_count"),
        F.col("accepted_rejected_overlap") == 0, F.col("source_row_count") > 0)


def _unsound(geometry: str) -> Column:
    return ~F.coalesce(geom.rings_are_closed(geometry) & (geom.area(geometry) > 0), F.lit(False))


def zone_check(raw: DataFrame, zones: DataFrame, rejected: DataFrame,
               expected_zones: int = schemas.EXPECTED_ZONE_COUNT,
               srid: str | None = None) -> DataFrame:
    """Counts as expected, nothing rejected, nothing invalid, one planar system."""
    wrong = F.lit(False) if srid is None else F.col(srid) != schemas.PLANAR_SRID
    counts = side_by_side(
        raw.sparkSession,
        raw.agg(F.count("*").alias("source_row_count"),
                F.min("geography_version").alias("geography_version")),
        zones.agg(F.count("*").alias("normalized_row_count"),
                  count_if(_unsound("geometry")).alias("invalid_normalized_geometry_count"),
                  count_if(wrong).alias("wrong_srid_count")),
        _tally(rejected, "rejected_row_count"), reason_map(rejected))
    return with_verdict(
        counts, F.col("source_row_count") == expected_zones,
        F.col("normalized_row_count") == expected_zones, F.col("rejected_row_count") == 0,
        F.col("invalid_normalized_geometry_count") == 0, F.col("wrong_srid_count") == 0)


def cell_check(vertices: DataFrame, topology: DataFrame, cells: DataFrame, rejected: DataFrame,
               expected_vertices: int = schemas.EXPECTED_VERTEX_COUNT,
               expected_cells: int = schemas.EXPECTED_CELL_COUNT,
               srid: str | None = None) -> DataFrame:
    """Mesh counts as expected, three topology rows per cell, four zero counters."""
    wrong = F.lit(False) if srid is None else F.col(srid) != schemas.PLANAR_SRID
    counts = side_by_side(
        cells.sparkSession, _tally(vertices, "raw_vertex_count"),
        topology.agg(F.count_distinct("cell_index").alias("raw_cell_count"),
                     F.count("*").alias("topology_row_count")),
        cells.agg(F.count("*").alias("normalized_cell_count"),
                  count_if(_unsound("geometry")).alias("invalid_normalized_geometry_count"),
                  count_if(wrong).alias("wrong_srid_count"),
                  count_if(geom.exterior_point_count("geometry") != 4).alias("non_triangle_count")),
        _tally(rejected, "rejected_cell_count"), reason_map(rejected))
    return with_verdict(
        counts, F.col("raw_vertex_count") == expected_vertices,
        F.col("raw_cell_count") == expected_cells,
        F.col("topology_row_count") == expected_cells * 3,
        F.col("normalized_cell_count") == expected_cells, F.col("rejected_cell_count") == 0,
        F.col("invalid_normalized_geometry_count") == 0, F.col("wrong_srid_count") == 0,
        F.col("non_triangle_count") == 0)


def only(df: DataFrame, **scope) -> DataFrame:
    """The rows of one slice, e.g. ``only(bridge, geography_version=v, source_grid_id=g)``.

    The filters are plain equalities, so they prune partitions and reach the scan.
    """
    for column, value in scope.items():
        df = df.filter(F.col(column) == value)
    return df


def bridge_preconditions(zones: DataFrame, cells: DataFrame) -> DataFrame:
    """Both sides present before a bridge or mask is built."""
    counts = side_by_side(zones.sparkSession, _tally(zones, "zone_count"),
                          _tally(cells, "cell_count"))
    return with_verdict(counts, F.col("zone_count") > 0, F.col("cell_count") > 0)


def bridge_summary(bridge: DataFrame) -> DataFrame:
    return bridge.agg(F.count("*").alias("bridge_row_count"),
                      F.count_distinct("plr_id").alias("represented_plr_count"),
                      F.count_distinct("cell_index").alias("represented_icon_cell_count"))


#: One zone of one geography version on one grid: its weights sum to one.
BRIDGE_KEY = ("geography_version", "source_grid_id", "plr_id")


def bridge_check(bridge: DataFrame, zones: DataFrame, cells: DataFrame,
                 expected_zones: int | Column = schemas.EXPECTED_ZONE_COUNT,
                 tolerance: float = schemas.DEFAULT_WEIGHT_TOLERANCE) -> DataFrame:
    """Coverage, orphans, positive areas, fractions in (0, 1] and weights summing to one."""
    zone_key = ["plr_id", "geography_version"]
    plr, cell = F.col("fraction_of_plr"), F.col("fraction_of_icon_cell")
    areas = [F.col(c) <= 0 for c in ("intersection_area_m2", "plr_area_m2", "icon_cell_area_m2")]
    deviation = weight_deviation(
        bridge, [c for c in BRIDGE_KEY if c in bridge.columns], "fraction_of_plr", tolerance).select(
        F.col("weight_failure_count").alias("plr_weight_failure_count"),
        F.col("max_weight_error").alias("max_plr_weight_error"))
    counts = side_by_side(
        bridge.sparkSession, bridge_summary(bridge), _tally(zones, "source_plr_count"),
        _tally(unmatched_keys(zones, bridge, zone_key), "missing_plr_count"),
        _orphan_rows(bridge, zones, zone_key, "orphan_plr_count"),
        _orphan_rows(bridge, cells, ["source_grid_id", "cell_index"], "orphan_icon_cell_count"),
        bridge.agg(count_if(areas[0] | areas[1] | areas[2]).alias("nonpositive_area_count"),
                   count_if((plr <= 0) | (plr > 1 + tolerance) | (cell <= 0)
                            | (cell > 1 + tolerance)).alias("invalid_fraction_count")),
        deviation)
    zero = [F.col(c) == 0 for c in (
        "missing_plr_count", "orphan_plr_count", "orphan_icon_cell_count",
        "nonpositive_area_count", "invalid_fraction_count", "plr_weight_failure_count")]
    return with_verdict(counts, F.col("source_plr_count") == expected_zones,
                        F.col("bridge_row_count") > 0,
                        F.col("represented_plr_count") == F.col("source_plr_count"), *zero)


def bridge_contract(bridge: DataFrame, expected_zones: int | None = schemas.EXPECTED_ZONE_COUNT,
                    tolerance: float = 1e-5) -> DataFrame:
    """Contract of a bridge read from files: columns, unique pairs, finite positive numbers."""
    numeric = ("intersection_area_m2", "plr_area_m2", "icon_cell_area_m2", "fraction_of_plr",
               "fraction_of_icon_cell")
    schemas.require_columns(bridge, ("plr_id", "cell_index", *numeric), "bridge")
    not_finite, not_positive = F.lit(False), F.lit(False)
    for name in numeric:
        not_finite = not_finite | ~F.coalesce(is_finite(F.col(name)), F.lit(False))
        not_positive = not_positive | (F.col(name) <= 0)
    above = (F.col("fraction_of_plr") > 1 + tolerance) | (
        F.col("fraction_of_icon_cell") > 1 + tolerance)
    counts = side_by_side(
        bridge.sparkSession,
        bridge.agg(F.count("*").alias("bridge_row_count"),
                   F.count_distinct("plr_id").alias("plr_count"),
                   F.count_distinct("cell_index").alias("icon_cell_count"),
                   count_if(F.col("plr_id").isNull() | F.col("cell_index").isNull())
                   .alias("null_key_count"),
                   count_if(not_finite).alias("non_finite_count"),
                   count_if(not_positive).alias("nonpositive_count"),
                   count_if(above).alias("above_one_count")),
        duplicate_count(bridge, ["plr_id", "cell_index"], "duplicate_pair_count"),
        weight_deviation(bridge, [c for c in BRIDGE_KEY if c in bridge.columns], "fraction_of_plr",
                         tolerance))
    expected = F.lit(True) if expected_zones is None else F.col("plr_count") == expected_zones
    zero = [F.col(c) == 0 for c in (
        "null_key_count", "non_finite_count", "nonpositive_count", "above_one_count",
        "duplicate_pair_count", "weight_failure_count")]
    return with_verdict(counts, F.col("bridge_row_count") > 0, expected, *zero)


def mask_buffer_from_env(variable: str = "WEATHER_MASK_BUFFER_M") -> int:
    """Buffer in metres, overridable through the environment; must not be negative."""
    value = int(os.environ.get(variable, schemas.DEFAULT_MASK_BUFFER_M))
    if value < 0:
        raise ValueError("the mask buffer must not be negative")
    return value


def current_mask(masks: DataFrame, zones: DataFrame, buffer_m: int) -> DataFrame:
    """Mask rows of the current geography version; the version frame is one row."""
    version = current_version(zones).select("geography_version")
    return (masks.filter(F.col("mask_buffer_m") == buffer_m)
            .join(F.broadcast(version), "geography_version", "left_semi"))


def mask_check(mask: DataFrame, bridge: DataFrame, zones: DataFrame, cells: DataFrame,
               expected_zones: int | Column = schemas.EXPECTED_ZONE_COUNT) -> DataFrame:
    """The mask must contain every bridge cell and no unknown cell."""
    key = ["source_grid_id", "cell_index"]
    bridge_cells = bridge.select(*key).distinct()
    counts = side_by_side(
        mask.sparkSession, _tally(zones, "source_plr_count"), _tally(mask, "mask_cell_count"),
        _tally(bridge_cells, "bridge_cell_count"),
        _tally(unmatched_keys(bridge_cells, mask, key), "missing_bridge_cell_count"),
        _orphan_rows(mask, cells, key, "orphan_mask_cell_count"))
    return with_verdict(
        counts, F.col("source_plr_count") == expected_zones, F.col("mask_cell_count") > 0,
        F.col("bridge_cell_count") > 0, F.col("mask_cell_count") >= F.col("bridge_cell_count"),
        F.col("missing_bridge_cell_count") == 0, F.col("orphan_mask_cell_count") == 0)


PARTITION = ("run_time_utc", "lead_time")


def _per_indicator(row_count: str) -> Column:
    """Map over the five expected indicators, zero where none was observed."""
    pairs = []
    for name in sorted(schemas.INDICATORS):
        pairs += [F.lit(name), F.coalesce(F.max(F.when(F.col("indicator") == name,
                                                       F.col(row_count))), F.lit(0))]
    return F.create_map(*pairs)


def full_partition_check(fields: DataFrame, expected_cells: int | Column =
                         schemas.EXPECTED_CELL_COUNT,
                         metadata: Sequence[str] = ("source_unit", "source_url", "raw_path",
                                                    "source_sha256")) -> DataFrame:
    """Verdict per forecast over unscoped fields: five full indicators and nothing else.

    One shuffle by (run, lead, indicator) after partial counting, then a tiny second level.
    """
    cell, wanted = F.col("cell_index"), (
        expected_cells if isinstance(expected_cells, Column) else F.lit(expected_cells))
    constant = F.lit(True)
    for name in metadata:
        constant = constant & is_constant(name)
    by_indicator = fields.groupBy(*PARTITION, "indicator").agg(
        F.count("*").alias("row_count"),
        count_if(F.col("valid_time_utc") != valid_time(F.col("run_time_utc"), F.col("lead_time")))
        .alias("wrong_valid"),
        count_if((cell < 0) | (cell >= wanted)).alias("bad_cell"),
        count_if(F.col("source_value").isNull()).alias("null_value"),
        constant.alias("constant"))
    known = F.col("indicator").isin(*schemas.INDICATORS)
    right = count_if(known & (F.col("row_count") == wanted))
    verdicts = by_indicator.groupBy(*PARTITION).agg(
        F.sum("row_count").alias("total_row_count"),
        (wanted * F.lit(5).cast("long")).alias("expected_row_count"),
        F.count_distinct("indicator").alias("indicator_count"),
        (F.lit(5).cast("long") - count_if(known)).alias("missing_indicator_count"),
        count_if(~known).alias("unexpected_indicator_count"),
        (F.lit(5).cast("long") - right).alias("wrong_row_count_indicator_count"),
        F.sum("wrong_valid").alias("wrong_valid_time_row_count"),
        F.sum("bad_cell").alias("invalid_cell_index_row_count"),
        count_if(~F.col("constant")).alias("inconsistent_source_metadata_indicator_count"),
        F.sum("null_value").alias("null_source_value_count"),
        _per_indicator("row_count").alias("per_indicator_row_counts"))
    zero = [F.col(c) == 0 for c in (
        "missing_indicator_count", "unexpected_indicator_count",
        "wrong_row_count_indicator_count", "wrong_valid_time_row_count",
        "invalid_cell_index_row_count", "inconsistent_source_metadata_indicator_count")]
    return verdicts.withColumn("passed", passed(
        F.col("total_row_count") == F.col("expected_row_count"), F.col("indicator_count") == 5,
        *zero))


def scoped_partition_check(manifest: DataFrame, fields: DataFrame, mask: DataFrame,
                           expected_points: int | Column = schemas.EXPECTED_CELL_COUNT
                           ) -> DataFrame:
    """Verdict per forecast over masked fields and their source manifests.

    A forecast known from either side gets a row. Fields are reduced to one row per
    (run, lead, indicator) before anything is joined except the mask lookup.
    """
    known = F.col("indicator").isin(*schemas.INDICATORS)
    scope_columns = ("source_grid_id", "geography_version", "mask_buffer_m",
                     "retained_point_count")
    variants = F.lit(0)
    for name in scope_columns:
        variants = variants + F.count_distinct(name)
    scope = manifest.groupBy(*PARTITION).agg(
        F.count("*").alias("source_indicator_count"),
        *[F.min(c).alias(c) for c in scope_columns[:3]],
        F.min("retained_point_count").alias("mask_cell_count"),
        variants.alias("variants"),
        F.count_distinct(F.when(known, F.col("indicator"))).alias("known_count"),
        count_if(~known).alias("unexpected_indicator_count"),
        count_if(F.col("source_point_count") != expected_points)
        .alias("wrong_source_point_count_indicator_count"),
        count_if(F.col("valid_time_utc") != valid_time(F.col("run_time_utc"), F.col("lead_time")))
        .alias("wrong_valid_time_indicator_count"))

    scoped = lookup_join(fields, scope.select(*PARTITION, *scope_columns[:3]), PARTITION, "left",
                         ["indicator", "cell_index"])
    mask_key = [*scope_columns[:3], "cell_index"]
    held = lookup_join(scoped, mask.select(*mask_key).distinct().withColumn("_in", F.lit(True)),
                       mask_key, "left", [*PARTITION, "indicator", "cell_index"])
    by_indicator = held.groupBy(*PARTITION, "indicator").agg(
        F.count("*").alias("row_count"),
        count_if(F.col("source_value").isNull()).alias("null_value"),
        count_if(F.col("_in").isNull() & F.col("source_grid_id").isNotNull()).alias("outside"))
    observed = by_indicator.groupBy(*PARTITION).agg(
        F.count_distinct("indicator").alias("field_indicator_count"),
        F.sum("row_count").alias("total_retained_row_count"),
        F.sum("null_value").alias("null_retained_value_count"),
        F.sum("outside").alias("outside_mask_row_count"),
        _per_indicator("row_count").alias("per_indicator_row_counts"))

    counters = ["source_indicator_count", "field_indicator_count", "total_retained_row_count",
                "null_retained_value_count", "outside_mask_row_count", "variants", "known_count",
                "unexpected_indicator_count", "wrong_source_point_count_indicator_count",
                "wrong_valid_time_indicator_count"]
    empty = F.create_map(*[x for i in sorted(schemas.INDICATORS) for x in (F.lit(i), F.lit(0).cast("long"))])
    joined = (scope.join(observed, list(PARTITION), "full_outer").fillna(0, subset=counters)
              .withColumn("per_indicator_row_counts",
                          F.coalesce("per_indicator_row_counts", empty)))
    size = F.coalesce(F.col("mask_cell_count"), F.lit(0))
    wrong = F.lit(0).cast("long")
    for name in schemas.INDICATORS:
        wrong = wrong + (F.col("per_indicator_row_counts")[name] != size).cast("long")
    verdicts = joined.select(
        *PARTITION, "source_indicator_count", "field_indicator_count",
        "total_retained_row_count",
        (F.col("mask_cell_count") * F.lit(5).cast("long")).alias("expected_retained_row_count"),
        "mask_cell_count", (F.lit(5).cast("long") - F.col("known_count")).alias("missing_indicator_count"),
        "unexpected_indicator_count", "wrong_source_point_count_indicator_count",
        wrong.alias("wrong_retained_row_count_indicator_count"),
        "wrong_valid_time_indicator_count",
        F.when(F.col("variants") == 4, 0).otherwise(1).cast("long")
        .alias("inconsistent_scope_count"),
        "outside_mask_row_count", "null_retained_value_count", "per_indicator_row_counts")
    zero = [F.col(c) == 0 for c in (
        "missing_indicator_count", "unexpected_indicator_count",
        "wrong_source_point_count_indicator_count", "wrong_retained_row_count_indicator_count",
        "wrong_valid_time_indicator_count", "inconsistent_scope_count",
        "outside_mask_row_count")]
    return verdicts.withColumn("passed", passed(
        F.col("source_indicator_count") == 5, F.col("field_indicator_count") == 5,
        F.col("total_retained_row_count") == F.col("expected_retained_row_count"), *zero))


def artefact_contract(accepted: DataFrame, rejected: DataFrame,
                      expected_rows: int | None = schemas.EXPECTED_ZONE_COUNT) -> DataFrame:
    """Unique ids, nothing missing in accepted rows, disjoint halves, expected total."""
    values = ("population_total", "population_65plus", "share_65plus")
    schemas.require_columns(accepted, ("plr_id", *values), "accepted population")
    schemas.require_columns(rejected, ("plr_id", *values, "rejection_reason"),
                            "rejected population")
    missing = F.col(values[0]).isNull() | F.col(values[1]).isNull() | F.col(values[2]).isNull()
    counts = side_by_side(
        accepted.sparkSession,
        accepted.agg(F.count("*").alias("accepted_row_count"),
                     count_if(missing).alias("accepted_missing_count")),
        _tally(rejected, "rejected_row_count"),
        duplicate_count(accepted, ["plr_id"], "accepted_duplicate_count"),
        duplicate_count(rejected, ["plr_id"], "rejected_duplicate_count"),
        _tally(accepted.select("plr_id").intersect(rejected.select("plr_id")), "overlap_count"),
        reason_map(rejected)).withColumn(
        "source_row_count", F.col("accepted_row_count") + F.col("rejected_row_count"))
    expected = F.lit(True) if expected_rows is None else (
        F.col("source_row_count") == expected_rows)
    zero = [F.col(c) == 0 for c in ("accepted_missing_count", "accepted_duplicate_count",
                                    "rejected_duplicate_count", "overlap_count")]
    return with_verdict(counts, expected, *zero)


def coverage_check(final: DataFrame, expected_zones: int | Column = schemas.EXPECTED_ZONE_COUNT
                   ) -> DataFrame:
    """Per forecast: as many rows as distinct zones as expected, none without an id."""
    counts = final.groupBy(*PARTITION).agg(
        F.count("*").alias("row_count"), F.count_distinct("plr_id").alias("unique_plr_count"),
        count_if(F.col("plr_id").isNull()).alias("missing_plr_ids"))
    return counts.withColumn("passed", passed(
        F.col("row_count") == expected_zones, F.col("unique_plr_count") == expected_zones,
        F.col("missing_plr_ids") == 0))


def identity_check(final: DataFrame, partition: Sequence[str] = ("run_label", "lead_label")
                   ) -> DataFrame:
    """Per stored partition: one run, lead and valid time, equal to the partition's labels."""
    counts = final.groupBy(*partition).agg(
        *[F.count_distinct(c).alias(f"{c}_count") for c in (*PARTITION, "valid_time_utc")],
        *[F.min(c).alias(c) for c in (*PARTITION, "valid_time_utc")])
    run = parse_run_label(F.col(partition[0]))
    return counts.withColumn("passed", passed(
        *[F.col(f"{c}_count") == 1 for c in (*PARTITION, "valid_time_utc")],
        F.col("run_time_utc") == run, F.col("lead_time") == F.col(partition[1]),
        F.col("valid_time_utc") == valid_time(run, F.col(partition[1]))))


def exceptions_check(final: DataFrame, registry: DataFrame) -> DataFrame:
    """Statuses known, rejected zones equal to the registry, values present exactly if available."""
    status, reason = F.col("population_status"), F.col("population_rejection_reason")
    values = [F.col(c) for c in ("population_total", "population_65plus", "share_65plus")]
    any_missing = values[0].isNull() | values[1].isNull() | values[2].isNull()
    any_present = values[0].isNotNull() | values[1].isNotNull() | values[2].isNotNull()
    available, refused = status == "available", status == "rejected_source_record"
    refused_ids = final.filter(refused).select("plr_id").distinct()
    counts = side_by_side(
        final.sparkSession,
        final.agg(count_if(available).alias("available_count"),
                  count_if(refused).alias("final_rejected_count"),
                  count_if(status.isNull() | ~status.isin(*schemas.POPULATION_STATUSES))
                  .alias("bad_status_count"),
                  count_if(available & any_missing).alias("available_incomplete_count"),
                  count_if(refused & any_present).alias("rejected_with_metrics_count"),
                  count_if(refused & reason.isNull()).alias("rejected_without_reason_count")),
        _tally(registry, "registry_rejected_count"),
        _tally(compare_keys(refused_ids, registry, ["plr_id"]), "registry_difference_count"))
    zero = [F.col(c) == 0 for c in (
        "bad_status_count", "available_incomplete_count", "rejected_with_metrics_count",
        "rejected_without_reason_count", "registry_difference_count")]
    return with_verdict(counts, *zero)


def evolution_guard(tables: Mapping[str, DataFrame], column: str) -> DataFrame:
    """Per table: may the column become mandatory, or do rows without it exist?"""
    parts = [df.agg(F.lit(name).alias("table_name"),
                    count_if(F.col(column).isNull()).alias("null_count"))
             for name, df in tables.items()]
    result = parts[0]
    for part in parts[1:]:
        result = result.union(part)
    return result.withColumn("passed", F.col("null_count") == 0)


def add_missing_columns(stored: DataFrame, incoming: DataFrame) -> DataFrame:
    """Additive evolution: the union of both column sets, NULL where a side lacks one."""
    return stored.unionByName(incoming, allowMissingColumns=True)
