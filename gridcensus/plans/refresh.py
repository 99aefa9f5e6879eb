"""Refresh jobs: check the preconditions, compute, replace the stored slice, summarise.

Each job takes the stored tables (or None for the first run) and returns their next version
with a one-row summary. The caller writes them; ``sources.tables`` has the writers. A failed
precondition raises before anything is returned, so stored tables stay as they are.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridcensus import schemas
from gridcensus.operators import checks, gates, spatial, weather
from gridcensus.operators.joins import explained_audit, unmatched_keys
from gridcensus.operators.verdict import enforce, side_by_side
from gridcensus.session import cut_lineage
from gridcensus.sources.tables import replace_slice, upsert, write_partitions


@dataclass(frozen=True)
class Refreshed:
    """Next version of the target table, of its quarantine if it has one, and a summary."""

    table: DataFrame
    rejected: DataFrame | None
    summary: DataFrame


def _stamped(rejected: DataFrame) -> DataFrame:
    return rejected.withColumn("rejected_at_utc", F.current_timestamp())


def _replaced(stored: DataFrame | None, incoming: DataFrame, keys, slices: DataFrame) -> DataFrame:
    return incoming if stored is None else replace_slice(stored, incoming, keys, slices)


def refresh_population(raw: DataFrame, accepted: DataFrame | None = None,
                       rejected: DataFrame | None = None,
                       expected_rows: int | None = schemas.EXPECTED_ZONE_COUNT) -> Refreshed:
    """Split one snapshot and replace its reference date in both halves."""
    enforce(gates.population_preconditions(raw, expected_rows), "population snapshot")
    split = gates.population_gate(raw).stored()
    slices = split.classified.select("reference_date").distinct()
    refused = _stamped(split.rejected)
    enforce(checks.population_check(raw, split.accepted, split.rejected), "population split")
    return Refreshed(_replaced(accepted, split.accepted, ["reference_date"], slices),
                     _replaced(rejected, refused, ["reference_date"], slices), split.report())


def refresh_zones(raw: DataFrame, zones: DataFrame | None = None,
                  rejected: DataFrame | None = None) -> Refreshed:
    """Normalise one zone source, upsert its zones and replace its quarantine."""
    enforce(gates.zone_preconditions(raw), "zone source")
    split = gates.zone_gate(raw).stored()
    table = split.accepted if zones is None else upsert(
        zones, split.accepted, ["plr_id", "geography_version"])
    slices = raw.select("source_sha256").distinct()
    return Refreshed(table, _replaced(rejected, _stamped(split.rejected), ["source_sha256"],
                                      slices), split.report())


def refresh_cells(topology: DataFrame, vertices: DataFrame, cells: DataFrame | None = None,
                  rejected: DataFrame | None = None) -> Refreshed:
    """Build the triangles of a mesh, upsert them and replace the mesh's quarantine."""
    enforce(side_by_side(
        topology.sparkSession, topology.agg(F.count("*").alias("topology_rows")),
        vertices.agg(F.count("*").alias("vertex_rows"))).withColumn(
        "passed", (F.col("topology_rows") > 0) & (F.col("vertex_rows") > 0)), "mesh")
    split = gates.cell_gate(topology, vertices).stored()
    table = split.accepted if cells is None else upsert(
        cells, split.accepted, ["source_grid_id", "cell_index"])
    slices = topology.select("source_grid_id").distinct()
    return Refreshed(table, _replaced(rejected, _stamped(split.rejected), ["source_grid_id"],
                                      slices), split.report())


def refresh_bridge(zones: DataFrame, cells: DataFrame, bridge: DataFrame | None = None,
                   tile_size: float | None = None) -> Refreshed:
    """Rebuild the bridge of the given version and mesh."""
    enforce(checks.bridge_preconditions(zones, cells), "bridge sides")
    built = cut_lineage(spatial.area_bridge(zones, cells, tile_size))
    key = ["geography_version", "source_grid_id"]
    return Refreshed(_replaced(bridge, built, key, built.select(*key).distinct()), None,
                     checks.bridge_summary(built))


def refresh_mask(zones: DataFrame, cells: DataFrame, bridge: DataFrame,
                 masks: DataFrame | None = None, buffer_m: int | None = None,
                 tile_size: float | None = None) -> Refreshed:
    """Rebuild the mask of the given version, mesh and buffer; count bridge cells outside."""
    buffer_m = checks.mask_buffer_from_env() if buffer_m is None else buffer_m
    enforce(checks.bridge_preconditions(zones, cells), "mask sides")
    built = cut_lineage(spatial.weather_mask(zones, cells, buffer_m, tile_size).withColumn(
        "created_at_utc", F.current_timestamp()))
    key = ["geography_version", "source_grid_id", "mask_buffer_m"]
    cell = ["geography_version", "source_grid_id", "cell_index"]
    used = bridge.select(*cell).distinct().join(
        built.select(*cell[:2]).distinct(), cell[:2], "left_semi")
    summary = side_by_side(
        built.sparkSession, built.agg(F.count("*").alias("mask_cell_count")),
        used.agg(F.count("*").alias("bridge_cell_count")),
        unmatched_keys(used, built, cell).agg(F.count("*").alias("missing_bridge_cell_count")))
    return Refreshed(_replaced(masks, built, key, built.select(*key).distinct()), None, summary)


def publish_exposure(field: DataFrame, bridge: DataFrame, accepted: DataFrame,
                     rejected: DataFrame, path: str | None = None,
                     expected_zones: int = schemas.EXPECTED_ZONE_COUNT) -> Refreshed:
    """Zone weather with population for every forecast in ``field``, checked, then written.

    The fields of the bridge cells, the zone weather and the result are kept in the shared folder
    between the checks and the write, so the fields are joined to the cells once and the zones to
    the population once.
    """
    kept = cut_lineage(weather.restrict_to_cells(field, bridge))
    enforce(weather.bridge_coverage(field, bridge, kept), "bridge cells")
    enforce(weather.field_identity_audit(kept), "fields of the bridge cells")
    zone_weather = cut_lineage(weather.plr_weather(field, bridge, kept=kept))
    final = cut_lineage(weather.plr_weather_population(zone_weather, accepted, rejected))
    enforce(explained_audit(zone_weather, accepted, rejected, "plr_id"), "population keys")
    enforce(checks.coverage_check(final, expected_zones), "zone coverage")
    enforce(checks.exceptions_check(final, rejected), "population exceptions")
    if path is not None:
        write_partitions(final, path)
    return Refreshed(final, None, weather.partition_summary(final))
