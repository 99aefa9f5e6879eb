"""The refresh jobs over stored tables: each replaces its slice, or the buckets it updates.

A job checks its preconditions, computes the slice alone (never the rest of the table), and
publishes it through ``sources.stored``: staged, checked as written, then moved into place.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridcensus import schemas
from gridcensus.operators import checks
from gridcensus.operators.verdict import CheckFailed, with_verdict
from gridcensus.plans import refresh
from gridcensus.sources import stored
from gridcensus.sources.tables import PARTITION_COLUMNS
from gridcensus.operators.weather import with_partition_labels

BUCKETS = 64


def _unique(keys):
    """Check of a publication: no key repeats in the written rows."""
    def check(rows: DataFrame) -> DataFrame:
        counted = rows.groupBy(*keys).agg(F.count("*").alias("n"))
        return with_verdict(counted.agg(F.count_if(F.col("n") > 1).alias("repeated_keys")),
                            F.col("repeated_keys") == 0)
    return check


@dataclass(frozen=True)
class Store:
    """The tables of one installation, as folders below ``root``."""

    spark: SparkSession
    root: str
    buckets: int = BUCKETS

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def read(self, name: str) -> DataFrame:
        table = stored.read_stored(self.spark, self.path(name))
        if table is None:
            raise CheckFailed(f"the stored table {name} is empty")
        return table

    def files(self, name: str) -> DataFrame:
        return stored.stored_files(self.spark, self.path(name))

    def _publish(self, df, name, by, check=None, slices=None):
        return stored.publish(df, self.path(name), by, check, slices)

    def population(self, raw: DataFrame,
                   expected_rows: int | None = schemas.EXPECTED_ZONE_COUNT) -> DataFrame:
        """Both halves of a snapshot's reference date."""
        done = refresh.refresh_population(raw, expected_rows=expected_rows)
        dates = done.table.select("reference_date").unionByName(
            done.rejected.select("reference_date")).distinct()
        by = ["reference_date"]
        self._publish(done.table, "population", by, _unique(["reference_date", "plr_id"]), dates)
        self._publish(done.rejected, "population_rejected", by, None, dates)
        return done.summary

    def zones(self, raw: DataFrame) -> DataFrame:
        """Upsert of the zones, and the source's quarantine."""
        done = refresh.refresh_zones(raw)
        keys = ["plr_id", "geography_version"]
        stored.upsert_stored(self.path("zones"), done.table, keys, self.buckets,
                             check=_unique(keys))
        self._publish(done.rejected, "zones_rejected", ["source_sha256"], None,
                      raw.select("source_sha256"))
        return done.summary

    def cells(self, topology: DataFrame, vertices: DataFrame) -> DataFrame:
        """Upsert of a mesh's triangles, and its quarantine."""
        done = refresh.refresh_cells(topology, vertices)
        keys = ["source_grid_id", "cell_index"]
        stored.upsert_stored(self.path("cells"), done.table, keys, self.buckets,
                             check=_unique(keys))
        self._publish(done.rejected, "cells_rejected", ["source_grid_id"], None,
                      topology.select("source_grid_id"))
        return done.summary

    def bridge(self, geography_version: str, source_grid_id: str,
               tile_size: float | None = None) -> DataFrame:
        """The bridge of one version and mesh."""
        zones = self.read("zones").where(F.col("geography_version") == geography_version)
        cells = self.read("cells").where(F.col("source_grid_id") == source_grid_id)
        done = refresh.refresh_bridge(zones, cells, tile_size=tile_size)
        count = zones.agg(F.count("*")).first()[0]
        self._publish(done.table, "bridge", ["geography_version", "source_grid_id"],
                      lambda rows: checks.bridge_contract(rows, count))
        return done.summary

    def mask(self, geography_version: str, source_grid_id: str, buffer_m: int,
             tile_size: float | None = None) -> DataFrame:
        """The mask of one version, mesh and buffer."""
        zones = self.read("zones").where(F.col("geography_version") == geography_version)
        cells = self.read("cells").where(F.col("source_grid_id") == source_grid_id)
        done = refresh.refresh_mask(zones, cells, self.read("bridge"), None, buffer_m, tile_size)
        by = ["geography_version", "source_grid_id", "mask_buffer_m"]
        self._publish(done.table, "mask", by, _unique([*by, "cell_index"]))
        return done.summary

    def exposure(self, field: DataFrame, geography_version: str, source_grid_id: str,
                 expected_zones: int = schemas.EXPECTED_ZONE_COUNT) -> DataFrame:
        """The exposure partitions of the forecasts in ``field``."""
        bridge = self.read("bridge").where(
            (F.col("geography_version") == geography_version)
            & (F.col("source_grid_id") == source_grid_id))
        newest = F.col("reference_date") == self.read("population").agg(
            F.max("reference_date")).scalar()
        done = refresh.publish_exposure(
            field, bridge, self.read("population").where(newest),
            self.read("population_rejected").where(newest), None, expected_zones)
        self._publish(with_partition_labels(done.table), "exposure", list(PARTITION_COLUMNS),
                      lambda rows: checks.coverage_check(rows, expected_zones))
        return done.summary
