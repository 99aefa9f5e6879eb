"""Registered queries over stored tables: every refresh job run twice, and what it left alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridcensus.functions import geom
from gridcensus.plans import lenses
from gridcensus.plans.catalogue import Query, _longs
from gridcensus.plans.stored_refresh import Store
from gridcensus.session import cut_lineage, stored_path
from gridcensus.sources import stored

QUERIES: dict[str, Query] = {}
LATER = "2024-01-01"


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _store(spark: SparkSession) -> Store:
    return Store(spark, stored_path(spark))


def _slice(name: str) -> Column:
    return F.regexp_extract("file_path", f"{name}=([^/]+)", 1)


def _kept(before: DataFrame, after: DataFrame, label: Column) -> DataFrame:
    """label and whether all files that it had are still there as they were."""
    return stored.kept_files(before, after).groupBy(label.alias("label")).agg(
        F.min("kept").alias("kept"))


def _files(store: Store, name: str) -> DataFrame:
    return cut_lineage(store.files(name))


@query
def stored_population(spark, sf_dir):
    """Two snapshots; the later one comes again with a third of its rows."""
    store, raw = _store(spark), lenses.raw_population(spark, sf_dir)
    store.population(raw.withColumn("reference_code_source", F.lit("202412")), None)
    store.population(raw, None)
    before = _files(store, "population")
    store.population(raw.where(F.col("source_row_id") % 3 == 0), None)
    kept = _kept(before, store.files("population"), _slice("reference_date"))
    halves = store.read("population").select(F.lit("accepted").alias("half"), "reference_date",
                                             "population_65plus").unionByName(
        store.read("population_rejected").select(F.lit("rejected").alias("half"), "reference_date",
                                                 "population_65plus"))
    counted = halves.groupBy("half", F.col("reference_date").cast("string").alias("label")).agg(
        F.count("*").alias("row_count"), F.sum("population_65plus").alias("residents"))
    return counted.join(kept, "label").select("half", "label", "row_count", "residents", "kept")


@query
def stored_zones(spark, sf_dir):
    """A zone source, then another that moves or adds a few zones; other buckets stay."""
    store = _store(spark)
    raw = cut_lineage(lenses.raw_zones(spark, sf_dir))
    store.zones(raw)
    before = _files(store, "zones")
    x, y = lenses._square("source_row_id")
    moved = raw.where("source_row_id % 400 = 10").withColumns({
        "plr_id_source": lenses.plr_id(F.col("source_row_id")), "srid": F.lit(25833),
        "geometry_type": F.lit("MULTIPOLYGON"), "geography_version": F.lit(lenses.VERSION),
        "geometry": geom.promote(geom.polygon(geom.rectangle(x, y, x + 100, y + 100))),
        "source_sha256": F.lit("c" * 64)})
    store.zones(moved)
    touched = moved.select(F.col("plr_id_source").alias("plr_id"), "geography_version").select(
        stored.bucket_of(["plr_id", "geography_version"], store.buckets).alias("b"),
        F.lit(True).alias("_hit")).distinct()
    files = stored.kept_files(before, store.files("zones")).withColumn(
        "b", _slice("bucket").cast("int")).join(touched, "b", "left").agg(
        F.count_if(F.col("kept") & F.col("_hit").isNotNull()).alias("kept_of_updated"),
        F.count_if(~F.col("kept") & F.col("_hit").isNull()).alias("lost_of_others"))
    zones = store.read("zones").agg(F.count("*").alias("zone_count"), F.round(F.sum(
        geom.area("geometry")), 1).alias("area_m2"))
    rejected = store.read("zones_rejected").agg(F.count("*").alias("rejected_count"))
    return zones.join(rejected).join(files)


@query
def stored_cells(spark, sf_dir):
    """A mesh, then a few of its cells again: their rows and the mesh's quarantine change."""
    store = _store(spark)
    topology, vertices = (cut_lineage(df) for df in lenses.mesh(spark, sf_dir))
    store.cells(topology, vertices)
    before = _files(store, "cells")
    some = topology.where("cell_index % 400 IN (2, 24)")
    store.cells(some, vertices)
    touched = some.select(stored.bucket_of(["source_grid_id", "cell_index"], store.buckets).alias(
        "b"), F.lit(True).alias("_hit")).distinct()
    lost = stored.kept_files(before, store.files("cells")).withColumn(
        "b", _slice("bucket").cast("int")).join(touched, "b", "left").agg(
        F.count_if(~F.col("kept") & F.col("_hit").isNull()).alias("lost_of_others"))
    cells = store.read("cells").agg(F.count("*").alias("cell_count"), F.sum(
        F.round("icon_cell_area_m2")).cast("bigint").alias("area_m2"))
    rejected = store.read("cells_rejected").agg(F.count("*").alias("rejected_count"))
    return cells.join(rejected).join(lost)


def _geography(spark: SparkSession, sf_dir: str) -> Store:
    """A store with the zones of two versions, every second one in the later, and the cells."""
    store = _store(spark)
    first = lenses.zones(spark, sf_dir)
    later = first.where(F.col("plr_id").cast("bigint") % 2 == 0).withColumn(
        "geography_version", F.lit(LATER))
    stored.upsert_stored(store.path("zones"), first.unionByName(later),
                         ["plr_id", "geography_version"], store.buckets)
    stored.upsert_stored(store.path("cells"), lenses.cells(spark, sf_dir),
                         ["source_grid_id", "cell_index"], store.buckets)
    return store


@query
def stored_bridge(spark, sf_dir):
    """Bridges of two versions; the later one is built again."""
    store, size = _geography(spark, sf_dir), float(lenses.CELL_M)
    for version in (lenses.VERSION, LATER):
        store.bridge(version, lenses.GRID, size)
    before = _files(store, "bridge")
    store.bridge(LATER, lenses.GRID, size)
    kept = _kept(before, store.files("bridge"), _slice("geography_version"))
    counted = store.read("bridge").groupBy(F.col("geography_version").cast("string").alias("label")).agg(
        F.count("*").alias("row_count"), F.count_distinct("plr_id").alias("zone_count"),
        F.round(F.sum("intersection_area_m2"), 1).alias("area_m2"))
    return counted.join(kept, "label")


@query
def stored_mask(spark, sf_dir):
    """Masks of two buffers; the narrow one is built again."""
    store, size = _geography(spark, sf_dir), float(lenses.CELL_M)
    store.bridge(lenses.VERSION, lenses.GRID, size)
    for buffer_m in (5000, 2000):
        store.mask(lenses.VERSION, lenses.GRID, buffer_m, size)
    before = _files(store, "mask")
    store.mask(lenses.VERSION, lenses.GRID, 2000, size)
    kept = _kept(before, store.files("mask"), _slice("mask_buffer_m"))
    counted = store.read("mask").groupBy(F.col("mask_buffer_m").cast("string").alias("label")).agg(
        F.count("*").alias("row_count"), F.sum("cell_index").alias("index_sum"))
    return _longs(counted.join(kept, "label"))


@query
def stored_exposure(spark, sf_dir):
    """Exposure of every forecast; the newest one is published again from warmer fields."""
    store, field = _store(spark), lenses.field(spark, sf_dir)
    store.population(lenses.raw_population(spark, sf_dir), None)
    stored.publish(lenses.event_bridge(spark, sf_dir), store.path("bridge"),
                   ["geography_version", "source_grid_id"])
    zones = lenses.table(spark, sf_dir, "customer").count()
    field = cut_lineage(field)
    store.exposure(field, lenses.VERSION, lenses.GRID, zones)
    before = _files(store, "exposure")
    newest = field.where(F.col("run_time_utc") == field.agg(F.max("run_time_utc")).scalar())
    store.exposure(newest.withColumn("source_value", F.col("source_value") + F.when(
        F.col("indicator") == "T_2M", 1).otherwise(0)), lenses.VERSION, lenses.GRID, zones)
    kept = _kept(before, store.files("exposure"), _slice("run_label"))
    counted = store.read("exposure").groupBy(F.col("run_label").cast("string").alias("label")).agg(
        F.count("*").alias("row_count"), F.count("temperature_c").alias("temperature_count"),
        F.round(F.sum("temperature_c"), 4).alias("temperature_sum"),
        F.count("population_total").alias("population_count"))
    return counted.join(kept, "label")
