"""Registered queries over stored files, written and read back, and over the table contracts.

Sources are put into their file formats from whole given tables first, so that what is read has
passed through the format; contracts are judged on tables that hold every violation they name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridcensus import schemas
from gridcensus.functions import geom, projection, text
from gridcensus.operators import (checks, gates, joins, profiles, readiness, report, spatial,
                                  weather)
from gridcensus.operators.verdict import offenders, side_by_side
from gridcensus.plans import lenses
from gridcensus.plans.catalogue import Query, _coerced, _final, _longs, _rounded
from gridcensus.session import cut_lineage, stored_path
from gridcensus.sources import manifests, mesh, population, stored, tables, zones
from gridcensus.sources.functions import table_function
from gridcensus.streaming import completion

QUERIES: dict[str, Query] = {}
#: Zones of a document, all nations taken together, before a nation gets a further one.
DOCUMENT_ZONES = 100_000


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _reasons(df: DataFrame, column: str = "rejection_reasons") -> DataFrame:
    """The reason map as text in the order of its keys."""
    entries = F.array_sort(F.map_entries(column))
    return df.withColumn(column, F.array_join(F.transform(
        entries, lambda e: F.concat(e.key, F.lit("="), e.value.cast("string"))), ","))


# Sources

@query
def population_source(spark, sf_dir):
    """A delimited snapshot with a byte-order mark, read back as text and stamped."""
    raw = lenses.raw_population(spark, sf_dir).select(
        F.col("plr_id_source").alias("﻿RAUMID"), F.col("population_total_source").alias("E_E"),
        F.col("population_65_79_source").alias("E_E65U80"),
        F.col("population_80plus_source").alias("E_E80U110"),
        F.col("reference_code_source").alias("ZEIT"), F.lit("unused").alias("OTHER"))
    path = stored_path(spark)
    raw.write.option("sep", ";").option("header", True).csv(path)
    stamped = population.raw_population(population.read_population(spark, path), "a" * 64, "p.csv",
                                        "2026-04-02")
    return stamped.drop("loaded_at_utc")


def _coordinates(geometry: str) -> Column:
    return F.transform(geometry, lambda poly: F.transform(
        poly, lambda ring: F.transform(ring, lambda p: F.array(p.x, p.y))))


@query
def zone_source(spark, sf_dir):
    """Zone features, one per line, as Polygon, MultiPolygon or a type that is no area."""
    key = F.col("c_custkey")
    kind = (F.when(key % 19 == 7, "Point").when(key % 2 == 0, "Polygon")
            .otherwise("MultiPolygon"))
    parts = _coordinates("geometry")
    nested = F.when(kind == "Polygon", F.to_json(parts[0])).when(
        kind == "MultiPolygon", F.to_json(parts)).otherwise("[1.0,2.0]")
    name = F.when(key % 19 == 1, "  ").otherwise(lenses.plr_id(key))
    line = F.concat(
        F.lit('{"type":"Feature","properties":{"OTHER":"x","PLR_ID":"'), name,
        F.lit('"},"geometry":{"type":"'), kind, F.lit('","coordinates":'), nested, F.lit("}}"))
    path = stored_path(spark)
    (lenses.table(spark, sf_dir, "customer")
     .select("c_custkey", lenses.zone_polygon().alias("geometry"))
     .select(line.alias("value")).write.text(path))
    read = zones.with_extent(zones.read_zones(spark, path, lenses.VERSION, "b" * 64,
                                              "2023-01-01", line_delimited=True))
    rings = F.flatten("geometry")
    corner = F.concat(F.lit("POINT("), text.fixed(F.col("box.minx"), 0), F.lit(" "),
                      text.fixed(F.col("box.miny"), 0), F.lit(")"))
    return _longs(read.groupBy(
        "plr_id_source", "geometry_type", "srid", "source_crs", "geography_version",
        "reference_date", F.size("geometry").alias("part_count"), F.size(rings).alias("ring_count"),
        F.when(F.col("geometry").isNotNull(), text.ewkt(F.col("srid"), corner))
        .alias("lower_corner")).agg(F.count("*").alias("feature_count"), F.sum(
            F.size(F.flatten(rings))).alias("point_count")))


@query
def mesh_source(spark, sf_dir):
    """Coordinate arrays in radians or degrees to vertices; lengths of the two axes."""
    value = F.transform("embedding", lambda v: v.cast("double"))
    scale = F.when(F.col("vec_id") % 2 == 0, 1.0).otherwise(100.0)
    half = F.transform(value, lambda v: v * scale / 2)
    arrays = lenses.table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("source_grid_id"),
        F.transform(value, lambda v: v * scale).alias("longitude"),
        F.when(F.col("vec_id") % 7 == 0, F.slice(half, 1, F.greatest(F.size(half) - 1, F.lit(0))))
        .otherwise(half).alias("latitude"))
    vertices = mesh.vertex_rows(arrays).groupBy("source_grid_id").agg(
        F.count("*").alias("vertex_count"), F.count("latitude_deg").alias("latitude_rows"),
        F.round(F.sum("longitude_deg"), 6).alias("longitude_sum"),
        F.round(F.min("latitude_deg"), 6).alias("min_latitude"),
        F.round(F.max("latitude_deg"), 6).alias("max_latitude"))
    return _longs(mesh.mesh_lengths(arrays).join(vertices, "source_grid_id"))


@query
def mesh_topology(spark, sf_dir):
    """Index matrices by row or by corner, counted from zero or one, per grid with verdict."""
    grids = lenses.table(spark, sf_dir, "embeddings").select(
        F.concat(F.lit("E"), F.col("vec_id").cast("string")).alias("source_grid_id"),
        F.explode(F.sequence(F.lit(0), F.lit(2))).alias("row"), "vec_id", "embedding").select(
        "source_grid_id", "row", F.transform("embedding", lambda _, i: (
            i + F.col("row") + F.col("vec_id") % 3).cast("bigint")).alias("indexes"))
    base = F.pmod(F.col("c_custkey") * 7, F.lit(10)) + F.col("c_nationkey") % 3
    cells = lenses.table(spark, sf_dir, "customer").select(
        F.concat(F.lit("C"), F.col("c_nationkey").cast("string")).alias("source_grid_id"),
        F.col("c_custkey").cast("int").alias("row"),
        F.array(*[(base + j).cast("bigint") for j in range(3)]).alias("indexes"))
    topology, verdict = mesh.topology_rows(grids.unionByName(cells), 66)
    known = lenses.table(spark, sf_dir, "embeddings").select(
        F.concat(F.lit("E"), F.col("vec_id").cast("string")).alias("source_grid_id"),
        F.posexplode("embedding").alias("vertex_index", "_v")).drop("_v")
    dangling = mesh.dangling_corners(topology, known).groupBy("source_grid_id").agg(
        F.sum("row_count").alias("dangling_count"))
    sums = topology.groupBy("source_grid_id").agg(
        F.count("*").alias("corner_count"), F.sum("cell_index").alias("cell_sum"),
        F.sum("vertex_order").alias("order_sum"), F.sum("vertex_index").alias("vertex_sum"))
    return _longs(verdict.join(sums, "source_grid_id").join(dangling, "source_grid_id", "left")
                  .fillna(0, ["dangling_count"]))


@query
def incomplete_forecasts(spark, sf_dir):
    """Zone weather where the first run lacks an indicator and the last one a cell of it."""
    field = lenses.field(spark, sf_dir)
    runs = lenses.field_forecasts(spark, sf_dir).agg(
        F.min("run_time_utc").alias("a"), F.max("run_time_utc").alias("b"))
    run, kind = F.col("run_time_utc"), F.col("indicator")
    lost = ((run == runs.select("a").scalar()) & (kind == "V_10M")) | (
        (run == runs.select("b").scalar()) & (kind == "T_2M") & (F.col("cell_index") % 50 == 3))
    out = weather.plr_weather(field.filter(~lost), lenses.event_bridge(spark, sf_dir))
    return _rounded(out.drop("geography_version"), schemas.WEATHER_VALUES)


# Stored tables

@query
def partition_store(spark, sf_dir):
    """Fields stored by forecast; the newest run is written again, two leads are read."""
    path = stored_path(spark)
    tables.write_partitions(lenses.sparse_field(spark, sf_dir), path)
    newest = tables.latest_label(tables.read_partitions(spark, path))
    tables.write_partitions(cut_lineage(newest.withColumn(
        "source_value", F.col("source_value") * 2)), path)
    read = tables.read_partitions(spark, path, lead_labels=["PT000H00M", "PT006H00M"])
    return read.groupBy("run_label", "lead_label").agg(
        F.count("*").alias("row_count"), F.round(F.sum("source_value"), 4).alias("value_sum"),
        F.max("valid_time_utc").alias("valid_time_utc"))


@query
def snapshot_reload(spark, sf_dir):
    """A source hash loaded again replaces its rows; the load counts what it wrote."""
    orders = lenses.table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_totalprice", F.sha2("o_orderpriority", 256).alias("source_sha256"))
    again = orders.filter(F.col("source_sha256") == F.sha2(F.lit("1-URGENT"), 256)).withColumn(
        "o_totalprice", F.round(F.col("o_totalprice") * 2, 2))
    path = stored_path(spark)
    written = tables.load_rows(tables.reload_snapshot(orders, again),
                               ["source_sha256", "o_orderkey", "o_totalprice"], path)
    return spark.read.parquet(path).groupBy("source_sha256").agg(
        F.count("*").alias("order_count"), F.round(F.sum("o_totalprice"), 2).alias("price_sum"),
        F.lit(written).cast("bigint").alias("written_rows"))


@query
def column_upsert(spark, sf_dir):
    """The newest order changes a customer's balance and leaves the name; new keys come in."""
    customers = lenses.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("key"), F.col("c_acctbal").alias("amount"),
        F.col("c_name").alias("name"))
    fresh = lenses.table(spark, sf_dir, "orders").filter("o_orderstatus = 'F'").groupBy(
        (F.col("o_custkey") * 2).alias("key")).agg(F.max("o_totalprice").alias("amount"))
    return tables.upsert_columns(customers, fresh, ["key"], ["amount"])


@query
def summary_lines(spark, sf_dir):
    """One JSON line per nation with report text in it, written and read back."""
    nations = lenses.table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(
        F.count("*").alias("customers"),
        F.sum(F.floor("c_acctbal").cast("bigint")).alias("balance"),
        F.min("c_acctbal").alias("lowest"),
        F.avg(F.when(F.col("c_acctbal") < 0, 1.0).otherwise(0.0)).alias("share"))
    lines = nations.select(
        F.col("c_nationkey").cast("bigint").alias("nation"), "customers",
        text.thousands(F.col("balance")).alias("balance"),
        text.fixed(F.col("lowest"), 2).alias("lowest"),
        text.percent(F.when(F.col("c_nationkey") % 5 != 0, F.col("share")), 8).alias("share"))
    path = stored_path(spark)
    tables.write_summary(lines, path)
    return spark.read.text(path).select(F.col("value").alias("line"))


@query
def mandatory_columns(spark, sf_dir):
    """May the population columns become mandatory, or are there rows without them?"""
    raw = lenses.raw_population(spark, sf_dir)
    sides = {c: raw.select(F.col(c).alias("provenance")) for c in (
        "plr_id_source", "population_total_source", "population_65_79_source",
        "population_80plus_source")}
    return checks.evolution_guard(sides, "provenance")


@query
def additive_columns(spark, sf_dir):
    """Rows of two generations of a table under the columns of both."""
    old = lenses.table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    new = lenses.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("amount"))
    return checks.add_missing_columns(old, new)


# Contracts

@query
def zone_contract(spark, sf_dir):
    """Counts, reasons and soundness of the zone gate's halves, some zones spoiled afterwards."""
    raw = lenses.raw_zones(spark, sf_dir)
    split = gates.zone_gate(raw).stored()
    key = F.col("plr_id").try_cast("bigint")
    spoiled = split.accepted.withColumns({
        "geometry": F.when(key % 29 == 0, F.slice("geometry", 1, 0)).otherwise(F.col("geometry")),
        "srid": F.when(key % 31 == 0, 4326).otherwise(25833)})
    total = lenses.table(spark, sf_dir, "customer").agg(F.count("*")).scalar()
    return _longs(_reasons(checks.zone_check(raw, spoiled, split.rejected, total, "srid")))


@query
def cell_contract(spark, sf_dir):
    """Counts, reasons and soundness of the cell gate's halves, some cells spoiled afterwards."""
    topology, vertices = lenses.mesh(spark, sf_dir)
    split = gates.cell_gate(topology, vertices).stored()
    key = F.col("cell_index")
    square = geom.promote(geom.polygon(geom.rectangle(*[F.lit(float(v)) for v in (0, 0, 1, 1)])))
    spoiled = split.accepted.withColumns({
        "geometry": F.when(key % 29 == 0, F.slice("geometry", 1, 0))
        .when(key % 29 == 5, square).otherwise(F.col("geometry")),
        "srid": F.when(key % 31 == 0, 4326).otherwise(25833)})
    part = lenses.table(spark, sf_dir, "part").agg(F.count("*")).scalar()
    return _longs(_reasons(checks.cell_check(
        vertices, topology, spoiled, split.rejected, part, part, "srid")))


@query
def bridge_contract(spark, sf_dir):
    """A bridge with empty keys, infinite areas, bad fractions and repeated pairs."""
    bridge = lenses.event_bridge(spark, sf_dir)
    d = F.col("plr_id").cast("bigint") % 13
    broken = bridge.withColumns({
        "cell_index": F.when(d != 1, F.col("cell_index")),
        "intersection_area_m2": F.when(d == 2, float("inf")).when(d == 3, F.lit(None)).otherwise(
            F.col("intersection_area_m2")),
        "plr_area_m2": F.when(d == 4, -1.0).otherwise(F.col("plr_area_m2")),
        "fraction_of_plr": F.when(d == 5, 1.5).otherwise(F.col("fraction_of_plr"))})
    doubled = broken.filter(d == 6)
    zones_expected = lenses.table(spark, sf_dir, "customer").agg(F.count("*")).scalar()
    verdict = checks.bridge_contract(broken.unionByName(doubled), zones_expected)
    return _rounded(_longs(verdict), ("max_weight_error",))


@query
def bridge_distribution(spark, sf_dir):
    """Distributions over bridge rows and over the rollup per zone."""
    shown = profiles.bridge_description(lenses.event_bridge(spark, sf_dir))
    return _rounded(shown, [c for c, t in shown.dtypes if t == "double"], 4)


@query
def population_distribution(spark, sf_dir):
    """Distributions of the coerced counts."""
    shown = profiles.population_description(_coerced(spark, sf_dir))
    return _rounded(shown, [c for c, t in shown.dtypes if t == "double"], 4)


@query
def incomplete_population(spark, sf_dir):
    """Zones whose count of the old is unknown, with the parts that are known."""
    return profiles.incomplete_population(_coerced(spark, sf_dir))


@query
def zone_profile(spark, sf_dir):
    """Feature, id and geometry counters of the raw layer."""
    return _longs(profiles.zone_profile(lenses.raw_zones(spark, sf_dir)))


@query
def zone_types(spark, sf_dir):
    """Features per geometry type."""
    return profiles.geometry_types(lenses.raw_zones(spark, sf_dir))


@query
def union_share(spark, sf_dir):
    """Triangle centres within the zones, and their share of the grid."""
    cells = lenses.rounded_centres(lenses.cells(spark, sf_dir), ["cell_index"])
    inside = spatial.points_in_union(cells, lenses.zones(spark, sf_dir), ["cell_index"],
                                     float(lenses.ZONE_M))
    return _rounded(_longs(profiles.union_share(inside, cells)), ("grid_share",))


# Joins and exposure

@query
def checked_lookup(spark, sf_dir):
    """Order lines with their order, whose keys must not repeat."""
    orders = lenses.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    lines = lenses.table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_quantity")
    joined = joins.checked_join(lines, orders, ["o_orderkey"], "left", "many_to_one")
    return joined.groupBy("o_orderpriority").agg(
        F.count("*").alias("line_count"), F.round(F.sum("l_quantity"), 2).alias("quantity"))


@query
def expected_counts(spark, sf_dir):
    """Every nation with its suppliers in credit, zero where there are none."""
    expected = lenses.table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("bigint").alias("nation"))
    seen = lenses.table(spark, sf_dir, "supplier").filter("s_acctbal > 6000").groupBy(
        F.col("s_nationkey").cast("bigint").alias("nation")).agg(
        F.count("*").alias("supplier_count"))
    return joins.with_expected(expected, seen, ["nation"], {"supplier_count": 0})


@query
def label_offenders(spark, sf_dir):
    """The first ten field rows with a foreign unit, valid times computed anew."""
    wrong = weather.with_valid_time(lenses.sparse_field(spark, sf_dir).drop("valid_time_utc")
                                    .filter(F.col("source_unit") != "unit"))
    order = ["run_time_utc", "lead_time", "indicator", "cell_index"]
    return _longs(offenders(wrong, order).select(*order, "valid_time_utc"))


@query
def uncovered_bridge_cells(spark, sf_dir):
    """The first bridge cells that the newest forecasts lack."""
    field = lenses.sparse_field(spark, sf_dir).filter(F.col("indicator") == "T_2M").filter(
        F.col("source_value") > 90)
    return _longs(weather.missing_bridge_cells(field, lenses.event_bridge(spark, sf_dir)))


@query
def temperature_audit(spark, sf_dir):
    """Per forecast: bridge cells repeated or lacking, values missing, weights not whole."""
    t = lenses.sparse_field(spark, sf_dir).filter(F.col("indicator") == "T_2M").select(
        "run_time_utc", "lead_time", "valid_time_utc", "cell_index",
        F.when(F.col("cell_index") % 11 != 0, F.col("source_value")).alias("temperature_c"),
        F.col("source_value").alias("temperature_k"))
    t = t.unionByName(t.filter(F.col("cell_index") % 10 == 0))
    return _longs(weather.temperature_audit(t, lenses.event_bridge(spark, sf_dir)))


@query
def current_mask(spark, sf_dir):
    """Mask rows of the newest geography version at one buffer."""
    key = F.col("p_partkey")
    masks = lenses.table(spark, sf_dir, "part").select(
        F.when(key % 3 == 0, "2021-01-01").otherwise("2023-01-01").alias("geography_version"),
        F.lit(lenses.GRID).alias("source_grid_id"),
        F.when(key % 5 == 0, 3000).otherwise(5000).alias("mask_buffer_m"),
        key.cast("bigint").alias("cell_index"))
    dated = lenses.table(spark, sf_dir, "customer").select(
        F.when(F.col("c_custkey") % 2 == 0, "2021-01-01").otherwise("2023-01-01")
        .alias("geography_version"),
        F.when(F.col("c_custkey") % 2 == 0, "2021-01-01").otherwise("2023-01-01").cast("date")
        .alias("reference_date"))
    return _longs(checks.current_mask(masks, dated, 5000))


@query
def exposure_header(spark, sf_dir):
    """Counts and the one forecast identity of the current exposure."""
    return _longs(report.report_header(_final(spark, sf_dir, newest=True)))


@query
def exposure_exceptions(spark, sf_dir):
    """Zones of the current exposure without population, and why."""
    return report.exceptions(_final(spark, sf_dir, newest=True))


@query
def exposure_table(spark, sf_dir):
    """The ranking of the current exposure as report text."""
    current = _final(spark, sf_dir, newest=True)
    rounded = current.withColumn("temperature_c", F.round("temperature_c", 6))
    return _longs(report.formatted(report.hottest_zones(rounded)))


@query
def seeded_exposure_checks(spark, sf_dir):
    """The checks of the final table on one with lost zones, wrong states and shifted labels."""
    split = gates.population_gate(lenses.raw_population(spark, sf_dir)).stored()
    sound = cut_lineage(_final(spark, sf_dir, newest=True))
    d = F.col("plr_id").cast("bigint") % 29
    status = F.col("population_status")
    seeded = cut_lineage(sound.filter(d != 1).withColumns({
        "population_status": F.when(d == 2, "unknown").otherwise(status),
        "population_rejection_reason": F.when(
            d != 3, F.col("population_rejection_reason")),
        "population_total": F.when(d == 4, 1).when(d == 5, F.lit(None)).otherwise(
            F.col("population_total"))}))
    total = lenses.table(spark, sf_dir, "customer").agg(F.count("*")).scalar()
    coverage = checks.coverage_check(seeded, total).select(
        F.col("passed").alias("coverage_passed"), "row_count", "missing_plr_ids")
    exceptions = checks.exceptions_check(seeded, split.rejected)
    shifted = weather.with_partition_labels(seeded).withColumn("run_label", F.when(
        d == 6, "19700101T0000").otherwise(F.col("run_label")))
    identity = checks.identity_check(shifted)
    audit = joins.explained_audit(
        seeded, split.accepted.filter(d != 7), split.rejected.filter(d != 8), "plr_id").select(
        F.col("passed").alias("explained_passed"), "unmatched_key_count",
        "unexplained_key_count", "unused_registry_key_count")
    judged = identity.agg(F.min("passed").alias("identity_passed"),
                          F.count("*").alias("identity_groups"))
    return _longs(side_by_side(spark, coverage, exceptions, audit, judged))


# Stored tables with seeded faults

def _seeded_bridge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two versions of the bridge: zones left out, halved, of unknown id, on unknown cells."""
    d = F.col("plr_id").cast("bigint") % 13
    one = lenses.event_bridge(spark, sf_dir)
    old = one.withColumn("geography_version", F.lit("2021-01-01"))
    seeded = one.filter(d != 1).withColumns({
        "fraction_of_plr": F.when(d == 2, F.col("fraction_of_plr") / 2).when(
            d == 3, -0.5).otherwise(F.col("fraction_of_plr")),
        "plr_id": F.when(d == 4, F.concat(F.lit("X"), F.col("plr_id"))).otherwise(F.col("plr_id")),
        "cell_index": F.when(d == 5, F.col("cell_index") + 1000000000).otherwise(
            F.col("cell_index")),
        "intersection_area_m2": F.when(d == 6, 0.0).otherwise(F.col("intersection_area_m2"))})
    return seeded.unionByName(old)


def _grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every cell of the event mesh as a parallel range."""
    top = lenses.table(spark, sf_dir, "events").agg(F.max("user_id")).first()[0]
    return spark.range(0 if top is None else top + 1).select(
        F.lit(lenses.GRID).alias("source_grid_id"), F.col("id").cast("int").alias("cell_index"))


def _versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = lenses.table(spark, sf_dir, "customer").select(
        lenses.plr_id(F.col("c_custkey")).alias("plr_id"))
    return ids.withColumn("geography_version", F.explode(F.array(
        F.lit(lenses.VERSION), F.lit("2021-01-01"))))


@query
def seeded_bridge_check(spark, sf_dir):
    """Each stored version of a bridge judged alone: the sound one and the one with faults."""
    bridge = cut_lineage(_seeded_bridge(spark, sf_dir))
    zones_of, cells = _versions(spark, sf_dir), _grid(spark, sf_dir)
    total = lenses.table(spark, sf_dir, "customer").agg(F.count("*")).scalar()
    judged = [checks.bridge_check(checks.only(bridge, geography_version=v),
                                  checks.only(zones_of, geography_version=v), cells, total)
              .withColumn("geography_version", F.lit(v)) for v in ("2021-01-01", lenses.VERSION)]
    return _rounded(_longs(judged[0].unionByName(judged[1])), ("max_plr_weight_error",))


@query
def seeded_mask_check(spark, sf_dir):
    """Masks of two buffers judged alone: one lacks bridge cells, both hold unknown ones."""
    bridge = checks.only(lenses.event_bridge(spark, sf_dir), geography_version=lenses.VERSION)
    cells = _grid(spark, sf_dir)
    key = F.col("cell_index")
    wide = cells.withColumn("mask_buffer_m", F.lit(5000))
    narrow = cells.filter(key % 9 != 0).withColumn("mask_buffer_m", F.lit(3000))
    stray = cells.filter(key % 4 == 1).select(
        "source_grid_id", (-1 - key).cast("int").alias("cell_index"),
        F.lit(3000).alias("mask_buffer_m"))
    masks = cut_lineage(wide.unionByName(narrow).unionByName(stray))
    zones_of = checks.only(_versions(spark, sf_dir), geography_version=lenses.VERSION)
    total = lenses.table(spark, sf_dir, "customer").agg(F.count("*")).scalar()
    judged = [checks.mask_check(checks.only(masks, mask_buffer_m=b), bridge, zones_of, cells, total)
              .withColumn("mask_buffer_m", F.lit(b)) for b in (3000, 5000)]
    return _longs(judged[0].unionByName(judged[1]))


@query
def seeded_accounting(spark, sf_dir):
    """Split accounting where rows are in both halves, in neither, or come from nowhere."""
    raw = lenses.raw_population(spark, sf_dir)
    split = gates.population_gate(raw).stored()
    d = F.col("plr_id").cast("bigint") % 23
    accepted = split.accepted.filter(d != 1)
    both = split.accepted.filter(d == 2).select("plr_id")
    nowhere = split.accepted.filter(d == 3).select(F.concat(F.lit("X"), "plr_id").alias("plr_id"))
    refused = split.rejected.select("plr_id").union(both).union(nowhere)
    return _longs(joins.split_accounting(split.classified, accepted, refused, ["plr_id"]))


@query
def sql_functions(spark, sf_dir):
    """Population, bridge and completeness checks asked as table functions in SQL."""
    table_function("population_issues", {"wanted": "STRING"}, gates.classify_population(
        lenses.raw_population(spark, sf_dir)).select("plr_id", "rejection_reason"),
        "t.rejection_reason = wanted")
    rollup = profiles.zone_rollup(lenses.event_bridge(spark, sf_dir)).select(
        "plr_id", "geography_version", "source_grid_id", "icon_cells_used", "weight_sum")
    table_function("bridge_zones", {"version": "STRING", "grid": "STRING", "cells": "BIGINT"}, rollup,
                   "t.geography_version = version AND t.source_grid_id = grid AND "
                   "t.icon_cells_used >= cells")
    verdicts = checks.full_partition_check(
        lenses.sparse_field(spark, sf_dir), lenses.cell_count(spark, sf_dir), ("source_unit",)).select(
        "run_time_utc", "lead_time", "total_row_count", "missing_indicator_count")
    table_function("lacking_forecasts", {"lead": "STRING", "least": "INT"}, verdicts,
                   "t.lead_time = lead AND t.missing_indicator_count >= least")
    return spark.sql(f"""
        SELECT 'population' AS kind, rejection_reason AS label, count(*) AS row_count
        FROM population_issues('zero_population_total') GROUP BY rejection_reason
        UNION ALL SELECT 'population', rejection_reason, count(*)
        FROM population_issues('invalid_population_65plus') GROUP BY rejection_reason
        UNION ALL SELECT 'bridge', CAST(z.icon_cells_used AS STRING), count(*)
        FROM bridge_zones('{lenses.VERSION}', '{lenses.GRID}', 2) AS z GROUP BY z.icon_cells_used
        UNION ALL SELECT 'forecast', lead_time, sum(total_row_count)
        FROM lacking_forecasts('PT002H00M', 0) GROUP BY lead_time
        UNION ALL SELECT 'lacking', lead_time, count(*)
        FROM lacking_forecasts('PT006H00M', 1) GROUP BY lead_time""")


@query
def stream_outcomes(spark, sf_dir):
    """Forecasts that a stream completes, and those given up with what they lack.

    Runs are expected and fields arrive in six files each, some fields twice, some too late.
    """
    n, run = F.col("event_id"), F.date_trunc("day", "ts")
    delay = F.make_interval(hours=F.when(n % 4 == 0, 1).otherwise(30 + n % 40).cast("int"))
    fields = cut_lineage(lenses.table(spark, sf_dir, "events").filter("value > 20").select(
        run.alias("run_time_utc"), lenses._lead(n).alias("lead_time"),
        lenses._indicator().alias("indicator"), (F.col("ts") + delay).cast("timestamp").alias("arrived_at")))
    runs = cut_lineage(readiness.with_leads(fields.select("run_time_utc").distinct()).select(
        "run_time_utc", "lead_time"))
    folders = {}
    for name, df, at in (("runs", runs, "run_time_utc"), ("fields", fields, "arrived_at")):
        folders[name] = stored_path(spark)
        low, high = df.agg(F.min(F.unix_seconds(at)), F.max(F.unix_seconds(at))).first()
        step = ((high or 0) - (low or 0)) // 6 + 1
        for part in range(6):  # files are read in the order they were written
            seconds = F.unix_seconds(at) - F.lit(low or 0)
            df.filter(F.floor(seconds / step) == part).coalesce(1).write.mode("append").parquet(
                folders[name])
    read = lambda name, df: spark.readStream.schema(df.schema).option(
        "maxFilesPerTrigger", 1).parquet(folders[name])
    found = completion.run_outcomes(read("runs", runs), read("fields", fields))
    return found.withColumn("missing_indicators", F.array_join("missing_indicators", ","))


@query
def zone_interiors(spark, sf_dir):
    """Squares whose holes touch the shell or each other: an interior must stay in one piece."""
    x, y = lenses._square("c_custkey")
    at = lambda *spots: geom.closed_ring(*[geom.point(x + a, y + b) for a, b in spots])
    shell = at((0, 0), (900, 0), (900, 900), (0, 900))
    once = at((0, 300), (300, 200), (300, 400))           # touches the left side
    twice = at((0, 300), (450, 200), (900, 300), (450, 400))  # touches both sides
    right = at((300, 300), (900, 300), (600, 400))        # touches the first hole and the right side
    inner = at((300, 300), (500, 250), (500, 350))        # touches the first hole only
    kind = F.col("c_custkey") % 5
    left = at((0, 300), (300, 300), (150, 400))
    shape = (F.when(kind == 0, geom.polygon(shell, once)).when(kind == 1, geom.polygon(shell, twice))
             .when(kind == 2, geom.polygon(shell, left, right))
             .when(kind == 3, geom.polygon(shell, left, inner)).otherwise(geom.polygon(shell)))
    rows = lenses.keyed_rows(spark, sf_dir, "customer", "c_custkey").select(
        "c_custkey", geom.promote(shape).alias("geometry"))
    return spatial.flag_invalid(rows, ["c_custkey"]).select("c_custkey", "is_invalid")


@query
def zone_neighbours(spark, sf_dir):
    """How many other zones share at least a point with a zone."""
    z = spatial.with_box(lenses.zones(spark, sf_dir).select("plr_id", "geometry"))
    met = spatial.candidate_pairs(z, z, float(lenses.ZONE_M)).filter(
        (F.col("plr_id") != F.col("r_plr_id")) & geom.intersects("geometry", "r_geometry"))
    counted = met.groupBy("plr_id").agg(F.count("*").alias("neighbour_count"))
    return z.select("plr_id").join(counted, "plr_id", "left").fillna(0, ["neighbour_count"])


@query
def zone_documents(spark, sf_dir):
    """Zone features as documents per nation, with or without a named reference system.

    A document is one record and one task's work, so a nation with many zones has several, of
    about ``DOCUMENT_ZONES`` zones at most.
    """
    nation = F.col("c_nationkey")
    customers = lenses.table(spark, sf_dir, "customer")
    documents = F.ceil(customers.agg(F.count("*")).scalar() / DOCUMENT_ZONES)
    feature = F.concat(
        F.lit('{"type":"Feature","properties":{"PLR_ID":"'), lenses.plr_id(F.col("c_custkey")),
        F.lit('"},"geometry":{"type":"MultiPolygon","coordinates":'),
        F.to_json(_coordinates("geometry")), F.lit("}}"))
    crs = F.when(nation % 2 == 0, F.lit(
        '"crs":{"type":"name","properties":{"name":"urn:ogc:def:crs:EPSG::25833"}},')).otherwise("")
    path = stored_path(spark)
    (lenses.keyed_rows(spark, sf_dir, "customer", "c_custkey", "c_nationkey")
     .select("c_nationkey", F.pmod(F.xxhash64("c_custkey"), F.greatest(documents, F.lit(1))).alias(
         "document"), "c_custkey", lenses.zone_polygon().alias("geometry"))
     .groupBy("c_nationkey", "document").agg(F.array_join(F.collect_list(feature), ",").alias("f"))
     .select(F.concat(F.lit('{"type":"FeatureCollection",'), crs, F.lit('"features":['), "f",
                      F.lit("]}")).alias("value"), "c_nationkey", "document")
     .repartition("c_nationkey", "document").write.partitionBy("c_nationkey", "document").text(path))
    read = zones.read_zones(spark, path, lenses.VERSION, "b" * 64, "2023-01-01")
    return _longs(read.groupBy("source_crs", "srid", "geometry_type").agg(
        F.count("*").alias("feature_count"), F.count_distinct("plr_id_source").alias("zone_count"),
        F.round(F.sum(geom.area("geometry")), 1).alias("area_m2")))


@query
def lenient_preconditions(spark, sf_dir):
    """What the lenient gate requires of a snapshot, with blank and repeated ids among it."""
    key = F.col("plr_id").cast("bigint")
    frame = _coerced(spark, sf_dir).withColumn("plr_id", F.when(key % 41 == 0, F.lit("7")).when(
        key % 43 != 1, F.col("plr_id")))
    return _longs(gates.lenient_preconditions(gates.lenient_population_gate(frame), None))


@query
def bridge_counters(spark, sf_dir):
    """Sizes, missing values, repeated pairs and largest errors of a bridge with faults."""
    d = F.col("plr_id").cast("bigint") % 13
    bridge = lenses.event_bridge(spark, sf_dir).withColumns({
        "cell_index": F.when(d != 1, F.col("cell_index")),
        "plr_area_m2": F.when(d != 2, F.col("plr_area_m2")),
        "fraction_of_plr": F.when(d == 5, F.col("fraction_of_plr") * 1.5).otherwise(
            F.col("fraction_of_plr"))})
    profile = profiles.bridge_profile(bridge.unionByName(bridge.filter(d == 6)))
    return _rounded(_longs(profile), ("max_weight_error", "max_coverage_error"))


def _as_files(df: DataFrame, value: str, path: str, ending: str) -> None:
    """Column ``value`` of the rows of each ``file``, in the order of doc_id, as file<ending>."""
    spark, staging = df.sparkSession, stored_path(df.sparkSession)
    (df.select("file", "doc_id", F.col(value).alias("value")).repartition("file")
     .sortWithinPartitions("file", "doc_id").select("file", "value")
     .write.partitionBy("file").text(staging))
    root = staging.rsplit("/", 1)[0]
    folder = stored.Folder(spark, root)
    inner, target = staging[len(root) + 1:], path[len(root) + 1:]
    for name in folder.partitions(inner, 1):
        part, = folder.files(f"{inner}/{name}")
        wanted = f"{target}/{name.split('=')[1]}{ending}"
        folder.delete(wanted)
        folder.move(f"{inner}/{name}/{part}", wanted)


@query
def binary_manifest(spark, sf_dir):
    """Files of 500 documents each with sidecars; some change, and only they are hashed again."""
    docs = lenses.table(spark, sf_dir, "documents").select(
        F.floor(F.col("doc_id") / 500).alias("file"), "doc_id", F.coalesce("text", F.lit("")).alias("text"))
    path, sides = stored_path(spark), stored_path(spark)
    _as_files(docs, "text", path, ".bin")
    first = cut_lineage(manifests.incremental_manifest(spark, path, glob="*.bin"))
    identity = {"indicator": F.lit("T_2M"), "lead_time": F.lit("PT000H00M"),
                "run_time_utc": F.lit("2026-08-19").cast("timestamp"),
                "valid_time_utc": F.lit("2026-08-19").cast("timestamp")}
    name = F.regexp_extract("path", r"([^/]+)\.bin$", 1)
    lines = first.withColumns(identity).select(
        name.alias("file"), F.lit(0).alias("doc_id"), F.to_json(F.struct(
            "indicator", "run_time_utc", "lead_time", "valid_time_utc", "sha256", "size_bytes")).alias("line"))
    _as_files(lines, "line", sides, ".bin.json")
    _as_files(docs.filter("file % 5 = 3").withColumn("text", F.concat(F.lit("x"), "text")), "text",
              path, ".bin")
    again = cut_lineage(manifests.incremental_manifest(spark, path, first, "*.bin"))
    judged = manifests.reuse_decision(
        again.withColumns(identity).withColumn("path", name),
        manifests.sidecars_by_path(spark, sides).withColumn("path", name))
    return judged.select(F.col("path").cast("bigint").alias("file"), "size_bytes", "sha256",
                         "rehashed", "decision")


@query
def reproject_systems(spark, sf_dir):
    """Supplier positions in Web Mercator, two southern UTM zones or an unknown system, put into
    one northern zone."""
    n = F.col("s_suppkey")
    lon = F.pmod(n, F.lit(50)) * 0.05 + 12.0
    lat = (F.floor(n / 50) % 400 * 0.05 + 1.0) * F.when(n % 4 == 0, 1.0).otherwise(-1.0)
    srid = F.when(n % 4 == 0, 3857).when(n % 4 == 1, 32733).when(n % 4 == 2, 32734).otherwise(2056)
    south = lambda meridian: projection.to_planar(F.col("lon"), F.col("lat"), meridian)
    placed = lenses.table(spark, sf_dir, "supplier").select(
        "s_suppkey", lon.alias("lon"), lat.alias("lat"), srid.alias("srid")).withColumn(
        "zone", F.when(F.col("srid") == 32733, south(15.0)).otherwise(south(21.0)))
    web = F.struct((F.radians("lon") * projection.SEMI_MAJOR).alias("x"),
                   (F.asinh(F.tan(F.radians("lat"))) * projection.SEMI_MAJOR).alias("y"))
    utm = F.struct(F.col("zone.x").alias("x"), (F.col("zone.y") + 10_000_000.0).alias("y"))
    there = placed.withColumn("p", F.when(F.col("srid") == 3857, web).otherwise(utm))
    moved = there.withColumn("q", projection.reproject(F.array(F.array(F.array("p"))), F.col("srid")))
    spot = F.col("q")[0][0][0]
    return moved.select("s_suppkey", F.col("srid").cast("bigint").alias("srid"),
                        projection.is_supported(F.col("srid")).alias("is_supported"),
                        F.round(spot["x"], 3).alias("x"), F.round(spot["y"], 3).alias("y"))
