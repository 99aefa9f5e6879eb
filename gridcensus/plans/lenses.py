"""Domain tables derived from the given tables, whole and deterministic.

The given tables hold no weather, zones or meshes. Each lens reads one of them entirely and
maps its rows onto a table of the data model, so the work of a query grows with the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridcensus.functions import geom
from gridcensus.operators.skew import spread
from gridcensus.schemas import INDICATORS, LEAD_TIMES

VERSION = "2023-01-01"
GRID = "G1"
ZONE_M, ZONE_COLUMNS, ZONE_X, ZONE_Y = 4000, 8, 370000, 5800000
CELL_M, CELL_COLUMNS, CELL_X, CELL_Y = 7000, 6, 367000, 5797000
EVENT_INDICATORS = {"click": "T_2M", "error": "RELHUM_2M", "purchase": "TD_2M",
                    "signup": "U_10M", "view": "V_10M"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keyed_rows(spark: SparkSession, sf_dir: str, name: str, key: str, *columns: str) -> DataFrame:
    """Key and columns of a table, dealt over all tasks: its file has few splits, and every row
    becomes shapes or text of many times its size."""
    return spread(table(spark, sf_dir, name).select(key, *columns), key)


def _indicator() -> Column:
    entries = [x for k, v in EVENT_INDICATORS.items() for x in (F.lit(k), F.lit(v))]
    return F.create_map(*entries)[F.col("event_type")]


def _lead(n: Column) -> Column:
    return F.get(F.array(*[F.lit(x) for x in LEAD_TIMES]), F.pmod(n, F.lit(6)).cast("int"))


def cell_count(spark: SparkSession, sf_dir: str) -> Column:
    """Cells of the event mesh, one per user number."""
    return table(spark, sf_dir, "events").agg(F.max("user_id") + 1).scalar()


def field(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dense weekly fields at lead 0: every cell of every indicator, NULL where no event fell.

    The cells are a parallel range; each meets the short list of runs and indicators.
    """
    events = table(spark, sf_dir, "events")
    keys = ["run_time_utc", "cell_index", "indicator"]
    run = F.date_trunc("week", "ts").alias("run_time_utc")
    seen = (events.select(run, F.col("user_id").cast("int").alias("cell_index"),
                          _indicator().alias("indicator"), "value")
            .groupBy(*keys).agg(F.max("value").alias("source_value")))
    cells = events.agg(F.max("user_id")).first()[0]
    runs = events.select(run).agg(F.collect_set("run_time_utc")).scalar()
    grid = (spark.range(0 if cells is None else cells + 1)
            .select(F.col("id").cast("int").alias("cell_index"),
                    F.explode(runs).alias("run_time_utc"))
            .withColumn("indicator", F.explode(F.array(*[F.lit(i) for i in INDICATORS]))))
    return (grid.join(seen, keys, "left")
            .withColumn("lead_time", F.lit("PT000H00M"))
            .withColumn("valid_time_utc", F.col("run_time_utc"))
            .select("run_time_utc", "lead_time", "valid_time_utc", "indicator", "cell_index",
                    "source_value"))


def field_forecasts(spark: SparkSession, sf_dir: str, newest: bool = False) -> DataFrame:
    """The forecasts that ``field`` holds, or the newest, from one narrow scan."""
    run = F.date_trunc("week", "ts").alias("run_time_utc")
    rows = table(spark, sf_dir, "events").select(run)
    known = rows.agg(F.max("run_time_utc").alias("run_time_utc")).where(
        "run_time_utc IS NOT NULL") if newest else rows.distinct()
    return known.withColumn("lead_time", F.lit("PT000H00M")).withColumn(
        "valid_time_utc", F.col("run_time_utc"))


def sparse_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily runs times six leads with many gaps and a few disagreeing units."""
    hours = F.get(F.array(*[F.lit(int(x[2:5])) for x in LEAD_TIMES]),
                  F.pmod("event_id", F.lit(6)).cast("int"))
    run = F.date_trunc("day", "ts")
    return (table(spark, sf_dir, "events")
            .select(run.alias("run_time_utc"), _lead(F.col("event_id")).alias("lead_time"),
                    (run + F.make_interval(hours=hours)).alias("valid_time_utc"),
                    _indicator().alias("indicator"),
                    F.col("user_id").cast("int").alias("cell_index"),
                    F.col("value").alias("source_value"),
                    F.when(F.col("event_id") % 1000 == 7, "other").otherwise("unit")
                    .alias("source_unit"))
            .groupBy("run_time_utc", "lead_time", "valid_time_utc", "indicator", "cell_index")
            .agg(F.max("source_value").alias("source_value"),
                 F.min("source_unit").alias("source_unit")))


def event_bridge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four weighted cells per customer zone, weights summing to one."""
    key, k = F.col("c_custkey"), F.col("k")
    cells = cell_count(spark, sf_dir)
    raw = (keyed_rows(spark, sf_dir, "customer", "c_custkey")
           .withColumn("_total", sum((1 + F.pmod(key * 7 + j * 3, F.lit(5)) for j in range(4)),
                                     F.lit(0)))
           .withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(3))))
           .withColumn("_w", 1 + F.pmod(key * 7 + k * 3, F.lit(5))))
    return raw.select(
        plr_id(key).alias("plr_id"), F.lit(VERSION).alias("geography_version"),
        F.lit(GRID).alias("source_grid_id"),
        F.pmod(key * 7 + k * 13, cells).cast("int").alias("cell_index"),
        (F.col("_w") * 100.0).alias("intersection_area_m2"),
        (F.col("_total") * 100.0).alias("plr_area_m2"), F.lit(10000.0).alias("icon_cell_area_m2"),
        (F.col("_w") / F.col("_total")).alias("fraction_of_plr"),
        (F.col("_w") / 100.0).alias("fraction_of_icon_cell"))


def plr_id(key: Column) -> Column:
    return F.lpad(key.cast("string"), 8, "0")


def raw_population(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text counts per customer zone with every kind of defect among them."""
    d = F.col("c_custkey") % 17
    base = (F.floor(F.abs("c_acctbal")) + 1).cast("bigint")
    share = lambda pct: F.expr(f"(floor(abs(c_acctbal)) + 1) * {pct} div 100")
    text = lambda c: c.cast("string")
    none = F.lit(None).cast("string")
    total = (F.when(d == 1, none).when(d == 2, "   ").when(d == 3, "n/a").when(d == 4, "0")
             .when(d == 5, "-5").when(d == 6, F.concat(F.lit("  "), text(base), F.lit(" ")))
             .otherwise(text(base)))
    mid = (F.when(d == 7, none).when(d == 8, "x1").when(d == 9, "-1").otherwise(text(share(15))))
    old = (F.when(d == 10, "").when(d == 11, "1.5").when(d == 12, text(base + 1))
           .otherwise(text(share(5))))
    return keyed_rows(spark, sf_dir, "customer", "c_custkey", "c_acctbal").select(
        F.col("c_custkey").alias("source_row_id"),
        F.concat(F.lit(" "), plr_id(F.col("c_custkey"))).alias("plr_id_source"),
        total.alias("population_total_source"), mid.alias("population_65_79_source"),
        old.alias("population_80plus_source"), F.lit("202512").alias("reference_code_source"),
        F.lit("2026-04-02").cast("date").alias("publication_date"),
        F.lit("a" * 64).alias("source_sha256"))


def _square(key: str) -> tuple[Column, Column]:
    x = F.col(key) % ZONE_COLUMNS * ZONE_M + ZONE_X
    y = F.floor(F.col(key) / ZONE_COLUMNS) * ZONE_M + ZONE_Y
    return x.cast("double"), y.cast("double")


def zone_polygon(key: str = "c_custkey") -> Column:
    """Squares, squares with a square hole, and L-shapes, by turns."""
    x, y = _square(key)
    m, half = ZONE_M, ZONE_M // 2
    full = geom.rectangle(x, y, x + m, y + m)
    hole = geom.rectangle(x + 1000, y + 1000, x + 2000, y + 2500)
    ell = geom.closed_ring(
        geom.point(x, y), geom.point(x + m, y), geom.point(x + m, y + half),
        geom.point(x + half, y + half), geom.point(x + half, y + m), geom.point(x, y + m))
    kind = F.col(key) % 3
    return geom.promote(F.when(kind == 0, geom.polygon(full))
                        .when(kind == 1, geom.polygon(full, hole)).otherwise(geom.polygon(ell)))


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed_rows(spark, sf_dir, "customer", "c_custkey").select(
        plr_id(F.col("c_custkey")).alias("plr_id"), F.lit(VERSION).alias("geography_version"),
        zone_polygon().alias("geometry"))


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two triangles per mesh square, one per part."""
    square = F.floor(F.col("p_partkey") / 2)
    x = (F.pmod(square, F.lit(CELL_COLUMNS)) * CELL_M + CELL_X).cast("double")
    y = (F.floor(square / CELL_COLUMNS) * CELL_M + CELL_Y).cast("double")
    corner = F.when(F.col("p_partkey") % 2 == 0, geom.point(x + CELL_M, y)).otherwise(
        geom.point(x, y + CELL_M))
    ring = geom.closed_ring(geom.point(x, y), geom.point(x + CELL_M, y + CELL_M), corner)
    return keyed_rows(spark, sf_dir, "part", "p_partkey").select(
        F.lit(GRID).alias("source_grid_id"), F.col("p_partkey").cast("int").alias("cell_index"),
        geom.promote(geom.polygon(ring)).alias("geometry"),
        F.lit(CELL_M * CELL_M / 2.0).alias("icon_cell_area_m2"))


def rounded_centres(df: DataFrame, keep) -> DataFrame:
    """Centroids on whole metres, so that distances are exact and ties are real ties."""
    c = geom.centroid("geometry")
    return (df.select(*keep, c.alias("c"))
            .select(*keep, F.round("c.x").alias("x"), F.round("c.y").alias("y")))


def raw_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw zones with every defect the gate names."""
    d = F.col("c_custkey") % 19
    x, y = _square("c_custkey")
    bow = geom.closed_ring(geom.point(x, y), geom.point(x + 4000, y + 3000),
                           geom.point(x + 4000, y), geom.point(x, y + 4000))
    open_ring = F.array(geom.point(x, y), geom.point(x + 4000, y), geom.point(x + 4000, y + 4000),
                        geom.point(x, y + 4000))
    shape = zone_polygon()
    empty = F.filter(shape, lambda p: F.lit(False))
    geometry = (F.when(d == 4, F.lit(None)).when(d == 5, empty)
                .when(d == 8, geom.promote(geom.polygon(bow)))
                .when(d == 9, geom.promote(geom.polygon(open_ring))).otherwise(shape))
    return keyed_rows(spark, sf_dir, "customer", "c_custkey").select(
        F.col("c_custkey").alias("source_row_id"),
        F.when(d == 1, "  ").when(d == 3, "DUP00001").otherwise(plr_id(F.col("c_custkey")))
        .alias("plr_id_source"),
        F.when(d == 7, "LINESTRING").otherwise("MULTIPOLYGON").alias("geometry_type"),
        geometry.alias("geometry"), F.when(d == 6, 0).otherwise(25833).alias("srid"),
        F.when(d != 2, VERSION).alias("geography_version"),
        F.lit("2023-01-01").cast("date").alias("reference_date"),
        F.lit("b" * 64).alias("source_sha256"))


def mesh(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(topology, vertices) of a geographic lattice over the parts, with broken cells."""
    part = keyed_rows(spark, sf_dir, "part", "p_partkey")
    key, d = F.col("p_partkey"), F.col("p_partkey") % 23
    square = F.floor(key / 2)
    column, row = F.pmod(square, F.lit(CELL_COLUMNS)), F.floor(square / CELL_COLUMNS)
    wide = CELL_COLUMNS + 1
    base = row * wide + column
    third = F.when(key % 2 == 0, base + 1).otherwise(base + wide)
    odd = key * 2 + 100000000
    last = (F.when(d == 2, base).when(d == 3, odd).when(d == 4, odd + 1).otherwise(third))
    corners = F.array(base, base + wide + 1, last)
    topology = (part.select(F.lit(GRID).alias("source_grid_id"),
                            key.cast("int").alias("cell_index"), d.alias("_d"),
                            F.posexplode(corners).alias("vertex_order", "vertex_index"))
                .filter(~((F.col("_d") == 1) & (F.col("vertex_order") == 2))).drop("_d"))
    lattice = (part.select(F.explode(F.array(base, base + 1, base + wide, base + wide + 1))
                           .alias("vertex_index")).distinct())
    v = F.col("vertex_index")
    regular = lattice.select(
        F.lit(GRID).alias("source_grid_id"), "vertex_index",
        (F.pmod(v, F.lit(wide)) * 0.1 + 13.0).alias("longitude_deg"),
        (F.floor(v / wide) % 15000 * 0.002 + 52.0).alias("latitude_deg"))
    broken = part.filter(d.isin(3, 4)).select(
        F.lit(GRID).alias("source_grid_id"),
        F.when(d == 3, odd).otherwise(odd + 1).alias("vertex_index"),
        F.when(d == 4, 13.0).alias("longitude_deg"), F.lit(95.0).alias("latitude_deg"))
    return topology, regular.unionByName(broken)
