"""Registered queries: each runs one or more operators over whole given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridcensus import schemas
from gridcensus.functions import fields, forecast, geom, projection, text
from gridcensus.operators import (aggregates, checks, gates, joins, profiles, readiness, report,
                                  spatial, weather)
from gridcensus.operators.skew import is_small
from gridcensus.operators.verdict import reason_counts, side_by_side
from gridcensus.plans import lenses
from gridcensus.session import cut_lineage
from gridcensus.sources import catalogue, manifests, tables
from gridcensus.streaming import completion

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
DIGITS = 6


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _rounded(df: DataFrame, columns, digits: int = DIGITS) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), digits) for c in columns})


def _longs(df: DataFrame) -> DataFrame:
    """Counters as bigint whatever aggregate produced them."""
    return df.select(*[F.col(n).cast("bigint").alias(n) if t in ("int", "bigint") else F.col(n)
                       for n, t in df.dtypes])


def _wanted_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mask of the event mesh: cells that ever saw a large purchase."""
    return (lenses.table(spark, sf_dir, "events")
            .filter((F.col("event_type") == "purchase") & (F.col("value") >= 50))
            .select(F.col("user_id").cast("int").alias("cell_index")).distinct())


# Fields

@query
def field_explode(spark, sf_dir):
    """Decoded arrays to long rows."""
    vectors = lenses.table(spark, sf_dir, "embeddings").select(
        "vec_id", F.col("embedding").alias("values"))
    return (weather.explode_fields(vectors)
            .select("vec_id", F.col("cell_index").cast("bigint").alias("cell_index"),
                    F.round("source_value", DIGITS).alias("source_value")))


@query
def bitmap_missing(spark, sf_dir):
    """Marker values are missing only in fields whose header says so; counts must agree."""
    header = F.col("vec_id") % 3
    decoded = lenses.table(spark, sf_dir, "embeddings").select(
        "vec_id", F.transform("embedding", lambda v: F.when(v > 0.2, 9999.0).otherwise(
            v.cast("double"))).alias("values"))
    rows = weather.explode_fields(decoded).withColumn(
        "numberOfMissing", F.when(header == 0, 0).otherwise(1)).withColumn(
        "bitmapPresent", F.when(header == 2, 0).otherwise(1))
    clean = rows.withColumn("kept", fields.unmark_missing(
        F.col("source_value"), F.lit(9999.0), F.col("numberOfMissing"), F.col("bitmapPresent")))
    audit = gates.missing_marker_audit(rows, ["vec_id"])
    kept = clean.groupBy("vec_id").agg(F.count("kept").alias("kept_count"))
    return _longs(audit.join(kept, "vec_id"))


@query
def field_masked_manifest(spark, sf_dir):
    """Masked load: source, missing and retained counts per field."""
    masked, manifest = weather.mask_fields(lenses.field(spark, sf_dir),
                                           _wanted_cells(spark, sf_dir))
    kept = masked.groupBy("run_time_utc", "indicator").agg(
        F.count("*").alias("masked_rows"), F.round(F.sum("source_value"), 4).alias("masked_sum"))
    return manifest.join(kept, ["run_time_utc", "indicator"], "left").select(
        "run_time_utc", "lead_time", "indicator", "source_point_count",
        "source_missing_value_count", "retained_point_count", "masked_rows", "masked_sum")


@query
def combine_fields(spark, sf_dir):
    """Five fields to one converted row per cell, wind speed before any averaging."""
    wide = weather.combine_fields(lenses.field(spark, sf_dir))
    return _rounded(_longs(wide), schemas.WEATHER_VALUES)


@query
def field_identity(spark, sf_dir):
    """Do the five fields share one complete cell set per forecast?"""
    return _longs(weather.field_identity_audit(lenses.sparse_field(spark, sf_dir)))


@query
def contract_units(spark, sf_dir):
    """Field headers against the indicator contract, first violation per field."""
    run = F.date_trunc("day", "ts")
    variant = F.col("event_id") % 11
    surface = F.when(F.col("event_type").isin("signup", "view"), 10).otherwise(2)
    codes = {"click": (0, 0, " K "), "error": (1, 1, "%"), "purchase": (0, 6, "kelvin"),
             "signup": (2, 2, "m s**-1"), "view": (2, 3, "m·s-1")}
    pick = lambda i: F.create_map(*[x for k, v in codes.items()
                                    for x in (F.lit(k), F.lit(v[i]))])[F.col("event_type")]
    headers = lenses.table(spark, sf_dir, "events").select(
        "event_id", run.alias("run_time_utc"), F.lit("PT001H00M").alias("lead_time"),
        F.when(variant == 10, "PMSL").otherwise(lenses._indicator()).alias("indicator"),
        F.when(variant == 1, 1).otherwise(2).alias("edition"), F.lit(0).alias("discipline"),
        pick(0).alias("parameterCategory"),
        F.when(variant == 2, 99).otherwise(pick(1)).alias("parameterNumber"),
        F.lit(103).alias("typeOfFirstFixedSurface"),
        F.when(variant == 3, 0).otherwise(surface).alias("scaledValueOfFirstFixedSurface"),
        F.when(variant == 4, "Pa").otherwise(pick(2)).alias("units"),
        F.when(variant == 5, 7).otherwise(542040).alias("numberOfPoints"),
        F.when(variant == 6, 3).otherwise(0).alias("numberOfMissing"),
        F.lit(0).alias("bitmapPresent"),
        F.when(variant == 7, None).otherwise(run).alias("source_run_time_utc"),
        F.when(variant == 8, run).otherwise(run + F.expr("interval 1 hour"))
        .alias("source_valid_time_utc"))
    gated = gates.field_metadata_gate(headers, schemas.indicator_contract(spark),
                                      schemas.EXPECTED_CELL_COUNT)
    return gated.select("event_id", F.coalesce("rejection_reason", F.lit("accepted"))
                        .alias("outcome"))


def _temperature(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kelvin and Celsius per event, with paired, single and inconsistent markers."""
    d = F.col("event_id") % 101
    k = F.col("value") / 10 + 270
    return lenses.table(spark, sf_dir, "events").select(
        F.col("event_id").alias("cell_index"), F.date_trunc("week", "ts").alias("run_time_utc"),
        F.date_trunc("week", "ts").alias("valid_time_utc"),
        F.when(d.isin(1, 2), 9999.0).otherwise(k).alias("temperature_k"),
        F.when(d.isin(1, 3), 9725.85).when(d == 4, k - 270).otherwise(k - 273.15)
        .alias("temperature_c"))


@query
def sentinel_audit(spark, sf_dir):
    """Temperature contract per week's batch: paired markers, finite, consistent, within bounds.

    Every third week is sound; the others hold every defect, some with a cell, a time or a run
    too few or too many.
    """
    n, week = F.col("event_id"), F.date_trunc("week", "ts")
    sound = F.weekofyear(week) % 3 == 1
    d = F.when(sound, 0).otherwise(n % 101)
    k = F.when(d == 10, float("inf")).otherwise(F.col("value") / 10 + 270)
    hour = F.expr("interval 1 hour")
    rows = lenses.table(spark, sf_dir, "events").select(
        week.alias("batch"), F.when(d != 7, n).alias("cell_index"),
        F.when(d == 11, week - hour).otherwise(week).alias("run_time_utc"),
        F.when(d == 9, week + hour).when(d != 8, week).alias("valid_time_utc"),
        F.when(d.isin(1, 2), 9999.0).otherwise(k).alias("temperature_k"),
        F.when(d.isin(1, 3), 9725.85).when(d == 4, k - 270).otherwise(k - 273.15)
        .alias("temperature_c"))
    verdict = gates.temperature_contract(rows, None, group=("batch",))
    return _rounded(_longs(verdict), ("min_k", "max_k"))


@query
def temperature_profile(spark, sf_dir):
    """Counters of the whole temperature table with the covered bridge cells."""
    field = _temperature(spark, sf_dir)
    bridge = lenses.event_bridge(spark, sf_dir)
    subset = profiles.bridge_subset_profile(field, bridge).select(
        "expected_relevant_cell_count", "matched_cell_count", "missing_relevant_cell_count",
        "missing_temperature_row_count", "mean_c")
    whole = profiles.temperature_profile(field).select(
        "row_count", "distinct_cell_count", "duplicate_cell_index_count", "missing_row_count",
        "distinct_run_time_count", "missing_share")
    return _rounded(_longs(side_by_side(spark, whole, subset)), ("mean_c", "missing_share"))


@query
def observed_temperature(spark, sf_dir):
    """Distribution of the values that are not markers."""
    shown = profiles.observed_temperature(_temperature(spark, sf_dir))
    return _rounded(shown, ("min", "median", "mean", "max", "sum", "std"), 4)


# Text, labels, identity

@query
def text_parse_flags(spark, sf_dir):
    """Strict and lenient number parsing with the present-but-unreadable flag."""
    c = F.col("population_80plus_source")
    return lenses.raw_population(spark, sf_dir).select(
        text.blank_to_null(F.col("plr_id_source")).alias("plr_id"),
        text.strict_bigint(c).alias("strict"), text.is_unparsable(c).alias("unparsable"),
        text.lenient_number(c).alias("lenient"))


@query
def reference_month_end(spark, sf_dir):
    """Month codes to month ends."""
    code = F.when(F.col("o_orderkey") % 50 == 0, "2024").otherwise(
        F.date_format("o_orderdate", "yyyyMM"))
    return lenses.table(spark, sf_dir, "orders").select(
        "o_orderkey", text.month_end(code).alias("month_end"),
        F.coalesce(text.is_month_code(code), F.lit(False)).alias("is_code"))


@query
def lead_time_parse(spark, sf_dir):
    """Labels to minutes and back, valid times and the two-dimensional key."""
    n = F.col("event_id")
    run = F.date_trunc("hour", "ts")
    minutes = F.pmod(n * 7, F.lit(70000)).cast("int")
    label = F.coalesce(forecast.lead_label(minutes), F.lit("12h"))
    bad = F.when(n % 97 == 0, F.format_string("PT%03dH%02dM", F.lit(12), F.lit(99))).otherwise(label)
    rows = lenses.table(spark, sf_dir, "events").select(
        "event_id", run.alias("run"), bad.alias("label"))
    keyed = rows.withColumn("key", forecast.partition_key(F.col("label"), F.col("run")))
    return keyed.select(
        "event_id", "label", forecast.lead_minutes(F.col("label")).cast("bigint").alias("minutes"),
        forecast.valid_time(F.col("run"), F.col("label")).alias("valid_time_utc"),
        "key", forecast.key_lead(F.col("key")).alias("key_lead"),
        forecast.key_run(F.col("key")).alias("key_run"))


@query
def source_urls(spark, sf_dir):
    """Field addresses and header times put together from integers."""
    stamp = F.col("run_time_utc")
    day = F.date_format(stamp, "yyyyMMdd").cast("int")
    minute = F.when(F.col("lead_time") != "PT006H00M", F.pmod(F.col("cell_index"), F.lit(24)) * 100)
    return lenses.sparse_field(spark, sf_dir).select(
        "indicator", "run_time_utc", "lead_time", F.col("cell_index").cast("bigint").alias("cell_index"),
        forecast.field_address("https://example.org/p/", F.col("indicator"), stamp,
                               F.col("lead_time")).alias("address"),
        forecast.stamp_from_integers(day, minute).alias("header_time"),
        text.directory_label(F.col("indicator")).alias("directory"))


@query
def polling_window(spark, sf_dir):
    """Events that fall into the polling window of their hour."""
    return (lenses.table(spark, sf_dir, "events")
            .groupBy(F.date_trunc("day", "ts").alias("day"))
            .agg(aggregates.count_if(forecast.poll_window_open(F.col("ts"))).alias("open_count"),
                 F.count("*").alias("event_count")))


# Population

@query
def population_gate(spark, sf_dir):
    """Every row with its parsed counts, share and first rejection reason."""
    c = gates.classify_population(lenses.raw_population(spark, sf_dir))
    return _rounded(c.select("plr_id", "population_total", "population_65_79",
                             "population_80plus", "population_65plus", "share_65plus",
                             "rejection_reason", "reference_date"), ("share_65plus",))


def _coerced(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = lenses.raw_population(spark, sf_dir).select(
        F.col("plr_id_source").alias("RAUMID"), F.col("population_total_source").alias("E_E"),
        F.col("population_65_79_source").alias("E_E65U80"),
        F.col("population_80plus_source").alias("E_E80U110"),
        F.col("reference_code_source").alias("ZEIT"))
    return gates.normalise_population(raw)


@query
def population_gate_lenient(spark, sf_dir):
    """The four-reason gate over coerced numbers."""
    c = gates.lenient_population_gate(_coerced(spark, sf_dir)).classified
    return _rounded(c.select("plr_id", "population_total", "population_65plus", "share_65plus",
                             "rejection_reason"), ("share_65plus",))


@query
def population_reasons(spark, sf_dir):
    """Rejected rows per reason."""
    split = gates.population_gate(lenses.raw_population(spark, sf_dir))
    return reason_counts(split.rejected)


@query
def population_accounting(spark, sf_dir):
    """Preconditions, source = accepted + rejected, no overlap, ids rebuilt."""
    raw = lenses.raw_population(spark, sf_dir)
    split = gates.population_gate(raw).stored()
    checked = checks.population_check(raw, split.accepted, split.rejected).select(
        "passed", "source_row_count", "accepted_row_count", "rejected_row_count",
        "accepted_rejected_overlap")
    pre = gates.population_preconditions(raw, None).select(
        F.col("passed").alias("preconditions_passed"), "distinct_plr_count", "blank_plr_count",
        "reference_code_count")
    ids = joins.split_accounting(split.classified, split.accepted, split.rejected,
                                 ["plr_id"]).select("key_difference_count")
    return _longs(side_by_side(spark, checked, pre, ids))


@query
def population_contract(spark, sf_dir):
    """Strict contract counters and the artefact contract over the lenient split."""
    frame = _coerced(spark, sf_dir)
    key = F.col("plr_id").cast("bigint")
    spoiled = frame.withColumns({
        "ZEIT": F.when(key % 47 == 2, "202412").when(key % 47 != 3, F.col("ZEIT")),
        "plr_id": F.when(key % 43 != 1, F.col("plr_id"))})
    strict = gates.population_contract(spoiled, None, "202512")
    split = gates.lenient_population_gate(frame).stored()
    both = split.accepted.filter(key % 53 == 4).select("plr_id", *[
        F.lit(None).cast(t).alias(c) for c, t in split.rejected.dtypes if c != "plr_id"])
    artefact = checks.artefact_contract(split.accepted, split.rejected.unionByName(both), None).select(
        F.col("passed").alias("artefact_passed"), "accepted_missing_count", "overlap_count",
        F.col("source_row_count").alias("artefact_rows"))
    return _longs(side_by_side(spark, strict.drop("code"), artefact))


@query
def population_profile(spark, sf_dir):
    """Identity and missing counts of the coerced snapshot."""
    return _longs(profiles.population_profile(_coerced(spark, sf_dir)))


# Joins and aggregates

@query
def cardinality_audit(spark, sf_dir):
    """Repeated line items per key, and how many rows belong to them."""
    lines = lenses.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    return joins.duplicate_keys(lines, ["l_orderkey", "l_linenumber"])


@query
def duplicate_flags(spark, sf_dir):
    """Every member of a repeated line key is flagged; counted per line number."""
    lines = lenses.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    flagged = joins.flag_duplicates(lines, ["l_orderkey", "l_linenumber"])
    return flagged.groupBy(F.col("l_linenumber").cast("bigint").alias("l_linenumber")).agg(
        F.count("*").alias("row_count"),
        aggregates.count_if(F.col("is_duplicate")).alias("duplicate_rows"))


@query
def constraint_audit(spark, sf_dir):
    """Key, reference, NOT NULL and CHECK violations of the order lines."""
    t = lambda n: lenses.table(spark, sf_dir, n)
    return _longs(checks.constraint_audit(
        t("lineitem"), ["l_orderkey", "l_linenumber"], ["l_partkey", "l_shipdate"],
        {"quantity_range": F.col("l_quantity").between(2, 49),
         "flag_enum": F.col("l_returnflag").isin("A", "N"),
         "discount": F.col("l_discount") <= 0.09},
        {"order": (["l_orderkey"], t("orders"), ["o_orderkey"]),
         "supplier": (["l_suppkey"], t("supplier").filter("s_acctbal > 0"), ["s_suppkey"])}))


@query
def orphan_rows(spark, sf_dir):
    """Order lines whose order is not open, through an anti join."""
    open_orders = lenses.table(spark, sf_dir, "orders").filter("o_orderstatus = 'O'")
    lines = lenses.table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return joins.orphans(lines, open_orders, ["o_orderkey"])


@query
def key_differences(spark, sf_dir):
    """Users who ever had an error against users who ever bought."""
    events = lenses.table(spark, sf_dir, "events")
    a = events.filter("event_type = 'error'").select("user_id")
    b = events.filter("event_type = 'purchase'").select("user_id")
    return joins.compare_keys(a, b, ["user_id"])


@query
def numeric_describe(spark, sf_dir):
    """Exact distribution of line item numbers and event values."""
    lines = aggregates.describe(lenses.table(spark, sf_dir, "lineitem"),
                                ("l_quantity", "l_extendedprice", "l_discount", "l_tax"))
    events = aggregates.describe(lenses.table(spark, sf_dir, "events"), ("value",))
    return _rounded(lines.unionByName(events), ("min", "median", "mean", "max", "sum", "std"), 4)


@query
def null_and_value_counts(spark, sf_dir):
    """Missing numbers and rows per value of the raw population text."""
    raw = lenses.raw_population(spark, sf_dir).withColumn(
        "population_80plus_source", F.when(F.length("population_80plus_source") == 2,
                                           F.col("population_80plus_source")))
    return aggregates.value_counts(raw, "population_80plus_source", "<NULL>")


@query
def latest_source(spark, sf_dir):
    """Last loaded source and current version among order priorities."""
    orders = lenses.table(spark, sf_dir, "orders")
    last = aggregates.latest_by(orders, "o_orderpriority", "o_orderdate").select(
        F.lit("latest").alias("kind"), F.col("o_orderpriority").alias("label"),
        F.col("o_orderdate").alias("stamp"))
    dated = orders.withColumn("o_orderdate", F.when(F.col("o_orderstatus") != "P",
                                                    F.col("o_orderdate")))
    current = aggregates.current_version(dated, "o_orderstatus", "o_orderdate").select(
        F.lit("current").alias("kind"), F.col("o_orderstatus").alias("label"),
        F.col("o_orderdate").alias("stamp"))
    return last.union(current)


# Zone weather

def _weather(spark: SparkSession, sf_dir: str, newest: bool = False) -> DataFrame:
    field = lenses.field(spark, sf_dir)
    if newest:
        field = weather.newest_forecast(field, lenses.field_forecasts(spark, sf_dir))
    return weather.plr_weather(field, lenses.event_bridge(spark, sf_dir),
                               lenses.field_forecasts(spark, sf_dir, newest))


def _final(spark: SparkSession, sf_dir: str, newest: bool = False) -> DataFrame:
    raw = lenses.raw_population(spark, sf_dir)
    split = gates.population_gate(raw).stored()
    return weather.plr_weather_population(_weather(spark, sf_dir, newest), split.accepted,
                                          split.rejected, is_small(raw))


@query
def plr_weather(spark, sf_dir):
    """Area-weighted weather per zone and forecast, missing-preserving."""
    return _rounded(_weather(spark, sf_dir).drop("geography_version"), schemas.WEATHER_VALUES)


@query
def plr_temperature(spark, sf_dir):
    """Weighted temperature sums per zone with weight sum and cells used."""
    t = (lenses.field(spark, sf_dir).filter(F.col("indicator") == "T_2M")
         .select("cell_index", "run_time_utc", "valid_time_utc",
                 F.col("source_value").alias("temperature_k"),
                 fields.celsius(F.col("source_value")).alias("temperature_c")))
    out = weather.plr_temperature(t, lenses.event_bridge(spark, sf_dir))
    return _rounded(out, ("temperature_c", "temperature_k", "weight_sum"))


@query
def bridge_coverage(spark, sf_dir):
    """Per forecast: bridge cells the sparse fields lack."""
    field = lenses.sparse_field(spark, sf_dir)
    return _longs(weather.bridge_coverage(field, lenses.event_bridge(spark, sf_dir)))


@query
def plr_weather_population(spark, sf_dir):
    """Zone weather with population or the reason for its absence."""
    return _rounded(_final(spark, sf_dir).drop("geography_version"),
                    (*schemas.WEATHER_VALUES, "share_65plus"))


@query
def partition_summary(spark, sf_dir):
    """One row per produced forecast: sizes, missing values, population states."""
    return weather.partition_summary(_final(spark, sf_dir))


@query
def current_exposure(spark, sf_dir):
    """Rows of the newest run at its first lead."""
    return _rounded(_final(spark, sf_dir, newest=True).drop("geography_version"),
                    (*schemas.WEATHER_VALUES, "share_65plus"))


@query
def hottest_zones(spark, sf_dir):
    """Ten warmest zones of the current forecast and who lives there."""
    current = _final(spark, sf_dir, newest=True)
    rounded = current.withColumn("temperature_c", F.round("temperature_c", DIGITS))
    top = report.hottest_zones(rounded)
    return _rounded(_longs(top), ("relative_humidity_percent", "share_65plus"))


@query
def status_reason_counts(spark, sf_dir):
    """Rows per population status and per rejection reason."""
    final = _final(spark, sf_dir)
    status = report.status_counts(final).select(
        F.lit("status").alias("kind"), F.col("population_status").alias("label"), "row_count")
    reasons = report.rejection_reason_counts(final).select(
        F.lit("reason").alias("kind"), F.col("population_rejection_reason").alias("label"),
        "row_count")
    return status.union(reasons)


@query
def final_checks(spark, sf_dir):
    """Coverage, exceptions and the explained-join audit of the final table."""
    split = gates.population_gate(lenses.raw_population(spark, sf_dir)).stored()
    zone_weather = cut_lineage(_weather(spark, sf_dir))
    final = cut_lineage(weather.plr_weather_population(zone_weather, split.accepted,
                                                       split.rejected))
    zones = lenses.table(spark, sf_dir, "customer").agg(F.count("*")).scalar()
    coverage = checks.coverage_check(final, zones).agg(
        F.count("*").alias("forecast_count"), F.min("passed").alias("coverage_passed"),
        F.sum("row_count").alias("row_count"), F.sum("missing_plr_ids").alias("missing_plr_ids"))
    exceptions = checks.exceptions_check(final, split.rejected)
    audit = joins.explained_audit(zone_weather, split.accepted, split.rejected, "plr_id").select(
        F.col("passed").alias("explained_passed"), "unmatched_key_count",
        "unexplained_key_count", "unused_registry_key_count")
    labelled = weather.with_partition_labels(final)
    identity = checks.identity_check(labelled).agg(F.min("passed").alias("identity_passed"))
    return _longs(side_by_side(spark, coverage, exceptions, audit, identity))


# Completeness and readiness

def _indicator_columns(df: DataFrame) -> DataFrame:
    rows = F.col("per_indicator_row_counts")
    return df.select("*", *[rows[i].alias(f"rows_{i.lower()}") for i in schemas.INDICATORS]
                     ).drop("per_indicator_row_counts")


@query
def partition_complete_full(spark, sf_dir):
    """Unscoped completeness verdict per forecast, with every defect that it counts."""
    c = F.col("cell_index")
    spoiled = lenses.sparse_field(spark, sf_dir).withColumns({
        "indicator": F.when((c % 97 == 13) & (F.col("indicator") == "U_10M"), "PMSL").otherwise(
            F.col("indicator")),
        "valid_time_utc": F.col("valid_time_utc") + F.when(
            c % 89 == 7, F.expr("interval 1 hour")).otherwise(F.expr("interval 0 hour")),
        "source_value": F.when(c % 79 != 3, F.col("source_value")),
        "cell_index": F.when(c % 83 == 11, -c - 1).otherwise(c)})
    verdicts = checks.full_partition_check(
        spoiled, lenses.cell_count(spark, sf_dir), ("source_unit",))
    return _longs(_indicator_columns(verdicts))


@query
def partition_complete_scoped(spark, sf_dir):
    """Scoped completeness verdict per forecast, with a lost manifest, stray rows, and sources
    of a wrong name, size, time or scope in four of five weeks."""
    field, mask = lenses.field(spark, sf_dir), _wanted_cells(spark, sf_dir)
    masked, manifest = weather.mask_fields(field, mask)
    first = field.agg(F.min("run_time_utc")).scalar()
    last = field.agg(F.max("run_time_utc")).scalar()
    stray = field.filter((F.col("run_time_utc") == first) & (F.col("indicator") == "T_2M")).join(
        mask, "cell_index", "left_anti")
    scope = {"source_grid_id": F.lit(lenses.GRID), "geography_version": F.lit(lenses.VERSION),
             "mask_buffer_m": F.lit(5000)}
    sources = manifest.filter(~((F.col("run_time_utc") == last)
                                & (F.col("indicator") == "V_10M"))).withColumns(scope)
    week, kind = F.weekofyear("run_time_utc") % 5, F.col("indicator")
    odd = lambda n, name: (week == n) & (kind == name)
    sources = sources.withColumns({
        "indicator": F.when(odd(1, "TD_2M"), "PMSL").otherwise(kind),
        "source_point_count": F.col("source_point_count") + odd(2, "RELHUM_2M").cast("int"),
        "valid_time_utc": F.when(odd(3, "U_10M"), F.col("run_time_utc") + F.expr(
            "interval 1 hour")).otherwise(F.col("valid_time_utc")),
        "geography_version": F.when(odd(4, "V_10M"), "other").otherwise(F.col("geography_version"))})
    verdicts = checks.scoped_partition_check(
        sources, masked.unionByName(stray), mask.withColumns(scope),
        lenses.cell_count(spark, sf_dir))
    return _longs(_indicator_columns(verdicts))


def _observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly arrivals: which indicator was seen for which run and lead."""
    return lenses.table(spark, sf_dir, "events").select(
        F.date_trunc("hour", "ts").alias("run_time_utc"),
        lenses._lead(F.col("event_id")).alias("lead_time"),
        lenses._indicator().alias("indicator"))


@query
def missing_indicators(spark, sf_dir):
    """Expected calendar against arrivals: what each forecast still lacks."""
    seen = _observed(spark, sf_dir)
    bounds = seen.agg(F.min("run_time_utc").alias("a"), F.max("run_time_utc").alias("b"))
    calendar = readiness.forecast_calendar(spark, bounds.select("a").scalar(),
                                           bounds.select("b").scalar())
    judged = readiness.availability(calendar, seen)
    return judged.select("run_time_utc", "lead_time",
                         F.array_join("missing_indicators", ",").alias("missing_indicators"),
                         "complete")


def _pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = _observed(spark, sf_dir).withColumn("run_time_utc", F.date_trunc("day", "run_time_utc"))
    large = lenses.table(spark, sf_dir, "events").filter("value > 60").select(
        F.date_trunc("day", "ts").alias("run_time_utc"),
        lenses._lead(F.col("event_id")).alias("lead_time"),
        lenses._indicator().alias("indicator"))
    done = readiness.completed_partitions(large)
    some = daily.filter(~((F.col("lead_time") == "PT002H00M") & (F.col("indicator") == "U_10M")))
    return readiness.pending_availability(daily, some, done, "2024-01-05 00:00:00", 6)


@query
def ready_partitions(spark, sf_dir):
    """State of every candidate in the recent window."""
    return _pending(spark, sf_dir).select(
        "run_time_utc", F.col("lead_order").cast("bigint").alias("lead_order"), "lead_time",
        "state", F.array_join("missing_indicators", ",").alias("missing_indicators"))


@query
def readiness_decision(spark, sf_dir):
    """Counts over the window, newest incomplete forecast and the skip reason."""
    d = readiness.decision(_pending(spark, sf_dir))
    return d.withColumn("latest_missing_indicators",
                        F.array_join("latest_missing_indicators", ","))


@query
def retry_eligible(spark, sf_dir):
    """Which forecasts may be launched again, with attempt number and run key."""
    status = (F.when(F.col("o_orderstatus") == "F", "FAILURE")
              .when(F.col("o_orderstatus") == "O", "SUCCESS").otherwise("CANCELED"))
    log = lenses.table(spark, sf_dir, "orders").select(
        F.date_trunc("day", "o_orderdate").alias("run_time_utc"),
        lenses._lead(F.col("o_custkey")).alias("lead_time"), status.alias("status"),
        F.col("o_orderdate").alias("ts"), "o_orderkey")
    days = log.select("run_time_utc").distinct()
    ready = readiness.with_leads(days).select("run_time_utc", "lead_time")
    out = readiness.launchable(ready, log, "weather", status_order=("ts", "o_orderkey"))
    return _longs(out)


@query
def stream_completion(spark, sf_dir):
    """Forecasts a stream of arrivals completes."""
    schema = lenses.table(spark, sf_dir, "events").schema
    # A pattern finds the table whether it is one file or a folder of them.
    stream = spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parque[t]")
    arrivals = stream.select(
        F.date_trunc("day", "ts").alias("run_time_utc"),
        lenses._lead(F.col("event_id")).alias("lead_time"),
        lenses._indicator().alias("indicator"))
    return completion.run_available(arrivals, "completion").select("run_time_utc", "lead_time")


# Geometry

@query
def zone_area_bbox(spark, sf_dir):
    """Area, bounds and centroid of every zone."""
    z = lenses.zones(spark, sf_dir)
    return z.select("plr_id", F.round(geom.area("geometry"), 3).alias("area_m2"),
                    geom.bounds("geometry").alias("b"), geom.centroid("geometry").alias("c")).select(
        "plr_id", "area_m2", "b.minx", "b.miny", "b.maxx", "b.maxy",
        F.round("c.x", 3).alias("cx"), F.round("c.y", 3).alias("cy"))


@query
def zone_area_profile(spark, sf_dir):
    """Total bounds and area distribution of all zones."""
    p = profiles.area_profile(lenses.zones(spark, sf_dir))
    return _rounded(_longs(p), ("area_min", "area_median", "area_max", "area_sum"), 3)


@query
def triangle_build(spark, sf_dir):
    """Cell gate: triangles from incidence, reprojected, measured, or quarantined."""
    topology, vertices = lenses.mesh(spark, sf_dir)
    c = gates.cell_gate(topology, vertices).classified
    return c.select(F.col("cell_index").cast("bigint").alias("cell_index"), "rejection_reason",
                    F.round("icon_cell_area_m2").alias("area_m2"))


@query
def mesh_profile(spark, sf_dir):
    """Sizes, referenced vertices and coordinate ranges of the mesh."""
    topology, vertices = lenses.mesh(spark, sf_dir)
    p = profiles.mesh_profile(vertices, topology)
    return _rounded(_longs(p), ("min_longitude", "max_longitude", "min_latitude", "max_latitude"))


def _bridge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spatial.area_bridge(lenses.zones(spark, sf_dir), lenses.cells(spark, sf_dir),
                               float(lenses.CELL_M), 1e-3)


def _stored_bridge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bridge as a stored table: built once, then checked."""
    return cut_lineage(_bridge(spark, sf_dir))


@query
def area_bridge(spark, sf_dir):
    """Shared area of every zone and mesh triangle with both fractions."""
    return _longs(_bridge(spark, sf_dir).select(
        "plr_id", "cell_index", F.round("intersection_area_m2", 3).alias("intersection_area_m2"),
        F.round("fraction_of_plr", 6).alias("fraction_of_plr"),
        F.round("fraction_of_icon_cell", 6).alias("fraction_of_icon_cell")))


@query
def bridge_quality(spark, sf_dir):
    """Coverage, orphans, areas, fractions and weight sums of the bridge."""
    zones, cells = lenses.zones(spark, sf_dir), lenses.cells(spark, sf_dir)
    count = lenses.table(spark, sf_dir, "customer").agg(F.count("*")).scalar()
    verdict = checks.bridge_check(_stored_bridge(spark, sf_dir), zones, cells, count)
    return _rounded(_longs(verdict), ("max_plr_weight_error",))


@query
def bridge_profile(spark, sf_dir):
    """Per zone: cells, weight, covered area and coverage ratio."""
    rolled = profiles.zone_rollup(_bridge(spark, sf_dir)).drop(
        "geography_version", "source_grid_id")
    return _rounded(rolled.select(
        "plr_id", "icon_cells_used", F.round("weight_sum", 6).alias("weight_sum"),
        "intersection_area_sum_m2", "plr_area_m2", "coverage_ratio"),
        ("intersection_area_sum_m2", "plr_area_m2", "coverage_ratio"), 3)


@query
def bridge_references(spark, sf_dir):
    """Ids that only the bridge or only the zone and mesh sides know."""
    zones, cells = lenses.zones(spark, sf_dir), lenses.cells(spark, sf_dir)
    customers = lenses.table(spark, sf_dir, "customer").withColumn(
        "plr_id", lenses.plr_id(F.col("c_custkey")))
    known = zones.join(customers.filter("c_acctbal > 0").select("plr_id"), "plr_id", "left_semi")
    mesh = cells.join(lenses.table(spark, sf_dir, "part").filter("p_size > 5").select(
        F.col("p_partkey").cast("int").alias("cell_index")), "cell_index", "left_semi")
    bridge = lenses.event_bridge(spark, sf_dir).join(
        customers.filter("c_nationkey <> 3").select("plr_id"), "plr_id", "left_semi")
    return profiles.bridge_references(bridge, known, mesh)


@query
def reproject(spark, sf_dir):
    """Supplier numbers as positions, to planar metres and back."""
    lon = F.pmod("s_suppkey", F.lit(50)) * 0.1 + 12.0
    lat = F.floor(F.col("s_suppkey") / 50) % 800 * 0.05 + 48.0
    rows = lenses.table(spark, sf_dir, "supplier").select(
        "s_suppkey", lon.alias("lon"), lat.alias("lat"))
    planar = rows.withColumn("p", projection.to_planar(F.col("lon"), F.col("lat")))
    back = planar.withColumn("q", projection.to_geographic(F.col("p.x"), F.col("p.y")))
    return back.select("s_suppkey", F.round("p.x", 3).alias("x"), F.round("p.y", 3).alias("y"),
                       F.round("q.x", 6).alias("lon"), F.round("q.y", 6).alias("lat"))


def _nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zones, some without a position, and the cells nearest to them."""
    zones = lenses.rounded_centres(lenses.zones(spark, sf_dir), ["plr_id"]).withColumn(
        "x", F.when(F.col("plr_id").cast("bigint") % 37 != 5, F.col("x")))
    cells = lenses.rounded_centres(lenses.cells(spark, sf_dir), ["cell_index"])
    return spatial.nearest(zones, cells, "plr_id", ["cell_index"])


@query
def nearest_cell(spark, sf_dir):
    """Nearest triangle centre per zone centroid, ties kept; zones without a position stay."""
    found = _nearest(spark, sf_dir)
    return _rounded(_longs(found), ("distance_m",), 3)


@query
def nearest_summary(spark, sf_dir):
    """Distances and zones per assigned cell."""
    out = profiles.nearest_summary(cut_lineage(_nearest(spark, sf_dir)))
    return _rounded(_longs(out), [c for c, t in out.dtypes if t == "double"], 3)


@query
def cells_in_union(spark, sf_dir):
    """Triangle centres inside or on the edge of any zone."""
    cells = lenses.rounded_centres(lenses.cells(spark, sf_dir), ["cell_index"])
    inside = spatial.points_in_union(cells, lenses.zones(spark, sf_dir), ["cell_index"],
                                     float(lenses.ZONE_M))
    return _longs(inside)


@query
def union_outline(spark, sf_dir):
    """Edges left after dissolving the zones, counted by direction."""
    e = spatial.outline(lenses.zones(spark, sf_dir))
    return (e.groupBy(F.when(F.col("a.x") == F.col("b.x"), "vertical").otherwise("horizontal")
                      .alias("direction"))
            .agg(F.count("*").alias("edge_count"),
                 F.round(F.sum(F.abs(F.col("b.x") - F.col("a.x"))
                               + F.abs(F.col("b.y") - F.col("a.y"))), 3).alias("length_m")))


def _mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spatial.weather_mask(lenses.zones(spark, sf_dir), lenses.cells(spark, sf_dir), 5000,
                                float(lenses.CELL_M))


@query
def weather_mask(spark, sf_dir):
    """Cells within five kilometres of any zone."""
    return _longs(_mask(spark, sf_dir))


@query
def mask_quality(spark, sf_dir):
    """The mask contains every bridge cell and only known cells."""
    zones, cells = lenses.zones(spark, sf_dir), lenses.cells(spark, sf_dir)
    count = lenses.table(spark, sf_dir, "customer").agg(F.count("*")).scalar()
    return _longs(checks.mask_check(cut_lineage(_mask(spark, sf_dir)),
                                    _stored_bridge(spark, sf_dir), zones, cells, count))


@query
def zone_gate(spark, sf_dir):
    """First rejection reason per raw zone; duplicates all flagged, crossings found."""
    split = gates.zone_gate(cut_lineage(lenses.raw_zones(spark, sf_dir)))
    return split.classified.select("source_row_id", "plr_id", "rejection_reason", F.round(
        geom.area("geometry"), 3).alias("area_m2"))


# Storage and sources

@query
def slice_replace(spark, sf_dir):
    """Orders of the urgent slice recomputed and put back."""
    orders = lenses.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority",
                                                          "o_totalprice")
    fresh = (orders.filter(F.col("o_orderpriority") == "1-URGENT")
             .withColumn("o_totalprice", F.round(F.col("o_totalprice") * 2, 2)))
    return tables.replace_slice(orders, fresh, ["o_orderpriority"])


@query
def upsert(spark, sf_dir):
    """Finished orders update their customer's row, others stay."""
    customers = lenses.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("key"), F.col("c_acctbal").alias("amount"))
    newest = (lenses.table(spark, sf_dir, "orders").filter("o_orderstatus = 'F'")
              .groupBy(F.col("o_custkey").alias("key"))
              .agg(F.max("o_totalprice").alias("amount")))
    return tables.upsert(customers, newest, ["key"])


@query
def content_hash(spark, sf_dir):
    """Digest, size, payload problem and reuse decision per document."""
    docs = lenses.table(spark, sf_dir, "documents").select(
        "doc_id", "lang", "n_chars", F.encode("text", "UTF-8").alias("content"))
    digest = manifests.with_digest(docs).select(
        F.col("doc_id").cast("string").alias("path"), F.col("lang").alias("indicator"),
        F.lit(None).cast("timestamp").alias("run_time_utc"), F.lit("PT000H00M").alias("lead_time"),
        F.lit(None).cast("timestamp").alias("valid_time_utc"), "sha256", "size_bytes",
        "payload_problem", "doc_id", "n_chars")
    known = digest.filter(F.col("indicator") != "fr").withColumn("sha256", F.when(
        F.col("n_chars") > 2000, F.lit("0" * 64)).otherwise(F.col("sha256")))
    judged = manifests.reuse_decision(digest, known.drop("doc_id"))
    return judged.select("doc_id", "sha256", "size_bytes", "payload_problem", "decision")


@query
def page_payloads(spark, sf_dir):
    """Web pages are recognised as no data files."""
    pages = lenses.table(spark, sf_dir, "pages").select(
        "page_id", F.encode("html", "UTF-8").alias("content"))
    return (manifests.with_digest(pages).groupBy("payload_problem")
            .agg(F.count("*").alias("page_count"), F.sum("size_bytes").alias("size_bytes")))


@query
def listing_scan(spark, sf_dir):
    """Run labels advertised in page text, percent-encoded or not."""
    day = F.lpad((F.pmod(F.col("page_id"), F.lit(28)) + 1).cast("string"), 2, "0")
    hour = F.lpad(F.pmod(F.col("page_id") * 5, F.lit(24)).cast("string"), 2, "0")
    colon = F.when(F.col("page_id") % 2 == 0, "%3A").otherwise(":")
    link = F.concat(F.lit('<a href="2026-08-'), day, F.lit("T"), hour, colon, F.lit('00/">'))
    pages = lenses.table(spark, sf_dir, "pages").select(F.concat("html", link).alias("html"))
    return manifests.advertised_runs(pages)


_ALIASES = {"gear": ("gear", "large gear", "cog"), "plate": ("plate", "new plate"),
            "bolt": ("bolt", "red bolt", "screw")}


@query
def alias_match(spark, sf_dir):
    """Score part names against alias lists; best score and its ties per target."""
    layers = lenses.table(spark, sf_dir, "part").select(
        F.concat(F.lit("ns:"), "p_name").alias("name"), F.col("p_type").alias("title")).distinct()
    scored = catalogue.score_layers(layers, _ALIASES)
    return _longs(catalogue.layer_verdict(scored, _ALIASES))


def entry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hottest_zones(spark, sf_dir)

