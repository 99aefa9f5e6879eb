"""Quality gates: classify every source row, then split it into accepted and quarantined.

A gate returns a ``Split`` of lazy frames. Nothing is written and nothing raises; the
preconditions are a one-row verdict for ``verdict.enforce``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridcensus import schemas
from gridcensus.functions import fields, geom, text
from gridcensus.functions.forecast import valid_time
from gridcensus.functions.projection import is_supported, reproject
from gridcensus.operators.aggregates import count_if
from gridcensus.operators.spatial import (duplicate_zone_flags, flag_invalid, triangle_geometry,
                                          triangles)
from gridcensus.operators.verdict import passed, reason_map, side_by_side, with_verdict
from gridcensus.session import cut_lineage


@dataclass(frozen=True)
class Split:
    """Classified rows and the two halves a caller writes."""

    classified: DataFrame
    accepted: DataFrame
    rejected: DataFrame

    @classmethod
    def of(cls, classified: DataFrame, accepted_columns, rejected_columns) -> "Split":
        reason = F.col("rejection_reason")
        return cls(classified, classified.filter(reason.isNull()).select(*accepted_columns),
                   classified.filter(reason.isNotNull()).select(*rejected_columns))

    def stored(self) -> "Split":
        """The same split over rows classified once and kept in the shared folder."""
        return Split.of(cut_lineage(self.classified), self.accepted.columns,
                        self.rejected.columns)

    def summary(self, group: str | None = None) -> DataFrame:
        """Source, accepted and rejected counts, in one pass over the classified rows."""
        reason = F.col("rejection_reason")
        grouped = self.classified.groupBy(group) if group else self.classified
        return grouped.agg(F.count("*").alias("source_row_count"),
                           count_if(reason.isNull()).alias("accepted_row_count"),
                           count_if(reason.isNotNull()).alias("rejected_row_count"))

    def report(self) -> DataFrame:
        return side_by_side(self.classified.sparkSession, self.summary(),
                            reason_map(self.classified))


_POPULATION = ("plr_id", "population_total", "population_65_79", "population_80plus",
               "population_65plus", "share_65plus")


def _share() -> Column:
    return F.col("population_65plus").cast("double") / F.col("population_total")


def classify_population(raw: DataFrame) -> DataFrame:
    """Parse the text counts and give every row its first applicable rejection reason."""
    total, mid, old = ("population_total", "population_65_79", "population_80plus")
    parsed = raw.select(
        text.blank_to_null(F.col("plr_id_source")).alias("plr_id"),
        *[text.strict_bigint(F.col(f"{c}_source")).alias(c) for c in (total, mid, old)],
        *[text.is_unparsable(F.col(f"{c}_source")).alias(f"_bad_{c}") for c in (total, mid, old)],
        text.month_end(F.col("reference_code_source")).alias("reference_date"),
        "publication_date", "source_sha256")
    derived = parsed.withColumn("population_65plus", F.col(mid) + F.col(old))
    bad_total, bad_mid, bad_old = (F.col(f"_bad_{c}") for c in (total, mid, old))
    t, m, o, both = F.col(total), F.col(mid), F.col(old), F.col("population_65plus")
    reason = text.first_match(
        (t.isNull() & ~bad_total, "missing_population_total"),
        (bad_total, "invalid_population_total"),
        ((m.isNull() & ~bad_mid) | (o.isNull() & ~bad_old), "missing_population_65plus_component"),
        (bad_mid | bad_old, "invalid_population_65plus_component"),
        (t < 0, "negative_population_total"),
        (t == 0, "zero_population_total"),
        ((m < 0) | (o < 0) | (both < 0) | (m > t) | (o > t) | (both > t),
         "invalid_population_65plus"))
    return (derived.withColumn("rejection_reason", reason)
            .withColumn("share_65plus", F.when(F.col("rejection_reason").isNull(), _share()))
            .select(*_POPULATION, "rejection_reason", "reference_date", "publication_date",
                    "source_sha256"))


def population_preconditions(raw: DataFrame,
                             expected_rows: int | None = schemas.EXPECTED_ZONE_COUNT) -> DataFrame:
    """Everything that must hold for one snapshot before it may be split, per source."""
    plr = text.blank_to_null(F.col("plr_id_source"))
    code = F.col("reference_code_source")
    counts = raw.agg(
        F.count("*").alias("source_row_count"),
        F.count_distinct(plr).alias("distinct_plr_count"),
        count_if(plr.isNull()).alias("blank_plr_count"),
        F.count_distinct(code).alias("reference_code_count"),
        F.min(code).alias("reference_code"))
    expected = F.lit(True) if expected_rows is None else (
        F.col("source_row_count") == expected_rows)
    return with_verdict(
        counts, F.col("source_row_count") > 0, expected, F.col("blank_plr_count") == 0,
        F.col("distinct_plr_count") == F.col("source_row_count"),
        F.col("reference_code_count") == 1, text.is_month_code(F.col("reference_code")))


def population_gate(raw: DataFrame) -> Split:
    dated = ("reference_date", "publication_date", "source_sha256")
    return Split.of(classify_population(raw), (*_POPULATION, *dated),
                    (*_POPULATION, "rejection_reason", *dated))


def normalise_population(frame: DataFrame, plr: str = "RAUMID", total: str = "E_E",
                         mid: str = "E_E65U80", old: str = "E_E80U110") -> DataFrame:
    """Coerce a source frame: unreadable numbers become missing."""
    schemas.require_columns(frame, (plr, total, mid, old), "population source")
    return (frame.select(
        text.blank_to_null(F.col(plr), any_whitespace=True).alias("plr_id"),
        text.lenient_number(F.col(total)).alias("population_total"),
        text.lenient_number(F.col(mid)).alias("population_65_79"),
        text.lenient_number(F.col(old)).alias("population_80plus"),
        *[c for c in frame.columns if c not in (plr, total, mid, old)])
        .withColumn("population_65plus", F.col("population_65_79") + F.col("population_80plus"))
        .withColumn("share_65plus", F.try_divide(F.col("population_65plus"),
                                                 F.col("population_total"))))


def lenient_population_gate(normalised: DataFrame) -> Split:
    """The four-reason gate over coerced numbers; the share is not gated."""
    t, both = F.col("population_total"), F.col("population_65plus")
    reason = text.first_match(
        (t.isNull(), "missing_population_total"),
        (F.col("population_65_79").isNull() | F.col("population_80plus").isNull(),
         "missing_population_65plus_component"),
        (t < 0, "negative_population_total"),
        ((both < 0) | (both > t), "invalid_population_65plus"))
    return Split.of(normalised.withColumn("rejection_reason", reason), _POPULATION,
                    (*_POPULATION, "rejection_reason"))


def lenient_preconditions(split: Split, expected_rows: int | None = schemas.EXPECTED_ZONE_COUNT
                          ) -> DataFrame:
    """Row count, unique present ids and, for accepted rows, no missing share."""
    accepted = F.col("rejection_reason").isNull()
    missing = (F.col("population_total").isNull() | F.col("population_65plus").isNull()
               | F.col("share_65plus").isNull())
    counts = split.classified.agg(
        F.count("*").alias("source_row_count"),
        F.count_distinct("plr_id").alias("distinct_plr_count"),
        count_if(F.col("plr_id").isNull()).alias("blank_plr_count"),
        count_if(accepted & missing).alias("accepted_missing_count"))
    expected = F.lit(True) if expected_rows is None else (
        F.col("source_row_count") == expected_rows)
    return with_verdict(
        counts, expected, F.col("blank_plr_count") == 0,
        F.col("distinct_plr_count") + F.col("blank_plr_count") == F.col("source_row_count"),
        F.col("accepted_missing_count") == 0)


def zone_gate(raw: DataFrame) -> Split:
    """Classify raw zones, reproject the sound ones, and quarantine what the transform broke.

    ``raw`` follows ``schemas.RAW_ZONE``. Rings are compared with each other once, before the
    transform; after it closure and area are tested again. A zone in a system that has no
    transform here is quarantined as such.
    """
    g = F.col("geometry")
    keyed = raw.withColumn("plr_id", text.blank_to_null(F.col("plr_id_source")))
    flagged = flag_invalid(duplicate_zone_flags(keyed), ["source_sha256", "source_row_id"])
    first = text.first_match(
        (F.col("plr_id").isNull(), "missing_plr_id"),
        (F.col("geography_version").isNull(), "missing_geography_version"),
        (F.col("is_duplicate"), "duplicate_plr_id"),
        (g.isNull(), "missing_geometry"),
        (geom.is_empty("geometry"), "empty_geometry"),
        (F.col("srid").isNull() | (F.col("srid") == 0), "missing_srid"),
        (~geom.is_polygonal(F.col("geometry_type")), "non_polygonal_geometry"),
        (F.col("is_invalid"), "invalid_geometry"),
        (~is_supported(F.col("srid")), "unsupported_srid"))
    planar = (flagged.withColumn("rejection_reason", first)
              .withColumn("geometry", F.when(F.col("rejection_reason").isNull(),
                                             reproject(g, F.col("srid")))))
    sound = F.coalesce(geom.rings_are_closed("geometry") & (geom.area("geometry") > 0), F.lit(False))
    classified = planar.withColumn("rejection_reason", F.coalesce(
        "rejection_reason", F.when(~sound, "invalid_after_transform")))
    return Split.of(
        classified, ("plr_id", "geometry", "geography_version", "reference_date", "source_sha256"),
        ("source_sha256", "source_row_id", "plr_id", "geography_version", "rejection_reason"))


def zone_preconditions(raw: DataFrame) -> DataFrame:
    """A source must not be empty and must hold exactly one geography version."""
    counts = raw.agg(F.count("*").alias("source_row_count"),
                     F.count_distinct("geography_version").alias("geography_version_count"),
                     F.min("geography_version").alias("geography_version"))
    return with_verdict(counts, F.col("source_row_count") > 0,
                        F.col("geography_version_count") == 1)


def cell_gate(topology: DataFrame, vertices: DataFrame) -> Split:
    """Build a planar triangle per cell and quarantine those that cannot be one."""
    lons, lats = ([F.col(f"{axis}_{k}") for k in range(3)] for axis in ("lon", "lat"))
    any_missing, out_of_range = F.lit(False), F.lit(False)
    for lon, lat in zip(lons, lats):
        any_missing = any_missing | lon.isNull() | lat.isNull()
        out_of_range = out_of_range | text.outside(lon, -180, 180) | text.outside(lat, -90, 90)
    early = text.first_match(
        (F.col("vertex_count") != 3, "invalid_vertex_count"),
        (~F.col("corners_differ"), "repeated_vertex"),
        (any_missing, "missing_vertex_coordinate"),
        (out_of_range, "invalid_vertex_coordinate"))
    g = F.col("geometry")
    late = text.first_match(
        (F.col("_early").isNotNull(), "early"),
        (g.isNull(), "geometry_construction_failed"),
        (geom.is_empty("geometry"), "empty_geometry"),
        (~geom.rings_are_closed("geometry"), "invalid_geometry"),
        (F.col("icon_cell_area_m2") <= 0, "non_positive_area"),
        (geom.exterior_point_count("geometry") != 4, "not_triangular"))
    built = (triangles(topology, vertices).withColumn("_early", early)
             .withColumn("geometry", F.when(F.col("_early").isNull(), triangle_geometry()))
             .withColumn("icon_cell_area_m2", geom.area("geometry")))
    classified = built.withColumn("rejection_reason", F.coalesce("_early", late))
    return Split.of(classified, ("source_grid_id", "cell_index", "geometry", "icon_cell_area_m2"),
                    ("source_grid_id", "cell_index", "rejection_reason"))


def field_metadata_gate(metadata: DataFrame, contract: DataFrame,
                        expected_points: int | None = None) -> DataFrame:
    """First contract violation per field file; NULL where the metadata fits its key.

    ``metadata`` holds one row per (run_time_utc, lead_time, indicator) with the decoded
    header columns. The contract has five rows and is broadcast.
    """
    m = metadata.withColumn("_unit", text.unit_key(F.col("units")))
    c = contract.select("indicator", *[F.col(k).alias(f"c_{k}") for k in (
        "discipline", "parameter_category", "parameter_number", "surface_type",
        "surface_value")], F.transform("allowed_units", text.unit_key).alias("c_units"),
        F.lit(True).alias("_known"))

    def differs(column: str, wanted: str) -> Column:
        return ~F.col(column).eqNullSafe(F.col(wanted))

    missing = F.coalesce(F.col("numberOfMissing"), F.lit(0))
    points = F.col("numberOfPoints")
    wrong_points = F.lit(False) if expected_points is None else (
        points.isNotNull() & (points != expected_points))
    run, valid = (F.to_timestamp(F.col(f"source_{k}_time_utc")) for k in ("run", "valid"))
    reason = text.first_match(
        (F.col("_known").isNull(), "unsupported_indicator"),
        (~F.col("edition").eqNullSafe(F.lit(2)), "wrong_edition"),
        (differs("discipline", "c_discipline"), "wrong_discipline"),
        (differs("parameterCategory", "c_parameter_category"), "wrong_parameter_category"),
        (differs("parameterNumber", "c_parameter_number"), "wrong_parameter_number"),
        (differs("typeOfFirstFixedSurface", "c_surface_type"), "wrong_surface_type"),
        (differs("scaledValueOfFirstFixedSurface", "c_surface_value"), "wrong_surface_value"),
        (~F.coalesce(F.array_contains("c_units", F.col("_unit")), F.lit(False)),
         "unexpected_units"),
        (wrong_points, "wrong_point_count"),
        ((missing > 0) & (F.coalesce(F.col("bitmapPresent"), F.lit(0)) != 1),
         "missing_without_bitmap"),
        (run.isNull(), "missing_run_time"),
        (valid.isNull(), "missing_valid_time"),
        (run != F.col("run_time_utc"), "run_time_mismatch"),
        (~valid.eqNullSafe(valid_time(F.col("run_time_utc"), F.col("lead_time"))),
         "valid_time_mismatch"))
    return (m.join(F.broadcast(c), "indicator", "left").withColumn("rejection_reason", reason)
            .drop("_unit", "_known", *[n for n in c.columns if n.startswith("c_")]))


def missing_marker_audit(values: DataFrame, keys, marker: float = fields.MISSING_KELVIN
                         ) -> DataFrame:
    """Marker rows per field must equal the header's missing count, which needs a bitmap."""
    count = F.col("missing_count")
    audit = values.groupBy(*keys).agg(
        count_if(F.col("source_value") == marker).alias("marker_count"),
        F.coalesce(F.max("numberOfMissing"), F.lit(0)).alias("missing_count"),
        F.coalesce(F.max("bitmapPresent"), F.lit(0)).alias("bitmap_present"))
    return audit.withColumn("passed", passed(
        count >= 0, (count == 0) | (F.col("bitmap_present") == 1),
        (count == 0) | (F.col("marker_count") == count)))


def temperature_contract(field: DataFrame, expected_cells: int | None =
                         schemas.EXPECTED_CELL_COUNT, low_k: float = 253.0,
                         high_k: float = 313.0, tolerance: float = 1e-6,
                         group: tuple[str, ...] = ()) -> DataFrame:
    """Verdict per group over a temperature field, in one aggregate."""
    schemas.require_columns(field, ("cell_index", "run_time_utc", "valid_time_utc",
                                    "temperature_k", "temperature_c"), "temperature field")
    k, c = F.col("temperature_k"), F.col("temperature_c")
    observed = ~fields.is_missing_pair(k, c)
    seen_k = F.when(observed, k)
    finite = fields.is_finite(k) & fields.is_finite(c)
    grouped = field.groupBy(*group) if group else field
    counts = grouped.agg(
        F.count("*").alias("row_count"),
        count_if(F.col("cell_index").isNull()).alias("null_cell_count"),
        F.count_distinct("cell_index").alias("distinct_cell_count"),
        count_if(F.col("run_time_utc").isNull() | F.col("valid_time_utc").isNull())
        .alias("null_time_count"),
        F.count_distinct("run_time_utc").alias("run_time_count"),
        F.count_distinct("valid_time_utc").alias("valid_time_count"),
        count_if(fields.is_half_missing(k, c)).alias("half_missing_count"),
        count_if(~observed).alias("missing_count"),
        count_if(observed & ~F.coalesce(finite, F.lit(False))).alias("non_finite_count"),
        count_if(observed & finite & (F.abs(c - fields.celsius(k)) > tolerance))
        .alias("inconsistent_count"),
        F.min(fields.finite_or_null(seen_k)).alias("min_k"),
        F.max(fields.finite_or_null(seen_k)).alias("max_k"))
    rows = F.lit(True) if expected_cells is None else F.col("row_count") == expected_cells
    return counts.withColumn("passed", passed(
        rows, F.col("null_cell_count") == 0,
        F.col("distinct_cell_count") + F.col("null_cell_count") == F.col("row_count"),
        F.col("null_time_count") == 0, F.col("run_time_count") == 1,
        F.col("valid_time_count") == 1, F.col("half_missing_count") == 0,
        F.col("non_finite_count") == 0, F.col("inconsistent_count") == 0,
        F.coalesce(F.col("min_k") >= low_k, F.lit(True)),
        F.coalesce(F.col("max_k") <= high_k, F.lit(True))))


def population_contract(frame: DataFrame, expected_rows: int | None =
                        schemas.EXPECTED_ZONE_COUNT, expected_code: str | None = None) -> DataFrame:
    """Strict contract over a coerced snapshot that still carries its ``ZEIT`` code."""
    t, m, o = (F.col(c) for c in ("population_total", "population_65_79", "population_80plus"))
    both, share, code = F.col("population_65plus"), F.col("share_65plus"), F.col("ZEIT")
    counts = frame.agg(
        F.count("*").alias("row_count"),
        count_if(F.col("plr_id").isNull()).alias("blank_id_count"),
        F.count_distinct("plr_id").alias("distinct_id_count"),
        count_if(code.isNull()).alias("null_code_count"),
        F.count_distinct(code).alias("code_count"), F.min(code).alias("code"),
        count_if(t.isNull()).alias("missing_total_count"),
        count_if(t < 0).alias("negative_total_count"),
        count_if((m < 0) | (o < 0)).alias("negative_component_count"),
        count_if((m > t) | (o > t)).alias("component_exceeds_count"),
        count_if(both > t).alias("sum_exceeds_count"),
        count_if((share < 0) | (share > 1)).alias("share_range_count"))
    rows = F.lit(True) if expected_rows is None else F.col("row_count") == expected_rows
    right = F.lit(True) if expected_code is None else F.col("code") == expected_code
    zero = [F.col(c) == 0 for c in (
        "blank_id_count", "null_code_count", "missing_total_count", "negative_total_count",
        "negative_component_count", "component_exceeds_count", "sum_exceeds_count",
        "share_range_count")]
    return with_verdict(counts, rows, right, F.col("code_count") == 1,
                        F.col("distinct_id_count") + F.col("blank_id_count")
                        == F.col("row_count"), *zero)
