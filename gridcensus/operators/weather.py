"""Fields to cells to zones: combine, area-weight, stamp, join to population, summarise.

All operators take many forecasts at once and group by forecast, so one job covers any
number of partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from gridcensus import schemas
from gridcensus.functions.fields import (indicator_bit, nan_to_null, output_value,
                                         wind_speed)
from gridcensus.functions.forecast import run_label, valid_time
from gridcensus.operators.aggregates import count_if, max_where, weighted_mean, weighted_sum
from gridcensus.operators.joins import explained_join, latest_partition, unmatched_keys
from gridcensus.operators.skew import is_small, lookup_join
from gridcensus.operators.verdict import passed

FORECAST = ("run_time_utc", "lead_time", "valid_time_utc")
# Output column of each indicator after unit conversion.
VALUE_COLUMNS = {
    "T_2M": "temperature_c",
    "RELHUM_2M": "relative_humidity_percent",
    "TD_2M": "dew_point_temperature_c",
    "U_10M": "wind_u_10m_ms",
    "V_10M": "wind_v_10m_ms",
}


def explode_fields(decoded: DataFrame, values: str = "values") -> DataFrame:
    """Decoded arrays to long rows; the position in the array is the cell index."""
    keys = [c for c in decoded.columns if c != values]
    return (decoded.select(*keys, F.posexplode(values).alias("cell_index", "source_value"))
            .withColumn("source_value", nan_to_null(F.col("source_value").cast("double"))))


def restrict_to_cells(field: DataFrame, cells: DataFrame, small: bool | None = None
                      ) -> DataFrame:
    """Keep only rows of the listed cells; runs map-side when the list is small."""
    wanted = cells.select("cell_index").distinct()
    return lookup_join(field, wanted, ["cell_index"], "left_semi",
                       [c for c in (*FORECAST, "indicator") if c in field.columns], small=small)


def combine_fields(field: DataFrame) -> DataFrame:
    """Long fields to one row per cell with converted values and the wind speed.

    One shuffle on the cell key replaces four joins. Like a chain of inner joins, only
    cells present in all five fields come out; ``field_identity_audit`` counts the rest.
    Wind speed is taken per cell, before any averaging.
    """
    value = nan_to_null(F.col("source_value"))
    converted = field.withColumn("_v", output_value(F.col("indicator"), value))
    wide = converted.groupBy("cell_index", *FORECAST).agg(
        *[max_where(F.col("_v"), F.col("indicator") == i).alias(c)
          for i, c in VALUE_COLUMNS.items()],
        *[count_if(F.col("indicator") == i).alias(f"_n_{i}") for i in VALUE_COLUMNS])
    for i in VALUE_COLUMNS:
        wide = wide.filter(F.col(f"_n_{i}") > 0)
    return (wide.withColumn("wind_speed_10m_ms",
                            wind_speed(F.col("wind_u_10m_ms"), F.col("wind_v_10m_ms")))
            .select("cell_index", *FORECAST, *schemas.WEATHER_VALUES))


def field_identity_audit(field: DataFrame) -> DataFrame:
    """Per forecast: five fields, no repeated cell in a field, every first-field cell combined."""
    bits = F.bit_or(indicator_bit(F.col("indicator")))
    by_cell = field.groupBy("cell_index", *FORECAST).agg(
        F.count("*").alias("rows"), F.bit_count(bits).alias("indicators"),
        count_if(F.col("indicator") == "T_2M").alias("first_rows"))
    counts = by_cell.groupBy(*FORECAST).agg(
        F.sum("first_rows").alias("expected_rows"),
        count_if(F.col("indicators") == 5).alias("combined_rows"),
        count_if(F.col("rows") > F.col("indicators")).alias("repeated_cells"))
    return counts.withColumn("passed", passed(
        F.col("combined_rows") == F.col("expected_rows"), F.col("repeated_cells") == 0))


def aggregate_to_zones(weather: DataFrame, bridge: DataFrame,
                       values: Sequence[str] = schemas.WEATHER_VALUES,
                       small: bool | None = None, forecasts: DataFrame | None = None) -> DataFrame:
    """Area-weighted mean per zone and forecast, missing-preserving.

    The weather is first reduced to bridge cells. Every zone of the bridge comes out for every
    forecast; one of which some bridge cell has no weather row gets NULL values, and
    ``bridge_coverage`` names those cells' forecasts. ``forecasts`` names the forecasts where
    the weather may lack some; without it they are those of the weather.
    """
    zone = [c for c in ("plr_id", "geography_version") if c in bridge.columns]
    small = is_small(bridge) if small is None else small
    sizes = bridge.groupBy(*zone).agg(F.count("*").alias("_cells"))
    links = bridge.select(*zone, "cell_index", F.col("fraction_of_plr").alias("_w")).join(
        sizes, zone, "inner")
    joined = lookup_join(weather.select("cell_index", *FORECAST, *values), links,
                         ["cell_index"], "inner", [*FORECAST], small=small)
    means = joined.groupBy(*zone, *FORECAST).agg(
        F.count("*").alias("_met"), F.max("_cells").alias("_cells"),
        *[weighted_mean(F.col(v), F.col("_w")).alias(v) for v in values])
    known = (weather if forecasts is None else forecasts).agg(
        F.collect_set(F.struct(*FORECAST))).scalar()
    expected = sizes.select(*zone, F.explode(known).alias("_f")).select(*zone, "_f.*")
    whole = F.col("_met") == F.col("_cells")
    return expected.join(means, [*zone, *FORECAST], "left").select(
        *zone, *FORECAST, *[F.when(whole, F.col(v)).alias(v) for v in values])


def bridge_coverage(weather: DataFrame, bridge: DataFrame, kept: DataFrame | None = None
                    ) -> DataFrame:
    """Per forecast: how many bridge cells the weather lacks. ``kept`` may name the weather's rows
    of bridge cells."""
    cells = bridge.select("cell_index").distinct()
    total = cells.agg(F.count("*").alias("n")).scalar()
    kept = restrict_to_cells(weather, cells) if kept is None else kept
    present = kept.groupBy(*FORECAST).agg(
        F.count_distinct("cell_index").alias("matched_cell_count"))
    forecasts = weather.select(*FORECAST).distinct()
    counts = (forecasts.join(present, list(FORECAST), "left").fillna(0)
              .withColumn("missing_cell_count", total - F.col("matched_cell_count")))
    return counts.withColumn("passed", F.col("missing_cell_count") == 0)


def missing_bridge_cells(weather: DataFrame, bridge: DataFrame, limit: int = 10) -> DataFrame:
    """First bridge cells that no forecast covers."""
    return unmatched_keys(bridge, weather, ["cell_index"]).orderBy("cell_index").limit(limit)


def plr_weather(field: DataFrame, bridge: DataFrame, forecasts: DataFrame | None = None,
                kept: DataFrame | None = None) -> DataFrame:
    """Zone weather for every forecast in ``field``, one without a complete cell included.

    ``forecasts`` (the identity columns) may name what the field holds; else a scan of the
    field's identity columns does. ``kept`` may name the field's rows of bridge cells.
    """
    small = is_small(bridge)
    kept = restrict_to_cells(field, bridge, small) if kept is None else kept
    named = (field if forecasts is None else forecasts).select(*FORECAST)
    return aggregate_to_zones(combine_fields(kept), bridge, small=small, forecasts=named)


def plr_weather_population(weather: DataFrame, accepted: DataFrame, rejected: DataFrame,
                           small: bool | None = None) -> DataFrame:
    """Zone weather with population, or with the reason the population is missing."""
    return explained_join(weather, accepted, rejected, "plr_id",
                          ("population_total", "population_65plus", "share_65plus"),
                          [*FORECAST], small=small)


def plr_temperature(temperature: DataFrame, bridge: DataFrame) -> DataFrame:
    """Weighted temperature sums per zone with the weight sum and the cells used.

    ``temperature``: cell_index, run_time_utc, valid_time_utc, temperature_k, temperature_c.
    """
    identity = [c for c in FORECAST if c in temperature.columns]
    joined = lookup_join(temperature, bridge.select("plr_id", "cell_index", "fraction_of_plr"),
                         ["cell_index"], "inner", identity)
    w = F.col("fraction_of_plr")
    return joined.groupBy("plr_id", *identity).agg(
        weighted_sum(F.col("temperature_c"), w).alias("temperature_c"),
        weighted_sum(F.col("temperature_k"), w).alias("temperature_k"),
        F.count_distinct("cell_index").alias("icon_cells_used"),
        F.sum(w).alias("weight_sum"))


def temperature_audit(temperature: DataFrame, bridge: DataFrame, tolerance: float = 1e-6
                      ) -> DataFrame:
    """Per forecast: duplicate or missing bridge cells, missing values, bad weight sums."""
    identity = [c for c in FORECAST if c in temperature.columns]
    cells = bridge.select("cell_index").distinct()
    total = cells.agg(F.count("*").alias("n")).scalar()
    kept = restrict_to_cells(temperature, bridge)
    per_cell = kept.groupBy("cell_index", *identity).agg(
        F.count("*").alias("rows"),
        count_if(F.col("temperature_c").isNull()).alias("missing"))
    held = per_cell.groupBy(*identity).agg(
        count_if(F.col("rows") > 1).alias("duplicate_cell_count"),
        F.count("*").alias("_held"), F.sum("missing").alias("missing_value_count"))
    counts = temperature.select(*identity).distinct().join(held, identity, "left").fillna(0).select(
        *identity, "duplicate_cell_count", (total - F.col("_held")).alias("missing_cell_count"),
        "missing_value_count")
    bad = plr_temperature(temperature, bridge).groupBy(*identity).agg(
        count_if(F.abs(F.col("weight_sum") - 1) > tolerance).alias("bad_weight_count"))
    zero = [F.col(c) == 0 for c in ("duplicate_cell_count", "missing_cell_count",
                                    "missing_value_count", "bad_weight_count")]
    return counts.join(bad, identity, "left").fillna(0, ["bad_weight_count"]).withColumn(
        "passed", passed(*zero))


def newest_forecast(field: DataFrame, forecasts: DataFrame | None = None) -> DataFrame:
    """The field rows of the newest run at its first lead.

    ``forecasts`` (run_time_utc, lead_time) may name what there is, else the field's own keys
    do. The two filters prune partitions and are pushed below whatever reads the rows.
    """
    known = (field if forecasts is None else forecasts).select("run_time_utc", "lead_time")
    run = known.agg(F.max("run_time_utc")).scalar()
    lead = known.filter(F.col("run_time_utc") == known.agg(F.max("run_time_utc")).scalar()).agg(
        F.min("lead_time")).scalar()
    return field.filter((F.col("run_time_utc") == run) & (F.col("lead_time") == lead))


def current_exposure(final: DataFrame) -> DataFrame:
    """Newest run, its first lead."""
    return latest_partition(final, [F.desc("run_time_utc"), F.asc("lead_time")],
                            ["run_time_utc", "lead_time"])


def partition_summary(final: DataFrame, values: Sequence[str] = schemas.WEATHER_VALUES
                      ) -> DataFrame:
    """One row per produced partition: sizes, missing values and population states."""
    counts = [F.count("*").alias("row_count"), F.count_distinct("plr_id").alias("plr_count"),
              *[F.count_if(F.col(v).isNull()).alias(f"{v}_null_count") for v in values]]
    if "population_status" in final.columns:
        counts += [count_if(F.col("population_status") == s).alias(f"{s}_count")
                   for s in schemas.POPULATION_STATUSES]
    return final.groupBy(*FORECAST).agg(*counts)


def observe_partition(final: DataFrame, name: str, values: Sequence[str] =
                      schemas.WEATHER_VALUES):
    """The frame with counters collected while it is written, and their observation."""
    seen = Observation(name)
    return final.observe(seen, F.count(F.lit(1)).alias("row_count"), *[
        F.count_if(F.col(v).isNull()).alias(f"{v}_null_count") for v in values]), seen


def with_valid_time(field: DataFrame) -> DataFrame:
    return field.withColumn("valid_time_utc",
                            valid_time(F.col("run_time_utc"), F.col("lead_time")))


def with_partition_labels(df: DataFrame) -> DataFrame:
    return df.withColumn("run_label", run_label(F.col("run_time_utc"))).withColumn(
        "lead_label", F.col("lead_time"))


def mask_fields(field: DataFrame, mask: DataFrame, sources: DataFrame | None = None
                ) -> tuple[DataFrame, DataFrame]:
    """Masked rows and the manifest with source, missing and retained counts per field.

    Both come from the same rows tagged with whether the mask keeps them: the manifest is one
    partial aggregate, the masked rows one filter.
    """
    kept = mask.select("cell_index").distinct().withColumn("_kept", F.lit(True))
    tagged = lookup_join(field, kept, ["cell_index"], "left", [*FORECAST, "indicator"])
    manifest = tagged.groupBy(*FORECAST, "indicator").agg(
        F.count("*").alias("source_point_count"),
        F.count_if(F.col("source_value").isNull()).alias("source_missing_value_count"),
        count_if(F.col("_kept")).alias("retained_point_count"))
    if sources is not None:
        manifest = manifest.join(sources, [*FORECAST, "indicator"], "left")
    return tagged.filter(F.col("_kept")).drop("_kept"), manifest
