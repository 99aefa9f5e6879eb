"""Table schemas, the indicator contract and the default expectations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Default expectations of the checks. All are parameters.
EXPECTED_ZONE_COUNT = 542
EXPECTED_VERTEX_COUNT = 272_089
EXPECTED_CELL_COUNT = 542_040
DEFAULT_WEIGHT_TOLERANCE = 1e-6
DEFAULT_MASK_BUFFER_M = 5000
PLANAR_SRID = 25833
GEOGRAPHIC_SRID = 4326
LEAD_TIMES = ("PT000H00M", "PT001H00M", "PT002H00M", "PT006H00M", "PT012H00M", "PT024H00M")
FIRST_RUN = "2026-08-13 00:00:00"
CANDIDATE_RUNS = 3
MAX_ATTEMPTS = 5
POPULATION_STATUSES = ("available", "rejected_source_record")

# Indicator, output column, discipline, category, number, surface type,
# surface value, parameter id, allowed units.
INDICATOR_CONTRACT = (
    ("T_2M", "temperature_k", 0, 0, 0, 103, 2, 500011, ("k", "kelvin")),
    ("RELHUM_2M", "relative_humidity_percent", 0, 1, 1, 103, 2, 500036, ("%", "percent")),
    ("TD_2M", "dew_point_temperature_k", 0, 0, 6, 103, 2, 500017, ("k", "kelvin")),
    ("U_10M", "wind_u_10m_ms", 0, 2, 2, 103, 10, 500027, ("m/s", "ms-1", "ms**-1", "ms^-1")),
    ("V_10M", "wind_v_10m_ms", 0, 2, 3, 103, 10, 500029, ("m/s", "ms-1", "ms**-1", "ms^-1")),
)
INDICATORS = tuple(row[0] for row in INDICATOR_CONTRACT)

WEATHER_VALUES = (
    "temperature_c",
    "relative_humidity_percent",
    "dew_point_temperature_c",
    "wind_u_10m_ms",
    "wind_v_10m_ms",
    "wind_speed_10m_ms",
)

POINT = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])
RING = T.ArrayType(POINT)
POLYGON = T.ArrayType(RING)
MULTIPOLYGON = T.ArrayType(POLYGON)


_TYPES = {
    "string": T.StringType(), "bigint": T.LongType(), "int": T.IntegerType(),
    "double": T.DoubleType(), "date": T.DateType(), "timestamp": T.TimestampType(),
    "multipolygon": MULTIPOLYGON,
}


def _schema(text: str) -> T.StructType:
    """Fields from ``name type`` pairs, without needing a running session."""
    pairs = (field.split() for field in text.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


RAW_POPULATION = _schema(
    "source_row_id bigint, plr_id_source string, population_total_source string, "
    "population_65_79_source string, population_80plus_source string, "
    "reference_code_source string, reference_date date, publication_date date, "
    "source_path string, source_sha256 string, source_url string, publisher string, "
    "loaded_at_utc timestamp")
RAW_ZONE = _schema(
    "source_row_id bigint, plr_id_source string, geometry_type string, geometry multipolygon, "
    "srid int, source_crs string, geography_version string, reference_date date, "
    "source_path string, source_sha256 string, source_url string, publisher string, "
    "license string")
RAW_GRID_SOURCE = _schema(
    "source_grid_id string, source_path string, source_sha256 string, source_url string, "
    "vertex_count bigint, cell_count bigint")
RAW_GRID_VERTEX = _schema(
    "source_grid_id string, vertex_index int, longitude_deg double, latitude_deg double")
RAW_GRID_CELL_VERTEX = _schema(
    "source_grid_id string, cell_index int, vertex_order int, vertex_index int")
RAW_FIELD_SOURCE = _schema(
    "run_time_utc timestamp, lead_time string, indicator string, valid_time_utc timestamp, "
    "source_grid_id string, geography_version string, mask_buffer_m int, source_unit string, "
    "source_url string, raw_path string, source_sha256 string, source_point_count bigint, "
    "source_missing_value_count bigint, retained_point_count bigint")
RAW_FIELD = _schema(
    "run_time_utc timestamp, lead_time string, indicator string, cell_index int, "
    "source_value double")
ZONE = _schema(
    "plr_id string, geometry multipolygon, geography_version string, reference_date date, "
    "source_sha256 string")
CELL = _schema(
    "source_grid_id string, cell_index int, geometry multipolygon, icon_cell_area_m2 double")
ZONE_REJECTED = _schema(
    "source_sha256 string, source_row_id bigint, plr_id string, geography_version string, "
    "rejection_reason string, rejected_at_utc timestamp")
CELL_REJECTED = _schema(
    "source_grid_id string, cell_index int, rejection_reason string, rejected_at_utc timestamp")
BRIDGE = _schema(
    "plr_id string, geography_version string, source_grid_id string, cell_index int, "
    "intersection_area_m2 double, plr_area_m2 double, icon_cell_area_m2 double, "
    "fraction_of_plr double, fraction_of_icon_cell double")
MASK = _schema(
    "geography_version string, source_grid_id string, mask_buffer_m int, cell_index int, "
    "created_at_utc timestamp")
POPULATION_ACCEPTED = _schema(
    "plr_id string, population_total bigint, population_65_79 bigint, "
    "population_80plus bigint, population_65plus bigint, share_65plus double, "
    "reference_date date, publication_date date, source_sha256 string")
POPULATION_REJECTED = _schema(
    "plr_id string, population_total bigint, population_65_79 bigint, "
    "population_80plus bigint, population_65plus bigint, share_65plus double, "
    "rejection_reason string, reference_date date, publication_date date, "
    "source_sha256 string, rejected_at_utc timestamp")
PLR_WEATHER = _schema(
    "plr_id string, geography_version string, run_time_utc timestamp, lead_time string, "
    "valid_time_utc timestamp, " + ", ".join(f"{c} double" for c in WEATHER_VALUES))
PLR_WEATHER_POPULATION = T.StructType(PLR_WEATHER.fields + _schema(
    "population_total bigint, population_65plus bigint, share_65plus double, "
    "population_status string, population_rejection_reason string").fields)

PRIMARY_KEYS = {
    "zone": ("plr_id", "geography_version"),
    "cell": ("source_grid_id", "cell_index"),
    "bridge": ("plr_id", "geography_version", "source_grid_id", "cell_index"),
    "mask": ("geography_version", "source_grid_id", "mask_buffer_m", "cell_index"),
    "population_accepted": ("reference_date", "plr_id"),
    "population_rejected": ("plr_id", "reference_date"),
    "field": ("run_time_utc", "lead_time", "indicator", "cell_index"),
    "plr_weather": ("run_time_utc", "lead_time", "plr_id", "geography_version"),
}


def indicator_contract(spark: SparkSession) -> DataFrame:
    """The five-row contract dimension: codes, surface and allowed units per indicator."""
    return spark.createDataFrame(
        [(*row[:8], list(row[8])) for row in INDICATOR_CONTRACT],
        "indicator string, output_column string, discipline int, parameter_category int, "
        "parameter_number int, surface_type int, surface_value int, parameter_id int, "
        "allowed_units array<string>")


def require_columns(df: DataFrame, names, what: str = "frame") -> DataFrame:
    """Fail when a required column is absent; the frame passes through unchanged."""
    missing = sorted(set(names) - set(df.columns))
    if missing:
        raise ValueError(f"{what} is missing required columns: {missing}")
    return df


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project onto a table schema: declared columns only, declared types, in order."""
    require_columns(df, schema.names)
    return df.select([df[f.name].cast(f.dataType).alias(f.name) for f in schema.fields])
