"""GeoJSON zone layers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridcensus.functions import geom
from gridcensus.functions.projection import to_geographic_geometry
from gridcensus.functions.text import blank_to_null, epsg_code

# Id columns in order of preference.
ID_CANDIDATES = ("plr_id", "PLR_ID", "RAUMID", "raumid", "PLR", "plr")

_GEOMETRY = T.StructType([T.StructField("type", T.StringType()),
                          T.StructField("coordinates", T.StringType())])
_FEATURE = T.StructType([
    T.StructField("properties", T.MapType(T.StringType(), T.StringType())),
    T.StructField("geometry", _GEOMETRY)])
_CRS = T.StructType([T.StructField("properties", T.MapType(T.StringType(), T.StringType()))])
_COLLECTION = T.StructType([T.StructField("crs", _CRS),
                            T.StructField("features", T.ArrayType(_FEATURE))])


def find_id_column(names: Sequence[str], candidates: Sequence[str] = ID_CANDIDATES) -> str:
    for candidate in candidates:
        if candidate in names:
            return candidate
    raise ValueError(f"no zone id column among {sorted(names)}")


def _points(ring: Column) -> Column:
    return F.transform(ring, lambda p: F.struct(p[0].alias("x"), p[1].alias("y")))


def decode_geometry(kind: Column, coordinates: Column) -> Column:
    """GeoJSON coordinate text to the nested geometry model; other types give NULL."""
    single = F.from_json(coordinates, "array<array<array<double>>>")
    multi = F.from_json(coordinates, "array<array<array<array<double>>>>")
    return (F.when(kind == "Polygon", F.array(F.transform(single, _points)))
            .when(kind == "MultiPolygon", F.transform(
                multi, lambda poly: F.transform(poly, _points))))


def read_features(spark: SparkSession, path: str, line_delimited: bool = False) -> DataFrame:
    """One row per feature: properties, geometry_type, geometry, source_crs, srid.

    ``line_delimited`` reads one feature per line and splits large files over tasks; a
    single FeatureCollection document is one record by its format. It is parsed from its text:
    the reader of JSON files would go back to the file for every feature's coordinates.
    """
    if line_delimited:
        features = spark.read.schema(_FEATURE).json(path).withColumn(
            "source_crs", F.lit(None).cast("string"))
    else:
        whole = spark.read.text(path, wholetext=True)
        doc = whole.select(F.from_json(F.ltrim("value", F.lit("\ufeff")), _COLLECTION).alias("d")
                           ).select("d.*")
        features = doc.select(F.col("crs.properties")["name"].alias("source_crs"),
                              F.explode("features").alias("f")).select("source_crs", "f.*")
    crs = F.coalesce("source_crs", F.lit("EPSG:4326"))
    srid = F.when(crs.contains("CRS84"), 4326).otherwise(epsg_code(crs))
    return features.select(
        "properties", F.col("geometry.type").alias("geometry_type"),
        decode_geometry(F.col("geometry.type"), F.col("geometry.coordinates")).alias("geometry"),
        crs.alias("source_crs"), srid.alias("srid"))


def read_zones(spark: SparkSession, path: str, geography_version: str, source_sha256: str,
               reference_date: str | None = None, candidates: Sequence[str] = ID_CANDIDATES,
               line_delimited: bool = False) -> DataFrame:
    """Raw zone rows with the id column found by preference."""
    features = read_features(spark, path, line_delimited)
    present = features.agg(*[F.max(F.map_contains_key("properties", F.lit(c))).alias(c)
                             for c in candidates]).first()
    names = [c for c in candidates if present[c]]
    plr = blank_to_null(F.col("properties")[find_id_column(names, candidates)],
                        any_whitespace=True)
    row_id = F.xxhash64(F.to_json("properties"), "geometry_type", F.to_json("geometry"))
    return features.select(
        row_id.alias("source_row_id"), plr.alias("plr_id_source"), "geometry_type", "geometry",
        "srid", "source_crs", F.lit(geography_version).alias("geography_version"),
        F.lit(reference_date).cast("date").alias("reference_date"),
        F.lit(path).alias("source_path"), F.lit(source_sha256).alias("source_sha256"))


def write_points_geojson(df: DataFrame, path: str, properties: Sequence[str],
                         longitude: str = "longitude", latitude: str = "latitude") -> None:
    """One GeoJSON point feature per line."""
    feature = F.struct(
        F.lit("Feature").alias("type"), F.struct(*properties).alias("properties"),
        F.struct(F.lit("Point").alias("type"),
                 F.array(longitude, latitude).alias("coordinates")).alias("geometry"))
    df.select(F.to_json(feature).alias("value")).write.mode("overwrite").text(path)


def geographic(zones: DataFrame) -> DataFrame:
    """Planar zones with longitude and latitude coordinates."""
    return zones.withColumn("geometry", to_geographic_geometry(F.col("geometry")))


def with_extent(zones: DataFrame) -> DataFrame:
    return zones.withColumn("box", geom.bounds("geometry"))
