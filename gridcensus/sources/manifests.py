"""Provenance of fetched files, reuse decisions and run listings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridcensus.functions.forecast import parse_run
from gridcensus.functions.text import decode_percent

# Fixed value: run labels as they occur in listing pages.
RUN_IN_PAGE = r"\d{4}-\d{2}-\d{2}T\d{2}:\d{2}"
IDENTITY = ("indicator", "run_time_utc", "lead_time", "valid_time_utc", "sha256")


_HEAD = 256


def payload_problem(content: Column) -> Column:
    """Why binary content is no data file: empty, or a web page; NULL if it may be one.

    Blanks before the first mark don't count, however many: where the first ``_HEAD`` bytes don't
    show the mark's end, the whole content is looked at.
    """
    def mark(part: Column) -> Column:
        text = F.translate(F.decode(part, "ISO-8859-1"), "\t\n\r\f\v", "     ")
        return F.lower(F.substring(F.ltrim(text), 1, 16))

    head = mark(F.substring(content, 1, _HEAD))
    shown = F.when((F.length(head) < 16) & (F.length(content) > _HEAD), mark(content)).otherwise(head)
    return (F.when(F.length(content) == 0, "empty_payload")
            .when(shown.startswith("<html") | shown.startswith("<!doctype html"), "html_payload"))


def with_digest(df: DataFrame, content: str = "content") -> DataFrame:
    return df.select("*", F.sha2(F.col(content), 256).alias("sha256"),
                     F.length(content).cast("long").alias("size_bytes"),
                     payload_problem(F.col(content)).alias("payload_problem"))


def file_manifest(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """Path, size, hash and payload problem per file; the content itself is dropped.

    The reader skips files without content; ``with_expected_files`` brings them back.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return with_digest(reader.load(path)).drop("content")


def incremental_manifest(spark: SparkSession, path: str, known: DataFrame | None = None,
                         glob: str | None = None) -> DataFrame:
    """path, modified, size_bytes, sha256, payload_problem and rehashed per file.

    ``known`` is the manifest of an earlier look (stored). Files whose time and size are as they
    were keep its hash; the others' content is read. The listing reads no content, and the read of
    the changed files is bounded below by the oldest change, which the reader pushes down.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    files = reader.load(path).withColumnRenamed("modificationTime", "modified")
    columns = ["path", "modified", "size_bytes", "sha256", "payload_problem"]
    if known is None:
        return with_digest(files.drop("length")).select(*columns, F.lit(True).alias("rehashed"))
    listed = files.select("path", "modified", F.col("length").alias("size_bytes"))
    same = ["path", "modified", "size_bytes"]
    changed = listed.join(known.select(*same), same, "left_anti")
    oldest = changed.agg(F.min("modified")).first()[0]
    kept = known.select(*columns).join(listed, same, "left_semi").select(
        *columns, F.lit(False).alias("rehashed"))
    if oldest is None:
        return kept
    fresh = files.where(F.col("modified") >= F.lit(oldest)).drop("length").join(
        changed.select("path"), "path", "left_semi")
    return kept.unionByName(with_digest(fresh).select(*columns, F.lit(True).alias("rehashed")))


def with_expected_files(manifest: DataFrame, expected: DataFrame, key: str = "path") -> DataFrame:
    """Every expected file once; those the manifest lacks are empty or absent."""
    return expected.select(key).join(manifest, key, "left").withColumn(
        "payload_problem", F.when(F.col("sha256").isNull(), "empty_or_absent")
        .otherwise(F.col("payload_problem")))


def read_sidecars(spark: SparkSession, path: str) -> DataFrame:
    """JSON metadata beside retained files; unreadable documents have NULL columns."""
    schema = ("indicator string, run_time_utc timestamp, lead_time string, "
              "valid_time_utc timestamp, sha256 string, requested_url string, size_bytes long")
    return (spark.read.schema(schema).option("multiLine", True)
            .option("mode", "PERMISSIVE").json(path))


def sidecars_by_path(spark: SparkSession, path: str) -> DataFrame:
    """The sidecars ``<file>.json`` below a folder, with the path of the file they stand beside."""
    found = read_sidecars(spark, path).select("*", F.col("_metadata.file_path").alias("path"))
    return found.withColumn("path", F.regexp_replace("path", r"\.json$", ""))


def reuse_decision(retained: DataFrame, sidecars: DataFrame, key: str = "path") -> DataFrame:
    """``reuse`` when all five identity fields agree, ``missing`` without a sidecar, else
    ``replace``."""
    other = sidecars.select(key, *[F.col(c).alias(f"_s_{c}") for c in IDENTITY],
                            F.lit(True).alias("_has"))
    same = F.lit(True)
    for name in IDENTITY:
        same = same & F.col(name).eqNullSafe(F.col(f"_s_{name}"))
    status = (F.when(F.col("_has").isNull(), "missing").when(same, "reuse").otherwise("replace"))
    return (retained.join(other, key, "left").withColumn("decision", status)
            .drop("_has", *[f"_s_{c}" for c in IDENTITY]))


def advertised_runs(pages: DataFrame, html: str = "html") -> DataFrame:
    """Distinct run labels named anywhere in the pages, with their time."""
    labels = F.array_distinct(F.regexp_extract_all(
        decode_percent(F.col(html)), F.lit(f"({RUN_IN_PAGE})"), 1))
    return (pages.select(F.explode(labels).alias("run_text")).distinct()
            .withColumn("run_time_utc", parse_run(F.col("run_text"))))


def newest_first(runs: DataFrame) -> DataFrame:
    return runs.orderBy(F.desc("run_time_utc"))
