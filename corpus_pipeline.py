"""From raw documents to packed training sequences, stage by stage.

Every stage reads what its predecessor kept as a Parquet table and returns the columns of
``documents``, until the last, which returns the placed pieces. No stage samples or caps rows.

Defined results: needed are ``doc_id`` and ``text``; other columns go through as they are, whatever
their names, except that ``n_chars``, where there is one, follows a text that was cut. NULL and
empty texts stay until packing, where they are one end id; a row without an id is judged by its
text and never dropped as a copy or for a benchmark item; rows that repeat an id are documents
each; an empty table gives an empty result at every stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridcensus.llm import decontaminate, line_dedup, near_text, packing, quality
from gridcensus.session import cut_lineage, release_stored, stored_paths


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labelled ones, does not reject."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.accepted(docs, quality.fit(docs, labels))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later repeats of runs of lines go; a document goes if nothing but blanks is left of it."""
    inner = {c: c if c in ("doc_id", "text") else f"c{i}" for i, c in enumerate(docs.columns)}
    found = line_dedup.cleaned(docs.toDF(*inner.values()))
    cut = F.col("n_removed") > 0
    emptied = cut & (F.trim(F.regexp_replace("text", r"\s+", " ")) == "")
    left = found.where(~F.coalesce(emptied, F.lit(False)))
    kinds = dict(docs.dtypes)
    return left.select(*[
        F.when(cut, F.length("text").cast(kinds[c])).otherwise(F.col(n)).alias(c)
        if c == "n_chars" else F.col(n).alias(c) for c, n in inner.items()])


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return near_text.deduplicated(docs)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    return decontaminate.without_contaminated(
        docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents placed in sequences of 2048 tokens."""
    pieces = packing.token_pieces(docs, public_tokenizers.path("word_bpe_49k.json"))
    return packing.pack(pieces).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


STAGES = [("quality", quality_stage), ("line_dedup", line_stage), ("near_dedup", near_stage),
          ("decontaminate", benchmark_stage), ("packing", packing_stage)]

#: Neither the classifier nor the similarity search can be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn; the copies that a stage made are deleted when it is done."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = stored_paths()
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
        release_stored(spark, [p for p in stored_paths()[:-1] if p not in before])
    return STAGES[-1][1](spark, docs, sf_dir)
