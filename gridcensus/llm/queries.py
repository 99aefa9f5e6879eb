"""Registered queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridcensus.llm import (best_fit, decontaminate, importance, line_dedup, near_text, near_vectors,
                            packing, prefix_trie, quality, secret_scan, shards, token_counts,
                            url_lists)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contained(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_text.near_groups(table(spark, sf_dir, "documents"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.cleaned(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_removed", "removed", "text")


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.shard(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.token_pieces(
        table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return packing.pack(pieces).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, model).select(
        "doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(table(spark, sf_dir, "documents"))


def op9_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors.near_vectors(table(spark, sf_dir, "embeddings"))


def op10_url_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return url_lists.evaluate(url_lists.dated_captures(pages), url_lists.derived_entries(pages))


def op11_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).select(
        "doc_id", "n_features", "weight", "score", "rank")


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


def op13_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit.pack(
        table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


QUERIES = {f.__name__: f for f in (
    op1_decontaminate, op2_near_dedup, op3_token_counts, op4_line_dedup, op5_sharding, op6_packing, op7_quality,
    op8_secret_scan, op9_near_vectors, op10_url_lists, op11_resampling, op12_prefix_trie,
    op13_best_fit)}
ORACLES = {"op1_decontaminate": decontaminate.SQL, "op10_url_lists": url_lists.SQL}
