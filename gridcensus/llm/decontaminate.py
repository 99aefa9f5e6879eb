"""Benchmark decontamination: which documents contain which test items.

An item is contained if at least ``THRESHOLD`` of its distinct five-word shingles occur in the
document. A document is far longer than an item, so their Jaccard similarity says little; what
is sketched is the item. Items are partitioned by size (powers of two of their shingle count).
Every partition has its own MinHash sketch length: the k smallest hashes of an item, with k one
more than the shingles that a contained item of that partition may lack. A document that contains
the item therefore holds at least one of the k, whatever its length: the search has no false
negatives. A candidate is verified by exact containment over all shingles of the item.

An item of one to four words is one shingle of all of them; where the benchmark has such items,
the documents are probed with runs of those lengths as well.

Search: the documents' shingles probe the sketches (broadcast when counted to be small, else a
shuffled join). Verification reads the candidate documents again and counts.

Defined results: words are lower-case runs of letters and digits; items without words are never
found; NULL or empty texts and items give nothing; a repeated pair
of ids is judged once, over the rows that share them; empty tables give an empty result; other
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gridcensus.llm.words import SHINGLE, SIMILARITY, shingle_rows, small, word_hashes
from gridcensus.session import cut_lineage

THRESHOLD = SIMILARITY


def sketches(items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Distinct shingles of every item: item_id, shingle, words (its length), size, in_sketch.

    ``in_sketch`` marks the k smallest under a second hash, k by the item's size partition.
    """
    hashed = items.select("item_id", word_hashes(F.col("text")).alias("_words"))
    rows = shingles_of(hashed.where(F.size("_words") >= SHINGLE), "item_id", [SHINGLE])
    for length in range(1, SHINGLE):
        rows = rows.unionByName(shingles_of(hashed.where(F.size("_words") == length), "item_id", [length]))
    rows = rows.distinct()
    item = Window.partitionBy("item_id")
    upper = F.pow(F.lit(2.0), F.ceil(F.log2("size")))
    length = upper - F.ceil(upper * threshold - 1e-9) + 1
    order = F.row_number().over(item.orderBy(F.xxhash64("shingle", F.lit("sketch")), "shingle"))
    return rows.withColumn("size", F.count("*").over(item)).select(
        "item_id", "shingle", "words", "size", (order <= length).alias("in_sketch"))


def shingles_of(hashed: DataFrame, key: str, lengths: list[int]) -> DataFrame:
    """key, shingle and its number of words, for all runs of the given lengths."""
    parts = [shingle_rows(hashed, [key], length=n).withColumn("words", F.lit(n)) for n in lengths]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    return rows


def contained(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Pairs doc_id, item_id with n_shingles (of the item), n_found and containment."""
    known = cut_lineage(sketches(items, threshold))
    n_known = known.count()
    lengths = sorted(r["words"] for r in known.select("words").distinct().collect()) or [SHINGLE]
    same = ["shingle", "words"]
    hashed = docs.select("doc_id", word_hashes(F.col("text")).alias("_words"))
    probes = known.where("in_sketch").select(*same).distinct()
    candidates = cut_lineage(shingles_of(hashed, "doc_id", lengths).join(
        small(probes, n_known), same, "left_semi").select("doc_id").distinct())
    chosen = docs.select("doc_id", "text").join(
        small(candidates, candidates.count()), "doc_id", "left_semi")
    rows = shingles_of(chosen.select("doc_id", word_hashes(F.col("text")).alias("_words")),
                       "doc_id", lengths)
    hits = rows.join(small(known.select(*same, "item_id", "size"), n_known), same)
    return hits.groupBy("doc_id", "item_id", "size", "shingle").agg(F.lit(1)).groupBy(
        "doc_id", "item_id", F.col("size").alias("n_shingles")).agg(
        F.count("*").alias("n_found")).where(
        F.col("n_found") >= F.ceil(F.col("n_shingles") * threshold - 1e-9)).withColumn(
        "containment", F.round(F.col("n_found") / F.col("n_shingles"), 6))


def without_contaminated(docs: DataFrame, items: DataFrame,
                         threshold: float = THRESHOLD) -> DataFrame:
    """The documents that contain no item, with their columns."""
    found = cut_lineage(contained(docs, items, threshold).select("doc_id").distinct())
    return docs.join(small(found, found.count()), "doc_id", "left_anti").select(docs.columns)


SQL = r"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'),
                                      lambda x: x <> '') AS a FROM documents),
b AS (SELECT item_id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'),
                                  lambda x: x <> '') AS a FROM benchmark),
k AS (SELECT DISTINCT least(len(a), 5) AS k FROM b WHERE len(a) > 0),
ds AS (SELECT DISTINCT doc_id, array_to_string(a[i:i+k-1], ' ') AS g
       FROM (SELECT doc_id, a, k, unnest(range(1, len(a) - k + 2)) AS i FROM d, k)),
bs AS (SELECT DISTINCT item_id, array_to_string(a[i:i+k-1], ' ') AS g
       FROM (SELECT item_id, a, least(len(a), 5) AS k, unnest(range(1, len(a) - least(len(a), 5) + 2)) AS i
             FROM b WHERE len(a) > 0)),
n AS (SELECT item_id, count(*) AS n_shingles FROM bs GROUP BY item_id)
SELECT doc_id, item_id, n_shingles, count(*) AS n_found,
       round(count(*) / n_shingles, 6) AS containment
FROM ds JOIN bs USING (g) JOIN n USING (item_id)
GROUP BY doc_id, item_id, n_shingles
HAVING count(*) >= ceil(n_shingles * 0.8 - 1e-9)
"""
