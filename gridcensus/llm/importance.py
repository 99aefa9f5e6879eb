"""Resampling a corpus towards a target distribution of hashed n-grams.

Features of a text are its runs of one to three words, hashed into ``BUCKETS`` buckets by crc32.
The importance of a bucket is the log ratio of its smoothed share in the target texts to that in
the corpus, in thousandths; a document's weight is the sum over its features. Each document adds
Gumbel noise drawn from a hash of its id, and the highest scores are drawn: sampling without
replacement by weight, alike on every run.

A 256-byte table lower-cases A-Z and blanks every other byte that is no word byte;
``bytes.translate`` and ``bytes.split`` then give the words. The crc32 of an n-gram goes on from
that of its first words (``zlib.crc32`` takes the value so far as its seed). Counters collect the
buckets of a task and are summed; both count tables have at most ``BUCKETS`` rows, whatever the
corpus. The corpus is read twice, for counts and for scores, and never shuffled: ranks come
from one range exchange of ids and scores. A text is split in pieces of ``PIECE`` bytes that carry
two words over, so that a very long one needs little memory.

Defined results: a NULL or empty text or target has no features; documents without features
weigh 0; a NULL id hashes as an empty one and comes last among ties; rows that repeat an id are
documents each, scored and ranked each (between fully equal rows the order is arbitrary); an
empty target or corpus counts 0 everywhere; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridcensus.llm.words import small
from gridcensus.session import cut_lineage, ship_package

BUCKETS, LEAST_WORDS, PERCENT, SEED, PIECE = 10_000, 20, 5, 42, 1_000_000

WORD_BYTES = bytes(range(0x30, 0x3A)) + bytes(range(0x61, 0x7B)) + bytes(range(0x80, 0x100))
TABLE = bytes(b if b in WORD_BYTES else b + 32 if 0x41 <= b <= 0x5A else 32 for b in range(256))


def word_pieces(text: bytes, most: int = PIECE) -> Iterator[list[bytes]]:
    """The words of a text in order, some ``most`` bytes of them at a time."""
    clean, at = text.translate(TABLE), 0
    while at < len(clean):
        end = clean.find(b" ", at + most)
        end = len(clean) if end < 0 else end
        yield clean[at:end].split()
        at = end


def features(text: bytes, most: int = PIECE) -> Iterator[tuple[int, list[int]]]:
    """Pieces of a text: how many words, and the crc32 of each run of one to three words that
    ends there."""
    carried: list[bytes] = []
    for new in word_pieces(text, most):
        words, old = carried + new, len(carried)
        spaced = [b" " + w for w in words]
        ones = list(map(crc32, words))
        twos = list(map(crc32, spaced[1:], ones))
        threes = list(map(crc32, spaced[2:], twos))
        yield len(new), ones[old:] + twos[max(old - 1, 0):] + threes[max(old - 2, 0):]
        carried = words[-2:]


def buckets(crcs: list[int]) -> np.ndarray:
    return np.array(crcs, np.int64) % BUCKETS


def _bytes(df: DataFrame, *columns: str) -> DataFrame:
    ship_package(df.sparkSession)
    return df.select(*columns, F.coalesce("text", F.lit("")).cast("binary").alias("raw"))


def bucket_counts(texts: DataFrame) -> np.ndarray:
    """Features of all texts in each bucket."""
    def count(batches):
        found: Counter = Counter()
        for batch in batches:
            for raw in batch.column("raw"):
                for _, crcs in features(raw.as_py()):
                    found.update(buckets(crcs).tolist())
        yield pa.record_batch({"bucket": pa.array(list(found.keys()), pa.int32()),
                               "n": pa.array(list(found.values()), pa.int64())})

    rows = _bytes(texts).mapInArrow(count, "bucket int, n bigint")
    total = np.zeros(BUCKETS, np.int64)
    for row in rows.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # at most BUCKETS
        total[row.bucket] = row.n
    return total


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    all_corpus, all_target = float(corpus.sum()) + BUCKETS, float(target.sum()) + BUCKETS
    return np.array([math.floor(1000 * math.log(
        (t + 1.0) * all_corpus / ((s + 1.0) * all_target)))
        for s, t in zip(corpus.tolist(), target.tolist())], np.int64)


def noise(doc_id: object, seed: int = SEED) -> int:
    """Gumbel noise of a document in thousandths."""
    name = f"{seed}:{'' if doc_id is None else doc_id}"
    h = int(hashlib.sha256(name.encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(docs: DataFrame, gain: np.ndarray, seed: int = SEED) -> DataFrame:
    """doc_id, n_features, n_words, weight and score of every document."""
    kind = dict(docs.select("doc_id").dtypes)["doc_id"]

    def score(batches):
        for batch in batches:
            rows = []
            for raw, doc_id in zip(batch.column("raw"), batch.column("name").to_pylist()):
                words = n = weight = 0
                for more, crcs in features(raw.as_py()):
                    words += more
                    n += len(crcs)
                    weight += int(gain[buckets(crcs)].sum())
                rows.append((n, words, weight, weight + noise(doc_id, seed)))
            columns = np.array(rows, np.int64).reshape(-1, 4).T
            yield pa.record_batch({"doc_id": batch.column("doc_id")} | dict(zip(
                ("n_features", "n_words", "weight", "score"), map(pa.array, columns))))

    named = docs.withColumn("name", F.col("doc_id").cast("string"))
    return _bytes(named, "doc_id", "name").mapInArrow(
        score, f"doc_id {kind}, n_features bigint, n_words bigint, weight bigint, score bigint")


def ranked(rows: DataFrame, least_words: int = LEAST_WORDS, percent: int = PERCENT) -> DataFrame:
    """Add rank 1, 2, 3... to the highest scores among documents of enough words; NULL else.

    One range exchange orders the rows; a row's place is its number there plus the rows of the
    earlier ranges. The row number breaks ties last, so equal rows are spread over ranges too.
    """
    rows = cut_lineage(rows.withColumn("_row", F.monotonically_increasing_id()))
    enough = rows.where(F.col("n_words") >= least_words).count()
    order = [F.col("n_words") < least_words, F.col("score").desc(), F.col("doc_id").asc_nulls_last(),
             F.col("_row")]
    ordered = cut_lineage(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(
        "_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", 33)
    sizes = ordered.groupBy(part.alias("_part")).agg(F.count("*").alias("n")).collect()  # partitions
    before, held = [], 0
    for row in sorted(sizes):
        before.append((row["_part"], held))
        held += row["n"]
    starts = rows.sparkSession.createDataFrame(before, "_part bigint, _before bigint")
    place = F.col("_before") + F.col("_at").bitwiseAND(2**33 - 1) + 1
    drawn = enough * percent // 100
    return ordered.withColumn("_part", part).join(small(starts, len(before)), "_part").withColumn(
        "rank", F.when(place <= drawn, place)).drop("_part", "_before", "_at", "_row")


def resample(docs: DataFrame, target: DataFrame) -> DataFrame:
    """doc_id, n_features, n_words, weight, score and rank (NULL if not drawn) of every document."""
    gain = gains(bucket_counts(docs), bucket_counts(target))
    return ranked(scored(docs, gain))
