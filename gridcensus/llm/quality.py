"""Quality scores by nearest-neighbour voting over latent-semantic vectors.

A text becomes the relative frequencies of its terms: the runs of three bytes of the whole text,
hashed into ``GRAMS`` buckets, and marks for words that repeat, each weighted by its rarity among
the fitted texts. A truncated singular value decomposition of the labelled texts' term matrix
gives the latent space. Every document is projected into it and compared, by exact blocked cosine
products, with all labelled vectors; the labels of its nearest ones vote with their similarity as
weight.

The model is fitted on at most ``SAMPLE`` labelled rows, chosen by a hash of their ids, and has a
fixed size, so it can be broadcast: SAMPLE x rank vectors and TERMS x rank loadings. The rank and
the number of neighbours are those of ``RANKS`` and ``NEIGHBOURS`` under which these rows, each voted
on by the rows of the other ``INNER`` folds, are told apart best (mean share of both labels that is
right; in a tie the smaller rank, then more neighbours).
The held-out rows take no part in it. Scoring is a map over all documents without a shuffle, and
reads whole texts.

Defined results: a text without terms (NULL, empty) gets the share of label 1 among the fitted
rows; rows with a NULL id or label are not fitted on; of a document labelled more than once each
row counts; with no labelled row at all every score is 0.5; repeated documents score alike.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridcensus.llm import arrow_text
from gridcensus.session import ship_package

SAMPLE, RANKS, NEIGHBOURS, BLOCK = 4_000, (16, 32, 64), (5, 9, 15, 25), 512
ACCEPT = 0.3
FOLDS, INNER = 5, 4

GRAMS = 2048
MARKS = 3  # a word like the one before, a word like the one before that, any word
TERMS = GRAMS + MARKS


_WORD_BYTE = np.random.Generator(np.random.PCG64(7)).integers(1, 2**63, 256, dtype=np.uint64)


def term_counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(texts, TERMS) counts of a slice of UTF-8 bytes."""
    texts = len(offsets) - 1
    counts = np.zeros((texts, TERMS), np.float32)
    if not len(data):
        return counts
    wide = data.astype(np.uint32)
    run = ((wide[:-2] | wide[1:-1] << np.uint32(8) | wide[2:] << np.uint32(16))
           * np.uint32(2654435761)) >> np.uint32(21)  # the top eleven bits of the product
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    word = ~blank
    begins = word.copy()
    begins[1:] &= blank[:-1]
    starts = offsets[:-1][offsets[:-1] < offsets[1:]]
    begins[starts] |= word[starts]
    first = np.flatnonzero(begins)
    owner = np.searchsorted(offsets, first, "right") - 1
    hashes = np.add.reduceat(np.where(blank, np.uint64(0), _WORD_BYTE[data]), first) \
        if len(first) else np.zeros(0, np.uint64)
    for i in range(texts):
        a, b = offsets[i], offsets[i + 1]
        counts[i, :-MARKS] = np.bincount(run[a:max(a, b - 2)], minlength=GRAMS)
    again = np.zeros(len(first), bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
    earlier = np.zeros(len(first), bool)
    earlier[2:] = (hashes[2:] == hashes[:-2]) & (owner[2:] == owner[:-2])
    for mark, chosen in enumerate((again, earlier, np.ones(len(first), bool))):
        counts[:, GRAMS + mark] = np.bincount(owner[chosen], minlength=texts)
    return counts


def weighted(counts: np.ndarray, rarity: np.ndarray) -> np.ndarray:
    """Square roots of relative frequencies times rarity, at unit length; zero stays zero."""
    out = counts / np.maximum(counts[:, :-MARKS].sum(1, keepdims=True), 1)
    np.sqrt(out, out=out)
    out *= rarity
    out /= np.maximum(np.sqrt(np.einsum("ij,ij->i", out, out))[:, None], 1e-12)
    return out


@dataclass(frozen=True)
class Model:
    rarity: np.ndarray
    loadings: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    neighbours: int

    def project(self, counts: np.ndarray) -> np.ndarray:
        latent = weighted(counts, self.rarity) @ self.loadings
        return latent / np.maximum(np.sqrt((latent * latent).sum(1, keepdims=True)), 1e-12)

    def scores(self, counts: np.ndarray) -> np.ndarray:
        prior = float(self.labels.mean()) if len(self.labels) else 0.5
        out = np.full(len(counts), prior)
        filled = np.flatnonzero(counts.any(1))
        if not len(self.labels) or not len(filled):
            return out
        out[filled] = votes(self.project(counts[filled]), self.vectors, self.labels,
                            self.neighbours, prior)
        return np.clip(np.round(out, 6), 0, 1)


def votes(latent: np.ndarray, vectors: np.ndarray, labels: np.ndarray, neighbours: int,
          prior: float) -> np.ndarray:
    """Share of label 1 among the nearest vectors of each row, weighted by cosine, in blocks."""
    out, k = np.full(len(latent), prior), min(neighbours, len(labels))
    for at in range(0, len(latent), BLOCK):
        cosine = latent[at:at + BLOCK] @ vectors.T
        near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
        weight = np.maximum(np.take_along_axis(cosine, near, 1), 0)
        total = weight.sum(1)
        out[at:at + BLOCK] = np.where(total > 0, (weight * labels[near]).sum(1) / np.maximum(
            total, 1e-12), prior)
    return out


def chosen_shape(latent: np.ndarray, labels: np.ndarray, ranks: tuple[int, ...] = RANKS,
                 neighbours: tuple[int, ...] = NEIGHBOURS, folds: int = INNER,
                 accept: float = ACCEPT) -> tuple[int, int]:
    """The rank and the neighbours with which rows are told apart best by the rows of other folds.

    ``latent`` has the coordinates of the largest rank, of which smaller ranks take the first.
    """
    fold, best = np.arange(len(labels)) % folds, (-1.0, 0, 0)
    for rank in ranks:
        part = latent[:, :rank]
        part = part / np.maximum(np.sqrt((part * part).sum(1, keepdims=True)), 1e-12)
        for k in neighbours:
            right = np.zeros(len(labels), bool)
            for f in range(folds):
                mine, rest = fold == f, fold != f
                if mine.any() and rest.any():
                    found = votes(part[mine], part[rest], labels[rest], k, float(labels[rest].mean()))
                    right[mine] = (found >= accept) == (labels[mine] >= 0.5)
            shares = [right[labels == y].mean() for y in np.unique(labels)]
            best = max(best, (round(float(np.mean(shares)), 6), -rank, k))
    return -best[1], best[2]


def held_out(id_column: Column, folds: int = FOLDS) -> Column:
    return F.crc32(id_column.cast("string").cast("binary")) % folds == 0


def _counts_of(data: np.ndarray, offsets: np.ndarray):
    """Term counts of all texts, some at a time: a slice of short texts holds very many."""
    for _, _, part, at in arrow_text.slices(data, offsets):
        for first in range(0, len(at) - 1, BLOCK):
            cut = at[first:first + BLOCK + 1]
            yield term_counts(part[cut[0]:cut[-1]], cut - cut[0])


def _counted(batches):
    for batch in batches:
        data, offsets = arrow_text.flat_text(batch.column("text"))
        rows = [_packed(r) for part in _counts_of(data, offsets) for r in part]
        yield pa.record_batch({"label": batch.column("label"),
                               "counts": pa.array(rows, pa.binary())})


def _packed(counts: np.ndarray) -> bytes:
    """The terms that occur, then how often each, as 32-bit numbers: few of all terms do."""
    at = np.flatnonzero(counts)
    return np.concatenate([at.astype(np.float32), counts[at]]).tobytes()


def _unpacked(rows: list[bytes]) -> np.ndarray:
    out = np.zeros((len(rows), TERMS), np.float32)
    for row, raw in zip(out, rows):
        at, counts = np.frombuffer(raw, np.float32).reshape(2, -1)
        row[at.astype(np.int64)] = counts
    return out


def leading(matrix: np.ndarray, rank: int, extra: int = 16, rounds: int = 8) -> np.ndarray:
    """Leading right singular vectors by subspace iteration from a fixed random start."""
    start = np.random.Generator(np.random.PCG64(11)).standard_normal((matrix.shape[1], rank + extra))
    basis = np.linalg.qr(start.astype(np.float32))[0]
    for _ in range(rounds):
        basis = np.linalg.qr(matrix.T @ (matrix @ basis))[0]
    _, _, turn = np.linalg.svd(matrix @ basis, full_matrices=False)
    return np.ascontiguousarray((basis @ turn.T)[:, :rank])


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE,
        ranks: tuple[int, ...] = RANKS, neighbours: tuple[int, ...] = NEIGHBOURS,
        folds: int = FOLDS) -> Model:
    """Fit on at most ``sample`` labelled documents outside the held-out fold.

    The rows come to the driver as counts of the terms that occur, so what is gathered is bounded by
    ``sample`` times ``TERMS`` whatever the texts' lengths.
    """
    ship_package(docs.sparkSession)
    known = labels.select(F.col("doc_id"), F.col(label).cast("double").alias("label")).where(
        F.col("doc_id").isNotNull() & F.col("label").isNotNull() & ~held_out(F.col("doc_id"), folds))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(sample)
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select(
        "label", "text").mapInArrow(_counted, "label double, counts binary").collect()
    rows = sorted((r["label"], bytes(r["counts"])) for r in rows)
    truth = np.array([y for y, _ in rows])
    mixed = np.argsort([zlib.crc32(c) for _, c in rows], kind="stable")  # folds mix the labels
    counts = _unpacked([c for _, c in rows])
    del rows
    rarity = np.log1p(len(counts) / (1 + (counts > 0).sum(0))).astype(np.float32)
    matrix = weighted(counts, rarity)
    loadings = leading(matrix, max(ranks))
    rank, k = min(ranks), max(neighbours)
    if len(truth):
        rank, k = chosen_shape((matrix @ loadings)[mixed], truth[mixed], ranks, neighbours)
    loadings = np.ascontiguousarray(loadings[:, :rank])
    bare = Model(rarity, loadings, np.zeros((0, rank), np.float32), truth, k)
    return Model(rarity, loadings, bare.project(counts).astype(np.float32), truth, k)


def accepted(docs: DataFrame, model: Model, accept: float = ACCEPT) -> DataFrame:
    """The documents that the model does not reject, with their columns."""
    names = [f"k{i}" if c != "text" else c for i, c in enumerate(docs.columns)]
    scored = score(docs.toDF(*names), model, names, accept)
    return scored.where("predicted = 1").select(*[
        F.col(n).alias(c) for n, c in zip(names, docs.columns)])


def score(docs: DataFrame, model: Model, keep: list[str] | None = None,
          accept: float = ACCEPT) -> DataFrame:
    """Columns ``keep`` (doc_id if not given) of every document with score and predicted."""
    spark = docs.sparkSession
    ship_package(spark)
    keep = keep or ["doc_id"]
    named = [(f"_{i}", c) for i, c in enumerate(keep) if c != "text"]
    picked = docs.select("text", *[F.col(c).alias(n) for n, c in named])
    shared = spark.sparkContext.broadcast(model)
    kinds = dict(picked.dtypes)
    out_columns = [n for n, _ in named] + ["text"] * ("text" in keep)
    schema = "".join(f"{n} {kinds[n]}, " for n in out_columns)

    def run(batches):
        for batch in batches:
            data, offsets = arrow_text.flat_text(batch.column("text"))
            found = [shared.value.scores(counts) for counts in _counts_of(data, offsets)]
            found = np.concatenate(found) if found else np.zeros(0)
            yield pa.record_batch({n: batch.column(n) for n in out_columns} | {
                "_score": pa.array(found, pa.float64())})

    out = picked.mapInArrow(run, f"{schema}_score double")
    name_of = {c: n for n, c in named} | {"text": "text"}
    return out.select(*[F.col(name_of[c]).alias(c) for c in keep],
                      F.col("_score").alias("score"),
                      (F.col("_score") >= accept).cast("int").alias("predicted"))
