"""Best-fit decreasing packing of token pieces into sequences, exact over the whole corpus.

Pieces are taken from the longest to the shortest, and each goes into the open sequence with the
least room that still holds it; where none does, a new one is opened. The open sequences are kept
in a segment tree over remaining capacities, which finds the tightest in logarithmic time.

Lengths are whole numbers up to the sequence size, so the choices depend on the lengths' histogram
only, at most ``size`` rows. ``plan`` makes them for runs of pieces of equal length and runs of
sequences of equal room at a time: the tightest sequence stays the tightest until the length no
longer fits, so a run of n sequences takes whole multiples. The plan has a row per such step, whose
number is bounded by the size (each sequence meets at most sqrt(2 size) different lengths), never
by the corpus. Each piece then finds its step by its length and its rank among the pieces of that
length. Ranks are counted while the pieces are cut, per task, and shifted by the counts of the
earlier tasks: no piece is shuffled by its length, so a length that a third of all pieces share
lands in no single task.

Defined results: a NULL or empty text is one piece with the end id alone; only documents longer
than the size are cut; rows that repeat are packed each; pieces of one length are interchangeable,
so ties change ids of sequences, never their number; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gridcensus.llm import arrow_text
from gridcensus.llm.token_ids import word_ids
from gridcensus.llm.words import small
from gridcensus.session import cut_lineage, ship_package

SIZE, END_ID = 2048, 0


class Capacities:
    """How many open sequences have each remaining capacity, as a segment tree of sums."""

    def __init__(self, size: int):
        self._base = 1 << size.bit_length()
        self._sums = [0] * (2 * self._base)

    def add(self, capacity: int, sequences: int) -> None:
        node = self._base + capacity
        while node:
            self._sums[node] += sequences
            node //= 2

    def tightest(self, least: int) -> int | None:
        """The smallest capacity of at least ``least`` that an open sequence has."""
        node, sums = self._base + least, self._sums
        if sums[node]:
            return least
        while node > 1 and (node % 2 or not sums[node + 1]):
            node //= 2
        if node <= 1:
            return None
        node += 1
        while node < self._base:
            node = 2 * node + (not sums[2 * node])
        return node - self._base


def plan(counts: dict[int, int], size: int = SIZE) -> np.ndarray:
    """Steps of best-fit decreasing for ``counts`` pieces of each length, one row each.

    Columns: length, first rank, first sequence, pieces of the step per sequence, and their offset
    there. The step holds the ranks up to the next step of the same length.
    """
    tree, runs = Capacities(size), [[] for _ in range(size + 1)]
    steps, opened = [], 0

    def leave(first: int, n: int, capacity: int) -> None:
        if n and capacity:
            runs[capacity].append((first, n))
            tree.add(capacity, n)

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            capacity = tree.tightest(length)
            if capacity is None:
                n = -(-left // (size // length))
                leave(opened, n, size)
                opened += n
                continue
            first, n = runs[capacity].pop()
            tree.add(capacity, -n)
            each = capacity // length
            full = min(n, left // each)
            rest = left - full * each if full < n else 0
            used = full + (rest > 0)
            steps.append((length, rank, first, each, size - capacity))
            leave(first, full, capacity - each * length)
            leave(first + full, int(rest > 0), capacity - rest * length)
            leave(first + used, n - used, capacity)
            rank += full * each + rest
            left -= full * each + rest
    return np.array(sorted(steps), np.int64).reshape(-1, 5)


def ranks(lengths: np.ndarray, seen: np.ndarray) -> np.ndarray:
    """Rank of each piece among those of its length, after the ``seen`` ones, which it updates."""
    order = np.argsort(lengths, kind="stable")
    ordered = lengths[order]
    out = np.empty(len(lengths), np.int64)
    out[order] = np.arange(len(lengths)) - np.searchsorted(ordered, ordered) + seen[ordered]
    seen += np.bincount(lengths, minlength=len(seen))
    return out


def cut(docs: DataFrame, path: str, size: int = SIZE) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, and the task (part) and rank there by length."""
    ship_package(docs.sparkSession)
    picked = docs.select("doc_id", "text")
    kind = dict(picked.dtypes)["doc_id"]

    def pieces(batches):
        part, seen = TaskContext.get().partitionId(), np.zeros(size + 1, np.int64)
        for batch in batches:
            data, offsets = arrow_text.flat_text(batch.column("text"))
            for first, _, bytes_, at in arrow_text.slices(data, offsets):
                rows = []
                for row, ids in enumerate(word_ids(path).of(bytes_, at), first):
                    ids = np.append(ids, np.uint32(END_ID)).astype("<u4")
                    for piece, start in enumerate(range(0, len(ids), size)):
                        held = ids[start:start + size]
                        rows.append((row, piece, start, len(held), zlib.crc32(held.tobytes())))
                row, piece, start, length, crc = np.array(rows, np.int64).T
                yield pa.record_batch({
                    "doc_id": batch.column("doc_id").take(pa.array(row)),
                    "piece": pa.array(piece.astype(np.int32)), "start": pa.array(start),
                    "length": pa.array(length), "ids_crc32": pa.array(crc),
                    "part": pa.array(np.full(len(row), part, np.int32)),
                    "place": pa.array(ranks(length, seen))})

    return picked.mapInArrow(pieces, f"doc_id {kind}, piece int, start bigint, length bigint, "
                                     "ids_crc32 bigint, part int, place bigint")


def pack(docs: DataFrame, path: str, size: int = SIZE) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece."""
    pieces = cut_lineage(cut(docs, path, size))
    counts = cut_lineage(pieces.groupBy("part", "length").agg(F.count("*").alias("n")))
    histogram = counts.groupBy("length").agg(F.sum("n").alias("n")).collect()  # at most size rows
    steps = plan({r.length: r.n for r in histogram}, size)
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = counts.select("part", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).cast(
        "bigint").alias("earlier"))
    ranked = pieces.join(small(shifts, counts.count()), ["part", "length"])
    kind = dict(pieces.dtypes)["doc_id"]

    def place(batches):
        keys = steps[:, 0] << 44 | steps[:, 1]
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("place").to_numpy() + batch.column("earlier").to_numpy()
            step = np.searchsorted(keys, length << 44 | rank, "right") - 1
            _, first_rank, first, each, offset = steps[step].T
            number, at = np.divmod(rank - first_rank, each)
            yield pa.record_batch({
                **{n: batch.column(n) for n in ("doc_id", "piece", "start", "length", "ids_crc32")},
                "sequence_id": pa.array(first + number), "offset": pa.array(offset + at * length)})

    return ranked.mapInArrow(place, f"doc_id {kind}, piece int, start bigint, length bigint, "
                                    "ids_crc32 bigint, sequence_id bigint, offset bigint")
