"""Vector bin packing of token pieces into sequences of fixed length.

A sequence is a bin with three limits at once: tokens, segments (pieces it holds) and
loss-bearing tokens. The first ``PROMPT`` ids of a document (at most half of it) are its prompt
and bear no loss, the rest is its answer. The loss limit leaves room for one prompt beside a
sequence full of answers, and the segment limit is what prompts alone come to. Bins are filled one at a time: of the piece kinds that still fit, the one
whose demand has the largest dot product with the bin's remaining room goes in (each dimension
as a share of its limit), until none fits. Pieces of one demand are interchangeable, so a pick
looks at the distinct demands only.

Documents of at most two prompts' length stay whole. Others are cut after the prompt, and answers into as many pieces of the loss limit as they
hold, then a rest. The pieces are packed, without their ids, in groups of bounded size chosen by a hash of the document; group
after group is independent, so a lost task repeats with the same result.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridcensus.llm import arrow_text
from gridcensus.llm.token_ids import word_ids
from gridcensus.session import cut_lineage, ship_package

END_ID, PROMPT = 1, 64


@dataclass(frozen=True)
class Limits:
    tokens: int = 2048
    segments: int = 32
    loss: int = 2048 - PROMPT


#: Rests that one packing task takes; a group loses at most a few bins' worth of padding.
GROUP_ROWS = 20_000


def token_pieces(docs: DataFrame, path: str, limits: Limits = Limits(),
                 with_ids: bool = False, prompt: int = PROMPT) -> DataFrame:
    """Cut every longer document into its prompt and pieces of its answer that fit the limits.

    Columns: doc_id, start, length, loss (ids that bear loss: none of the prompt), ids_crc32 over little-endian unsigned 32-bit ids, doc_tokens, and ``ids`` on request. A NULL
    or empty text is one piece with the end id alone.
    """
    ship_package(docs.sparkSession)
    picked = docs.select("doc_id", "text")
    size = min(limits.tokens, limits.loss)
    kind = dict(picked.dtypes)["doc_id"]
    schema = (f"doc_id {kind}, start bigint, length bigint, loss bigint, ids_crc32 bigint, "
              "doc_tokens bigint" + ", ids array<bigint>" * with_ids)

    def cut(batches):
        for batch in batches:
            data, offsets = arrow_text.flat_text(batch.column("text"))
            for first, end, part, at in arrow_text.slices(data, offsets):
                rows, ids_of = [], []
                for row, ids in enumerate(word_ids(path).of(part, at), first):
                    ids = np.append(ids, np.uint32(END_ID)).astype("<u4")
                    asked = min(prompt, len(ids) // 2)
                    cuts = [0, len(ids)]
                    if len(ids) > min(2 * prompt, size):
                        cuts = [*range(0, asked, limits.tokens), *range(asked, len(ids), size), len(ids)]
                    for start, end in zip(cuts[:-1], cuts[1:]):
                        piece = ids[start:end]
                        rows.append((row, start, len(piece), end - max(start, min(asked, end)),
                                     zlib.crc32(piece.tobytes()), len(ids)))
                        if with_ids:
                            ids_of.append(piece.astype(np.int64))
                columns = np.array(rows, np.int64).T
                out = {"doc_id": batch.column("doc_id").take(pa.array(columns[0]))} | dict(zip(
                    ("start", "length", "loss", "ids_crc32", "doc_tokens"),
                    map(pa.array, columns[1:])))
                if with_ids:
                    out["ids"] = pa.array(ids_of, pa.list_(pa.int64()))
                yield pa.record_batch(out)

    return picked.mapInArrow(cut, schema)


def fill(tokens: np.ndarray, loss: np.ndarray, limits: Limits) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset in the bin) of each piece, by the dot-product rule; ties go to the larger
    token count, then to the larger loss. Every piece alone must fit in a bin."""
    demand, kind = np.unique(np.stack([tokens, loss], 1), axis=0, return_inverse=True)
    demand, kind = demand[::-1], len(demand) - 1 - kind.reshape(-1)
    waiting = np.argsort(kind, kind="stable")
    left = np.bincount(kind, minlength=len(demand))
    taken = np.append(0, np.cumsum(left))[:-1].copy()
    share = demand / np.array([limits.tokens, limits.loss])
    bin_of, offset_of = np.empty(len(tokens), np.int64), np.empty(len(tokens), np.int64)
    number, remaining = 0, len(tokens)
    while remaining:
        room_tokens, room_loss, segments = limits.tokens, limits.loss, limits.segments
        offset = 0
        while segments:
            fits = (left > 0) & (demand[:, 0] <= room_tokens) & (demand[:, 1] <= room_loss)
            if not fits.any():
                break
            room = room_tokens / limits.tokens, room_loss / limits.loss
            score = share[:, 0] * room[0] + share[:, 1] * room[1] + segments / limits.segments**2
            best = int(np.argmax(np.where(fits, score, -1.0)))
            row = waiting[taken[best]]
            taken[best] += 1
            left[best] -= 1
            bin_of[row], offset_of[row] = number, offset
            offset += int(demand[best, 0])
            room_tokens -= int(demand[best, 0])
            room_loss -= int(demand[best, 1])
            segments -= 1
            remaining -= 1
        if not offset:
            raise ValueError("a piece exceeds the limits of a sequence")
        number += 1
    return bin_of, offset_of


def pack(pieces: DataFrame, limits: Limits = Limits(), group_rows: int = GROUP_ROWS) -> DataFrame:
    """Add sequence_id and offset to pieces with doc_id, start, length and loss.

    Pieces that fill a sequence's tokens get one each, without a shuffle. The rest are dealt to groups of
    about ``group_rows`` by a hash of (doc_id, start), which no document or source can crowd.
    Rows that repeat are packed each. Sequence ids are unique, not consecutive: the group in the
    high bits, the bin in the low 32.
    """
    ship_package(pieces.sparkSession)
    pieces = cut_lineage(pieces)
    full = F.col("length") == limits.tokens
    counted = pieces.agg(F.count(F.when(~full, 1)).alias("rest")).first()
    groups = max(1, -(-counted["rest"] // group_rows))
    rest = pieces.where(~full).withColumn(
        "_group", F.pmod(F.xxhash64("doc_id", "start"), F.lit(groups)).cast("int"))
    schema = pieces.schema.simpleString()[len("struct<"):-1].replace(":", " ")

    def place(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["doc_id", "start"], kind="stable", ignore_index=True)
        number, offset = fill(group["length"].to_numpy(), group["loss"].to_numpy(), limits)
        group["sequence_id"] = (group["_group"].astype("int64") + 1) * 2**32 + number
        group["offset"] = offset
        return group.drop(columns="_group")

    placed = rest.groupBy("_group").applyInPandas(
        place, f"{schema}, sequence_id bigint, offset bigint")
    alone = pieces.where(full).withColumn(
        "sequence_id", -1 - F.monotonically_increasing_id()).withColumn(
        "offset", F.lit(0).cast("bigint"))
    return placed.unionByName(alone)
