"""Exact token counts of whole texts by compiled finite-state transducers.

Two transducers run in cascade. The first reads character classes and marks where the
pre-tokeniser's pieces begin; all chunks of all texts run side by side and their state maps are
composed by a parallel prefix scan (``chunk_scan``). The second reads a piece's bytes and emits
token counts (``count_transducer``); it runs once for each distinct piece of a slice.

Defined results: NULL and empty texts have 0 bytes and 0 tokens; a special token's string inside
a text is one token, as the public library counts it by default; repeated rows are counted each;
an empty table gives an empty result.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from gridcensus.llm import arrow_text, word_split
from gridcensus.llm.count_transducer import transducer
from gridcensus.llm.piece_table import PieceValues
from gridcensus.session import ship_package

SPECIAL = "<|endoftext|>"
LIMIT = 512


@cache
def _values(path: str) -> PieceValues:
    return PieceValues(transducer(path).counts, 300_000)


def count_slice(data: np.ndarray, offsets: np.ndarray, path: str) -> np.ndarray:
    """Tokens of each text of a slice of UTF-8 bytes."""
    texts = len(offsets) - 1
    marks = np.zeros(texts, np.int64)
    owner = np.arange(texts)
    special = SPECIAL.encode()
    if special in data.tobytes():
        parts, owner, mark = [], [], 0
        for i in range(texts):
            cut = data[offsets[i]:offsets[i + 1]].tobytes().split(special)
            parts += cut
            owner += [i] * len(cut)
            marks[i] = len(cut) - 1
        data = np.frombuffer(b"".join(parts), np.uint8)
        offsets = np.append(0, np.cumsum([len(p) for p in parts]))
        owner = np.array(owner)
    points, byte_at = arrow_text.code_points(data)
    ends = np.searchsorted(byte_at, offsets[1:])
    first, end, text, _ = word_split.pieces(points, ends, word_split.spaced())
    byte_at = np.append(byte_at, len(data))
    values, which = _values(path).of(data, byte_at[first], byte_at[end])
    return marks + np.bincount(owner[text], values[which], texts).astype(np.int64)


def token_counts(docs: DataFrame, path: str, id_column: str = "doc_id",
                 text_column: str = "text", limit: int = LIMIT) -> DataFrame:
    """One row per row of ``docs``: id, n_bytes, n_tokens, over_limit (n_tokens > limit).

    ``path`` names a byte-level vocabulary file that every worker can open. A map without a
    shuffle; only the two columns named are read.
    """
    ship_package(docs.sparkSession)
    picked = docs.select(docs[id_column].alias("doc_id"), docs[text_column].alias("text"))
    kind = dict(picked.dtypes)["doc_id"]

    def count(batches):
        for batch in batches:
            data, offsets = arrow_text.flat_text(batch.column("text"))
            tokens = [count_slice(part, at, path)
                      for _, _, part, at in arrow_text.slices(data, offsets)]
            tokens = np.concatenate(tokens) if tokens else np.zeros(0, np.int64)
            yield pa.record_batch({
                "doc_id": batch.column("doc_id"), "n_bytes": pa.array(np.diff(offsets)),
                "n_tokens": pa.array(tokens), "over_limit": pa.array(tokens > limit)})

    return picked.mapInArrow(
        count, f"doc_id {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean")
