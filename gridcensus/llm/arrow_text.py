"""Arrow string columns as flat byte arrays, in slices of bounded size.

Operators that read whole texts byte by byte work on these slices inside ``mapInArrow``, so a
task holds one Arrow batch and the work arrays of one slice. A slice has at most ``SLICE_BYTES``
of text unless one text alone is longer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1_000_000


def flat_text(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts one after the other, and the n + 1 offsets; NULL counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:][:len(column) + 1]
    data = column.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(data: np.ndarray, offsets: np.ndarray,
           most: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets from 0) of consecutive rows."""
    first, n = 0, len(offsets) - 1
    while first < n:
        end = int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1
        end = min(max(end, first + 1), n)
        yield (first, end, data[offsets[first]:offsets[end]],
               offsets[first:end + 1] - offsets[first])
        first = end


def row_slices(batches: Iterator[pa.RecordBatch], column: str = "text",
               most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of all batches in slices whose texts have about ``most`` bytes, one row at least."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        offsets = np.append(0, np.cumsum(sizes, dtype=np.int64) + 64 * np.arange(1, len(sizes) + 1))
        first = 0
        while first < batch.num_rows:
            end = int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1
            end = min(max(end, first + 1), batch.num_rows)
            yield batch.slice(first, end - first)
            first = end


def code_points(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of valid UTF-8 bytes, and the byte position of each."""
    points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    return points, np.flatnonzero((data & 0xC0) != 0x80)
