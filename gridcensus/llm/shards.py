"""Sharding by histogram sort: near-equal bytes per shard, one exchange of rows.

Rows are ordered by a hash of the text, then a hash of the id, so equal texts lie side by side.
Splitters are found without sorting: each round counts, over all partitions, the exact bytes
below a set of candidate boundaries, and narrows every splitter's interval until a candidate is
within tolerance of its target. Only those counts reach the driver (at most ``PROBES`` a round).
Boundaries lie between groups of equal texts. Where a group lies across a target, the boundary
goes to its nearer end; only a group that alone has more bytes than a shard is cut inside.

Slots number a shard's rows from 0 without gaps. A shard is cut into parts by a second hash;
parts are counted first, and each part is numbered on its own, so no task holds a whole shard.

Defined results: a NULL or empty text has size 16 and checksum 0; rows that repeat get a slot
each; an empty table gives an empty result; columns of the input named like an output are
replaced, all others kept whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gridcensus.llm.words import small
from gridcensus.session import cut_lineage, ship_package

SHARDS, ROW_BYTES, PROBES, TOLERANCE, PART_ROWS = 40, 16, 640, 0.001, 100_000
_HALF = 2**63
_END = 2**128


OUTPUTS = ("size", "text_crc32", "shard", "slot")


def keyed(docs: DataFrame) -> DataFrame:
    """The columns as c0, c1... with size, text_crc32 and the order key (_high, _low)."""
    at = docs.columns.index
    rows = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    text = F.coalesce(F.col(f"c{at('text')}"), F.lit(""))
    return rows.withColumns({
        "size": (F.octet_length(text) + ROW_BYTES).cast("bigint"),
        "text_crc32": F.crc32(text.cast("binary")),
        "_high": F.xxhash64(text), "_low": F.xxhash64(F.col(f"c{at('doc_id')}"), F.lit("order"))})


def _counter(probes: list[int]):
    """Sums bytes by how many probes are at or below a row's key."""
    high = np.array([p >> 64 for p in probes], np.uint64)
    low = np.array([p & (2**64 - 1) for p in probes], np.uint64)

    def run(batches):
        total, rows = np.zeros((2, len(probes) + 1), np.int64)
        for batch in batches:
            size = batch.column("size").to_numpy()
            a, b = (batch.column(c).to_numpy().astype(np.uint64) ^ np.uint64(_HALF)
                    for c in ("_high", "_low"))
            below = np.searchsorted(high, a, "left")
            level = np.searchsorted(high, a, "right") - below
            for i in np.flatnonzero(level):
                below[i] += np.searchsorted(low[below[i]:below[i] + level[i]], b[i], "right")
            total += np.bincount(below, size, len(total)).astype(np.int64)
            rows += np.bincount(below, minlength=len(total))
        at = np.flatnonzero(rows)
        yield pa.record_batch({"probe": pa.array(at), "bytes": pa.array(total[at]),
                               "rows": pa.array(rows[at])})

    return run


def splitters(keys: DataFrame, shards: int = SHARDS, probes: int = PROBES,
              tolerance: float = TOLERANCE) -> list[int]:
    """The shards - 1 boundaries, as 128-bit keys, over stored ``keys`` (_high, _low, size).

    A splitter is settled once a candidate is within ``tolerance`` of a shard's bytes, or no
    boundary is left between its two nearest ones. Candidates are ends of groups (whole high
    words) until only one group is left that is larger than a shard.
    """
    total, rows = keys.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("*")).first()
    targets = [total * k // shards for k in range(1, shards)]
    near = total / shards * tolerance
    low = [(0, 0, 0)] * len(targets)  # boundary, bytes and rows below it
    high = [(_END, total, rows)] * len(targets)
    found: dict[int, int] = {}
    inside: set[int] = set()  # splitters whose target lies in a group larger than a shard
    while len(found) < len(targets):
        todo = [k for k in range(len(targets)) if k not in found]
        each = max(3, probes // len(todo))
        tried = set()
        for k in todo:
            a, b = low[k][0], high[k][0]
            grain = 1 if k in inside else 2**64
            tried |= {(a + (b - a) * i // (each + 1)) // grain * grain
                      for i in range(1, each + 1)} - {a, b}
        tried = sorted(tried)
        counted = keys.select("_high", "_low", "size").mapInArrow(
            _counter(tried), "probe bigint, bytes bigint, rows bigint").groupBy("probe").agg(
            F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows")).collect()
        by_probe = np.zeros((len(tried) + 1, 2), np.int64)
        for row in counted:
            by_probe[row["probe"]] = row["bytes"], row["rows"]
        below = np.cumsum(by_probe, 0)[:-1].tolist()
        for k in todo:
            for probe, (size, count) in zip(tried, below):
                if size <= targets[k] and probe > low[k][0]:
                    low[k] = probe, size, count
                if size > targets[k] and probe < high[k][0]:
                    high[k] = probe, size, count
            best = min(low[k], high[k], key=lambda e: abs(e[1] - targets[k]))
            gap = high[k][0] - low[k][0]
            alone = high[k][2] - low[k][2] <= 1 or gap <= (1 if k in inside else 2**64)
            if alone and k not in inside and gap <= 2**64 and (
                    high[k][2] - low[k][2] > 1 and (high[k][1] - low[k][1]) * shards > total):
                inside.add(k)
            elif abs(best[1] - targets[k]) <= near or alone:
                found[k] = best[0]
    return [found[k] for k in range(len(targets))]


def shard_of(boundaries: list[int]) -> Column:
    """How many boundaries are at or below a row's key."""
    number = F.lit(0)
    for boundary in boundaries:
        high, low = (boundary >> 64) - _HALF, (boundary & (2**64 - 1)) - _HALF
        if boundary >= _END:
            continue
        number = number + ((F.col("_high") > high) | (F.col("_high") == high)
                           & (F.col("_low") >= low)).cast("int")
    return number


def shard(docs: DataFrame, shards: int = SHARDS, part_rows: int = PART_ROWS) -> DataFrame:
    """The rows with size, text_crc32, shard (0 to shards - 1) and slot (from 0 in each shard)."""
    ship_package(docs.sparkSession)
    keys = cut_lineage(keyed(docs).select("_high", "_low", "size"))
    number = shard_of(splitters(keys, shards))
    parts = max(1, -(-keys.count() // (shards * part_rows)))
    part = F.pmod("_low", F.lit(parts)).cast("int")
    counts = keys.groupBy(number.alias("shard"), part.alias("_part")).agg(
        F.count("*").alias("_rows"))
    before = Window.partitionBy("shard").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = cut_lineage(counts.select("shard", "_part", F.coalesce(
        F.sum("_rows").over(before), F.lit(0)).alias("_offset")))
    within = Window.partitionBy("shard", "_part").orderBy("_high", "_low")
    rows = keyed(docs).withColumns({"shard": number, "_part": part})
    numbered = rows.withColumn("slot", F.row_number().over(within) - 1).join(
        small(offsets, offsets.count()), ["shard", "_part"]).withColumn(
        "slot", (F.col("slot") + F.col("_offset")).cast("bigint"))
    return numbered.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)
                             if c not in OUTPUTS], *OUTPUTS)
