"""Prefix trie of conversations: which openings they share, and what sharing them saves.

A turn is named by 128 bits of a hash of its role and text; texts are read once and never
shuffled. Conversations become rows of turn names and are dealt to shards by ranges of the whole
sequence, then the id, so that the conversations below one node lie side by side and a
conversation that a third of all repeat is spread as well.

In a shard the turn names become small numbers in a padded matrix, which ``numpy.lexsort``
orders. A row starts a node of depth d if any of its first d columns differs from the row above:
an or-accumulated change mask per column, taken ``WIDTH`` columns at a time over the rows that
are so long. ``reduceat`` gives each depth's members and smallest ids, and sums from the deepest
column upwards give leaves and savings of the subtrees.

Only nodes on a shard's first or last row can go on in a neighbour. Each shard also gets the
neighbours' touching rows, so it knows to which depth; its nodes up to there leave as parts with a
128-bit name of their path, and are summed by that name, at most two paths a shard. A part knows
its ancestors, to which its savings and, if it has no child anywhere, its leaf are added.

The list of conversations that end in a shared node can't be hashed in parts, as SHA-256 reads it
in order: its stretches, sorted, stream through one hash state, which takes constant memory.

Defined results: turns are ordered by turn, NULL first, and at equal turns by their hash, repeats
kept; NULL role or text is empty; rows without conv_id are left out; a conversation that is left
without turns is a member of the root; ids below 0 take the base that the remainder of SQL gives;
a missing base gives no turns; an empty table gives an empty result; other columns are ignored.
The names of one conversation's turns (24 bytes each) are one row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gridcensus.llm.prob_minhash import mix
from gridcensus.session import cut_lineage, ship_package

BASES, HEADS, WIDTH = 100, 6, 64
#: Turns of a shard: at most so many, or fewer where that leaves cores idle; ids to a stretch.
SHARD_TURNS, LEAST_TURNS, STRETCH = 1_000_000, 8_000, 1000
_NODE = ("conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, "
         "n_leaves bigint, saved_tokens bigint, ends_sha256 string")
#: A shared node's part also has names: its own, its parent's and those of all its ancestors.
_PART = _NODE + ", key string, parent string, path array<string>, chars bigint, ends array<string>"


def turn_lists(conversations: DataFrame) -> DataFrame:
    """conv_id and its turns in order, each as two halves of a hash and the text's code points."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    named = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)
    half = lambda at: F.conv(F.substring(named, at, 16), 16, -10).cast("bigint")
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.struct("turn", half(1).alias("hi"), half(17).alias("lo"),
                 F.length(text).cast("bigint").alias("chars")).alias("t"))
    return rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns")).select(
        "conv_id", F.transform("turns", lambda t: t.dropFields("turn")).alias("turns"))


def rebuilt(conversations: DataFrame) -> DataFrame:
    """Each conversation with its opening taken from its base, by a hash of the id."""
    own = cut_lineage(turn_lists(conversations))
    bases = own.where(F.col("conv_id") % BASES == 0).select(
        F.col("conv_id").alias("base"), F.slice("turns", 1, HEADS - 1).alias("opening"))
    taken = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS).cast("int")
    none = F.slice("turns", 1, 0)
    return own.withColumn("taken", taken).withColumn(
        "base", F.col("conv_id") - F.col("conv_id") % BASES).join(bases, "base", "left").select(
        "conv_id", F.concat(F.slice(F.coalesce("opening", none), F.lit(1), F.col("taken")),
                            F.slice("turns", F.col("taken") + 1, F.greatest(F.size("turns"), F.lit(1)))
                            ).alias("turns"))


class Rows:
    """Conversations of a shard in order: ids, lengths, and turns as numbers in one flat array."""

    def __init__(self, conv: np.ndarray, turns: pa.ListArray):
        hi, lo, chars = (turns.values.field(n).to_numpy(zero_copy_only=False)
                         for n in ("hi", "lo", "chars"))
        at = turns.offsets.to_numpy().astype(np.int64)
        order = np.lexsort((lo, hi))
        new = np.append(True, (hi[order][1:] != hi[order][:-1]) | (lo[order][1:] != lo[order][:-1]))
        flat = np.empty(len(hi), np.int32)
        flat[order] = np.cumsum(new[:len(hi)])  # from 1; 0 pads
        firsts = order[new[:len(hi)]]
        self.chars = np.append(0, chars[firsts])
        self.names = np.append(0, hi[firsts]).view(np.uint64), np.append(0, lo[firsts]).view(np.uint64)
        self._flat, self._at, self.length = flat, at, np.diff(at)
        self.conv = conv
        self._sort()

    def block(self, rows: np.ndarray, number: int) -> np.ndarray:
        """Columns of a block of the padded matrix, for some rows."""
        column = number * WIDTH + np.arange(min(WIDTH, max(1, int(
            self.length[rows].max(initial=1)) - number * WIDTH)))
        inside = column < self.length[rows][:, None]
        at = np.where(inside, self._at[rows][:, None] + column, 0)
        return np.where(inside, self._flat[at], 0) if len(self._flat) else np.zeros(at.shape, np.int32)

    def _sort(self) -> None:
        first = self.block(np.arange(len(self.conv)), 0)
        rest = np.zeros(len(self.conv), np.int64)
        long = np.flatnonzero(self.length > WIDTH)
        if len(long):  # what lies beyond the matrix, as bytes that compare like the numbers
            tails = [self._flat[self._at[i] + WIDTH:self._at[i + 1]].astype(">u4").tobytes() for i in long]
            number = {tail: n for n, tail in enumerate(sorted(set(tails)), 1)}
            rest[long] = [number[tail] for tail in tails]
        order = np.lexsort((self.conv, rest, *first.T[::-1]))
        self.conv, self.length, self._at = self.conv[order], self.length[order], self._at[:-1][order]

    def shared(self, row: int, other: list[dict]) -> int:
        """Depth to which a row of the shard and a neighbour's turns are equal."""
        ids = self._flat[self._at[row]:self._at[row] + self.length[row]]
        n = min(len(ids), len(other))
        theirs = [np.array([t[name] for t in other[:n]], np.int64).view(np.uint64)
                  for name in ("hi", "lo")]
        apart = (self.names[0][ids[:n]] != theirs[0]) | (self.names[1][ids[:n]] != theirs[1])
        return int(np.argmax(apart)) if apart.any() else n

    def path(self, row: int, depth: int) -> list[str]:
        """Names of a row's nodes from the root to ``depth``."""
        ids = self._flat[self._at[row]:self._at[row] + depth]
        a, b, out = np.uint64(1), np.uint64(2), [""]
        with np.errstate(over="ignore"):
            for x, y in zip(self.names[0][ids], self.names[1][ids]):
                a, b = mix(a * np.uint64(3) + x), mix(b * np.uint64(5) + y)
                out.append(f"{a:016x}{b:016x}")
        return out

    def levels(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Per depth from 0: the rows so long, where their nodes start among them, the last turn
        of each node."""
        rows = np.arange(len(self.conv))
        yield rows, np.zeros(1, np.int64), np.zeros(1, np.int64)
        group = np.zeros(len(rows), np.int64)  # number of the node of the depth before
        for number in range(-(-int(self.length.max()) // WIDTH)):
            inside = self.length[rows] > number * WIDTH
            rows, group = rows[inside], group[inside]
            matrix = self.block(rows, number)
            changed = np.append(True, group[1:] != group[:-1])
            for column in range(matrix.shape[1]):
                ids = matrix[:, column]
                changed[1:] |= ids[1:] != ids[:-1]
                held = np.flatnonzero(ids)
                if not len(held):
                    return
                above = np.cumsum(changed)[held]
                starts = np.flatnonzero(np.append(True, above[1:] != above[:-1]))
                yield rows[held], starts, ids[held[starts]]
            group = np.cumsum(changed)


def hashed(ids: list[str]) -> str:
    return hashlib.sha256(",".join(ids).encode()).hexdigest()


def shard_nodes(conv: np.ndarray, turns: pa.ListArray, before: list | None, after: list | None) -> dict:
    """Nodes of a shard, as columns of ``_PART``; ``before`` and ``after`` are the turns of the
    neighbours' touching rows. Nodes shared with a neighbour have a key and hold only this
    shard's part: sums over its own nodes below."""
    table = Rows(conv, turns)
    levels = list(table.levels())
    open_first = table.path(0, table.shared(0, before)) if before is not None else []
    open_last = table.path(len(conv) - 1, table.shared(len(conv) - 1, after)) if after is not None else []
    found = []
    for depth, (rows, starts, last) in enumerate(levels):
        n = np.diff(np.append(starts, len(rows)))
        names: dict[int, list[str]] = {}
        if depth < len(open_first):
            names[0] = open_first[:depth + 1]
        if depth < len(open_last):
            names[len(starts) - 1] = open_last[:depth + 1]
        low = np.minimum.reduceat(table.conv[rows], starts)
        ending = np.add.reduceat((table.length[rows] == depth).astype(np.int64), starts)
        parent = np.zeros(len(starts), np.int64)
        if depth:
            above, above_starts = levels[depth - 1][:2]
            parent = np.searchsorted(above[above_starts], rows[starts], "right") - 1
        found.append({"n": n, "low": low, "ending": ending, "parent": parent, "names": names,
                      "chars": table.chars[last], "rows": rows, "starts": starts,
                      "kids": np.zeros(len(starts), np.int64), "leaves": np.zeros(len(starts), np.int64),
                      "saved": np.zeros(len(starts), np.int64)})
    for depth in range(len(found) - 1, -1, -1):
        at = found[depth]
        whole = np.ones(len(at["n"]), bool)
        whole[list(at["names"])] = False
        at["saved"] += np.where(whole, (at["n"] - 1) * at["chars"], 0)
        at["leaves"] += whole & (at["kids"] == 0)
        if depth:
            up, parent = found[depth - 1], at["parent"]
            np.add.at(up["kids"], parent, whole.astype(np.int64))
            for sums in ("leaves", "saved"):  # a part's go up by its path, once all are known
                np.add.at(up[sums], parent[whole], at[sums][whole])
    out: dict[str, list] = {f.split()[0]: [] for f in _PART.split(", ")}
    for depth, at in enumerate(found):
        up = found[depth - 1] if depth else None
        size = len(at["n"])
        digests, stretches = [hashed([])] * size, [None] * size
        for node in np.flatnonzero(at["ending"]):
            first = at["starts"][node]
            ids = list(map(str, table.conv[at["rows"][first:first + at["ending"][node]]].tolist()))
            if node in at["names"]:
                digests[node] = None
                stretches[node] = [",".join(ids[i:i + STRETCH]) for i in range(0, len(ids), STRETCH)]
            else:
                digests[node] = hashed(ids)
        parents = up["low"][at["parent"]].tolist() if up else [None] * size
        parent_names = [up["names"].get(p) for p in at["parent"].tolist()] if up else [None] * size
        names = [at["names"].get(i) for i in range(size)]
        for name, values in (
                ("conv_id", at["low"].tolist()), ("depth", [depth] * size),
                ("parent_conv_id", parents), ("n_convs", at["n"].tolist()),
                ("n_children", at["kids"].tolist()), ("n_leaves", at["leaves"].tolist()),
                ("saved_tokens", at["saved"].tolist()), ("ends_sha256", digests),
                ("key", [n and n[-1] for n in names]), ("parent", [n and n[-1] for n in parent_names]),
                ("path", names), ("chars", at["chars"].tolist()), ("ends", stretches)):
            out[name].extend(values)
    return out


def _streamed(ends: DataFrame) -> DataFrame:
    """key and ends_sha256 of stretches (key, first, ends), which are hashed one after the other."""
    def run(batches):
        key, state = None, None
        for batch in batches:
            done = []
            for k, text in zip(batch.column("key").to_pylist(), batch.column("ends")):
                if k != key:
                    if state is not None:
                        done.append((key, state.hexdigest()))
                    key, state = k, hashlib.sha256()
                else:
                    state.update(b",")
                state.update(text.as_py().encode())
            yield _named(done)
        if state is not None:
            yield _named([(key, state.hexdigest())])

    def _named(rows):
        return pa.record_batch({"key": pa.array([k for k, _ in rows], pa.string()),
                                "ends_sha256": pa.array([d for _, d in rows], pa.string())})

    return ends.repartition("key").sortWithinPartitions("key", "first").select(
        "key", "ends").mapInArrow(run, "key string, ends_sha256 string")


def joined(parts: DataFrame) -> DataFrame:
    """Whole nodes from the shards' parts of shared ones (rows with a key)."""
    names = cut_lineage(parts.groupBy("key").agg(
        F.min("conv_id").alias("conv_id"), F.first("depth").alias("depth"),
        F.first("parent").alias("parent"), F.first("path").alias("path"),
        F.first("chars").alias("chars"), F.sum("n_convs").alias("n_convs"),
        F.sum("n_children").alias("n_children"), F.sum("n_leaves").alias("n_leaves"),
        F.sum("saved_tokens").alias("saved_tokens")))
    children = names.where("parent IS NOT NULL").groupBy(F.col("parent").alias("key")).agg(
        F.count("*").alias("more"))
    known = cut_lineage(names.join(children, "key", "left").withColumn(
        "n_children", F.col("n_children") + F.coalesce("more", F.lit(0))).withColumn(
        "own_leaves", F.col("n_leaves") + (F.col("n_children") == 0).cast("bigint")).withColumn(
        "own_saved", F.col("saved_tokens") + (F.col("n_convs") - 1) * F.col("chars")))
    sums = known.select(F.explode("path").alias("key"), "own_leaves", "own_saved").groupBy("key").agg(
        F.sum("own_leaves").alias("n_leaves"), F.sum("own_saved").alias("saved_tokens"))
    stretches = parts.select("key", F.explode("ends").alias("ends")).withColumn(
        "first", F.substring_index("ends", ",", 1).cast("bigint"))
    above = known.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    return known.select("key", "parent", "conv_id", "depth", "n_convs", "n_children").join(
        sums, "key").join(_streamed(stretches), "key", "left").join(above, "parent", "left").select(
        "key", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
        "saved_tokens", F.coalesce("ends_sha256", F.lit(hashed([]))).alias("ends_sha256"))


def shards_for(spark: SparkSession, turns: int, most: int, least: int) -> int:
    cores = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(1, -(-turns // most), min(cores, turns // least))


def nodes(rows: DataFrame, most: int = SHARD_TURNS, least: int = LEAST_TURNS) -> DataFrame:
    """All nodes of the trie over rows conv_id, turns."""
    spark = rows.sparkSession
    ship_package(spark)
    rows = cut_lineage(rows)
    turns = rows.agg(F.sum(F.size("turns") + 1).alias("n")).first()["n"] or 0
    dealt = cut_lineage(rows.repartitionByRange(shards_for(spark, turns, most, least), "turns", "conv_id")
                        .withColumn("part", F.spark_partition_id()))
    row = F.struct("turns", "conv_id")
    edges = cut_lineage(dealt.groupBy("part").agg(F.min(row).alias("first"), F.max(row).alias("last")))
    order = Window.orderBy("part")  # a row per shard
    guests = edges.select("part", F.lag("last").over(order).alias("b"), F.lead("first").over(order).alias("a"))
    guests = guests.select("part", F.explode(F.array(
        F.struct(F.lit(-1).alias("side"), F.col("b.turns").alias("turns"), F.col("b.conv_id").alias("conv_id")),
        F.struct(F.lit(1).alias("side"), F.col("a.turns").alias("turns"), F.col("a.conv_id").alias("conv_id")),
    )).alias("g")).select("part", "g.*").where("conv_id IS NOT NULL")
    together = dealt.withColumn("side", F.lit(0)).unionByName(guests)

    def build(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        side = group.column("side").to_numpy()
        own = group.filter(pa.array(side == 0)).combine_chunks()
        turns = own.column("turns").combine_chunks() if own.num_rows else None
        if isinstance(turns, pa.ChunkedArray):
            turns = turns.chunk(0)
        edge = {}
        for at in np.flatnonzero(side):
            edge[int(side[at])] = group.column("turns")[int(at)].as_py()
        found = shard_nodes(own.column("conv_id").to_numpy(), turns, edge.get(-1), edge.get(1))
        return pa.table(found, schema=_SCHEMA)

    shard = together.select("part", "side", "conv_id", "turns").groupBy("part").applyInArrow(build, _PART)
    found = cut_lineage(shard)
    parts = found.where("key IS NOT NULL")
    shared = cut_lineage(joined(parts))
    above = shared.select(F.col("key").alias("parent"), F.col("conv_id").alias("_above"))
    whole = found.where("key IS NULL").join(above, "parent", "left").withColumn(
        "parent_conv_id", F.coalesce("_above", "parent_conv_id"))
    columns = [f.split()[0] for f in _NODE.split(", ")]
    return whole.select(columns).unionByName(shared.select(columns))


_SCHEMA = pa.schema([(f.split()[0], {"bigint": pa.int64(), "string": pa.string(),
                                     "array<string>": pa.list_(pa.string())}[f.split()[1]])
                     for f in _PART.split(", ")])


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """Nodes of the trie of the rebuilt conversations, one row each."""
    return nodes(rebuilt(conversations))
