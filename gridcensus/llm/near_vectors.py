"""Near-duplicate vectors by a subspace pigeonhole join.

Vectors are brought to unit length and rotated at random, which spreads their differences evenly,
then split into blocks of about ``BLOCK`` dimensions. Cosine at least ``COSINE`` means a squared
distance of at most 2 - 2 COSINE; then some block's squared distance is at most its proportional
share of that (the pigeonhole). Each block is range-joined under its share, and the union of the
candidates is verified by the exact cosine in double precision: the join is exact.

The range join of a block sorts its first coordinate into ranges of about ``TILE`` vectors (a
crowded range is cut into several tiles by a hash) and meets only tiles whose ranges come as near
as the block's budget allows; one task compares two tiles by blocked matrix products. A pair
that several blocks would find is counted in the first. Tasks return counts and a spanning forest
of their links, never the links, so a dense group costs no rows. Equal vectors are one class and
are compared once.

With evenly spread data a block of few dimensions rules out little, so the comparisons grow with
the square of the distinct vectors; the README has the figures.

Defined results: vectors that are NULL, empty, zero or hold NULL or non-finite components link
with nothing; vectors of different length don't link; rows that repeat an id get a row each; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridcensus.llm.graph import components
from gridcensus.llm.words import small
from gridcensus.session import cut_lineage, ship_package

COSINE, BLOCK, TILE, CHUNK = 0.9, 16, 16_384, 64
_SLACK = 1e-9


def rotation(dimensions: int) -> np.ndarray:
    """A fixed random orthogonal matrix."""
    start = np.random.Generator(np.random.PCG64(dimensions)).standard_normal((dimensions,) * 2)
    return np.linalg.qr(start)[0]


def blocks(dimensions: int, size: int = BLOCK) -> list[tuple[int, int]]:
    count = max(1, round(dimensions / size))
    cuts = [dimensions * i // count for i in range(count + 1)]
    return list(zip(cuts[:-1], cuts[1:]))


def unit(raw: list, dimensions: int) -> np.ndarray:
    rows = np.frombuffer(b"".join(raw), np.float64).reshape(-1, dimensions)
    return rows / np.sqrt((rows * rows).sum(1, keepdims=True))


def classes(vectors: DataFrame) -> DataFrame:
    """class_id (smallest id), size and the vector, for each distinct usable vector."""
    usable = vectors.select(F.col("vec_id"), F.col("embedding").cast("array<double>").alias("v")).where(
        "v IS NOT NULL AND size(v) > 0 AND vec_id IS NOT NULL").where(
        F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))).where(
        F.exists("v", lambda x: x != 0))
    return usable.groupBy("v").agg(F.min("vec_id").alias("class_id"), F.count("*").alias("size"))


def placed(known: DataFrame, block: int = BLOCK) -> DataFrame:
    """A row per class and block: class_id, size, dims, block, at (first coordinate), raw."""
    kind = dict(known.dtypes)["class_id"]

    def place(batches):
        for batch in batches:
            out: dict[str, list] = {n: [] for n in ("row", "dims", "block", "at", "raw")}
            for row, v in enumerate(batch.column("v")):
                v = v.values.to_numpy(zero_copy_only=False)
                scaled = v / np.abs(v).max()  # so that no square overflows
                raw = scaled.tobytes()
                turned = scaled / np.sqrt((scaled * scaled).sum()) @ _rotation(len(v))
                for number, (first, _) in enumerate(blocks(len(v), block)):
                    for name, value in zip(out, (row, len(v), number, turned[first], raw)):
                        out[name].append(value)
            at = pa.array(out["row"], pa.int64())
            yield pa.record_batch({
                "class_id": batch.column("class_id").take(at), "size": batch.column("size").take(at),
                "dims": pa.array(out["dims"], pa.int32()), "block": pa.array(out["block"], pa.int32()),
                "at": pa.array(out["at"], pa.float64()), "raw": pa.array(out["raw"], pa.binary())})

    return known.select("class_id", "size", "v").mapInArrow(
        place, f"class_id {kind}, size bigint, dims int, block int, at double, raw binary")


_ROTATIONS: dict[int, np.ndarray] = {}


def _rotation(dimensions: int) -> np.ndarray:
    if dimensions not in _ROTATIONS:
        _ROTATIONS[dimensions] = rotation(dimensions)
    return _ROTATIONS[dimensions]


def merge(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Union of a and b in an array of roots, in place."""
    while len(a):
        ra, rb = label[a], label[b]
        apart = ra != rb
        if not apart.any():
            return
        a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
        np.minimum.at(label, np.maximum(ra, rb), np.minimum(ra, rb))
        while True:
            shorter = label[label]
            if (shorter == label).all():
                break
            label[:] = shorter


def linked(left: np.ndarray, right: np.ndarray | None, number: int, cosine: float, block: int):
    """Yield (rows of left, rows of right) that link and that no block before ``number`` finds.

    Without ``right``, pairs within ``left``, each once.
    """
    dims = left.shape[1]
    other = left if right is None else right
    turned, against = (np.round(x @ _rotation(dims), 12) for x in (left, other))
    spans = blocks(dims, block)
    budgets = [(2 - 2 * cosine) * (b - a) / dims + _SLACK for a, b in spans]

    def distance(i, j, span):
        x, y = turned[i, span[0]:span[1]], against[j, span[0]:span[1]]
        return ((x - y)**2).sum(1)

    # one product in single precision gives all squared distances of the block; its slack lets
    # through whatever the exact test below could accept
    first, last = spans[number]
    one = lambda x: np.ones((len(x), 1))
    square = lambda x: (x[:, first:last]**2).sum(1, keepdims=True)
    rows = np.hstack([-2 * turned[:, first:last], square(turned), one(turned)]).astype(np.float32)
    columns = np.ascontiguousarray(np.hstack(
        [against[:, first:last], one(against), square(against)]).astype(np.float32).T)
    most = np.float32(budgets[number] + 1e-5)
    for at in range(0, len(left), CHUNK):
        past = at if right is None else 0
        near = rows[at:at + CHUNK] @ columns[:, past:] <= most
        if near.mean() > 0.02:  # a dense part: all cosines at once
            near &= left[at:at + CHUNK] @ other[past:].T >= cosine - 1e-12
        i, j = np.divmod(np.flatnonzero(near), near.shape[1])
        i, j = i + at, j + past
        if right is None:
            i, j = i[j > i], j[j > i]
        for cut in range(0, len(i), 100_000):
            a, b = i[cut:cut + 100_000], j[cut:cut + 100_000]
            keep = np.einsum("ij,ij->i", left[a], other[b]) >= cosine
            a, b = a[keep], b[keep]
            for before in range(number):
                keep = distance(a, b, spans[before]) > budgets[before]
                a, b = a[keep], b[keep]
            keep = distance(a, b, spans[number]) <= budgets[number]
            yield a[keep], b[keep]


def links(vectors: DataFrame, cosine: float = COSINE, block: int = BLOCK, tile: int = TILE,
          ) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Classes (class_id, size, v), their links summed (class_id, n) and a spanning set of links."""
    ship_package(vectors.sparkSession)
    known = cut_lineage(classes(vectors))
    rows = cut_lineage(placed(known, block))
    count = rows.groupBy("dims", "block").count().agg(F.max("count")).first()[0] or 0
    ranges = max(1, -(-count // tile))
    cuts = rows.groupBy("dims", "block").agg(F.percentile_approx(
        "at", [i / ranges for i in range(1, ranges)], 1000).alias("cuts")) if ranges > 1 else \
        rows.groupBy("dims", "block").agg(F.lit(None).cast("array<double>").alias("cuts"))
    bucket = F.coalesce(F.size(F.filter("cuts", lambda c: c <= F.col("at"))), F.lit(0))
    dealt = rows.join(F.broadcast(cuts), ["dims", "block"]).withColumn("bucket", bucket).drop("cuts")
    where = ["dims", "block", "bucket"]
    sizes = dealt.groupBy(*where).agg(F.count("*").alias("n"), F.min("at").alias("low"),
                                      F.max("at").alias("high"))
    parts = F.ceil(F.col("n") / (1.5 * tile)).cast("int")
    sizes = cut_lineage(sizes.withColumn("parts", parts))
    tiles = cut_lineage(sizes.select("*", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias(
        "part")).select("dims", "block", "low", "high", F.concat_ws(
            "-", *where, "part").alias("tile")))
    left = tiles.select("dims", "block", F.col("tile").alias("t1"), F.col("high").alias("h1"),
                        F.col("low").alias("l1"))
    right = tiles.select("dims", "block", F.col("tile").alias("t2"), F.col("low").alias("l2"),
                         F.col("high").alias("h2"))
    widest = F.ceil(F.col("dims") / F.greatest(F.lit(1.0), F.bround(F.col("dims") / block)))
    reach = F.sqrt((2 - 2 * cosine) * widest / F.col("dims")) + 1e-6
    meets = left.join(right, ["dims", "block"]).where("t1 <= t2").where(
        (F.col("l2") <= F.col("h1") + reach) & (F.col("l1") <= F.col("h2") + reach))
    pairs = cut_lineage(meets.select("t1", "t2", F.concat_ws("|", "t1", "t2").alias("pair")))
    n_pairs = pairs.count()
    placed_rows = dealt.join(F.broadcast(sizes.select(*where, "parts")), where).select(
        "class_id", "size", "dims", "block", "raw", F.concat_ws("-", *where, F.pmod(
            F.xxhash64("class_id"), F.col("parts"))).alias("tile"))
    ends = pairs.select(F.col("t1").alias("tile"), "pair", F.lit(0).alias("side")).unionByName(
        pairs.where("t1 <> t2").select(F.col("t2").alias("tile"), "pair", F.lit(1).alias("side")))
    sent = placed_rows.join(small(ends, n_pairs), "tile").drop("tile")
    kind = dict(known.dtypes)["class_id"]

    def compare(group: pa.Table) -> pa.Table:
        side = group.column("side").to_numpy()
        order = np.argsort(side, kind="stable")
        group = group.take(pa.array(order))
        n_left = int((side == 0).sum())
        number = group.column("block")[0].as_py()
        every = unit(group.column("raw").to_pylist(), group.column("dims")[0].as_py())
        weight = group.column("size").to_numpy()
        second = every[n_left:] if n_left < len(every) else None
        base = n_left if second is not None else 0
        n, label = np.zeros(len(every), np.int64), np.arange(len(every))
        for a, b in linked(every[:n_left], second, number, cosine, block):
            b = b + base
            np.add.at(n, a, weight[b])
            np.add.at(n, b, weight[a])
            merge(label, a, b)
        ids = group.column("class_id")
        some = np.flatnonzero(n)
        return pa.table({"class_id": ids.take(pa.array(some)), "n": pa.array(n[some]),
                         "root": ids.take(pa.array(label[some]))})

    found = cut_lineage(sent.groupBy("pair").applyInArrow(
        compare, f"class_id {kind}, n bigint, root {kind}"))
    return known, found.groupBy("class_id").agg(F.sum("n").alias("n")), found.select(
        F.col("class_id").alias("a"), F.col("root").alias("b")).where("a <> b").distinct()


def near_vectors(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """vec_id, n_links, component_id and kept for every row of ``vectors``."""
    known, counts, forest = links(vectors, cosine)
    grouped = components(forest).select(F.col("id").alias("class_id"), "component")
    of_class = known.join(counts, "class_id", "left").join(grouped, "class_id", "left").select(
        "v", (F.col("size") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"),
        F.coalesce("component", "class_id").alias("component_id"))
    rows = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("v"))
    out = rows.join(of_class, "v", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.col("vec_id") == F.col("component_id"))
