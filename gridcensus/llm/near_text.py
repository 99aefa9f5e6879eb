"""Near-duplicate documents by ProbMinHash signatures, banding and exact verification.

Texts of the same words are one class and are compared once. Every class has a signature of
``SLOTS`` slots, the first ``BANDS x ROWS`` of which make bands; classes that share a band's key
are candidates. At similarity 0.8 a pair shares none of the bands with probability
(1 - 0.8**ROWS)**BANDS, about 5e-6; nothing else of the search leaves a link out but by chance
below 1e-10.

Buckets may be crowded, by true copies or by a passage that many documents share, so the pairs
of a bucket are never put out. First each member is compared with the bucket's hub only, the
member that shares most with others; the links found join nearly all copies to components. What
is left are pairs of one bucket in different components. A pair belongs to the first band it
shares. Tasks compare the signatures, of which every slot keeps one byte, and say which members
have a pair of their own that agrees in ``AGREE`` of the slots (a pair at similarity 0.8 agrees
in fewer with probability below 1e-10). Only these send their words, and the task that gets
them verifies exactly. It puts out a spanning forest of what it links, at most one row per
member, and does not look at pairs it has linked already.

A bucket with more than ``CROWDED`` open pairs or ``CHUNK`` members is cut into chunks of about
``CHUNK``, and every pair of chunks that holds open pairs is a task: no task holds more than two
chunks, and one common band is enough in a bucket of any size. Where words are sent, parts are
cut by bytes in the same way, so a hub with very many members goes to each part once.

A link is a pair whose exact probability Jaccard similarity of counted five-word shingles is at
least 0.8. The group of a document is its component over all links.

Defined results: words are lower-case runs of letters and digits; a text of one to four words has
one shingle; texts without words (NULL, empty, signs only) are each their own group; rows that
repeat an id with the same words count as one document, with other words each row has its own
group; rows without an id are never dropped; an empty table gives an empty result; other columns
are kept by ``deduplicated`` and ignored else.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridcensus.llm import prob_minhash
from gridcensus.llm.graph import components
from gridcensus.llm.near_vectors import merge
from gridcensus.llm.words import SIMILARITY, hot_join, small, word_hashes, words
from gridcensus.session import cut_lineage, ship_package

BANDS, ROWS, CROWDED = 40, 6, 1_000_000
#: Slots of a signature (the first BANDS x ROWS make bands), and the share that must agree.
SLOTS, AGREE = 720, 0.7
BIN_ROWS, CHUNK = 20_000, 4096
#: Bytes of words that a task gets, and that one side of a comparison may have.
BIN_BYTES, PART_BYTES = 8_000_000, 16_000_000
_SLICE_WORDS = 300_000


def _words_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    offsets = column.offsets.to_numpy()
    values = column.values.to_numpy(zero_copy_only=False).view(np.uint64)
    return values, offsets


def signed(docs: DataFrame, bands: int = BANDS, rows: int = ROWS,
           slots: int = SLOTS) -> DataFrame:
    """id, a hash of the text, c1, c2 (128 bits of the word sequence), band keys and a byte of
    every slot. The keys are NULL without words.
    """
    ship_package(docs.sparkSession)
    hashed = docs.select(F.col("doc_id").alias("id"), F.xxhash64("text").alias("text_hash"),
                         word_hashes(F.col("text")).alias("words"))
    hashed = hashed.select("id", "text_hash", F.xxhash64("words").alias("c1"),
                           F.xxhash64(F.lit(17), "words").alias("c2"), "words")
    kind = dict(hashed.dtypes)["id"]

    def sign(batches):
        for batch in batches:
            words, offsets = _words_of(batch.column("words"))
            first = 0
            while first < batch.num_rows:
                end = int(np.searchsorted(offsets, offsets[first] + _SLICE_WORDS, "right")) - 1
                end = min(max(end, first + 1), batch.num_rows)
                parts = [prob_minhash.shingles(words[offsets[i]:offsets[i + 1]])
                         for i in range(first, end)]
                owner = np.repeat(np.arange(end - first), [len(h) for h, _ in parts])
                signature = prob_minhash.signatures(
                    np.concatenate([h for h, _ in parts]),
                    np.concatenate([c for _, c in parts]).astype(float), owner, end - first,
                    slots)
                keys = prob_minhash.band_keys(signature, bands, rows)
                filled = np.diff(offsets[first:end + 1]) > 0
                at = np.append(0, np.cumsum(np.where(filled, bands, 0))).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(at), pa.array(keys[filled].ravel()),
                                                 mask=pa.array(~filled))
                part = batch.slice(first, end - first)
                yield pa.record_batch({**{n: part.column(n) for n in ("id", "text_hash", "c1", "c2")},
                                       "keys": lists,
                                       "sketch": pa.array([r.tobytes() for r in (
                                           signature & np.uint64(255)).astype(np.uint8)],
                                           pa.binary())})
                first = end

    return hashed.mapInArrow(sign, f"id {kind}, text_hash bigint, c1 bigint, c2 bigint, "
                                   "keys array<bigint>, sketch binary")


def agreeing(sketch: np.ndarray, component: np.ndarray, agree: float,
             other: np.ndarray | None = None, against: np.ndarray | None = None):
    """Index pairs of different components that agree in a share ``agree`` of the bytes.

    Pairs i < j within ``sketch``, or of a row there and a row of ``other``, whose components are
    ``against``.
    """
    within = other is None
    if within:
        other, against = sketch, component
    n, slots = other.shape
    step = max(1, 16_000_000 // (n * slots))
    for at in range(0, len(sketch), step):
        past = at if within else 0
        apart = component[at:at + step, None] != against[None, past:]
        if within:
            apart &= np.arange(n - at) > np.arange(len(apart))[:, None]
        i, j = np.nonzero(apart)
        if not len(i):
            continue
        if len(i) * 4 < apart.size:  # few pairs: only those
            same = equal_bytes(sketch[i + at], other[j + past])
        else:
            same = equal_bytes(sketch[at:at + step, None, :], other[None, past:, :])[i, j]
        keep = same >= agree * slots
        yield i[keep] + at, j[keep] + past


def equal_bytes(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many bytes of the last axis are equal."""
    same = a == b
    if same.shape[-1] % 8 or same.shape[-1] > 8 * 255:
        return same.sum(-1)
    lanes = same.view(np.uint64).sum(-1)  # eight counts, each in a byte of its own
    return lanes.view(np.uint8).reshape(*lanes.shape, 8).sum(-1)


def owned(a: np.ndarray, b: np.ndarray, band: int, rows: int) -> np.ndarray:
    """Which pairs of sketches share ``band`` first; any pair where the band is negative."""
    if band < 0:
        return np.ones(len(a), bool)
    shared = (a == b)[:, :(band + 1) * rows].reshape(len(a), band + 1, rows).all(2)
    return shared[:, band] & ~shared[:, :band].any(1)


class Members:
    """Rows of a task (key, side, id, component, band), by key, then side, then id."""

    def __init__(self, group: pa.Table):
        self.table = group.sort_by([("key", "ascending"), ("side", "ascending"), ("id", "ascending")])
        self.ids, self.sides = self.table.column("id").to_numpy(), self.table.column("side").to_numpy()
        self.bands = self.table.column("band").to_numpy()
        self.components = self.table.column("component").to_numpy()
        if "sketch" in self.table.column_names:
            raw = b"".join(self.table.column("sketch").to_pylist())
            self.sketches = np.frombuffer(raw, np.uint8).reshape(len(self.ids), -1)

    def keys(self):
        """(first row, first row of side 1, end row) of each key; side 1 may be empty."""
        keys = self.table.column("key").combine_chunks().dictionary_encode().indices.to_numpy()
        starts = np.append(np.flatnonzero(np.append(True, keys[1:] != keys[:-1])), len(keys))
        for first, end in zip(starts[:-1], starts[1:]):
            yield first, first + int((self.sides[first:end] == 0).sum()), end

    def like_pairs(self, first: int, cut: int, end: int, agree: float, rows: int):
        """Row pairs of a key that agree and belong to its band; across sides if it has two."""
        sketch, component = self.sketches, self.components
        if cut < end:
            found = agreeing(sketch[first:cut], component[first:cut], agree,
                             sketch[cut:end], component[cut:end])
        else:
            found = agreeing(sketch[first:end], component[first:end], agree)
        for i, j in found:
            i, j = i + first, j + (cut if cut < end else first)
            keep = owned(sketch[i], sketch[j], int(self.bands[first]), rows)
            yield i[keep], j[keep]


def with_like_pairs(groups: DataFrame, sketches: DataFrame, agree: float, rows: int) -> DataFrame:
    """The rows (bin, key, side, id, component, band) that have a pair of their own and alike."""
    joined = groups.join(sketches, "id").select("bin", "key", "side", "id", "component", "band", "sketch")

    def compare(group: pa.Table) -> pa.Table:
        held = Members(group)
        marked = np.zeros(len(held.ids), bool)
        for first, cut, end in held.keys():
            for i, j in held.like_pairs(first, cut, end, agree, rows):
                marked[i] = marked[j] = True
        return held.table.filter(pa.array(marked)).select(["key", "side", "id", "component", "band"])

    return joined.groupBy("bin").applyInArrow(
        compare, "key string, side int, id bigint, component bigint, band int")


class Shingled:
    """Counted shingles of some texts, numbered from 0, for many exact similarities."""

    def __init__(self, texts: list[str]):
        number: dict[str, int] = {}
        parts = [prob_minhash.shingles(np.array(
            [number.setdefault(w, len(number)) for w in t.split(" ")], np.uint64)) for t in texts]
        self._parts = parts
        self.size = np.array([len(h) for h, _ in parts], np.int64)
        self._plain = np.array([bool((c == 1).all()) for _, c in parts])
        distinct, flat = np.unique(np.concatenate([h for h, _ in parts]), return_inverse=True)
        self._flat, self._seen = flat.reshape(-1), np.zeros(len(distinct), bool)
        self._at = np.append(0, np.cumsum(self.size))

    def near(self, one: int, others: np.ndarray, least: float) -> np.ndarray:
        """Which of the others have at least the similarity ``least`` with one text."""
        mine = self._flat[self._at[one]:self._at[one + 1]]
        self._seen[mine] = True
        size = self.size[others]
        start = np.append(0, np.cumsum(size))
        hit = self._seen[self._flat[np.repeat(self._at[others] - start[:-1], size) + np.arange(start[-1])]]
        self._seen[mine] = False
        both = np.add.reduceat(hit.astype(np.int64), start[:-1])
        found = both >= (least - 1e-12) * (len(mine) + size - both)  # if no shingle repeats
        for at in np.flatnonzero((both > 0) & ~(self._plain[others] & self._plain[one])):
            found[at] = prob_minhash.probability_jaccard(
                self._parts[one], self._parts[others[at]]) >= least - 1e-12
        return found


def class_words(docs: DataFrame, classes: DataFrame, ids: DataFrame) -> DataFrame:
    """id, its words joined by blanks, and their bytes, for the class ids in ``ids``.

    A row that repeats an id and its text is read as often; only then is one of them picked.
    """
    wanted = cut_lineage(classes.join(ids.select("id").distinct(), "id", "left_semi").select(
        "id", F.col("one.id").alias("doc_id"), "one.text_hash"))
    n_wanted = wanted.count()
    texts = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text").join(
        small(wanted, n_wanted), ["doc_id", "text_hash"])
    sent = cut_lineage(texts.select("id", F.array_join(words(F.col("text")), " ").alias("words")).withColumn(
        "bytes", F.octet_length("words")))
    return sent if sent.count() == n_wanted else cut_lineage(sent.distinct())


def linked(groups: DataFrame, classes: DataFrame, docs: DataFrame, least: float,
           agree: float | None, rows: int) -> DataFrame:
    """Spanning links a, b of the stored rows (key, side, id, component, band).

    Pairs are those within a key, or across its sides if it has two, that lie in different
    components and, with ``agree``, are alike by their sketches and the key's own.
    """
    sent = class_words(docs, classes, groups)
    sized = cut_lineage(groups.join(sent.select("id", "bytes"), "id"))
    half = lambda side: F.greatest(F.lit(1), F.ceil(F.sum(F.when(
        F.col("side") == side, F.col("bytes"))) / PART_BYTES)).cast("int")
    cuts = sized.groupBy("key").agg(
        F.coalesce(half(0), F.lit(1)).alias("parts0"), F.coalesce(half(1), F.lit(1)).alias("parts1"),
        F.max("side").alias("two"))
    mine = F.pmod(F.xxhash64("id"), F.when(F.col("side") == 0, F.col("parts0")).otherwise(F.col("parts1")))
    facing = F.when((F.col("side") == 0) & (F.col("two") == 1), F.col("parts1")).otherwise(F.col("parts0"))
    dealt = sized.join(cuts, "key").withColumn("_mine", mine).withColumn(
        "_other", F.explode(F.sequence(F.lit(0), facing - 1)))
    low = F.when(F.col("two") == 1, F.when(F.col("side") == 0, F.col("_mine")).otherwise(
        F.col("_other"))).otherwise(F.least("_mine", "_other"))
    high = F.when(F.col("two") == 1, F.when(F.col("side") == 0, F.col("_other")).otherwise(
        F.col("_mine"))).otherwise(F.greatest("_mine", "_other"))
    side = F.when(F.col("two") == 1, F.col("side")).otherwise((F.col("_mine") > low).cast("int"))
    dealt = cut_lineage(dealt.select(F.concat_ws("|", "key", low, high).alias("key"), side.alias("side"),
                                     "id", "component", "band", "bytes"))
    total = dealt.agg(F.sum("bytes").alias("n")).first()["n"] or 0
    bins = max(1, -(-total // BIN_BYTES))
    placed = dealt.withColumn("bin", F.pmod(F.xxhash64("key"), F.lit(bins)))
    joined = small(placed, placed.count()).join(sent.select("id", "words"), "id")
    columns = ["bin", "key", "side", "id", "component", "band", "words"]
    if agree is not None:
        joined, columns = joined.join(classes.select("id", "sketch"), "id"), columns + ["sketch"]

    def compare(group: pa.Table) -> pa.Table:
        held = Members(group)
        known, first_row, text_of = np.unique(held.ids, return_index=True, return_inverse=True)
        texts = Shingled(held.table.column("words").take(pa.array(first_row)).to_pylist())
        a, b = [], []
        for first, cut, end in held.keys():
            if first == cut:
                continue
            _, root, of = np.unique(held.components[first:end], return_index=True, return_inverse=True)
            label = root[of.reshape(-1)]
            if agree is not None:
                pairs = held.like_pairs(first, cut, end, agree, rows)
            else:
                pairs = ((np.full(end - cut, i), np.arange(cut, end)) for i in range(first, cut))
            for i, j in pairs:
                for one in np.unique(i):
                    others = j[i == one]
                    others = others[label[others - first] != label[one - first]]
                    if not len(others):
                        continue
                    others = others[texts.near(text_of[one], text_of[others], least)]
                    _, at = np.unique(label[others - first], return_index=True)
                    others = others[at]
                    a.extend([held.ids[one]] * len(others))
                    b.extend(held.ids[others])
                    merge(label, np.full(len(others), one - first), others - first)
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return joined.select(columns).groupBy("bin").applyInArrow(compare, "a bigint, b bigint")


def in_chunks(buckets: DataFrame, parts: DataFrame) -> DataFrame:
    """Rows (bin, key, side, id, component, band) of pairs of chunks, for buckets of any size.

    ``parts`` has the members n of each component of a bucket. One that fills a good part of a
    chunk gets chunks of its own, dealt by a hash of the ids; the others are dealt whole to the
    bucket's mixed chunks. Two chunks of one component never meet.
    """
    parts = cut_lineage(parts.withColumn("own", F.col("n") * 8 > CHUNK))
    mixed = parts.where("NOT own").groupBy("key").agg(F.sum("n").alias("_mixed"))
    cuts = cut_lineage(parts.join(mixed, "key", "left").select("key", "component", "own", F.ceil(
        F.when(F.col("own"), F.col("n")).otherwise(F.col("_mixed")) / CHUNK).alias("cuts")))
    number = F.pmod(F.when(F.col("own"), F.xxhash64("id")).otherwise(F.xxhash64("component")),
                    F.col("cuts"))
    owner = F.when(F.col("own"), F.col("component").cast("string"))
    rows = cut_lineage(buckets.join(small(cuts, cuts.count()), ["key", "component"]).select(
        "key", "band", "id", "component", owner.alias("owner"),
        F.concat_ws("/", "key", owner, number).alias("tile")))
    tiles = cut_lineage(rows.groupBy("key", "tile").agg(
        F.min("owner").alias("owner"), F.min("component").alias("low"),
        F.max("component").alias("high")))
    one = lambda n: tiles.select("key", F.col("tile").alias(f"t{n}"), F.col("owner").alias(f"o{n}"),
                                 (F.col("low") < F.col("high")).alias(f"several{n}"))
    pairs = cut_lineage(one(1).join(one(2), "key").where(
        "t1 < t2 AND (o1 IS NULL OR o2 IS NULL OR o1 <> o2) OR t1 = t2 AND several1").select(
        "t1", "t2"))
    pair = F.concat_ws("|", "t1", "t2")
    ends = pairs.select(F.col("t1").alias("tile"), pair.alias("pair"), F.lit(0).alias("side")).unionByName(
        pairs.where("t1 < t2").select(F.col("t2").alias("tile"), pair.alias("pair"), F.lit(1).alias("side")))
    return rows.select("tile", "band", "id", "component").join(
        small(ends, 8 * pairs.count()), "tile").select(
        F.col("pair").alias("bin"), F.col("pair").alias("key"), "side", "id", "component", "band")


def open_members(buckets: DataFrame, classes: DataFrame, crowded: int | None = None,
                 agree: float = AGREE, rows: int = ROWS) -> DataFrame:
    """Of the rows (key, band, id, component) of buckets, those with a like pair of the bucket's
    own in different components, as (key, side, id, component, band).

    A bucket with more than ``crowded`` open pairs or ``CHUNK`` members is compared in chunks.
    """
    crowded = CROWDED if crowded is None else crowded
    sketches = classes.select("id", "sketch")
    parts = cut_lineage(buckets.groupBy("key", "component").agg(F.count("*").alias("n")))
    count = F.sum("n")
    open_ = cut_lineage(parts.groupBy("key").agg(count.alias("members"), (
        (count * count - F.sum(F.col("n") * F.col("n"))) / 2).alias("pairs")).where("pairs > 0"))
    calm = (F.col("pairs") <= crowded) & (F.col("members") <= CHUNK)
    easy = cut_lineage(buckets.join(open_.where(calm).select("key"), "key", "left_semi"))
    bins = max(1, -(-easy.count() // BIN_ROWS))
    found = with_like_pairs(easy.select(
        F.pmod(F.xxhash64("key"), F.lit(bins)).cast("string").alias("bin"),
        F.col("key").cast("string").alias("key"), F.lit(0).alias("side"), "id", "component", "band"),
        sketches, agree, rows)
    busy = cut_lineage(open_.where(~calm).select("key"))
    n_busy = busy.count()
    if n_busy:
        of_busy = lambda df: df.join(small(busy, n_busy), "key", "left_semi")
        found = found.unionByName(with_like_pairs(
            in_chunks(cut_lineage(of_busy(buckets)), of_busy(parts)), sketches, agree, rows))
    return found


def hubs(buckets: DataFrame) -> DataFrame:
    """key and hub of buckets (key, id, n): the member whose buckets hold most, then smallest id."""
    shared = buckets.groupBy("id").agg(F.sum("n").alias("_met"))
    return buckets.select("key", "id").join(shared, "id").groupBy("key").agg(
        F.min(F.struct((-F.col("_met")).alias("_less"), "id")).alias("_best")).select(
        "key", F.col("_best.id").alias("hub"))


def near_links(buckets: DataFrame, classes: DataFrame, docs: DataFrame, least: float, rows: int,
               crowded: int | None = None) -> DataFrame:
    """Spanning links of all classes of buckets (key, band, id, n) by exact similarity."""
    stars = cut_lineage(buckets.join(hubs(buckets), "key").where("hub <> id").select("hub", "id").distinct())
    around = stars.select(F.col("hub").cast("string").alias("key"), F.lit(1).alias("side"), "id")
    middle = stars.select(F.col("hub").cast("string").alias("key"), F.lit(0).alias("side"),
                          F.col("hub").alias("id")).distinct()
    groups = cut_lineage(around.unionByName(middle).select(
        "key", "side", "id", F.col("id").alias("component"), F.lit(-1).alias("band")))
    links = cut_lineage(linked(groups, classes, docs, least, None, rows))
    joined = components(links)
    labelled = cut_lineage(buckets.select("key", "band", "id").join(joined, "id", "left").select(
        "key", "band", "id", F.coalesce("component", "id").alias("component")))
    rest = cut_lineage(open_members(labelled, classes, crowded, rows=rows))
    return links.unionByName(cut_lineage(linked(rest, classes, docs, least, AGREE, rows)))


def grouped(docs: DataFrame, least: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS,
            crowded: int | None = None) -> DataFrame:
    """doc_id, text_hash, class_id, group_id and kept; one row per row of ``docs``."""
    marks = cut_lineage(signed(docs, bands, rows))
    one = F.struct("id", "text_hash")
    classes = cut_lineage(marks.where("keys IS NOT NULL").groupBy("c1", "c2").agg(
        F.min(one).alias("one"), F.min("id").alias("class_id"), F.any_value("keys").alias("keys"),
        F.any_value("sketch").alias("sketch")).withColumn("id", F.monotonically_increasing_id()))
    placed = classes.where("class_id IS NOT NULL").select("id", F.posexplode("keys").alias("band", "key"))
    shared = placed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    buckets = cut_lineage(placed.join(shared, "key"))
    joined = cut_lineage(components(near_links(buckets, classes, docs, least, rows, crowded)))
    numbered = cut_lineage(classes.select("c1", "c2", "id", "class_id").join(joined, "id", "left"))
    linked_ones = numbered.where("component IS NOT NULL")
    smallest = cut_lineage(linked_ones.groupBy("component").agg(
        F.min("class_id").alias("group_id"), F.count("*").alias("_n")))
    of_class = hot_join(linked_ones, smallest, "component", "inner").select(
        "c1", "c2", "class_id", "group_id").unionByName(numbered.where("component IS NULL").select(
            "c1", "c2", "class_id", F.col("class_id").alias("group_id")))
    found = marks.where("keys IS NOT NULL").select(F.col("id").alias("doc_id"), "text_hash", "c1", "c2").join(
        of_class, ["c1", "c2"]).select("doc_id", "text_hash", "class_id", "group_id")
    alone = marks.where("keys IS NULL").select(
        F.col("id").alias("doc_id"), "text_hash", F.col("id").alias("class_id"), F.col("id").alias("group_id"))
    return found.unionByName(alone).withColumn("kept", F.col("doc_id") == F.col("group_id"))


def near_groups(docs: DataFrame, least: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS,
                crowded: int | None = None) -> DataFrame:
    """doc_id, class_id (smallest id with the same words), group_id (smallest id of the
    component), kept (doc_id = group_id); one row per row of ``docs``."""
    return grouped(docs, least, bands, rows, crowded).drop("text_hash")


def deduplicated(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """One document of each group, with its columns."""
    gone = cut_lineage(grouped(docs, least).where("NOT kept").select(
        F.col("doc_id").alias("_gone"), F.col("text_hash").alias("_gone_text")).distinct())
    keyed = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    of = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    return keyed.join(small(gone, gone.count()), (F.col(of["doc_id"]) == F.col("_gone")) & (
        F.xxhash64(of["text"]) == F.col("_gone_text")), "left_anti").toDF(*docs.columns)
