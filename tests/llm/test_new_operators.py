"""Resampling, the prefix trie and best-fit packing on small frames, against brute force."""

import bisect
import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from gridcensus.llm import best_fit, importance, prefix_trie
from tests.llm.test_operators import ODD, clashing, frame, prose

PATH = public_tokenizers.path("word_bpe_49k.json")


# best fit

def bins_one_by_one(lengths, size):
    """Remaining room of every sequence after best-fit decreasing, one piece at a time."""
    rooms = []
    for length in sorted(lengths, reverse=True):
        at = bisect.bisect_left(rooms, length)
        room = rooms.pop(at) if at < len(rooms) else size
        bisect.insort(rooms, room - length)
    return rooms


@pytest.mark.parametrize("seed", range(40))
def test_plan_equals_best_fit_piece_by_piece(seed):
    rng = random.Random(seed)
    size = rng.choice([1, 7, 64, 100, 2048])
    top = rng.choice([size, max(1, size // 3)])
    lengths = [rng.randint(1, top) for _ in range(rng.randint(1, 600))] + [min(top, 9)] * rng.randint(0, 300)
    steps = best_fit.plan(collections.Counter(lengths), size)
    keys = [tuple(s[:2]) for s in steps]
    rooms, placed = collections.Counter(), collections.defaultdict(list)
    seen = collections.Counter()
    for length in lengths:
        rank = seen[length]
        seen[length] += 1
        _, first_rank, first, each, offset = steps[bisect.bisect_right(keys, (length, rank)) - 1]
        number, at = divmod(rank - first_rank, each)
        placed[first + number].append((offset + at * length, length))
    for number, spans in placed.items():
        end = 0
        for at, length in sorted(spans):
            assert at == end
            end += length
        assert end <= size
        rooms[size - end] += 1
    assert sorted(rooms.elements()) == bins_one_by_one(lengths, size)


def test_tightest_capacity_equals_search():
    rng, tree, held = random.Random(3), best_fit.Capacities(37), collections.Counter()
    for _ in range(3000):
        capacity = rng.randint(1, 37)
        n = rng.choice([1, 1, 5, -held[capacity]])
        tree.add(capacity, n)
        held[capacity] += n
        least = rng.randint(1, 37)
        assert tree.tightest(least) == min((c for c in held if c >= least and held[c]), default=None)


def test_best_fit_places_every_id_once(spark):
    from tokenizers import Tokenizer

    texts = ODD + [prose(n, n) for n in (3, 900, 2500, 40, 700)] + ["one two three"] * 300 + [
        prose(5 + i % 40, i) for i in range(400)]
    rows = best_fit.pack(clashing(frame(spark, texts).repartition(7)), PATH).collect()
    library, of_sequence = Tokenizer.from_file(PATH), collections.defaultdict(list)
    of_doc = collections.defaultdict(list)
    for row in rows:
        of_sequence[row.sequence_id].append((row.offset, row.length))
        of_doc[row.doc_id].append(row)
    for i, text in enumerate(texts):
        ids = np.array(library.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        want = [(n, at, len(ids[at:at + 2048]), zlib.crc32(ids[at:at + 2048].tobytes()))
                for n, at in enumerate(range(0, len(ids), 2048))]
        assert sorted((r.piece, r.start, r.length, r.ids_crc32) for r in of_doc[i]) == want
    rooms = []
    for spans in of_sequence.values():
        end = 0
        for at, length in sorted(spans):
            assert at == end
            end += length
        rooms.append(2048 - end)
    assert sorted(rooms) == bins_one_by_one([r.length for r in rows], 2048)


def test_best_fit_repeats_ties_and_empty_tables(spark):
    docs = frame(spark, ["a b"] * 5).withColumn("doc_id", F.lit(None).cast("long"))
    rows = best_fit.pack(docs, PATH).collect()
    assert sorted(r.offset for r in rows) == [0, 3, 6, 9, 12] and {r.doc_id for r in rows} == {None}
    assert best_fit.pack(frame(spark, []), PATH).count() == 0


# resampling

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def grams(text):
    words = WORD.findall(re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    return len(words), [b" ".join(words[i:i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]


def resampled(docs, target):
    """Plain form of the contract: doc_id to (n_features, weight, score, rank)."""
    def counts(texts):
        return collections.Counter(zlib.crc32(g) % 10000 for t in texts for g in grams(t)[1])

    s, t = counts(x for _, x in docs), counts(target)
    all_s, all_t = sum(s.values()), sum(t.values())
    out, enough = {}, []
    for doc_id, text in docs:
        words, found = grams(text)
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * (all_s + 10000) / (
            (s[b] + 1) * (all_t + 10000)))) for b in (zlib.crc32(g) % 10000 for g in found))
        h = int(hashlib.sha256(f"42:{doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out[doc_id] = [len(found), weight, score, None]
        if words >= 20:
            enough.append((-score, doc_id))
    for rank, (_, doc_id) in enumerate(sorted(enough)[:5 * len(enough) // 100], 1):
        out[doc_id][3] = rank
    return {k: tuple(v) for k, v in out.items()}


def test_resampling_equals_brute_force(spark):
    texts = ODD + [prose(15 + i % 30, i) + (" É-Wort 7A\x00b" if i % 3 else "") for i in range(500)]
    target = [prose(30, 10_000 + i) for i in range(20)] + [None, ""]
    got = importance.resample(clashing(frame(spark, texts).repartition(5)), frame(spark, target)).collect()
    assert {r.doc_id: (r.n_features, r.weight, r.score, r["rank"]) for r in got} == resampled(
        list(enumerate(texts)), target)


@pytest.mark.parametrize("most", [1, 7, 40])
def test_a_text_in_pieces_has_the_features_of_the_whole(most):
    text = (prose(60, 5) + "  ,, Ünd 4x " + prose(9, 6)).encode()
    whole = [c for _, crcs in importance.features(text) for c in crcs]
    parts = list(importance.features(text, most))
    assert sorted(c for _, crcs in parts for c in crcs) == sorted(whole)
    assert sum(n for n, _ in parts) == grams(text.decode())[0]


def test_resampling_of_ties_repeats_and_empty_tables(spark):
    texts = [prose(30, 1)] * 100
    same = frame(spark, texts).withColumn("doc_id", F.lit(7).cast("long"))
    rows = importance.resample(same, frame(spark, [])).collect()
    assert sorted(r["rank"] for r in rows if r["rank"]) == [1, 2, 3, 4, 5] and len(rows) == 100
    tied = spark.createDataFrame([(i, 1, 30, 5, 5) for i in range(60)],
                                 "doc_id long, n_features long, n_words long, weight long, score long")
    assert sorted((r["rank"], r.doc_id) for r in importance.ranked(tied).collect() if r["rank"]) == [
        (1, 0), (2, 1), (3, 2)]
    none = same.withColumn("doc_id", F.lit(None).cast("long"))
    assert importance.resample(none, same).where("score IS NULL").isEmpty()
    assert importance.resample(frame(spark, []), same).count() == 0


# prefix trie

TURNS = "conv_id long, turn long, role string, text string"


def trie(rows):
    """Plain form of the contract: rows (conv_id, turn, role, text) to a set of nodes."""
    lists = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            name = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()[:16]
            signed = [int.from_bytes(name[i:i + 8], "big", signed=True) for i in (0, 8)]
            lists[conv].append((turn is not None, turn or 0, signed, role, text))
    own = {c: [(r, t) for *_, r, t in sorted(x)] for c, x in lists.items()}
    whole = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6
        whole[c] = own.get(c - c % 100, [])[:h] + own[c][h:]
    members, ends = collections.defaultdict(set), collections.defaultdict(list)
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].add(c)
        ends[tuple(turns)].append(c)
    kids, leaves, saved = collections.Counter(), collections.Counter(), collections.Counter()
    for node in members:
        if node:
            kids[node[:-1]] += 1
    for node, held in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += not kids[node]
            saved[node[:d]] += (len(held) - 1) * len(node[-1][1]) if node else 0
    return sorted((min(held), len(node), min(members[node[:-1]]) if node else -1, len(held), kids[node],
                   leaves[node], saved[node], hashlib.sha256(
                       ",".join(map(str, sorted(ends[node]))).encode()).hexdigest())
                  for node, held in members.items())


def found(df):
    return sorted((r.conv_id, r.depth, -1 if r.parent_conv_id is None else r.parent_conv_id, r.n_convs,
                   r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in df.collect())


def conversations(seed, convs, depth, texts, hot=0):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(convs * 2), convs):
        n = rng.randint(1, depth)
        if c < hot:
            rows += [(c, t, "user", f"hot {t}") for t in range(9)]
        else:
            rows += [(c, rng.choice([t, t, t, None]) if not t else t, rng.choice(["user", None, "a"]),
                      rng.choice(texts)) for t in range(n)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,shard", [(1, 10**6), (2, 40), (3, 7), (4, 1)])
def test_trie_equals_brute_force(spark, seed, shard):
    texts = ["", None, "é😀", "yes", "no", "x" * 5000][:2 + seed]
    rows = conversations(seed, 150, 11, texts, hot=120)
    frame_ = spark.createDataFrame(rows, TURNS).withColumn("part", F.lit("x")).withColumn("key", F.lit(1))
    whole = prefix_trie.nodes(prefix_trie.rebuilt(frame_), most=shard, least=10**9)
    assert found(whole) == trie(rows)


@pytest.mark.parametrize("shard", [10**6, 300])
def test_trie_of_conversations_wider_than_the_matrix(spark, shard):
    rng, rows = random.Random(9), []
    for c in range(40):
        n = rng.choice([3, 63, 64, 65, 130, 200, 0])
        cut = rng.randrange(200)
        rows += [(c * 101, t, "user", "same" if t < cut else f"own {rng.randrange(2)}") for t in range(n)]
    whole = prefix_trie.nodes(prefix_trie.rebuilt(spark.createDataFrame(rows, TURNS)), most=shard, least=10**9)
    assert found(whole) == trie(rows)


def test_trie_of_one_opening_that_all_share(spark):
    rows = [(c, t, "user", f"{t}") for c in range(3000) for t in range(3)] + [
        (c, 3, "user", "more") for c in range(5)]
    whole = prefix_trie.nodes(prefix_trie.rebuilt(spark.createDataFrame(rows, TURNS)), most=700, least=10**9)
    assert found(whole) == trie(rows)


def test_trie_of_odd_rows(spark):
    rows = [(None, 1, "a", "b"), (105, 0, "a", "b"), (105, 0, "a", "b"), (105, None, None, None),
            (1, 0, "1", "x"), (2, 0, "", "1x")]
    assert found(prefix_trie.prefix_trie(spark.createDataFrame(rows, TURNS))) == trie(rows)
    assert prefix_trie.prefix_trie(spark.createDataFrame([], TURNS)).count() == 0
    assert prefix_trie.prefix_trie(spark.createDataFrame([(None, 1, "a", "b")], TURNS)).count() == 0
