"""Each operator on small frames: brute force, nulls, empty and long texts, ties, repeats, clashes."""

import collections
import datetime
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import GroupedData
from pyspark.sql import functions as F

from gridcensus.llm import (automaton, decontaminate, graph, line_dedup, near_text, near_vectors,
                            packing, prob_minhash, quality, secret_scan, shards, token_counts,
                            url_lists, words)

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
RNG = random.Random(4)
VOCABULARY = ["".join(RNG.choice("abcdefghijklmnop") for _ in range(RNG.randint(2, 9)))
              for _ in range(400)]


def prose(words, seed):
    rng = random.Random(seed)
    return " ".join(rng.choice(VOCABULARY) for _ in range(words))


def edited(text, seed, changes):
    rng, words = random.Random(seed), text.split()
    for _ in range(changes):
        words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
    return " ".join(words)


def frame(spark, texts, schema=DOCS):
    return spark.createDataFrame(
        [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)], schema)


def clashing(docs):
    """Extra columns named like inner and outer ones."""
    names = ("size", "shard", "score", "key", "spans", "id", "words", "length", "n", "a", "_id")
    return docs.withColumns({n: F.lit("x") for n in names})


ODD = [None, "", " ", "\n\n", "!!! ???", "one", "é ß 日本 😀", "<|endoftext|> a", "it's we'll DON'T",
       "x" * 50_000, "  two\t\n words ", "same text here", "same text here"]


def test_token_counts_equal_the_library(spark):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    rng = random.Random(1)
    bits = ["'s", "'re", "'", " ", "  ", "\n", "\xa0", "\x1c", "The", "é", "12", "½", "!?", "日",
            "😀", "ing", "<|endoftext|>", "́", "_", "\x00"]
    texts = ODD + ["".join(rng.choice(bits) for _ in range(rng.randint(0, 30))) for _ in range(400)]
    rows = token_counts.token_counts(clashing(frame(spark, texts)), path).collect()
    library = Tokenizer.from_file(path)
    for row in rows:
        text = texts[row.doc_id] or ""
        want = len(library.encode(text, add_special_tokens=False).ids)
        assert (row.n_bytes, row.n_tokens, row.over_limit) == (len(text.encode()), want, want > 512)
    assert len(rows) == len(texts)
    assert token_counts.token_counts(frame(spark, []), path).count() == 0


def test_packing_round_trip_and_limits(spark):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    texts = ODD + [prose(n, n) for n in (3, 900, 2500, 40, 700)] + ["Σίσυφος İi", "<|startoftext|>"]
    pieces = packing.token_pieces(clashing(frame(spark, texts)), path, with_ids=True)
    limits = packing.Limits()
    rows = packing.pack(pieces, limits, group_rows=5).collect()
    library = Tokenizer.from_file(path)
    of_doc, of_sequence = collections.defaultdict(list), collections.defaultdict(list)
    for row in rows:
        of_doc[row.doc_id].append(row)
        of_sequence[row.sequence_id].append(row)
        assert zlib.crc32(np.array(row.ids, "<u4").tobytes()) == row.ids_crc32
    for i, text in enumerate(texts):
        ids = [x for r in sorted(of_doc[i], key=lambda r: r.start) for x in r.ids]
        assert ids == library.encode(text or "", add_special_tokens=False).ids + [1]
        assert all(r.doc_tokens == len(ids) for r in of_doc[i])
    for parts in of_sequence.values():
        parts.sort(key=lambda r: r.offset)
        assert [r.offset for r in parts] == [sum(q.length for q in parts[:k]) for k in range(len(parts))]
        assert sum(r.length for r in parts) <= limits.tokens
        assert sum(r.loss for r in parts) <= limits.loss and len(parts) <= limits.segments
    assert packing.pack(packing.token_pieces(frame(spark, []), path)).count() == 0


def test_every_limit_of_a_sequence_closes_some(spark):
    """Long answers are closed by loss, short documents by segments, the rest by tokens."""
    path = public_tokenizers.path("word_bpe_49k.json")
    texts = [prose(900 + 37 * i, i) for i in range(60)] + [prose(3, i) for i in range(300)] + [
        prose(100 + i, i) for i in range(300)]
    rows = packing.pack(packing.token_pieces(frame(spark, texts), path)).collect()
    limits, closed = packing.Limits(), collections.Counter()
    of_sequence = collections.defaultdict(list)
    for r in rows:
        asked = min(packing.PROMPT, r.doc_tokens // 2)
        assert r.loss == sum(at >= asked for at in range(r.start, r.start + r.length))
        assert r.length == r.doc_tokens or r.doc_tokens > 2 * packing.PROMPT
        of_sequence[r.sequence_id].append(r)
    used = 0
    for parts in of_sequence.values():
        tokens, loss = sum(r.length for r in parts), sum(r.loss for r in parts)
        assert tokens <= limits.tokens and loss <= limits.loss and len(parts) <= limits.segments
        used += tokens
        closed["tokens"] += tokens == limits.tokens
        closed["loss"] += loss == limits.loss
        closed["segments"] += len(parts) == limits.segments
    assert min(closed["tokens"], closed["loss"], closed["segments"]) >= 5, closed
    assert used / (2048 * len(of_sequence)) > 0.9


def test_fill_respects_every_dimension():
    rng = np.random.default_rng(3)
    tokens = rng.integers(1, 60, 500)
    loss = np.minimum(tokens, rng.integers(0, 40, 500))
    limits = packing.Limits(tokens=100, segments=4, loss=50)
    bins, offsets = packing.fill(tokens, loss, limits)
    for b in range(bins.max() + 1):
        at = bins == b
        assert tokens[at].sum() <= 100 and loss[at].sum() <= 50 and at.sum() <= 4
    assert len(offsets) == 500
    with pytest.raises(ValueError):
        packing.fill(np.array([101]), np.array([0]), limits)


def test_shards_are_near_equal_and_slots_gapless(spark):
    texts = [prose(5 + i % 37, i) for i in range(900)] + ["copy " * 30] * 600 + ODD
    docs = clashing(frame(spark, texts))
    rows = shards.shard(docs, shards=8, part_rows=40).select(
        "doc_id", "text", "size", "text_crc32", "shard", "slot").collect()
    assert sorted(r.doc_id for r in rows) == list(range(len(texts)))
    total, of_shard = 0, collections.defaultdict(list)
    for r in rows:
        raw = (r.text or "").encode()
        assert r.size == len(raw) + 16 and r.text_crc32 == zlib.crc32(raw)
        total += r.size
        of_shard[r.shard].append(r)
    assert set(of_shard) <= set(range(8))
    for part in of_shard.values():
        assert sorted(r.slot for r in part) == list(range(len(part)))
        assert abs(sum(r.size for r in part) - total / 8) <= 50_100  # the text of 50,000 characters
    assert shards.shard(frame(spark, []), shards=8).count() == 0


def test_groups_smaller_than_a_shard_stay_whole(spark):
    texts = [f"{prose(6, i)} {i % 3}" for i in range(3000)]
    for i in range(60):  # groups from two to a third of a shard, and one larger than a shard
        texts += [prose(8, 5000 + i)] * (2 + i)
    texts += [prose(9, 6000)] * 2500
    rows = shards.shard(clashing(frame(spark, texts)), shards=16).select("doc_id", "shard", "size").collect()
    places, sizes = collections.defaultdict(set), collections.Counter()
    for r in rows:
        places[texts[r.doc_id]].add(r.shard)
        sizes[r.shard] += r.size
    assert {t for t, found in places.items() if len(found) > 1} == {prose(9, 6000)}
    mean = sum(sizes.values()) / 16
    assert len(sizes) == 16 and max(abs(v - mean) for v in sizes.values()) < 0.3 * mean
    even = shards.shard(frame(spark, [prose(6, i) for i in range(4000)]), shards=16).groupBy("shard").agg(
        F.sum("size").alias("n")).collect()
    mean = sum(r.n for r in even) / 16
    assert max(abs(r.n - mean) for r in even) <= 0.002 * mean + 100


def test_shards_keep_columns_of_any_name(spark):
    names = ("_high", "_low", "_part", "_offset", "c0", "_rows")
    docs = frame(spark, ["a", "b"]).withColumns({n: F.lit(n) for n in names})
    out = shards.shard(docs, shards=2)
    assert [c for c in out.columns if c not in shards.OUTPUTS] == docs.columns
    assert all(r[n] == n for r in out.collect() for n in names)


def test_splitters_cut_a_group_of_equal_texts(spark):
    docs = frame(spark, ["same words"] * 1000)
    counts = shards.shard(docs, shards=4).groupBy("shard").count().collect()
    assert len(counts) == 4 and all(abs(r["count"] - 250) <= 1 for r in counts)


def base_spans(text):
    assign = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?"""
                        r"([A-Za-z0-9+/_.=-]+)")
    found = [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m.group(2)) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text)
              if m.end() - m.start() >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text)
              if m.end() - m.start() >= 24]
    return sorted(found)


def test_secret_spans_equal_regular_expressions(spark):
    rng = random.Random(9)
    bits = ["password", "PassWd", "secret", "token", "api_key", "APIKEY", "=", ":", " ", '"', "'",
            "abc", "é", "😀", "\n", "AKIA", "0123456789ab", "deadbeef", "A1B2C3D4E5F6G7H8", "+/",
            "token=mysecret: abcdef", "secret=token: abcdefgh"]
    texts = ODD + ["".join(rng.choice(bits) for _ in range(rng.randint(0, 25))) for _ in range(1500)]
    texts += ["0123456789abcdef" * 500, "a" * 3000 + "token=" + "b" * 3000]
    rows = secret_scan.scan(clashing(frame(spark, texts))).collect()
    names = secret_scan.BASE
    for row in rows:
        want = base_spans(texts[row.doc_id] or "")
        joined = ",".join(f"{names[k]}:{a}:{b}" for a, k, b in want)
        assert row.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert [row.n_assign, row.n_access, row.n_hex] == [
            sum(k == n for _, k, _ in want) for n in range(3)]
        assert set(filter(None, joined.split(","))) <= set(row.spans.split(","))
    assert secret_scan.scan(frame(spark, [])).count() == 0


def test_added_kinds_are_found(spark):
    key = "-----BEGIN RSA PRIVATE KEY-----"
    row = secret_scan.scan(frame(spark, [f"é {key} ghp_{'x1' * 18}Z"])).first()
    assert row.spans == f"private_key:2:{2 + len(key)},hosting_token:{3 + len(key)}:{44 + len(key)}"


def test_automaton_is_minimal():
    rule = automaton.alt(automaton.text("ab"), automaton.text("cb"))
    assert automaton.Automaton([rule], anchored=True).states == 4  # begin, middle, end, dead


def test_line_dedup_equals_brute_force(spark):
    long = [prose(60, 1000 + i) for i in range(6)]
    short = [prose(9, 2000 + i) for i in range(10)]
    texts = []
    for i in range(120):
        rng = random.Random(i)
        lines = [prose(rng.randint(1, 30), 100 * i + k) for k in range(rng.randint(0, 5))]
        at = rng.randint(0, len(lines))
        run = rng.randint(0, 4)
        lines[at:at] = [long[rng.randrange(6)]] if rng.random() < 0.5 else short[run:run + 7]
        texts.append("\n".join(lines))
    texts += [None, "", "\n", long[0] + "\n\n" + long[0], "  " + long[1].replace(" ", "  "),
              "\n".join(prose(8, 7000 + i) for i in range(3000))]
    rows = line_dedup.cleaned(clashing(frame(spark, texts))).collect()
    places, drop = {}, collections.defaultdict(set)
    for doc, text in enumerate(texts):
        lines = [(i, " ".join(x.split())) for i, x in enumerate((text or "").split("\n")) if x.split()]
        for s in range(len(lines)):
            words = 0
            for e in range(s, len(lines)):
                words += len(lines[e][1].split())
                if words >= line_dedup.WORDS:
                    content = "\n".join(x for _, x in lines[s:e + 1])
                    if places.setdefault(content, (doc, s)) != (doc, s):
                        drop[doc].update(range(lines[s][0], lines[e][0] + 1))
                    break
    assert sum(map(len, drop.values())) > 50 and len(rows) == len(texts)
    for row in rows:
        text = texts[row.doc_id]
        assert row.n_removed == len(drop[row.doc_id]) and row.key == "x"
        assert row.text == (None if text is None else "\n".join(
            x for i, x in enumerate(text.split("\n")) if i not in drop[row.doc_id]))
    assert line_dedup.cleaned(frame(spark, [])).count() == 0


def test_line_dedup_deletes_whole_repeated_runs(spark):
    run = [prose(n, 3000 + n) for n in (100, 11, 10, 9, 12, 30, 8, 7, 60, 5, 6)]
    texts = ["\n".join(run), "\n\n".join(run)]
    for i in range(60):  # parts of the run, cut anywhere, between lines of their own
        rng = random.Random(i)
        first = rng.randrange(len(run))
        part = run[first:rng.randint(first + 1, len(run))]
        texts.append("\n".join([prose(5, 4000 + i), *part, prose(rng.randint(1, 60), 5000 + i)]))
    texts += [run[0] + "\n" + "\n".join(run[1:4])] * 2
    lines = [[(k, x) for k, x in enumerate(t.split("\n")) if x] for t in texts]
    drop, places = collections.defaultdict(set), {}
    for doc, own in enumerate(lines):  # every run of 50 words or more, not only the shortest
        for s in range(len(own)):
            for e in range(s + 1, len(own) + 1):
                held = [x for _, x in own[s:e]]
                if sum(len(x.split()) for x in held) >= line_dedup.WORDS and places.setdefault(
                        tuple(held), (doc, s)) != (doc, s):
                    drop[doc].update(range(own[s][0], own[e - 1][0] + 1))
    got = {r.doc_id: r for r in line_dedup.cleaned(frame(spark, texts)).collect()}
    for doc, text in enumerate(texts):
        assert got[doc].n_removed == len(drop[doc])
        assert got[doc].text == "\n".join(
            x for i, x in enumerate(text.split("\n")) if i not in drop[doc])
    assert got[1].text == got[len(texts) - 1].text == ""


def test_contained_items_equal_brute_force(spark):
    items = [prose(n, 50 + n) for n in (5, 6, 9, 17, 40, 60, 33)] + ["a b", "", None,
                                                                           "What is two plus", "zebra", "!!"]
    texts = [prose(300, 900 + i) for i in range(30)]
    texts[7] += " (what is: TWO plus) two?"
    texts[8] += " a-b, a c b zebra"
    for i, item in enumerate(items[:7]):
        cut = item.split()
        texts[i] += " " + item.upper().replace(" ", ", ")
        texts[i + 10] += " " + " ".join(cut[:max(5, int(len(cut) * 0.9))]) + " " + texts[3]
        texts[i + 20] += " " + " ".join(cut[: len(cut) // 2])
    texts += ODD
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string").withColumn(
        "doc_id", F.lit(1))
    found = {(r.doc_id, r.item_id): r.n_found for r in decontaminate.contained(
        clashing(frame(spark, texts)), bench).collect()}

    def words(text):
        return re.findall(r"[^\W_]+", (text or "").lower())

    def grams(text, n):
        return {tuple(text[i:i + n]) for i in range(len(text) - n + 1)}

    want = {}
    for d, text in enumerate(texts):
        for i, item in enumerate(items):
            n = min(5, len(words(item)))  # a short item is one shingle
            have = grams(words(item), n) if n else set()
            if have and len(have & grams(words(text), n)) >= 0.8 * len(have):
                want[d, i] = len(have & grams(words(text), n))
    assert found == want and len(want) >= 13 and {(7, 10), (8, 7), (8, 11)} <= set(want)
    clean = decontaminate.without_contaminated(frame(spark, texts), bench)
    assert {r.doc_id for r in clean.collect()} == set(range(len(texts))) - {d for d, _ in want}
    assert decontaminate.contained(frame(spark, []), bench).count() == 0
    assert decontaminate.contained(frame(spark, texts), bench.limit(0)).count() == 0


def brute_groups(texts):
    sets = []
    for text in texts:
        words = re.findall(r"[^\W_]+", (text or "").lower())
        n = min(5, len(words))
        sets.append(collections.Counter(tuple(words[i:i + n]) for i in range(len(words) - n + 1))
                    if words else collections.Counter())
    group = list(range(len(texts)))

    def root(x):
        while group[x] != x:
            x = group[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and a.keys() & b.keys():
                both = a.keys() | b.keys()
                near = sum(1 / sum(max(a[k] / a[d], b[k] / b[d]) for k in both)
                           for d in a.keys() & b.keys())
                if near >= 0.8 - 1e-12:
                    x, y = root(i), root(j)
                    group[max(x, y)] = min(x, y)
    return [root(i) for i in range(len(texts))]


def test_near_groups_equal_brute_force(spark):
    base = [prose(120, i) for i in range(5)]
    texts = [edited(base[i % 5], i, 1 + i % 4) for i in range(90)]
    passage = prose(80, 77)
    texts += [passage + " " + prose(60, 500 + i) for i in range(30)]  # shared, but not alike
    texts += [base[0]] * 10 + [base[0].upper() + "!"] + ODD
    want = brute_groups(texts)
    for crowded in (near_text.CROWDED, 3):  # as it is, and with nearly every bucket split
        rows = near_text.near_groups(clashing(frame(spark, texts)), crowded=crowded).collect()
        assert len(rows) == len(texts)
        assert {r.doc_id: r.group_id for r in rows} == dict(enumerate(want))
        assert all(r.kept == (r.doc_id == r.group_id) for r in rows)
    kept = near_text.deduplicated(frame(spark, texts))
    assert {r.doc_id for r in kept.collect()} == set(want)
    assert near_text.near_groups(frame(spark, [])).count() == 0


def marked(spark, sketch, component, **how):
    """Ids with a like pair of their own in the one bucket of all sketches, the first band's."""
    buckets = spark.createDataFrame([(1, 0, i, component[i]) for i in range(len(sketch))],
                                    "key long, band int, id long, component long")
    classes = spark.createDataFrame([(i, r.tobytes()) for i, r in enumerate(sketch)],
                                    "id long, sketch binary")
    return near_text.open_members(buckets, classes, **how)


def test_near_text_tasks_are_bounded_in_one_large_bucket(spark, monkeypatch):
    most, plain = 200, GroupedData.applyInArrow

    def bounded(self, compare, schema):
        def checked(group):
            assert group.num_rows <= most, f"{group.num_rows} rows in a task"
            return compare(group)
        return plain(self, checked, schema)

    monkeypatch.setattr(near_text, "CHUNK", 60, raising=False)
    monkeypatch.setattr(GroupedData, "applyInArrow", bounded)
    rng = np.random.default_rng(1)
    sketch = rng.integers(0, 256, (900, 720), dtype=np.uint8)
    sketch[899], sketch[898] = sketch[7], sketch[820]  # an outsider like a member, two outsiders
    found = marked(spark, sketch, [0] * 800 + list(range(800, 900))).collect()
    assert sorted(r.id for r in found) == [7, 820, 898, 899]
    assert len({r.key for r in found if r.id in (7, 899)}) == 1


def test_one_common_band_is_enough_in_a_crowded_bucket(spark):
    sketch = np.random.default_rng(2).integers(0, 256, (12, 720), dtype=np.uint8)
    sketch[11] = sketch[0]
    assert sorted(r.id for r in marked(spark, sketch, list(range(12)), crowded=3).collect()) == [0, 11]


def test_a_pair_belongs_to_the_first_band_it_shares():
    a = np.random.default_rng(4).integers(0, 256, (1, 24), dtype=np.uint8)
    b = a.copy()
    b[0, 2] ^= 1  # bands of six: the first differs
    assert [near_text.owned(a, b, band, 6)[0] for band in range(-1, 4)] == [
        True, False, True, False, False]


def barely(base, apart, seed):
    """A text that shares all but ``apart`` shingles with the base, whose words are distinct."""
    words = base.split()
    return " ".join(words[:len(words) - apart] + [f"y{seed}x{i}" for i in range(apart)])


def test_near_links_of_a_bucket_of_thousands_near_the_threshold(spark, monkeypatch):
    """Groups just under and just over 0.8 within one crowd: links are found, pairs never listed."""
    rows_out, plain = [], near_text.cut_lineage
    monkeypatch.setattr(near_text, "cut_lineage", lambda df: rows_out.append(
        (kept := plain(df)).count()) or kept)
    base = " ".join(f"w{i}" for i in range(104))  # 100 shingles
    over = [barely(base, 11, i) for i in range(2500)]   # 89 of 111 with each other: 0.802
    under = [barely(base, 12, i + 5000) for i in range(2500)]  # 88 of 112: 0.786 with all
    docs = frame(spark, over + under)
    found = {r.doc_id: r.group_id for r in near_text.near_groups(docs).collect()}
    assert found == dict.fromkeys(range(2500), 0) | {i: i for i in range(2500, 5000)}
    assert max(rows_out) < 5000 * 2 * near_text.BANDS


def test_parts_of_words_by_bytes_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(near_text, "PART_BYTES", 3000)
    monkeypatch.setattr(near_text, "BIN_BYTES", 5000)
    base = [prose(120, i) for i in range(3)]
    texts = [edited(base[i % 3], i, 1 + i % 4) for i in range(60)]
    rows = near_text.near_groups(frame(spark, texts), crowded=3).collect()
    assert {r.doc_id: r.group_id for r in rows} == dict(enumerate(brute_groups(texts)))


def test_an_id_with_two_texts_loses_only_the_copy(spark):
    texts = [prose(60, 1), prose(60, 1), prose(60, 2)]
    docs = spark.createDataFrame([(1, texts[0], "x"), (5, texts[1], "y"), (5, texts[2], "z"), (None, texts[0], "w")],
                                 "doc_id long, text string, lang string")
    assert sorted(r.lang for r in near_text.deduplicated(docs).collect()) == ["w", "x", "z"]


def test_signatures_estimate_probability_jaccard():
    rng = np.random.default_rng(5)
    shared = rng.integers(1, 2**63, 300, dtype=np.uint64)
    a = np.unique(np.append(shared, rng.integers(1, 2**63, 60, dtype=np.uint64)))
    b = np.unique(np.append(shared, rng.integers(1, 2**63, 90, dtype=np.uint64)))
    wa, wb = 1 + (a % 3).astype(np.int64), 1 + (b % 3).astype(np.int64)
    signature = prob_minhash.signatures(
        np.append(a, b), np.append(wa, wb).astype(float),
        np.repeat([0, 1], [len(a), len(b)]), 2, 6000)
    want = prob_minhash.probability_jaccard((a, wa), (b, wb))
    assert abs((signature[0] == signature[1]).mean() - want) < 0.03


def test_components_of_a_long_chain(spark):
    order = list(range(200))
    random.Random(2).shuffle(order)
    links = list(zip(order[:-1], order[1:])) + [(500, 501), (501, 500), (700, 700)]
    found = {r.id: r.component for r in graph.components(
        spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == dict.fromkeys(range(200), 0) | {500: 500, 501: 500}


def test_near_vectors_equal_brute_force(spark):
    rng = np.random.default_rng(8)
    rows = [rng.standard_normal(24) for _ in range(150)]
    center = rng.standard_normal(24)
    rows += [center + 0.25 * rng.standard_normal(24) for _ in range(150)]
    rows += [rows[3], rows[3] * 7, rows[3] * 1e200]
    table = [(i, [float(x) for x in v], i % 3) for i, v in enumerate(rows)]
    odd = [None, [], [0.0] * 24, [float("nan")] + [1.0] * 23, [None] + [1.0] * 23, [1.0] * 8,
           [float("inf")] * 24]
    table += [(1000 + i, v, 0) for i, v in enumerate(odd)]
    frame_ = spark.createDataFrame(table, "vec_id long, embedding array<double>, label int").withColumn(
        "size", F.lit(3))
    unit = np.array([v / np.abs(v).max() for v in rows])
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.9
    np.fill_diagonal(near, False)
    group = np.arange(len(rows))
    while True:
        new = np.array([min([group[i], *group[near[i]]]) for i in range(len(rows))])
        if (new == group).all():
            break
        group = new
    got = {r.vec_id: r for r in near_vectors.near_vectors(frame_).collect()}
    assert len(got) == len(table)
    for i in range(len(rows)):
        assert (got[i].n_links, got[i].component_id) == (near[i].sum(), group[i])
    for i in range(len(odd)):
        assert (got[1000 + i].n_links, got[1000 + i].component_id) == (0, 1000 + i)
    known, counts, _ = near_vectors.links(frame_, tile=20)  # many tiles, same counts
    assert counts.agg(F.sum("n")).first()[0] == sum(
        r.n for r in near_vectors.links(frame_)[1].collect())
    assert known.count() == len(rows)  # one repeated, one of another length
    assert near_vectors.near_vectors(frame_.limit(0)).count() == 0


def test_near_vectors_reach_at_forty_dimensions(spark):
    rng, turned = np.random.default_rng(3), []
    for _ in range(150):  # pairs that only the first of two blocks finds, 0.3 apart in its range
        half = np.zeros(40)
        half[0], half[20] = 0.15, 0.162
        w = rng.standard_normal(40)
        w[0] = w[20] = 0
        first = rng.uniform(-0.4, 0.4)
        second = -first * half[0] / half[20]
        w *= np.sqrt(1 - half @ half - first**2 - second**2) / np.linalg.norm(w)
        w[0], w[20] = first, second
        turned += [w + half, w - half]
    rows = np.array(turned) @ near_vectors.rotation(40).T
    near = rows @ rows.T >= 0.9
    want = int(near.sum()) - len(rows)
    table = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(rows)],
                                  "vec_id long, embedding array<double>")
    assert want >= 300
    assert near_vectors.links(table, tile=3)[1].agg(F.sum("n")).first()[0] == want


def test_url_lists_intervals_and_verdicts(spark):
    day = datetime.date
    entries = spark.createDataFrame([
        ("a", "example.org", "block", day(2024, 1, 10), 0),
        ("a", "example.org", None, day(2024, 3, 1), 1),          # removed
        ("a", "example.org", "block", day(2024, 5, 1), 2),
        ("a", "example.org", "allow", day(2024, 5, 1), 3),        # last of the day wins
        ("b", "sub.example.org", "allow", day(2024, 1, 1), 0),
        ("b", "other.net/en", "block", day(2024, 2, 1), 0),
        ("b", "sub.example.org", "block", day(2024, 2, 1), 1),
        ("a", "sub.example.org", "allow", day(2024, 2, 1), 0),    # a tie: allow wins
        (None, "other.net", "block", day(2024, 1, 1), 0), ("a", None, "block", day(2024, 1, 1), 0),
        ("a", "other.net", "block", None, 0)],
        "list string, pattern string, verdict string, listed_on date, seq int")
    cases = [
        ("http://example.org/x", day(2024, 1, 9), 0, False), ("http://example.org/x", day(2024, 1, 10), 1, True),
        ("http://www.Example.org:80", day(2024, 2, 29), 1, True), ("http://example.org/x", day(2024, 3, 1), 0, False),
        ("http://example.org/x", day(2024, 6, 1), 1, False), ("https://u@sub.example.org/", day(2024, 1, 20), 2, False),
        ("https://sub.example.org/", day(2024, 2, 20), 3, False), ("http://other.net/en/1?q#f", day(2024, 2, 1), 1, True),
        ("http://other.net/en/1", day(2024, 1, 31), 0, False), ("notexample.org", day(2024, 2, 1), 0, False),
        ("http://notexample.org/", day(2024, 2, 1), 0, False), (None, day(2024, 2, 1), 0, False),
        ("", day(2024, 2, 1), 0, False), ("http://example.org/x", None, 0, False)]
    captures = spark.createDataFrame(
        [(i, u, d) for i, (u, d, _, _) in enumerate(cases)], "page_id long, url string, fetched_on date")
    captures = captures.unionByName(captures.limit(2)).withColumn("pattern", F.lit("example.org"))
    rows = {r.page_id: r for r in url_lists.evaluate(captures, entries).collect()}
    for i, (_, _, active, blocked) in enumerate(cases):
        assert (rows[i].n_active, rows[i].blocked) == (active, blocked), cases[i]
    assert url_lists.evaluate(captures, entries.limit(0)).where("blocked").count() == 0
    assert url_lists.evaluate(captures.limit(0), entries).count() == 0


def test_hosts_of_odd_urls(spark):
    cases = {
        "http://10.1.2.3:8080/x": ("10.1.2.3", ["10.1.2.3", "10.1.2.3/x"]),
        "http://[2001:db8::1]:80/x": ("[2001:db8::1]", ["[2001:db8::1]", "[2001:db8::1]/x"]),
        "https://Example.org./a": ("example.org", ["example.org", "example.org/a"]),
        "http://user@ex.org@evil.com/": ("evil.com", ["evil.com"]),
        "http://u:p@sub.ex.org:1/": ("sub.ex.org", ["sub.ex.org", "ex.org"]),
        "http://localhost": ("localhost", ["localhost"]), "http://@/": (None, None), "x": (None, None)}
    rows = spark.createDataFrame([(u,) for u in cases], "url string").select(
        "url", url_lists.host(F.col("url")).alias("host"), url_lists.patterns(F.col("url")).alias("p"))
    for r in rows.collect():
        host, found = cases[r.url]
        assert r.host == host and (host is None or r.p == found), r


def test_a_common_key_is_joined_where_it_lies(spark):
    left = spark.createDataFrame([(1 if i % 3 else i, i) for i in range(900)], "k int, i int")
    keyed = left.groupBy("k").agg(F.count("*").alias("_n"), F.min("i").alias("first"))
    got = words.hot_join(left, keyed.where("k <> 9"), "k", "inner", most=10)
    assert got.columns == ["k", "i", "first"] and got.count() == 899
    assert got.where("k = 1 AND first <> 1").isEmpty()
    assert words.hot_join(left, keyed.where("k = 9"), "k", "left_semi", most=10).count() == 1


def test_votes_equal_plain_neighbours():
    rng = np.random.default_rng(6)
    unit = lambda n: (x := rng.standard_normal((n, 8))) / np.linalg.norm(x, axis=1, keepdims=True)
    known, rows, labels = unit(300), unit(1100), rng.integers(0, 2, 300).astype(float)
    got = quality.votes(rows, known, labels, 25, 0.4)
    for i in range(0, 1100, 7):
        cosine = [float(a @ rows[i]) for a in known]
        near = sorted(range(300), key=lambda j: -cosine[j])[:25]
        weight = [max(cosine[j], 0.0) for j in near]
        assert abs(got[i] - sum(w * labels[j] for w, j in zip(weight, near)) / sum(weight)) < 1e-9
    assert quality.votes(rows[:3], -rows[:1], labels[:1], 25, 0.4)[0] == 0.4  # none alike


def test_the_rank_is_chosen_by_inner_folds():
    rng = np.random.default_rng(9)
    labels = rng.integers(0, 2, 400).astype(float)
    latent = rng.standard_normal((400, 6)) * 0.3
    latent[:, 3] += np.where(labels > 0, 2, -2)  # only the fourth coordinate tells
    assert quality.chosen_shape(latent, labels, (2, 4, 6), (25,)) == (4, 25)
    assert quality.chosen_shape(latent, np.ones(400), (2, 4, 6), (5, 25)) == (2, 25)
    few = np.r_[np.zeros(12), np.ones(388)]  # a small group that many neighbours outvote
    spots = np.where(few[:, None] > 0, [[1.0, 0.0]], [[0.6, 0.8]]) + rng.standard_normal((400, 2)) * 0.01
    assert quality.chosen_shape(spots, few, (2,), (5, 25)) == (2, 5)


def test_terms_know_no_sign_by_name():
    texts = [b"abc abc x|y|z", b"", b"a", "é日本 日本".encode()]
    at = np.cumsum([0] + [len(t) for t in texts])
    counts = quality.term_counts(np.frombuffer(b"".join(texts), np.uint8), at)
    assert counts.shape == (4, quality.TERMS) and counts[0, :quality.GRAMS].sum() == len(texts[0]) - 2
    assert counts[0, quality.GRAMS:].tolist() == [1, 0, 3] and not counts[1].any()


def labelled(spark, n=600):
    texts, labels = [], []
    for i in range(n):
        good = i % 3 > 0
        text = prose(60, i)
        texts.append(text if good else [
            " ".join(w + "%%%" for w in text.split()), text.upper().replace(" ", "!! "),
            " ".join(w for w in text.split()[:5] for _ in range(12))][i // 3 % 3])
        labels.append((i, int(good), 0))
    return frame(spark, texts), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_quality_votes_on_held_out_rows(spark):
    docs, labels = labelled(spark)
    model = quality.fit(docs, labels)
    rows = quality.score(docs, model).collect()
    held = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert len(held) > 80
    assert np.mean([r.predicted == (r.doc_id % 3 > 0) for r in held]) > 0.97
    again = {r.doc_id: r.score for r in quality.score(docs, quality.fit(docs, labels)).collect()}
    assert again == {r.doc_id: r.score for r in rows}
    odd = quality.score(clashing(frame(spark, ODD)), model, ["doc_id", "score", "text"])
    assert odd.columns == ["doc_id", "score", "text", "score", "predicted"] and odd.count() == len(ODD)
    kept = quality.accepted(clashing(docs), model)
    assert kept.columns == clashing(docs).columns and 350 < kept.count() < 450
    assert quality.score(frame(spark, []), model).count() == 0
    blank = quality.score(frame(spark, [None, ""]), model).collect()
    assert all(abs(r.score - model.labels.mean()) < 1e-6 for r in blank)


def test_quality_without_labels_scores_half(spark):
    docs, labels = labelled(spark, 30)
    no = labels.withColumn("quality", F.lit(None).cast("int"))
    assert {r.score for r in quality.score(docs, quality.fit(docs, no)).collect()} == {0.5}
