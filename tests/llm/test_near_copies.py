"""Near-duplicate stage against brute-force Jaccard of 5-word shingles."""

import random

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.test_text_operators import DOCS, ODD, prose, rows, words_of
from txlens.llm import nearcopies, simhash


def shingles(text, n=5):
    w = [x.encode().lower() for x in words_of(text)]
    return {tuple(w[i:i + n]) for i in range(max(len(w) - n + 1, 1))} if w else set()


def least_of_groups(docs):
    sets, root = [shingles(t) for _, t in docs], list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i, x in enumerate(sets):
        for j, y in enumerate(sets[:i]):
            if x == y or 5 * len(x & y) >= 4 * len(x | y):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    least = {}
    for i, (d, _) in enumerate(docs):
        least[find(i)] = min(least.get(find(i), d), d)
    return set(least.values())


def edited(rng, text, edits):
    w = text.split()
    for _ in range(edits):
        at = rng.randrange(len(w))
        w[at:at + rng.randint(0, 1)] = [prose(rng.random(), 1)]
    return " ".join(w)


def test_near_copies_by_brute_force(spark):
    rng = random.Random(4)
    docs = []
    for i in range(60):
        text = prose(i, rng.choice([6, 12, 30, 60, 200, 900]))
        for _ in range(4):
            docs.append((len(docs), text))
            text = edited(rng, text, rng.randint(0, max(len(text.split()) // 45, 1)))
    rng.shuffle(docs)
    expected = least_of_groups(docs)
    assert 60 < len(expected) < 200
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumn("node", F.lit(1))
    # the stage's fingerprints of 64 bits kept near copies that differ by more than three bits
    got = corpus_pipeline.near_dedup(spark, frame, None)
    assert got.columns == frame.columns
    assert sorted(r.doc_id for r in got.collect()) == sorted(expected)


def sets_of(spark, sets):
    return spark.createDataFrame([(i, len(s), sorted(s)) for i, s in enumerate(sets)], "node long, size long, shingles array<long>")


def near(x, y):
    return 5 * len(x & y) >= 4 * len(x | y)


def test_filters_lose_no_pair(spark):
    """Random sets around common ones: near pairs share a rare shingle, and their differences agree."""
    rng = random.Random(6)
    sets = []
    for size in (1, 2, 3, 5, 9, 20, 40, 90, 200):
        base = [rng.getrandbits(62) for _ in range(size)]
        for _ in range(30):
            drop = rng.randint(0, max(size // 6, 1))
            kept = set(rng.sample(base, max(size - drop, 1))) | {rng.getrandbits(62) for _ in range(rng.randint(0, max(size // 6, 1)))}
            if rng.random() < 0.4 and sets:  # the same edits again, and some more
                kept = set(rng.choice(sets)) - set(rng.sample(base, size // 10))
            sets.append(kept or {1})
    sets = [set(s) for s in dict.fromkeys(map(frozenset, sets))]
    frame = nearcopies.stage(sets_of(spark, sets))
    rare = nearcopies._under_rare_shingles(frame).collect()
    under = {}
    for r in rare:
        under.setdefault(r["shingle"], set()).add(r["node"])
    true = {(i, j) for j in range(len(sets)) for i in range(j) if near(sets[i], sets[j])}
    assert len(true) > 100 and all(any({i, j} <= nodes for nodes in under.values()) for i, j in true)
    # one leader for all sets: whatever is near is either near to it or among the agreeing pairs
    for lead in (0, len(sets) // 2, len(sets) - 1):
        led = spark.createDataFrame([(lead, i) for i in range(len(sets)) if i != lead], "lead long, node long")
        deltas = nearcopies.stage(nearcopies._differences(frame, led).withColumn(
            "far", 9 * F.size("delta") > F.col("words") + F.col("lead_size")))
        close = {lead} | {r["node"] for r in deltas.where("not far").collect()}
        assert close == {i for i, s in enumerate(sets) if near(s, sets[lead])}
        pairs = nearcopies._agreeing(deltas)
        agreeing = {(r["a"], r["b"]) for r in pairs.collect()}
        wanted = {(i, j) for i, j in true if not {i, j} <= close and lead not in (i, j)}
        assert wanted <= agreeing
        assert {(r["a"], r["b"]) for r in nearcopies._near(frame, pairs).collect()} == agreeing & true


def test_a_group_of_close_texts_is_not_compared_pair_by_pair(spark):
    """Texts with edits of their own, each near to the base or not: hardly a pair passes the filters."""
    base = [7 * i + 10**6 for i in range(160)]
    rng = random.Random(9)
    sets = [set(base)]
    for _ in range(400):
        lost = set(rng.sample(base, rng.randint(5, 24)))
        sets.append((set(base) - lost) | {rng.getrandbits(62) for _ in lost})
    frame = nearcopies.stage(sets_of(spark, sets))
    led = spark.createDataFrame([(0, i) for i in range(1, 401)], "lead long, node long")
    deltas = nearcopies.stage(nearcopies._differences(frame, led).withColumn(
        "far", 9 * F.size("delta") > F.col("words") + F.col("lead_size")))
    far = deltas.where("far").count()
    assert far > 50 and nearcopies._agreeing(deltas).count() < far * 400 / 100


def test_rows_of_one_doc_id_are_judged_by_their_own_texts(spark):
    text, other = prose(1, 80), prose(2, 80)
    docs = [(1, text, 1), (2, text, 2), (2, other, 3), (2, other, 3), (None, prose(3, 80), 4), (None, prose(4, 80), 5), (None, text, 6)]
    kept = nearcopies.keep_first(spark.createDataFrame(docs, "doc_id long, text string, key long"))
    assert sorted(r["key"] for r in kept.collect()) == [1, 3, 4, 5] and kept.columns == ["doc_id", "text", "key"]


def test_groups_joined_by_pairs_that_miss_the_ends(spark):
    """A group in which most pairs are below the bound is found by its few links."""
    base = prose(77, 400)
    docs = [(i, edited(random.Random(i), base, 11)) for i in range(1, 40)] + [(0, base)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    assert {r.doc_id for r in nearcopies.keep_first(frame).collect()} == least_of_groups(docs)


def test_near_copies_of_odd_rows(spark):
    odd = spark.createDataFrame(ODD, DOCS)
    kept = nearcopies.keep_first(odd)
    assert kept.columns == odd.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3, 6, 7, 8, 9, 10, 12]
    assert rows(nearcopies.keep_first(odd.limit(0))) == []


def test_pairs_that_fingerprints_missed(spark):
    docs = [(i, edited(random.Random(i), prose(500, 200), 2)) for i in range(6)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    assert simhash.near_duplicates(frame).select("component_id").distinct().count() > 1
    got = corpus_pipeline.near_dedup(spark, frame, None)
    assert {r.doc_id for r in got.collect()} == least_of_groups(docs) == {0}


def test_fingerprints_link_what_is_near_and_within_three_bits(spark):
    """Every near pair of different fingerprints at most three bits apart is found by the pigeonring chains."""
    rng = random.Random(12)
    sets = []
    for size in (3, 30, 300, 900):
        base = {rng.getrandbits(62) for _ in range(size)}
        for lost in range(6):
            sets.append({x for i, x in enumerate(sorted(base)) if i >= lost * size // 100 or i == size - 1} | {rng.getrandbits(62) for _ in range(lost // 3)})
    sets = [set(s) for s in dict.fromkeys(map(frozenset, sets))]
    prints = [sum((2 * sum(x >> k & 1 for x in s) > len(s)) << k for k in range(64)) for s in sets]
    signed = [b - (1 << 64) if b >> 63 else b for b in prints]
    assert signed == [simhash.majority(np.array(sorted(s), np.uint64)) for s in sets]
    frame = nearcopies.stage(spark.createDataFrame(
        [(i, len(s), b, sorted(s)) for i, (s, b) in enumerate(zip(sets, signed))],
        "node long, size long, bits long, shingles array<long>"))
    first = {b: prints.index(b) for b in prints}
    within = {(i, j) for j in range(len(sets)) for i in range(j) if near(sets[i], sets[j]) and (
        first[prints[j]] == i if prints[i] == prints[j] else
        first[prints[i]] == i and first[prints[j]] == j and (prints[i] ^ prints[j]).bit_count() <= 3)}
    assert len(within) > 5
    assert {(r["a"], r["b"]) for r in nearcopies.fingerprint_links(frame).collect()} == within


def test_the_stage_links_by_fingerprints(spark, monkeypatch):
    asked = []
    search = simhash.links
    monkeypatch.setattr(simhash, "links", lambda different, distance=3: asked.append(different) or search(different, distance))
    docs = [(i, edited(random.Random(i), prose(500, 400), 1)) for i in range(6)]
    corpus_pipeline.near_dedup(spark, spark.createDataFrame(docs, "doc_id long, text string"), None)
    assert len(asked) == 1 and asked[0].count() > 1
