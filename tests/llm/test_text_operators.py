"""Text operators against brute force, and on nulls, empty and long texts, ties and repeats."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from txlens.llm import decontam, factormachine, graphs, licenses, linechunks, mixing, quality, secretscan, simhash, substrings, toolcalls
from txlens.llm.textkit import Rolling, Words

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def prose(seed, words):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8))) for _ in range(words))


LONG = prose(1, 4000)
PASSAGE = prose(2, 60)
ODD = [
    (1, LONG, "en", "s0", 1), (2, LONG, "en", "s0", 1), (3, None, "en", "s0", None), (4, "", None, None, 0),
    (5, " \t\n\v\f\r ", "fr", "s1", 7), (6, "one", "fr", "s1", 3), (None, LONG, "fr", "s1", 3),
    (7, prose(3, 30) + " " + PASSAGE + " " + prose(4, 30), "de", "s2", 1),
    (8, prose(5, 80) + "\n" + PASSAGE + "\t" + prose(6, 10), "de", "s2", 1),
    (9, PASSAGE, "de", None, 1), (10, "a " * 300, "en", "s0", 600), (11, "a " * 120, "en", "s0", 240),
    (12, "É ÉÉ \U0001f600 wörter " * 30, "fr", "s3", 1), (12, "É ÉÉ \U0001f600 wörter " * 30, "fr", "s3", 1),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, DOCS)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


def words_of(text):
    return [w for w in re.split("[\x20\x09-\x0d]+", text or "") if w]


def rows(frame):
    return [tuple(r) for r in frame.collect()]


# --- array helpers -----------------------------------------------------------------------

def test_words_and_rolling_hashes():
    texts = ["  a  bb\n", None, "", "ccc", " \t ", "bb a", "É é"]
    words = Words(pa.array(texts))
    assert [words.text(i).decode() for i in range(len(texts))] == [" ".join(words_of(t)) for t in texts]
    assert np.diff(words.of).tolist() == [len(words_of(t)) for t in texts]
    hashes = Rolling(12345).spans(words.data, words.start, words.end)
    assert hashes[1] == hashes[3] and hashes[0] == hashes[4] and len(set(hashes.tolist())) == 5


# --- substring dedup -----------------------------------------------------------------------

def cut_by_hand(docs, length):
    first = {}
    for doc_id, text in docs:
        w = words_of(text)
        for i in range(len(w) - length + 1):
            key, rank = tuple(w[i:i + length]), (doc_id is None, doc_id)
            first[key] = min(first.get(key, rank), rank)
    out = []
    for doc_id, text in docs:
        w = words_of(text)
        gone = set()
        for i in range(len(w) - length + 1):
            if first[tuple(w[i:i + length])] < (doc_id is None, doc_id):
                gone |= set(range(i, i + length))
        kept = " ".join(x for j, x in enumerate(w) if j not in gone)
        out.append((doc_id, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("length", [3, 8, 50])
def test_substrings_by_hand(odd, length):
    got = substrings.remove_repeated_windows(odd.withColumn("anchors", F.lit(1)), length).drop("kept_text")
    assert sorted(rows(got), key=str) == cut_by_hand([r[:2] for r in ODD], length)


def test_substrings_of_random_overlaps(spark):
    rng = random.Random(9)
    blocks = [prose(100 + i, rng.randint(5, 90)) for i in range(12)]
    docs = [(i, " ".join(rng.choice(blocks) for _ in range(rng.randint(0, 5)))) for i in range(60)]
    got = substrings.remove_repeated_windows(spark.createDataFrame(docs, "doc_id long, text string")).drop("kept_text")
    assert sorted(rows(got), key=str) == cut_by_hand(docs, 50)


def test_substrings_of_nothing(nothing):
    assert rows(substrings.remove_repeated_windows(nothing)) == []


# --- SimHash ---------------------------------------------------------------------------------

def fingerprint(text, n=3):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    shingles = [b" ".join(w[i:i + n]) for i in range(max(len(w) - n + 1, 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(bits, distance=3):
    """Component of every node by brute force: the least index reached."""
    parent = list(range(len(bits)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i in range(len(bits)):
        for j in range(i):
            if (bits[i] ^ bits[j]).bit_count() <= distance:
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return [find(i) for i in range(len(bits))]


def test_simhash_on_given_documents(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    data = sorted(rows(docs.select("doc_id", "text")))
    bits = [fingerprint(t) for _, t in data]
    expected = [(d, f"{b:016x}", data[g][0]) for (d, _), b, g in zip(data, bits, groups(bits))]
    assert sorted(rows(simhash.near_duplicates(docs))) == expected


def test_simhash_links_by_brute_force(spark):
    rng = random.Random(5)
    bits = {0, (1 << 64) - 1}
    for _ in range(40):
        bits.add(center := rng.getrandbits(64))
        for _ in range(8):
            bits.add(center := center ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 4))))
    signed = [b - (1 << 64) if b >> 63 else b for b in bits]
    frame = spark.createDataFrame([(b,) for b in signed], "bits long")
    for distance in (0, 1, 2, 3):
        expected = {(a, b) for a in signed for b in signed if a < b and ((a ^ b) & (1 << 64) - 1).bit_count() <= distance}
        assert set(rows(simhash.links(frame, distance))) == expected
    with pytest.raises(ValueError):
        simhash.links(frame, 4)


def test_simhash_of_odd_rows(odd, nothing):
    got = rows(simhash.near_duplicates(odd.withColumn("bits", F.lit(1))))
    assert len(got) == len(ODD)
    by = {}
    for doc_id, bits, component in got:
        by.setdefault(doc_id, set()).add((bits, component))
    assert by[3] == by[4] == by[5] == {("0" * 16, 3)}
    assert {c for _, c in by[2] | by[None]} == {1} and by[12] == {(f"{fingerprint(ODD[-1][1]):016x}", 12)}
    assert rows(simhash.near_duplicates(nothing)) == []


def test_components_of_chain_star_and_ring(spark):
    links = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 160)] + [(200, 201), (201, 202), (202, 200), (7, 7), (None, 3)]
    random.Random(1).shuffle(links)
    got = dict(rows(graphs.components(spark.createDataFrame(links, "a long, b long"), "a", "b")))
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}, 200: 200, 201: 200, 202: 200}


# --- decontamination -------------------------------------------------------------------------

def edit_distance_inside(pattern, text):
    """Least edits of the pattern against any stretch of the text."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        new = [i]
        for j, t in enumerate(text, 1):
            new.append(min(row[j - 1] + (p != t), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(row)


def test_decontamination_by_brute_force(spark):
    rng = random.Random(3)
    items = [(i, prose(500 + i, rng.randint(8, 40))) for i in range(6)] + [(90, "short"), (91, None), (92, "eightltr"), (93, "a dozen and a half")]
    docs = []
    for i in range(24):
        text = items[i % 6][1]
        for _ in range(i // 2):
            at = rng.randrange(len(text))
            text = text[:at] + rng.choice(["", "x", "yz"]) + text[at + rng.randint(0, 1):]
        docs.append((i, prose(900 + i, 20) + "\n" + text.upper() + " " + prose(950 + i, 20)))
    docs += [(50, None), (51, ""), (52, items[0][1][:70]), (53, items[0][1][:20]), (54, "a" * 300), (50, None),
             (55, "Some EIGHTLTR here"), (56, "some eightlt r"), (57, "not a dozen  andx a half."), (58, "a dozen xxx a half"),
             *[(60 + k, "z " + items[2][1][k:k + 71] + " z") for k in range(0, 24, 5)]]  # a stretch that is sure to be found
    cut = {}
    for item_id, text in items:
        body = " ".join((text or "").lower().split()).encode()
        starts = sorted({*range(0, max(len(body) - 63, 1), 8), max(len(body) - 64, 0)}) if len(body) >= 8 else []
        cut[item_id] = [body[a:a + 64] for a in starts]
    expected = {}
    for doc_id, text in docs:
        body = " ".join(words_of(text)).lower().encode()
        for item_id, parts in cut.items():
            edits = [edit_distance_inside(part, body) for part in parts]
            near = [e for e, part in zip(edits, parts) if e <= min(len(part) // 12, len(part) // 8 - 1)]
            if near:
                expected[doc_id, item_id] = (len(near), len(parts), min(near))
    assert {(55, 92), (57, 93)} <= set(expected) and not {(56, 92), (58, 93)} & set(expected)
    assert {(60 + k, 2) for k in range(0, 24, 5)} <= set(expected)
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumn("region", F.lit("x"))
    bench = spark.createDataFrame(items, "item_id long, text string")
    for block_bytes in (1 << 20, 200):
        found = rows(decontam.find_leaks(frame, bench, block_bytes=block_bytes))
        assert {r[:2]: r[2:] for r in found} == expected and len(found) == len(expected)
    clean = decontam.clean_documents(frame, bench)
    assert clean.columns == frame.columns
    assert sorted(r.doc_id for r in clean.collect()) == sorted(d for d, _ in docs if d not in {e[0] for e in expected})


def test_decontamination_of_repetitive_texts(spark, monkeypatch):
    monkeypatch.setattr(decontam, "PAIRS", 1000)
    words = decontam.Words(pa.array(["ab " * 500, "x", "xy " * 200 + PASSAGE + " ab" * 30, None]))
    text, region, edits = decontam._leaks(words, decontam.Regions([(1, "ab " * 60), (2, PASSAGE)]))
    assert set(text.tolist()) == {0, 2} and max(edits) <= 5
    one = set(zip(text.tolist(), region.tolist()))
    monkeypatch.setattr(decontam, "PAIRS", 1 << 21)
    text, region, _ = decontam._leaks(words, decontam.Regions([(1, "ab " * 60), (2, PASSAGE)]))
    assert set(zip(text.tolist(), region.tolist())) == one


def test_decontamination_of_odd_rows(spark, odd, nothing):
    bench = spark.createDataFrame([(1, PASSAGE)], "item_id long, text string")
    assert {r[0] for r in rows(decontam.find_leaks(odd, bench))} == {7, 8, 9}
    assert rows(decontam.find_leaks(nothing, bench)) == rows(decontam.find_leaks(odd, bench.limit(0))) == []
    assert decontam.clean_documents(odd, bench).count() == len(ODD) - 3


# --- quality rules -----------------------------------------------------------------------------

def statistics_by_hand(text):
    text = text or ""
    w, lines = words_of(text), [x for x in text.split("\n") if words_of(x)]
    at, seen = set(), {}
    for i in range(len(w) - 7):
        seen.setdefault(tuple(w[i:i + 8]), []).append(i)
    for places in seen.values():
        if len(places) > 1:
            at |= {j for i in places for j in range(i, i + 8)}
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(at),
            len(w) < 20 or 100 * len(at) > 30 * len(w))


def test_statistics_by_hand(spark, odd):
    more = spark.createDataFrame([(90, "x\ny\nx\n \nx " + "#|< " * 30, "en", "s", 1), (91, PASSAGE + " " + PASSAGE + " z", "en", "s", 1)], DOCS)
    frame = quality.text_statistics(odd.union(more))
    for r in frame.collect():
        got = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
        assert got == statistics_by_hand(r.text), r.doc_id


def test_binomial_tail(spark):
    from math import comb
    cases = [(k, n, p) for n in (1, 10, 200) for p in (0.01, 0.3) for k in (0, 1, 3) if k <= n * p]
    for k, n, p in cases:
        frame = spark.createDataFrame([(k, n)], "k long, n long")
        got = frame.select(quality.binomial_tail(F.col("k"), F.col("n"), p)).first()[0]
        assert got == pytest.approx(sum(comb(n, i) * p ** i * (1 - p) ** (n - i) for i in range(k + 1)), rel=1e-9)


def test_cutoffs_hold_false_rejections(spark):
    good = [(i, prose(i, 40), "en", "s", 1) for i in range(3000)]
    bad = [(5000 + i, prose(i, 40).replace(" ", "## "), "en", "s", 1) for i in range(200)]
    few = [(9000 + i, prose(i, 40).replace(" ", "## "), "xx", "s", 1) for i in range(20)]
    docs = spark.createDataFrame(good + bad + few, DOCS)
    labels = spark.createDataFrame([(i, 1) for i in range(3000)] + [(5000 + i, 0) for i in range(200)] + [(0, None), (1, 1)],
                                   "doc_id long, quality int")
    kept = {r.doc_id for r in quality.judge(docs, labels).where("kept").collect()}
    assert len(kept & set(range(3000))) >= 2970
    assert not kept & set(range(5000, 5200))
    assert kept >= set(range(9000, 9020))  # a stratum without labels has base rules only


def test_cutoffs_hold_for_the_verdict_of_all_rules(spark):
    """Three rules that would each reject half of what is allowed reject too much together."""
    damage = [lambda t: t.replace(" ", " ## "), lambda t: t.replace(" ", "! "), lambda t: t.replace(" ", "x" * 30 + " ")]
    good = [(i, damage[i % 3](prose(i, 40)) if i < 120 else prose(i, 40), "en", "s", 1) for i in range(6000)]
    frame = spark.createDataFrame(good, DOCS).withColumn("lang", F.lit("ignored")).withColumn("cut_symbols", F.lit(0.0))
    labels = spark.createDataFrame([(i, 1) for i in range(6000)], "doc_id long, quality int")
    assert quality.judge(frame, labels).where("not kept").count() <= 60
    half = frame.select(quality._half(F.col("doc_id")).alias("h")).groupBy("h").count().collect()
    assert {r.h for r in half} == {0, 1} and min(r["count"] for r in half) > 2800


def test_quality_of_odd_rows(spark, odd, nothing):
    labels = spark.createDataFrame([(1, 1), (7, 0), (None, 1)], "doc_id long, quality int")
    judged = quality.judge(odd, labels)
    assert sorted((str(r.doc_id), r.kept) for r in judged.collect()) == sorted(
        (str(d), not statistics_by_hand(t)[5]) for d, t, *_ in ODD)
    assert quality.keep_good(odd, labels.limit(0)).columns == odd.columns
    assert rows(quality.judge(nothing, labels)) == []


# --- line dedup ----------------------------------------------------------------------------------

def test_lines_shift_resistant_and_kept_once(spark):
    passage = "\n".join(prose(i, 8) for i in range(20))
    docs = [(i, "\n".join(prose(1000 * i + k, 6) for k in range(5 + i)) + "\n" + passage + "\n"
             + "\n".join(prose(5000 * i + k, 6) for k in range(4)), "en") for i in range(1, 8)]
    docs += [(20, None, "en"), (21, "", "en"), (22, "a\nb", "en"), (None, passage, "en"), (5, docs[4][1], "en"), (30, "\n" * 50, "en"), (31, "\n" * 50, "en")]
    frame = spark.createDataFrame(docs, "doc_id long, text string, gone string")
    out = linechunks.dedup_lines(frame)
    got = {r.doc_id: r for r in out.collect()}
    assert out.count() == len(docs) and got[1].text == docs[0][1] and got[1].n_removed_lines == 0
    for i in range(2, 8):
        left = got[i].text.split("\n")
        assert len(docs[i - 1][1].split("\n")) - len(left) == got[i].n_removed_lines >= 14
        assert [x for x in docs[i - 1][1].split("\n") if x in left] == left
        assert set(docs[i - 1][1].split("\n")) - set(left) <= set(passage.split("\n"))
    assert (got[20].text, got[20].n_lines, got[21].text, got[22].text, got[None].text) == (None, 0, "", "a\nb", passage)
    assert got[30].text == got[31].text == "\n" * 50
    assert rows(linechunks.dedup_lines(frame.limit(0))) == []


def test_lines_of_runs_and_around_chunks(spark):
    run, body = "| a | b |", "\n".join(prose(i, 30) for i in range(40))
    docs = [(1, "\n".join([prose(91, 5)] + [run] * 9 + [prose(92, 5)])),
            (2, "\n".join([prose(93, 5)] * 1 + [run] * 400 + [prose(94, 5)])),
            (3, body), (4, "\n".join([prose(95, 5), body, prose(96, 5)])), (4, "\n".join([prose(97, 5), body])),
            (5, "\n".join(prose(200 + i % 5000, 6) for i in range(20000)))]
    got = {r.text: r for r in linechunks.dedup_lines(
        spark.createDataFrame([(d, t, 1, "x") for d, t in docs], "doc_id long, text string, _mark int, start string")).collect()}
    texts = sorted(got, key=len)
    assert docs[2][1] in got  # the first occurrence stays whole
    # a passage with a chunk inside goes from its first line to its last
    assert "\n".join([prose(95, 5), prose(96, 5)]) in got and prose(97, 5) in got
    assert sum(t.split("\n").count(run) for t in texts) <= 6
    long = max(got.values(), key=lambda r: r.n_lines)
    assert long.n_lines == 20000 and sorted(set(long.text.split("\n"))) == sorted(set(docs[5][1].split("\n")))
    assert long.n_removed_lines == 15000
    assert all(set(t.split("\n")) <= {x for _, d in docs for x in d.split("\n")} for t in texts)


# --- secret scans ---------------------------------------------------------------------------------

def spans_by_hand(text):
    found = []
    for rank, (kind, pattern, group, least) in enumerate([
            ("assign", "((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 8),
            ("access", "AKIA[A-Z0-9]+", 0, 16), ("hex", "[0-9a-f]+", 0, 32)]):
        found += [(m.start(), rank, kind, m.end()) for m in re.finditer(pattern, text or "") if len(m[group]) >= least]
    return ",".join(f"{k}:{s}:{e}" for s, _, k, e in sorted(found))


SECRETS = [
    (1, "é\U0001f600 Password = 'abcdefgh12' token=secret=abcdefgh token=secret:abcdefgh"), (2, "AKIA" + "A" * 12 + " AKIAAKIA"),
    (3, "token: " + "0a" * 16 + " " + "f" * 31 + " " + "f" * 32 + "g"), (4, None), (5, ""), (6, "api_key==x1234567=, apikey:short"),
    (7, "token: " + "0a" * 16 + " " + "f" * 31 + " " + "f" * 32 + "g"), (None, "secret='12345678'"), (4, None),
    (8, "x " * 2000 + "passwd=aaaaaaaaaaaa " * 40), (9, "ghp_" + "a1B2" * 10 + " -----BEGIN RSA PRIVATE KEY-----"),
]


def test_secrets_by_hand(spark):
    frame = spark.createDataFrame(SECRETS, "doc_id long, text string").withColumn("blob", F.lit(0))
    got = secretscan.secrets(frame).collect()
    assert len(got) == len(SECRETS)
    texts = dict(SECRETS)
    for r in got:
        base = spans_by_hand(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        assert ",".join(s for s in r.spans.split(",") if s.split(":")[0] in ("assign", "access", "hex")) == base
        assert [r.n_assign, r.n_access, r.n_hex] == [base.count(f"{k}:") for k in ("assign", "access", "hex")]
        if r.doc_id == 9:
            assert r.spans == "github:0:44,private_key:45:76"
    assert rows(secretscan.secrets(frame.limit(0))) == []


def test_ledger_scans_only_unseen_pairs(spark):
    frame = spark.createDataFrame(SECRETS, "doc_id long, text string")
    versions, ledger = secretscan.scan(frame)
    blobs = len({t or "" for _, t in SECRETS})
    assert ledger.count() == blobs * len(secretscan.RULES)
    # a planted finding shows that a pair already in the ledger is not scanned again
    marked = ledger.withColumn("spans", F.when((F.size("spans") > 0) & (F.col("kind") == "hex"), F.slice("spans", 1, 0)).otherwise(F.col("spans")))
    newer = [r._replace(version=2) if r.kind == "access" else r for r in secretscan.RULES]
    more = frame.union(spark.createDataFrame([(70, "AKIA" + "B" * 14)], "doc_id long, text string"))
    again = secretscan.secrets(more, marked, newer)
    got = {r.doc_id: r for r in again.collect()}
    assert got[3].n_hex == 0 and got[2].n_access == 1 and got[70].n_access == 1
    _, grown = secretscan.scan(more, marked, newer)
    assert grown.count() == blobs * len(secretscan.RULES) + blobs + len(secretscan.RULES)


# --- licences ---------------------------------------------------------------------------------------

def test_licenses(spark):
    docs = [(1, "x\nReleased under the MIT license\ny"), (2, "Licensed under the Apache License, Version 2.0."), (3, None), (4, ""),
            (5, "one"), (6, prose(1, 3000)), (7, "Licensed under the Apache License (Version 3.0)"), (None, "Released under the MIT License."),
            (8, "Released\nunder the\nMIT License"), (1, "x\nReleased under the MIT license\ny")]
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumn("line", F.lit(1))
    got = {r.doc_id: (r.n_hits, r.license, r.line) for r in licenses.licenses(frame).collect()}
    assert got == {1: (1, "MIT", 1), 2: (1, "Apache-2.0", 0), 3: (0, None, None), 4: (0, None, None), 5: (0, None, None),
                   6: (0, None, None), 7: (0, None, None), None: (1, "MIT", 0), 8: (1, "MIT", -1)}
    assert rows(licenses.licenses(frame.limit(0))) == []


def windows_by_hand(text, name, least=0.8):
    """Dice and first word of the best window of the template's length, over every place of the text."""
    def split(x):
        return re.sub(r"[\W_]+", " ", x.lower()).split()

    model = split(licenses.TEMPLATES[name])
    target, words = set(zip(model, model[1:])), split(text)
    found = []
    for i in range(len(words) - 1):
        if (words[i], words[i + 1]) in target:
            part = words[i:i + len(model)]
            held = set(zip(part, part[1:]))
            found.append((-2.0 * len(held & target) / (len(held) + len(target)), i))
    dice, at = min(found, default=(0, 0))
    return (at, -dice) if -dice >= least else None


def test_license_windows(spark):
    def wrapped(name, width):
        words = licenses.TEMPLATES[name].split()
        return "\n".join(" ".join(words[i:i + width]) for i in range(0, len(words), width))

    damaged = licenses.TEMPLATES["MIT-text"].replace("sublicense", "sell again").replace("merchantability", "")
    docs = [(1, prose(1, 50) + "\n" + wrapped("MIT-text", 11) + "\n" + prose(2, 50)),
            (2, "Copyright someone. " + licenses.TEMPLATES["MIT-grant"] + " and " + prose(3, 40)),
            (3, prose(4, 30) + " released under the MIT License. " + prose(5, 30)),
            (4, prose(6, 9) + "\n" + wrapped("BSD-2-Clause-text", 9) + "\n" + wrapped("ISC-text", 7)),
            (5, prose(7, 20) + "\n" + damaged), (6, " ".join(licenses.TEMPLATES["MIT-text"].split()[::-1])),
            (7, "released under the " * 200), (8, None), (9, prose(8, 3000) + " " + wrapped("GPL-3.0-notice", 8)),
            (10, ("\n" + wrapped("Apache-2.0-notice", 10)) * 3), (11, "Permission is hereby granted"),
            (None, prose(9, 30) + " released under the MIT License twice, released under the MIT License " + prose(10, 9))]
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumn("word", F.lit(1)).withColumn("dice", F.lit("x"))
    hits = licenses.license_hits(frame).collect()
    plain = {(r.doc_id, r.license) for r in hits if r.line != licenses.WINDOW}
    expected = {(i, name): at for i, text in docs for name in licenses.TEMPLATES
                if (at := windows_by_hand(text or "", name)) and (i, name) not in plain}
    got = [r for r in hits if r.line == licenses.WINDOW]
    assert {(r.doc_id, r.license): (r.word, r.dice) for r in got} == expected and len(got) == len(expected)
    assert {(1, "MIT-text"), (1, "MIT-grant"), (2, "MIT-grant"), (3, "MIT"), (4, "ISC-text"),
            (9, "GPL-3.0-notice"), (None, "MIT")} <= set(expected) and not {6, 7, 8, 11} & {i for i, _ in expected}
    assert (4, "BSD-2-Clause-text") in plain  # most of the whole text
    assert (5, "MIT-text") in plain | set(expected) and (10, "Apache-2.0-notice") in plain | set(expected)
    assert rows(licenses.licenses(frame, templates={})) == rows(licenses.licenses(frame, templates={"one": "word"}))
    assert {r.doc_id: r.license for r in licenses.licenses(frame).collect()}[1] in ("MIT-text", "MIT-grant")


# --- tool calls ---------------------------------------------------------------------------------------

def test_tool_calls(spark):
    good = '{"words": 2, "message": "é \\"x\\"", "style": "a"}'
    calls = spark.createDataFrame([
        (1, 5, "a", "reply", good, ["b"]), (1, 3, "b", "reply", '{"message":"m","words":"two"}', None),
        (2, 1, "a", "reply", good, ["c", "zz", None]), (2, 4, "c", "reply", '{"words":1}', []), (2, 6, "d", "nope", good, ["a"]),
        (3, 1, "x", "reply", good, ["y"]), (3, 2, "y", "reply", good, ["x"]), (3, 3, "z", "reply", "{bad", ["y"]), (3, 4, "w", "reply", "[1]", []),
        (4, 1, "r", "reply", good, []), (4, 2, "r", "reply", good, []), (None, None, None, None, None, None),
        (4, 2, "r", "reply", good, []), (4, 1, "r", "nope", good, []), (5, 1, None, "reply", good, []), (5, 1, None, "reply", good, []),
        (5, 2, None, "reply", "{}", []),
    ], "conv_id long, turn long, call_id string, name string, arguments string, after array<string>")
    results = spark.createDataFrame([(1, 6, "a", "out"), (4, 9, "r", "late"), (4, 3, "r", None), (9, 1, "q", "orphan"), (2, 5, "c", "o"),
                                     (4, 9, "r", "late"), (5, 3, None, "lost"), (5, 3, None, "lost")],
                                    "conv_id long, turn long, call_id string, output string").withColumn("status", F.lit("x"))
    every = toolcalls.link_calls(calls.withColumn("n_calls", F.lit(7)), results).collect()
    # each call and each result is in a record: repeated ones, and those without an identifier
    again = sorted((r.turn, r.status, r.n_calls, r.n_results, r.step) for r in every if r.call_id == "r")
    assert again == [(1, "ok", 4, 3, 1), (1, "unknown tool", 4, 3, 1), (2, "ok", 4, 3, 1), (9, "further result", 0, 3, None)]
    lone = sorted((r.turn, r.status) for r in every if r.conv_id == 5)
    assert lone == [(1, "no result"), (1, "no result"), (2, "message is missing"), (3, "no call"), (3, "no call")]
    first = {}
    for r in sorted(every, key=lambda r: (r.status == "further result", r.status != "ok", r.turn or 0)):
        first.setdefault((r.conv_id, r.call_id), r)
    got = {k: r for k, r in first.items() if k[0] != 5}
    assert got[1, "a"].record == '{"after":["b"],"arguments":{"message":"é \\"x\\"","style":"a","words":2},"id":"a","name":"reply","output":"out"}'
    status = {k: r.status for k, r in got.items()}
    assert status == {(1, "a"): "ok", (1, "b"): "words is not BIGINT", (2, "a"): "no result", (2, "c"): "message is missing",
                      (2, "d"): "unknown tool", (3, "x"): "cycle", (3, "y"): "cycle", (3, "z"): "cycle",
                      (3, "w"): "arguments are not an object", (4, "r"): "ok", (9, "q"): "no call", (None, None): "unknown tool"}
    assert got[1, "a"].step > got[1, "b"].step and got[2, "d"].step > got[2, "a"].step > got[2, "c"].step
    assert (got[4, "r"].n_calls, got[4, "r"].n_results, got[9, "q"].step) == (4, 3, None)
    assert rows(toolcalls.link_calls(calls.limit(0), results.limit(0))) == []


# --- mixing --------------------------------------------------------------------------------------------

def test_raking_meets_every_target(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    cells = mixing.count_cells(docs)
    targets = mixing.tempered_targets(cells)
    raked = mixing.rake(cells, targets, rounds=40, tolerance=1e-9).collect()
    for name in mixing.DIMENSIONS:
        share = {}
        for r in raked:
            share[r[name]] = share.get(r[name], 0) + r.weight * r.tokens
        assert share == pytest.approx(dict(rows(targets[name])), abs=1e-4)


def test_mixing_of_odd_rows(spark, odd, nothing):
    got = mixing.mix(odd.withColumn("probability", F.lit("x")), rounds=3).collect()
    assert len(got) == len(ODD) and all(0 <= r.probability <= 1 <= r.weight for r in got)
    assert {r.source for r in got} == {"s0", "s1", "s2", "s3", "(none)"} and len({r.sampled for r in got if r.doc_id == 12}) == 1
    assert all(r.sampled for r in got if r.probability == 1)
    assert rows(mixing.mix(nothing, rounds=1)) == []


# --- classifier -------------------------------------------------------------------------------------------

def test_pairs_by_the_sum_of_squares():
    rng = np.random.default_rng(0)
    model = factormachine.Model(0.3, rng.normal(size=factormachine.SIZE), rng.normal(size=(factormachine.SIZE, 3)))
    text, feature, value = factormachine.features(pa.array(["a b b c", "", None, "x"]), Rolling(7))
    got, _ = factormachine._forward(model, text, feature, value, 4)
    for i in range(4):
        f, v = feature[text == i], value[text == i]
        plain = 0.3 + (model.weights[f] * v).sum() + sum(
            model.factors[f[a]] @ model.factors[f[b]] * v[a] * v[b] for a in range(len(f)) for b in range(a))
        assert got[i] == pytest.approx(plain)


def test_classifier_on_held_out_labels(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    scored = factormachine.score(docs, factormachine.train(docs, labels)).join(labels, "doc_id").where("held_out").collect()
    assert len(scored) > 50 and sum(r.predicted == r.quality for r in scored) / len(scored) >= 0.95
    plain = factormachine.score(docs.withColumns({"lang": F.lit("zz"), "source": F.lit("zz")}), factormachine.train(
        docs, labels.withColumn("quality", F.when(factormachine.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))))
    same = {r.doc_id: r.score for r in plain.collect()}
    assert all(same[r.doc_id] == r.score for r in scored)


def test_classifier_of_odd_rows(spark, odd, nothing):
    labels = spark.createDataFrame([(1, 1), (3, 0), (6, 0), (7, 1), (None, 1), (8, None), (1, 0)], "doc_id long, quality int")
    model = factormachine.train(odd, labels)
    got = factormachine.score(odd.withColumn("score", F.lit("x")), model).collect()
    assert len(got) == len(ODD) and all(0 <= r.score <= 1 for r in got)
    assert rows(factormachine.score(nothing, model)) == []
    assert factormachine.train(odd, labels.limit(0)).bias == 0
