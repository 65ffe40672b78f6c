"""The corpus pipeline, stage by stage, against a brute-force version on a small corpus."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.test_text_operators import (edit_distance_inside, fingerprint, groups, prose, statistics_by_hand,
                                           words_of)
from txlens.llm import decontam
from txlens.llm.linechunks import FACTOR, PRIME

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def corpus():
    rng = random.Random(11)
    passage = "\n".join(prose(70 + i, 7) for i in range(12))
    items = [(i, prose(300 + i, 20)) for i in range(4)]
    docs = []
    for i in range(70):
        lines = [prose(1000 * i + k, rng.randint(4, 9)) for k in range(rng.randint(6, 14))]
        if i % 6 == 1:
            lines.insert(3, passage)
        if i % 9 == 2:
            lines.insert(2, items[i % 4][1].replace(" ", "  ", 1).upper())
        if i % 11 == 3:
            lines = [" ".join([prose(i, 5)] * 12)]
        docs.append([i, "\n".join(lines), rng.choice(["en", "en", "fr", None]), rng.choice(["s0", "s0", "s1", None]), 5])
    for i in range(70, 78):  # exact copies, and copies with one word more
        docs.append([i, docs[i - 65][1] + (" " + prose(i, 1) if i % 2 else ""), "en", "s2", 5])
    docs += [[90, None, "en", "s0", None], [91, "", "en", "s0", 0], [92, "few words", "fr", "s1", 1],
             [93, passage, "en", "s0", 1], [None, prose(9393, 40), "en", "s0", 1]]
    return [tuple(d) for d in docs], items


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("corpus"))
    docs, items = corpus()
    spark.createDataFrame(docs, SCHEMA).withColumn("gone", F.lit("clash")).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    spark.createDataFrame([(1, 1, 0), (2, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def chunks_by_hand(text):
    """First line and line after the last of each chunk."""
    lines = text.split("\n")
    h = [int(hashlib.md5(x.encode()).hexdigest()[:15], 16) % PRIME for x in lines]
    r = [((h[i - 1] if i else 0) * FACTOR + h[i]) % PRIME for i in range(len(h))]
    starts = [0]
    for i in range(1, len(h)):
        like_last, like_next = h[i] == h[i - 1], i + 1 < len(h) and h[i] == h[i + 1]
        lowest = r[i] < r[i - 1] and (i + 1 == len(r) or r[i] < r[i + 1])
        run_before = i > 1 and h[i - 1] == h[i - 2]
        if (like_next and i % 2 == 0) if like_last else (lowest or like_next or run_before):
            starts.append(i)
    return list(zip(starts, starts[1:] + [len(lines)]))


def lines_by_hand(docs):
    cut = {k: (d[1].split("\n"), chunks_by_hand(d[1])) for k, d in enumerate(docs) if d[1] is not None and d[0] is not None}
    first = {}
    for k in sorted(cut, key=lambda k: docs[k][0]):
        lines, chunks = cut[k]
        for c, (a, b) in enumerate(chunks):
            if b - a > 1 and words_of("\n".join(lines[a:b])):
                first.setdefault(tuple(lines[a:b]), (k, c))
    out = []
    for k, d in enumerate(docs):
        if k not in cut:
            out.append(d)
            continue
        lines, chunks = cut[k]
        gone = set()
        for c, (a, b) in enumerate(chunks):
            where = first.get(tuple(lines[a:b]))
            if where is None or where == (k, c):
                continue
            others, places = cut[where[0]]
            gone |= set(range(a, b))
            low, high = chunks[max(c - 2, 0)][0], chunks[min(c + 2, len(chunks) - 1)][1]
            x, y = places[where[1]]
            low_1, high_1 = places[max(where[1] - 2, 0)][0], places[min(where[1] + 2, len(places) - 1)][1]
            while a > low and x > low_1 and lines[a - 1] == others[x - 1]:
                a, x = a - 1, x - 1
                gone.add(a)
            while b < high and y < high_1 and lines[b] == others[y]:
                gone.add(b)
                b, y = b + 1, y + 1
        text = "\n".join(x for i, x in enumerate(lines) if i not in gone)
        if not gone or words_of(text):
            out.append((d[0], text, *d[2:]))
    return out


def copies_by_hand(docs):
    """One document of each group connected by pairs of Jaccard 0.8 or more over 5-word shingles."""
    def shingles(text):
        w = [x.lower() for x in (y.encode() for y in words_of(text))]
        return {tuple(w[i:i + 5]) for i in range(max(len(w) - 4, 1))} if w else set()

    docs = sorted(docs, key=lambda d: (d[0] is None, d[0]))
    sets, root = [shingles(d[1]) for d in docs], list(range(len(docs)))
    for i, x in enumerate(sets):
        near = {root[i]} | {root[j] for j, y in enumerate(sets[:i]) if x == y or 5 * len(x & y) >= 4 * len(x | y)}
        root = [min(near) if r in near else r for r in root]
    return [d for i, d in enumerate(docs) if root[i] == i]


def leaks_by_hand(docs, items):
    regions = decontam.Regions(items)
    return [d for d in docs if not any(
        edit_distance_inside(r.tobytes(), " ".join(words_of(d[1])).lower().encode()) <= regions.edits[k]
        for k, r in enumerate(regions.texts))]


def mix_by_hand(docs, keep=0.5, power=0.7, rounds=8):
    def topic(text):
        n, text = len(words_of(text)), text or ""
        if 10 * text.count("|") > n:
            return "table"
        if 2 * sum(c in "#*$%&!" for c in text) > n:
            return "marked"
        return "note" if n < 100 else "article" if n < 1000 else "long"
    cell = {d: (d[3] or "(none)", d[2] or "(none)", topic(d[1])) for d in docs}
    tokens = {}
    for d in docs:
        tokens[cell[d]] = tokens.get(cell[d], 0) + len(words_of(d[1]))
    weight, targets = {c: 1.0 for c in tokens}, []
    for k in range(3):
        sums = {}
        for c, t in tokens.items():
            sums[c[k]] = sums.get(c[k], 0) + t
        raised = {v: t ** power for v, t in sums.items()}
        targets.append({v: t / sum(raised.values()) for v, t in raised.items()})
    for _ in range(rounds):
        for k in range(3):
            mass = {}
            for c, t in tokens.items():
                mass[c[k]] = mass.get(c[k], 0) + t * weight[c]
            for c in tokens:
                weight[c] *= targets[k][c[k]] / mass[c[k]]
    total, out = sum(tokens.values()), {}
    for d in docs:
        p = min(weight[cell[d]] * keep * total, 1.0)
        digits = hashlib.md5(f"mix:{'' if d[0] is None else d[0]}".encode()).hexdigest()[:13]
        if int(digits, 16) / 16 ** 13 < p:
            out[d[0]] = p
    return out


def test_every_stage_by_hand(spark, folder):
    docs, items = corpus()
    expected = [
        [d for d in docs if not statistics_by_hand(d[1])[5]], None, None, None]
    expected[1] = lines_by_hand(expected[0])
    expected[2] = copies_by_hand(expected[1])
    expected[3] = leaks_by_hand(expected[2], items)
    assert len(docs) > len(expected[0]) > len(expected[2]) > len(expected[3]) > 20 and expected[0] != expected[1]
    frame = spark.read.parquet(f"{folder}/documents.parquet")
    columns = frame.columns
    for (_, step), rows in zip(corpus_pipeline.STAGES, expected):
        frame = corpus_pipeline.stage(step(spark, frame, folder))
        assert frame.columns == columns
        got = frame.drop("gone").collect()
        assert sorted(map(tuple, got), key=str) == sorted(rows, key=str)
    mixed = corpus_pipeline.run(spark, folder)
    assert mixed.columns[:len(columns)] == columns
    chosen = mix_by_hand(expected[3])
    assert {r["doc_id"]: r["mix_probability"] for r in mixed.collect()} == pytest.approx(chosen, abs=1e-8)


def test_mixing_replaces_its_columns(spark, folder):
    docs = _read(spark, folder).withColumn("mix_topic", F.lit(1)).withColumn("mix_weight", F.lit("x"))
    mixed = corpus_pipeline.source_mixing(spark, docs, folder)
    assert sorted(mixed.columns) == sorted({*docs.columns, "mix_topic", "mix_probability", "mix_weight"})
    assert dict(mixed.dtypes)["mix_topic"] == "string" and dict(mixed.dtypes)["mix_weight"] == "double"
    assert mixed.where("mix_weight >= 1").count() == mixed.count() > 0


def _read(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet")


def test_empty_corpus(spark, tmp_path):
    for name, schema in (("documents", SCHEMA), ("benchmark", "item_id long, text string"),
                         ("labels", "doc_id long, quality int, toxic int")):
        spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_stages_and_registration(spark):
    import __spark_entry__

    assert len(corpus_pipeline.STAGES) == 5
    names = list(__spark_entry__.queries())
    assert "pipeline" in names and [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)] == [1] * 10
