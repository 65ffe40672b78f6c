"""Ranked search, packing and conversation repair against brute force, and on odd rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from txlens.llm import maxsketch, packing, turnrepair

DOCS = "doc_id long, text string, score long, item long, rank long"
WORDS = ["alpha", "Beta", "gamma", "été", "naïve", "x1", "42", "delta", "omega", "Ωmega", "日本"]


def rows(frame):
    return [tuple(r) for r in frame.collect()]


# --- ranked search -----------------------------------------------------------------------

def terms(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lowered)


def ranking(docs, items, places=10):
    held = [(doc_id, Counter(terms(text))) for doc_id, text, *_ in docs]
    n, total = sum(bool(c) for _, c in held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    found = []
    for item_id, text in set(items):
        scores = {}
        for doc_id, count in held:
            m = 25 + (75 * sum(count.values()) * n) // total if total else 25
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                        * ((10**9 * count[t]) // (1000 * count[t] + 8 * m)) for t in terms(text) if t in count)
            if score > 0:
                scores[doc_id] = max(score, scores.get(doc_id, 0))
        order = sorted(scores.items(), key=lambda x: (-x[1], x[0] is None, x[0] or 0))
        found += [(item_id, place + 1, doc_id, score) for place, (doc_id, score) in enumerate(order[:places])]
    return sorted(found, key=str)


def prose(rng, words):
    return rng.choice([" ", ", ", "\n"]).join(rng.choice(WORDS) + rng.choice(["", "", "s", str(rng.randint(0, 30))])
                                              for _ in range(words))


def test_search_agrees_with_brute_force(spark):
    rng = random.Random(5)
    docs = [(i, prose(rng, rng.randint(1, 60)), 1, 2, 3) for i in range(300)]
    docs += [(1000 + i, docs[7][1], None, None, None) for i in range(40)]  # copies: ties by doc_id
    docs += [(None, docs[7][1], 1, 1, 1), (5, "beta", 1, 1, 1), (5, docs[9][1], 1, 1, 1), (400, None, 1, 1, 1),
             (401, "", 1, 1, 1), (402, " .,;\n", 1, 1, 1), (403, prose(rng, 9000), 1, 1, 1)]
    items = [(i, prose(rng, rng.randint(1, 25))) for i in range(30)]
    items += [(3, "beta beta"), (50, None), (51, ""), (52, "unheard"), (53, docs[7][1]), (53, docs[7][1]), (None, "alpha")]
    frame = spark.createDataFrame(docs, DOCS).repartition(5)
    asked = spark.createDataFrame(items, "item_id long, text string")
    expected = ranking(docs, [(a, b) for a, b in items if b is not None])
    assert sorted(rows(maxsketch.search(frame, asked)), key=str) == expected
    # blocks of few items, several passes for statistics, tiers of one document
    small = maxsketch.search(frame, asked, items_per_block=4, item_bytes=2000, tier=1)
    assert sorted(rows(small), key=str) == expected


def test_search_of_empty_tables(spark):
    docs = spark.createDataFrame([], DOCS)
    items = spark.createDataFrame([(1, "alpha")], "item_id long, text string")
    assert rows(maxsketch.search(docs, items)) == []
    assert rows(maxsketch.search(spark.createDataFrame([(1, "alpha", 1, 1, 1)], DOCS), items.limit(0))) == []
    assert rows(maxsketch.search(spark.createDataFrame([(1, None, 1, 1, 1)], DOCS), items)) == []


def test_no_bound_is_below_its_score():
    rng = random.Random(8)
    texts = pa.array([prose(rng, rng.randint(0, 400)) for _ in range(40)] + ["alpha " * 70_000])
    found = maxsketch.terms_of(texts)
    statistics = maxsketch.Statistics(41, int(found.sizes.sum()), dict(zip(
        found.names.to_pylist(), np.bincount(found.term).tolist())))
    block = maxsketch.Block([(i, prose(rng, 20)) for i in range(9)], statistics)
    places, peaks = maxsketch._sketches(found)
    batch = pa.RecordBatch.from_arrays([pa.array(found.sizes), pa.array(places, pa.binary()), pa.array(peaks, pa.binary())],
                                       ["size", "places", "peaks"])
    bounds, scores = block.bounds(batch), block.scores(texts)
    assert (bounds >= scores).all() and (scores > 0).any()
    assert np.sum(bounds) < 1.5 * np.sum(scores)


# --- packing -----------------------------------------------------------------------------

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
HARD = ["", None, "one", "Hello, World! It's 2024's don't DON'T ''s 'tis", "naïve café, (été) «Ça»—oui… ",
        "İstanbul, İ! ×÷ 3×4=12 a≠b ≮ é, é!", "日本語 テスト,mixed漢字abc 1,234.56", "a\x0bb\x0cc\x1cd\xa0e f",
        "<|startoftext|>x <|ENDOFTEXT|> <|endoftext|>", "ΟΔΟΣ σς ß ſ ŉ ǆ ɐ ̈a ¨", "_under_score__ a_b 'a' \"q\" `x`",
        "tabs\t\tand\r\nlines \n", "\U0001f600\U0001f600! ½ ² Ⅷ ﬁ", "x" * 5000, "word " * 3000, "' ' 's '", "a'b'c'd ,'s .'re",
        "À,é.ñ;ü:ÿ!Ā?ɏ(ɿ)", "9a9 9é9 é9é é,9"]


def test_word_tokens_are_the_tokenizers():
    tokenizer = Tokenizer.from_file(TOKENIZER)
    rng = random.Random(3)
    signs = list("aZé'sdtrevm,.<|> \t\n09_≠́ßİ×÷Ωж漢—…\xa0")
    texts = HARD + ["".join(rng.choice(signs) for _ in range(rng.randint(1, 40))) for _ in range(1500)]
    make = packing.token_maker(open(TOKENIZER, encoding="utf-8").read())
    assert isinstance(make, packing.WordTokens)
    for part in (texts[:8], texts[9:], texts, texts[:0]):
        found = make(pa.array(part, pa.string()))
        whole = [tokenizer.encode(t or "", add_special_tokens=False).ids for t in part]
        assert [found.ids[a:b].tolist() for a, b in zip(found.of, found.of[1:])] == whole


def test_other_tokenizers_are_used_as_they_are():
    path = public_tokenizers.path("byte_bpe_50k.json")
    make, tokenizer = packing.token_maker(open(path, encoding="utf-8").read()), Tokenizer.from_file(path)
    found = make(pa.array(HARD))
    whole = [tokenizer.encode(t or "", add_special_tokens=False).ids for t in HARD]
    assert [found.ids[a:b].tolist() for a, b in zip(found.of, found.of[1:])] == whole


def best_fit(lengths, capacity):
    """Windows of one best-fit run over single pieces, longest first."""
    rooms = []
    for length in sorted(lengths, reverse=True):
        fitting = [i for i, room in enumerate(rooms) if room >= length]
        if fitting:
            rooms[min(fitting, key=lambda i: rooms[i])] -= length
        else:
            rooms.append(capacity - length)
    return rooms


@pytest.mark.parametrize("capacity", [1, 7, 64, 100])
def test_plan_is_best_fit_decreasing(capacity):
    rng = random.Random(capacity)
    for _ in range(60):
        lengths = [rng.randint(1, capacity) for _ in range(rng.randint(0, 80))]
        if rng.random() < 0.5:
            lengths += [rng.randint(1, capacity)] * 50
        runs, windows = packing.plan(Counter(lengths), capacity)
        order, used = sorted(lengths, reverse=True), {}
        ends = [run[0] for run in runs[1:]] + [len(order)]
        for (place, window, each, offset, length), end in zip(runs, ends):
            for at in range(place, end):
                assert order[at] == length
                used.setdefault(window + (at - place) // each, []).append((offset + (at - place) % each * length, length))
        assert sorted(used) == list(range(windows))
        for parts in used.values():  # gapless, within the capacity
            assert [a for a, _ in sorted(parts)] == np.cumsum([0, *[n for _, n in sorted(parts)]])[:-1].tolist()
        assert sorted(capacity - sum(n for _, n in p) for p in used.values()) == sorted(best_fit(lengths, capacity))


def test_tightest_capacity():
    tree = packing.CapacityTree(10)
    for room in (3, 7, 7):
        tree.add(room, 1)
    assert [tree.tightest(n) for n in range(11)] == [3, 3, 3, 3, 7, 7, 7, 7, None, None, None]
    tree.add(7, -2)
    assert tree.tightest(4) is None


def test_packed_pieces_make_the_documents_again(spark):
    docs = [(i, text) for i, text in enumerate(HARD)] + [(2, "one"), (None, "one"), (None, None), (3, "again " * 50)] * 9
    frame = spark.createDataFrame([(a, b, 1, 2, 3) for a, b in docs],
                                  "doc_id long, text string, offset long, length long, _row long").repartition(4)
    packed = packing.pack(frame, TOKENIZER, capacity=64, with_ids=True).cache()
    tokenizer = Tokenizer.from_file(TOKENIZER)
    whole = Counter()
    for doc_id, text in docs:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        for at in range(0, len(ids), 64):
            part = ids[at:at + 64]
            whole[doc_id, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes()), len(ids), tuple(part)] += 1
    assert Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"], tuple(r["ids"]))
                   for r in packed.collect()) == whole
    made = {r["sequence_id"]: r for r in packing.sequences(packed, capacity=64, pad=7).collect()}
    held = {}
    for r in packed.collect():
        held.setdefault(r["sequence_id"], []).append((r["offset"], r["ids"]))
    for sequence_id, parts in held.items():
        ids = [i for _, part in sorted(parts) for i in part]
        assert [a for a, _ in sorted(parts)] == np.cumsum([0, *[len(p) for _, p in sorted(parts)]])[:-1].tolist()
        whole_size = len(ids) if len(ids) & (len(ids) - 1) == 0 else 64
        assert made[sequence_id]["ids"] == ids + [7] * (whole_size - len(ids)) and made[sequence_id]["n_tokens"] == len(ids)
    assert sorted(64 - r["n_tokens"] for r in made.values()) == sorted(best_fit([k[2] for k in whole.elements()], 64))
    empty = packing.pack(frame.limit(0), TOKENIZER)
    assert rows(empty) == [] and empty.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


# --- conversation repair -----------------------------------------------------------------

SPACE = " \t\n\v\f\r"
STOPS = re.compile(r"(s?(ua)+)?")


def faults(turns):
    found, seen = [], set()
    for _, role, text in turns:
        bare = text.rstrip(SPACE)
        if not bare:
            found.append("blank")
        elif (role, text) in seen:
            found.append("duplicate")
        else:
            found.append("truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    return found


def cheapest(turns):
    """Least cost, least string and its lines, by trying every edit of every row."""
    found = faults(turns)
    best = None

    def go(i, initials, cost, audit, lines):
        nonlocal best
        if best is not None and cost > best[0]:
            return
        if i == len(turns) and STOPS.fullmatch(initials):
            key = (cost, audit, lines)
            best = key if best is None or key[:2] < best[:2] else best
        if not re.fullmatch(r"s?(ua)*u?", initials):
            return
        if len(audit) - i < 5:
            for role in ("user", "assistant"):
                go(i, initials + role[0], cost + 5, audit + "I", lines + [role + ":"])
        if i == len(turns):
            return
        _, role, text = turns[i]
        go(i + 1, initials, cost + 2, audit + "D", lines)
        if found[i] not in ("blank", "duplicate"):
            more = 5 if found[i] == "truncated" else 0
            go(i + 1, initials + (role[:1] or "?"), cost + more, audit + "K", lines + [f"{role}:{text}"])
            for other in ("user", "assistant"):
                go(i + 1, initials + other[0], cost + more + 1, audit + "R", lines + [f"{other}:{text}"])

    go(0, "", 0, "", [])
    return best


def summary(turns):
    """What repair() should say of turns in order, as (turn, role, text)."""
    numbers = [t for t, *_ in turns if t is not None]
    found = Counter(faults(turns))
    initials = [role[:1] for _, role, _ in turns]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    cost, audit, lines = cheapest(turns)
    return (max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0, found["blank"], found["duplicate"],
            found["truncated"], illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def in_order(turns):
    return sorted(turns, key=lambda t: (t[0] is not None, t[0] or 0, t[1].encode(), t[2].encode()))


def random_turns(rng):
    texts = ["Yes.", "no", " \t", "", "Why?\n", "é!", "So. it", "Fine!", "Go on."]
    return [(rng.choice([None, 0, 1, 2, 3, 4, 5, 9]), rng.choice(["user", "assistant"] * 4 + ["system", "system", "tool", ""]),
             rng.choice(texts)) for _ in range(rng.randint(1, 6))]


CHATS = "conv_id long, turn long, role string, text string, cost long, block long"


def test_repair_agrees_with_trying_everything(spark):
    rng = random.Random(11)
    chats = {i: in_order(random_turns(rng)) for i in range(350)}
    chats[None] = chats.pop(0)
    table = [(conv_id, *turn, 1, 2) for conv_id, turns in chats.items() for turn in turns]
    rng.shuffle(table)
    frame = spark.createDataFrame(table, CHATS).repartition(6)
    expected = {conv_id: summary(turns) for conv_id, turns in chats.items()}
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    for block in (turnrepair.BLOCK, 2):  # spilled and traced back in a second stream
        got = {r["conv_id"]: tuple(r[n] for n in names) for r in turnrepair.repair(frame, block).collect()}
        assert got == expected
        made = {}
        for r in sorted(turnrepair.repaired_turns(frame, block).collect(), key=lambda r: r["place"]):
            made.setdefault(r["conv_id"], []).append(f"{r['role']}:{r['text']}")
        assert {c: hashlib.sha256("\n".join(made.get(c, [])).encode()).hexdigest() for c in chats} == {
            c: e[-1] for c, e in expected.items()}


def test_repair_of_a_long_conversation(spark):
    """Costs agree with a plain table of costs; the audit costs what it says."""
    rng = random.Random(12)
    turns = in_order([(i // 2, rng.choice(["user", "assistant", "system"]), rng.choice(["Yes.", "no", f"No {i}."])) for i in range(5000)])
    frame = spark.createDataFrame([(1, *t, 0, 0) for t in turns], CHATS)
    row = turnrepair.repair(frame, block=512).first()
    found, costs = faults(turns), {"": 0}
    after = {"": "su", "s": "u", "u": "a", "a": "u"}
    for (_, role, _), fault in zip(turns, found):
        new = {}
        for last, cost in costs.items():
            ways = [(last, cost + 2)]
            if fault not in ("blank", "duplicate"):
                more = 5 * (fault == "truncated")
                for state, c in ((last, cost), *[(x, cost + 5) for x in after[last] if x != "s"]):
                    ways += [(x, c + more + (x != role[0])) for x in after[state] if x != "s" or role[0] == "s"]
            for state, c in ways:
                new[state] = min(c, new.get(state, c))
        costs = new
    assert row["cost"] == min(c + {"": 0, "s": 10, "u": 5, "a": 0}[s] for s, c in costs.items())
    edits = re.findall("I*[DKR]|I+$", row["audit"])
    spent = 5 * row["audit"].count("I") + 2 * row["audit"].count("D") + row["audit"].count("R")
    spent += 5 * sum(f == "truncated" and not e.endswith("D") for f, e in zip(found, edits))
    assert spent == row["cost"] and len(edits) - (row["audit"][-1] == "I") == len(turns)


def test_damage_and_conversations_without_rows(spark):
    table = [(i, t, r, x, 0, 0) for i in [*range(60), None] for t, r, x in (
        (0, "system", "Be kind."), (1, "user", "Hi."), (2, "assistant", "Hello!"), (None, None, None))]
    lonely = next(i for i in range(100, 10_000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    table.append((lonely, 0, "user", "Gone.", 0, 0))
    expected = {}
    for conv_id in {row[0] for row in table}:
        turns = []
        for c, turn, role, text, *_ in table:
            if c == conv_id:
                name = f"{' ' if c is None else c}:{' ' if turn is None else turn}"
                fate, role, text = zlib.crc32(name.encode()) % 20, role or " ", text or " "
                text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
                turns += [(turn, "user" if fate == 4 else role, text)] * (0 if fate == 0 else 2 if fate == 3 else 1)
        expected[conv_id] = summary(in_order(turns))
    got = {r[0]: tuple(r[1:]) for r in turnrepair.repair_damaged(spark.createDataFrame(table, CHATS)).collect()}
    assert got == expected
    assert got[lonely] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    empty = turnrepair.repair_damaged(spark.createDataFrame([], CHATS))
    assert rows(empty) == [] and rows(turnrepair.repair(spark.createDataFrame([], CHATS))) == []
