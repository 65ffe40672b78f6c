"""Packing of token sequences by best fit decreasing.

A document's tokens are cut into full windows and a rest. The rests are packed, longest first:
each goes into the open window whose remaining capacity is the tightest that holds it, which a
segment tree indexed by remaining capacity finds. Pieces of one length are alike, so the plan is
made for counts: from the number of pieces of each length (at most ``capacity`` numbers, however
many documents there are) it says which places, counted from the longest piece on, go into
which windows. One range shuffle numbers the pieces, and each finds its window in the plan. The
result is that of one best-fit run over all documents; no task and no driver holds them.
"""

import json
import zlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from txlens.llm.textkit import pieces, utf8
from txlens.operators.ordering import row_number_global
from txlens.staging import stage

CAPACITY = 2048
#: The id that ends every document.
END = 1
#: Pieces of text that one generation of the cache of a Python worker may hold.
CACHED = 200_000

# Normalisation and splitting of the tokenizers that WordTokens serves.
WORD_STEPS = {
    "normalizer": {"type": "Sequence", "normalizers": [
        {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"},
         "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]},
}

# Kinds of bytes. A text may be cut between two kinds, but for OTHER, and between two digits.
GAP, LETTER, DIGIT, MARK, OTHER = range(5)
_KIND = np.full(256, OTHER, np.uint8)
_KIND[[9, 10, 13, 32]] = GAP
for _first, _last, _kind in ((48, 57, DIGIT), (65, 90, LETTER), (97, 122, LETTER), (33, 38, MARK), (40, 47, MARK),
                             (58, 64, MARK), (91, 96, MARK), (123, 126, MARK)):
    _KIND[_first:_last + 1] = _kind
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class Tokens(NamedTuple):
    """``ids`` of a batch of texts; text i has those from ``of[i]`` to ``of[i + 1]``."""

    ids: np.ndarray
    of: np.ndarray


def _kinds(raw):
    """The kind of every byte; two-byte letters (U+00C0 to U+027F) count as letters."""
    kind = _KIND[raw]
    if len(raw) > 1:
        lead = np.flatnonzero((raw[:-1] >= 0xC3) & (raw[:-1] <= 0xC9))
        follow = raw[lead + 1]
        # the signs for times and divided by are no letters; a dotted capital I becomes two characters
        sign = (raw[lead] == 0xC3) & ((follow == 0x97) | (follow == 0xB7)) | (raw[lead] == 0xC4) & (follow == 0xB0)
        lead = lead[~sign]
        kind[lead] = kind[lead + 1] = LETTER
    return kind


class WordTokens:
    """Token ids by way of the distinct pieces of the texts.

    Words, digits and marks that stand next to each other never share a token of these
    tokenizers, so each distinct piece is tokenized once and kept for later batches of the same
    Python worker, in two generations of bounded size.
    """

    def __init__(self, tokenizer, added):
        self.tokenizer, self.added = tokenizer, [text.encode() for text in added]
        self.young, self.old = {}, {}

    def _known(self, names):
        """The ids of every name, as little-endian bytes."""
        lacking = [name for name in names if name not in self.young and name not in self.old]
        fresh = {}
        for a in range(0, len(lacking), 10_000):
            part = lacking[a:a + 10_000]
            for name, found in zip(part, self.tokenizer.encode_batch(part, add_special_tokens=False)):
                fresh[name] = np.array(found.ids, "<u4").tobytes()
        known = []
        for name in names:
            held = self.young.get(name)
            if held is None:
                held = fresh[name] if name in fresh else self.old[name]
                self.young[name] = held
            known.append(held)
        if len(self.young) > CACHED:
            self.young, self.old = {}, self.young
        return known

    def __call__(self, column):
        raw, offsets = utf8(column)
        if any(text in raw.tobytes() for text in self.added):
            return _plain(self.tokenizer, column)
        kind = _kinds(raw)
        inside = kind != GAP
        first = inside.copy()
        change = (kind[1:] != kind[:-1]) & (kind[1:] != OTHER) & (kind[:-1] != OTHER)
        change |= (kind[1:] == DIGIT) & (kind[:-1] == DIGIT)
        opens = np.zeros(len(raw) + 1, dtype=bool)
        opens[offsets[:-1]] = True
        first[1:] &= change | ~inside[:-1] | opens[1:-1]
        begin = np.flatnonzero(first)
        kept = np.cumsum(inside, dtype=np.int64)
        ends = np.append(kept[begin] - 1, kept[-1] if len(kept) else 0).astype(np.int32)
        parts = pa.StringArray.from_buffers(
            len(begin), pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(_LOWER[raw[inside]])))
        coded = parts.dictionary_encode()
        known = self._known(coded.dictionary.to_pylist())
        size = np.fromiter(map(len, known), np.int64, len(known)) // 4
        ids = np.frombuffer(b"".join(known), "<u4")
        start = np.cumsum(size) - size
        code = coded.indices.to_numpy(zero_copy_only=False)
        length = size[code]
        upto = np.concatenate([[0], np.cumsum(length)])
        ids = ids[np.arange(upto[-1]) + np.repeat(start[code] - upto[:-1], length)]
        return Tokens(ids, upto[np.searchsorted(begin, offsets)])


def _plain(tokenizer, column):
    """Token ids of whole texts, by the tokenizer alone."""
    found = [np.array(tokenizer.encode(text or "", add_special_tokens=False).ids, "<u4") for text in column.to_pylist()]
    return Tokens(np.concatenate([*found, np.empty(0, "<u4")]).astype("<u4"),
                  np.concatenate([[0], np.cumsum([len(x) for x in found], dtype=np.int64)]).astype(np.int64))


_workers = {}


def token_maker(definition):
    """What turns a text column into token ids; kept for the later tasks of a Python worker."""
    key = zlib.crc32(definition.encode()), len(definition)
    if key not in _workers:
        parts, tokenizer = json.loads(definition), Tokenizer.from_str(definition)
        if all(parts.get(step) == form for step, form in WORD_STEPS.items()):
            _workers[key] = WordTokens(tokenizer, [added["content"] for added in parts["added_tokens"]])
        else:
            def whole(column):
                return _plain(tokenizer, column)

            _workers[key] = whole
    return _workers[key]


PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def cut(docs, tokenizer, capacity=CAPACITY, end=END, with_ids=False):
    """The pieces of every document: full windows, and a rest if there is one.

    ``tokenizer`` is the path of a definition file, which is read here and sent to the tasks.
    """
    with open(tokenizer, encoding="utf-8") as file:
        shared = docs.sparkSession.sparkContext.broadcast(file.read())

    def run(batches):
        make = token_maker(shared.value)
        for batch in pieces(batches, max_bytes=1 << 22):
            tokens = make(batch.column("text"))
            sizes = np.diff(tokens.of) + 1
            of = np.concatenate([[0], np.cumsum(sizes)])
            ids = np.insert(tokens.ids, tokens.of[1:], end).astype("<u4")
            count = -(-sizes // capacity)
            text = np.repeat(np.arange(len(sizes)), count)
            start = (np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)) * capacity
            length = np.minimum(sizes[text] - start, capacity)
            at = of[text] + start
            data = memoryview(ids.tobytes())
            sums = [zlib.crc32(data[4 * a:4 * (a + n)]) for a, n in zip(at.tolist(), length.tolist())]
            columns = [batch.column("doc_id").take(pa.array(text)), pa.array(start), pa.array(length),
                       pa.array(sums, pa.int64()), pa.array(sizes[text])]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
            if with_ids:
                places = pa.array(np.append(at, of[-1]).astype(np.int32))
                columns.append(pa.ListArray.from_arrays(places, pa.array(ids.astype(np.int32))))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, PIECE + (", ids array<int>" if with_ids else ""))


class CapacityTree:
    """Which remaining capacities have open windows; finds the tightest that is enough."""

    def __init__(self, capacity):
        self.leaves = 1 << capacity.bit_length()
        self.open = [0] * (2 * self.leaves)

    def add(self, capacity, windows):
        place = capacity + self.leaves
        while place:
            self.open[place] += windows
            place //= 2

    def tightest(self, length):
        """The least capacity of ``length`` or more with an open window, or None."""
        place = length + self.leaves
        if self.open[place]:
            return length
        while place > 1:
            if place % 2 == 0 and self.open[place + 1]:
                place += 1
                break
            place //= 2
        else:
            return None
        while place < self.leaves:
            place = 2 * place if self.open[2 * place] else 2 * place + 1
        return place - self.leaves


def plan(counts, capacity=CAPACITY):
    """Runs (place, window, each, offset, length) of best fit decreasing, and the windows used.

    ``counts`` maps a length to its number of pieces. Pieces are numbered from 0, longest first.
    From ``place`` on, up to the next run, the pieces have ``length`` tokens, and ``each`` of
    them follow one another from ``offset`` on in every window from ``window`` on.
    """
    tree, open_, runs, windows, place = CapacityTree(capacity), {}, [], 0, 0

    def leave(room, first, count):
        if room and count:
            open_.setdefault(room, []).append((first, count))
            tree.add(room, count)

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            room = tree.tightest(length)
            if room is None:
                room, each = capacity, capacity // length
                first, count = windows, -(-left // each)
                windows += count
            else:
                each = room // length
                first, count = open_[room].pop()
                tree.add(room, -count)
                wanted = -(-left // each)
                if wanted < count:
                    leave(room, first + wanted, count - wanted)
                    count = wanted
            put = min(left, count * each)
            runs.append((place, first, each, capacity - room, length))
            place, left = place + put, left - put
            short = count * each - put
            leave(room - each * length, first, count - bool(short))
            if short:
                leave(room - (each - short) * length, first + count - 1, 1)
    return runs, windows


def pack(docs, tokenizer, capacity=CAPACITY, end=END, with_ids=False):
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document is its token ids and then ``end``; null and empty texts have that one id. Every
    id lies in one piece: ``start`` counts the document's ids before it. ``sequence_id`` counts
    from 0, ``offset`` is the place in the sequence, without gaps. Rows are documents each on
    their own, also with repeated or null doc_ids; ties between pieces of one length go by their
    place in the written table of pieces. Further columns are ignored. ``with_ids`` adds the
    token ids of the piece, which ``sequences`` puts together.
    """
    found = stage(cut(docs, tokenizer, capacity, end, with_ids).withColumn("_row", F.monotonically_increasing_id()))
    counts = {row["length"]: row["count"] for row in found.groupBy("length").count().collect()}
    runs, _ = plan(counts, capacity)
    numbered = row_number_global(found.withColumn("_shortness", -F.col("length")), ["_shortness", "_row"], "_place", staged=True)
    shared = docs.sparkSession.sparkContext.broadcast(np.array(runs or [(0,) * 5], np.int64))
    kept = [name for name in numbered.columns if name not in ("_row", "_shortness", "_place")]

    def place(batches):
        first, window, each, offset, length = shared.value.T
        for batch in batches:
            at = batch.column("_place").to_numpy(zero_copy_only=False) - 1
            run = np.searchsorted(first, at, side="right") - 1
            inner = at - first[run]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(name) for name in kept], pa.array(window[run] + inner // each[run]),
                 pa.array(offset[run] + inner % each[run] * length[run])], [*kept, "sequence_id", "offset"])

    return numbered.mapInArrow(place, PIECE + (", ids array<int>" if with_ids else "") + ", sequence_id long, offset long")


def sequences(packed, capacity=CAPACITY, pad=0):
    """``sequence_id, n_tokens, ids`` of pieces packed ``with_ids``.

    Sequences are filled up with ``pad`` to the capacity, unless their length is a power of two.
    """
    held = packed.groupBy("sequence_id").agg(
        F.sum("length").alias("n_tokens"), F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    ids = F.flatten(F.col("parts.ids"))
    whole = F.bit_count("n_tokens") == 1
    lacking = F.when(whole, F.lit(0)).otherwise(F.lit(capacity) - F.col("n_tokens")).cast("int")
    return held.select("sequence_id", "n_tokens", F.concat(ids, F.array_repeat(F.lit(pad), lacking)).alias("ids"))
