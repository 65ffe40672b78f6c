"""Benchmark decontamination by the q-gram lemma and banded alignment.

Benchmark items are cut into overlapping regions. A region within ``edits`` edit operations
of a stretch of a document shares at least ``length + 1 - q * (edits + 1)`` of its q-grams
with it, on neighbouring diagonals (document place minus region place). Shared q-grams are
counted in diagonal bands that overlap by half, so that such a group always lies in one band;
bands that reach the bound are verified by a banded alignment. No leak within budget is lost.
Texts are compared as UTF-8 bytes, A-Z lower-cased, white space runs as one space.
"""

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from txlens.llm.textkit import U64, Words, pieces

#: Length of a q-gram in bytes: one 64-bit word.
Q = 8
REGION = 64
#: A region may differ in one byte of so many.
BYTES_PER_EDIT = 12
#: Regions of an item begin at every so many bytes, so any stretch of REGION + STRIDE - 1 bytes holds one.
STRIDE = 8
SLOTS = 22
#: Shared q-grams that are counted at once.
PAIRS = 1 << 21
FACTOR = U64(0x9E3779B97F4A7C15)


def _grams(data):
    """The q-gram at every place as a 64-bit value."""
    if len(data) < Q:
        return np.empty(0, U64)
    return np.ndarray((len(data) - Q + 1,), "<u8", np.ascontiguousarray(data), strides=(1,))


class Regions:
    """The regions of a block of items and an index of their q-grams."""

    def __init__(self, items):
        self.texts, self.item, self.at = [], [], []
        for item_id, text in items:
            data = np.frombuffer(b" ".join(text.encode().lower().split()), np.uint8)
            if len(data) < Q:
                continue
            starts = list(range(0, max(len(data) - REGION, 0) + 1, STRIDE))
            if starts[-1] + REGION < len(data):
                starts.append(len(data) - REGION)
            for start in starts:
                self.texts.append(data[start:start + REGION])
                self.item.append(item_id)
                self.at.append(start)
        held = Counter(self.item)
        self.of_item = [held[i] for i in self.item]
        self.length = np.array([len(t) for t in self.texts], np.int64)
        # a short item has fewer edits, so that one q-gram is always shared
        self.edits = np.minimum(self.length // BYTES_PER_EDIT, self.length // Q - 1)
        self.bound = self.length + 1 - Q * (self.edits + 1)
        grams = [_grams(t) for t in self.texts]
        keys = np.concatenate([np.empty(0, U64), *grams])
        order = np.argsort(keys, kind="stable")
        self.keys = keys[order]
        self.region = np.repeat(np.arange(len(grams)), [len(g) for g in grams])[order]
        places = np.concatenate([np.empty(0, np.int64), *[np.arange(len(g)) for g in grams]])
        self.place = places.astype(np.int64)[order]
        self.slots = np.zeros(1 << SLOTS, dtype=bool)
        self.slots[self.slot(self.keys)] = True
        self.padded = np.zeros((len(self.texts), REGION), np.uint8)
        for i, text in enumerate(self.texts):
            self.padded[i, :len(text)] = text

    @staticmethod
    def slot(keys):
        return (keys * FACTOR) >> U64(64 - SLOTS)


def _dense(hit, span, least):
    """Hits that lie in a stretch of ``span`` places with ``least`` hits or more."""
    total = np.concatenate([[0], np.cumsum(hit)])
    end = np.minimum(np.arange(len(hit)) + span, len(hit))
    full = np.flatnonzero(hit & (total[end] - total[:-1] >= least))
    depth = np.zeros(len(hit) + 1, dtype=np.int32)
    np.add.at(depth, full, 1)
    np.add.at(depth, end[full], -1)
    return np.flatnonzero(hit & (np.cumsum(depth[:-1]) > 0))


def _align(data, low, high, first, regions, which):
    """Least edits of each region against the document's bytes on its band of diagonals.

    ``first`` is the band's lowest diagonal. Both ends on the document's side are free. All
    candidates go forward together, one byte of the region at a time.
    """
    budget = regions.edits[which]
    width = int(2 * (budget.max() + 1))
    inside = np.arange(width)[None, :] < (2 * (budget + 1))[:, None]
    far = np.int32(1 << 20)
    cost = np.where(inside, 0, far).astype(np.int32)
    place = first[:, None] + np.arange(width)[None, :]
    for j in range(REGION):
        at = place + j
        real = (at >= low[:, None]) & (at < high[:, None])
        byte = np.where(real, data[np.clip(at, 0, len(data) - 1)], -1)
        step = cost + (byte != regions.padded[which, j][:, None])
        step[:, :-1] = np.minimum(step[:, :-1], cost[:, 1:] + 1)
        for b in range(1, width):
            step[:, b] = np.minimum(step[:, b], step[:, b - 1] + 1)
        step = np.where(inside, step, far)
        cost = np.where((j < regions.length[which])[:, None], step, cost)
    return cost.min(axis=1)


def _banded(at, left, count, regions, low, high, texts, names, number):
    """Shared q-grams per (text, region, band) with those of more places added."""
    entry = np.repeat(left - np.cumsum(count) + count, count) + np.arange(count.sum())
    at = np.repeat(at, count)
    text = texts[np.searchsorted(low[texts], at, side="right") - 1]
    region, inside = regions.region[entry], at + Q <= high[text]
    text, region, diagonal = text[inside], region[inside], (at - regions.place[entry])[inside]
    band = (diagonal - low[text] + REGION) // (regions.edits[region] + 1)
    more = np.stack([np.tile(text, 2), np.tile(region, 2), np.concatenate([band, band - 1])])
    names = np.concatenate([names, more], axis=1)
    number = np.concatenate([number, np.ones(more.shape[1], np.int64)])
    order = np.lexsort(names)
    names, number = names[:, order], number[order]
    new = np.ones(names.shape[1], dtype=bool)
    new[1:] = (names[:, 1:] != names[:, :-1]).any(axis=0)
    heads = np.flatnonzero(new)
    return names[:, heads], np.add.reduceat(number, heads) if len(heads) else number


def _leaks(words, regions):
    """(text, region, edits) of every region found in a piece of texts."""
    data, grams = words.data, _grams(words.data)
    hit = regions.slots[regions.slot(grams)]
    span = int(regions.length.max() + regions.edits.max()) - Q + 1
    at = _dense(hit, span, int(regions.bound.min()))
    filled = words.of[:-1] < words.of[1:]
    low = np.zeros(len(filled), np.int64)
    high = np.zeros(len(filled), np.int64)
    low[filled] = words.start[words.of[:-1][filled]]
    high[filled] = words.end[words.of[1:][filled] - 1]
    texts = np.flatnonzero(filled)
    left = np.searchsorted(regions.keys, grams[at], side="left")
    count = np.searchsorted(regions.keys, grams[at], side="right") - left
    total = np.cumsum(count)
    names, number = np.empty((3, 0), np.int64), np.empty(0, np.int64)
    start = 0
    while start < len(at):  # a few million shared q-grams at a time, however often they repeat
        before = total[start - 1] if start else 0
        end = max(int(np.searchsorted(total, before + PAIRS, side="right")), start + 1)
        names, number = _banded(
            at[start:end], left[start:end], count[start:end], regions, low, high, texts, names, number)
        start = end
    text, region, band = names[:, number >= regions.bound[names[1]]]
    if not len(text):
        return text, region, band
    first = band * (regions.edits[region] + 1) - REGION + low[text]
    edits = np.concatenate([
        _align(data, low[text[k:k + 4096]], high[text[k:k + 4096]], first[k:k + 4096], regions, region[k:k + 4096])
        for k in range(0, len(text), 4096)])
    good = edits <= regions.edits[region]
    return text[good], region[good], edits[good]


def find_leaks(docs, benchmark, block_bytes=1 << 20):
    """``doc_id, item_id, n_regions, n_item_regions, edits`` for each document with part of an item.

    ``docs`` needs doc_id and text, ``benchmark`` item_id and text; null texts are empty, items
    under ``Q`` bytes have no q-gram and are ignored, repeated rows count once. ``edits`` is the least
    number of edits of a region found. The benchmark is searched in blocks of about
    ``block_bytes``, each broadcast on its own, so that what is broadcast stays bounded however
    large it is; each block is one pass over the documents, in which nothing is shuffled but
    the leaks found.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"),
                             F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).distinct()
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-total // block_bytes) or 1
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = None
    for block in range(blocks):
        held = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect()
        shared = spark.sparkContext.broadcast([tuple(r) for r in held])

        def run(batches, shared=shared):
            regions = Regions(shared.value)
            if not regions.texts:
                return
            for piece in pieces(batches):
                text, region, edits = _leaks(Words(piece.column("text"), lower=True), regions)
                ids = piece.column("doc_id").take(pa.array(text, pa.int64()))
                yield pa.RecordBatch.from_arrays([
                    ids, pa.array([regions.item[r] for r in region], pa.int64()),
                    pa.array([regions.at[r] for r in region], pa.int64()), pa.array(edits, pa.int64()),
                    pa.array([regions.of_item[r] for r in region], pa.int64()),
                ], ["doc_id", "item_id", "region", "edits", "n_item_regions"])

        part = rows.mapInArrow(run, "doc_id long, item_id long, region long, edits long, n_item_regions long")
        found = part if found is None else found.union(part)
    once = found.groupBy("doc_id", "item_id", "region").agg(
        F.min("edits").alias("edits"), F.max("n_item_regions").alias("n_item_regions"))
    return once.groupBy("doc_id", "item_id").agg(
        F.count("*").alias("n_regions"), F.max("n_item_regions").alias("n_item_regions"), F.min("edits").alias("edits"))


def clean_documents(docs, benchmark, **options):
    """The rows of ``docs`` without a leak, all columns as they were (null doc_id included)."""
    leaking = find_leaks(docs, benchmark, **options).select(F.col("doc_id").alias("_leaking")).distinct()
    return docs.join(leaking, docs["doc_id"].cast("long").eqNullSafe(leaking["_leaking"]), "left_anti")
