"""Ranked lexical search over hashed max-sketches.

A document's sketch has one coordinate for every hash value of a term and holds the highest
impact of the terms that fall on it. For one document an impact grows with the term's count
alone, so the sketch stores the highest count: it needs no statistics of the corpus, is made in
the same pass that gathers them, and stays valid when documents are added. The weights of an
item's terms, summed by coordinate, times a sketch give a bound that no score exceeds.

Items are looked up in blocks, as one matrix product per batch of sketches. The documents of the
highest bounds are rescored from their texts; then tiers of descending bound follow until no bound
reaches the score of the last place, so the ranking is the exact one.
"""

import math
import zlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Window
from pyspark.sql import functions as F

from txlens.llm.textkit import pieces, utf8
from txlens.staging import stage

#: Coordinates of a sketch; only those that occur are stored.
WIDTH = 4096
#: A stored count of this or more is taken as unbounded.
MOST = 65535
#: Items of one matrix product, and bytes of items whose terms are counted in one pass.
ITEMS = 256
ITEM_BYTES = 1 << 20
#: Sketches of one matrix product.
ROWS = 512
#: Documents per item of the first tier; every further tier may hold four times as many.
TIER = 64
SHARES = (0.0, 0.5, 0.75, 0.9, 0.97, 0.99, 0.997, 0.999, 0.9999, 0.99999)

_bytes = np.arange(256)
TERM = (((_bytes >= 48) & (_bytes <= 57)) | ((_bytes >= 65) & (_bytes <= 90))
        | ((_bytes >= 97) & (_bytes <= 122)) | (_bytes >= 128))
LOWER = np.where((_bytes >= 65) & (_bytes <= 90), _bytes + 32, _bytes).astype(np.uint8)


class Terms(NamedTuple):
    """Terms of a batch of texts: ``names[term[i]]`` stands ``count[i]`` times in ``text[i]``."""

    names: pa.Array
    text: np.ndarray
    term: np.ndarray
    count: np.ndarray
    sizes: np.ndarray


def terms_of(column):
    """Runs of ASCII letters, digits and all other characters; only A-Z are lower-cased."""
    raw, offsets = utf8(column)
    inside = TERM[raw]
    first = inside.copy()
    opens = np.zeros(len(raw) + 1, dtype=bool)
    opens[offsets[:-1]] = True
    first[1:] &= ~inside[:-1] | opens[1:-1]
    begin = np.flatnonzero(first)
    kept = np.cumsum(inside, dtype=np.int64)
    ends = np.append(kept[begin] - 1, kept[-1] if len(kept) else 0).astype(np.int32)
    words = pa.StringArray.from_buffers(
        len(begin), pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(LOWER[raw[inside]])))
    coded = words.dictionary_encode()
    sizes = np.diff(np.searchsorted(begin, offsets))
    width = max(len(coded.dictionary), 1)
    cell = np.repeat(np.arange(len(sizes)), sizes) * width + coded.indices.to_numpy(zero_copy_only=False)
    cell, count = np.unique(cell, return_counts=True)
    return Terms(coded.dictionary, cell // width, cell % width, count, sizes)


def coordinates(names):
    """The coordinate of every term."""
    return np.fromiter((zlib.crc32(name.encode()) % WIDTH for name in names.to_pylist()), np.int64, len(names))


def _sketches(terms):
    """Per text: its coordinates as 16-bit numbers, and the highest count on each."""
    cell = terms.text * WIDTH + coordinates(terms.names)[terms.term]
    order = np.argsort(cell, kind="stable")
    held, at = np.unique(cell[order], return_index=True)
    peak = np.maximum.reduceat(terms.count[order], at) if len(at) else terms.count
    places = np.searchsorted(held, np.arange(len(terms.sizes) + 1) * WIDTH)
    where, peak = (held % WIDTH).astype("<u2"), np.minimum(peak, MOST).astype("<u2")
    return ([where[a:b].tobytes() for a, b in zip(places, places[1:])],
            [peak[a:b].tobytes() for a, b in zip(places, places[1:])])


def _texts(docs):
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def index(docs, vocabulary, sketches=True):
    """One pass over the texts: a sketch per document, and statistics per task.

    Sketch rows hold doc_id, size (number of terms), places and peaks; statistics rows hold a
    number of ``vocabulary`` in ``term`` and in how many documents it is; -1 stands for the
    documents with a term, -2 for all terms.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches):
        wanted = pa.array(shared.value, pa.string())
        df, texts, total = np.zeros(len(wanted), np.int64), 0, 0
        for piece in pieces(batches):
            terms = terms_of(piece.column("text"))
            number = pc.index_in(terms.names, value_set=wanted).fill_null(-1).to_numpy(zero_copy_only=False)
            found = number[terms.term]
            df += np.bincount(found[found >= 0], minlength=len(wanted))[:len(wanted)]
            texts += int((terms.sizes > 0).sum())
            total += int(terms.sizes.sum())
            if sketches:
                places, peaks = _sketches(terms)
                none = pa.nulls(piece.num_rows, pa.int64())
                yield pa.RecordBatch.from_arrays([
                    piece.column("doc_id"), pa.array(terms.sizes, pa.int64()), pa.array(places, pa.binary()),
                    pa.array(peaks, pa.binary()), none, none], names)
        seen = np.flatnonzero(df)
        none = pa.nulls(len(seen) + 2, pa.int64())
        empty = pa.nulls(len(seen) + 2, pa.binary())
        yield pa.RecordBatch.from_arrays([none, none, empty, empty, pa.array([-1, -2, *seen], pa.int64()),
                                          pa.array([texts, total, *df[seen]], pa.int64())], names)

    names = ["doc_id", "size", "places", "peaks", "term", "held"]
    return stage(_texts(docs).mapInArrow(
        run, "doc_id long, size long, places binary, peaks binary, term long, held long"))


class Statistics(NamedTuple):
    documents: int
    terms: int
    df: dict

    def weight(self, term):
        return math.floor(1000 * math.log((2 * self.documents + 2) / (2 * self.df.get(term, 0) + 1)))

    def length_part(self, sizes):
        """m of documents with so many terms."""
        if not self.terms:
            return np.full(len(sizes), 25, np.int64)
        if int(sizes.max(initial=0)) * 75 * self.documents < 1 << 63:
            return 25 + (75 * sizes * self.documents) // self.terms
        return np.array([25 + 75 * int(n) * self.documents // self.terms for n in sizes], np.int64)


def _statistics(indexed, vocabulary):
    counted = indexed.where("term is not null").groupBy("term").agg(F.sum("held").alias("held")).collect()
    held = {row["term"]: row["held"] for row in counted}
    df = {name: held[i] for i, name in enumerate(vocabulary) if i in held}
    return Statistics(held.get(-1, 0), held.get(-2, 0), df)


def impacts(count, length_part):
    """The part of a score that one term of a document gives, before its weight."""
    return (1_000_000_000 * count) // (1000 * count + 8 * length_part)


class Block:
    """Some items: their terms, how often each item has them, and their weights."""

    def __init__(self, items, statistics):
        self.statistics = statistics
        terms = terms_of(pa.array([text for _, text in items], pa.string()))
        self.names = terms.names.to_pylist()
        weight = np.array([statistics.weight(name) for name in self.names], np.float64)
        self.weights = np.zeros((len(self.names), len(items)))
        self.weights[terms.term, terms.text] = terms.count
        self.weights *= weight[:, None]
        place = coordinates(terms.names)
        self.used, row = np.unique(place, return_inverse=True)
        self.folded = np.zeros((len(self.used), len(items)))
        np.add.at(self.folded, row, self.weights)
        # beyond 2**53 sums of doubles are rounded; bounds are then widened, scores summed in halves
        self.slack = 1.0 if self.folded.sum(axis=0).max(initial=0) * 1e6 < 1 << 53 else 1 + 2.0**-30

    def bounds(self, batch):
        """Bounds of the scores, sketches by items."""
        rows = batch.num_rows
        where, at = _flat(batch.column("places"))
        peak, _ = _flat(batch.column("peaks"))
        row = np.repeat(np.arange(rows), np.diff(at))
        column = np.searchsorted(self.used, where)
        hit = column < len(self.used)
        hit[hit] = self.used[column[hit]] == where[hit]
        row, column, peak = row[hit], column[hit], peak[hit].astype(np.int64)
        part = self.statistics.length_part(batch.column("size").to_numpy(zero_copy_only=False))
        value = np.where(peak >= MOST, 1_000_000, impacts(peak, part[row]))
        table = np.zeros((rows, len(self.used)))
        table[row, column] = value
        return table @ self.folded * self.slack

    def scores(self, column):
        """Exact scores, texts by items, as whole numbers."""
        terms = terms_of(column)
        number = pc.index_in(terms.names, value_set=pa.array(self.names, pa.string()))
        number = number.fill_null(-1).to_numpy(zero_copy_only=False)[terms.term]
        hit = number >= 0
        value = impacts(terms.count[hit], self.statistics.length_part(terms.sizes)[terms.text[hit]])
        total = np.zeros((len(terms.sizes), self.weights.shape[1]), np.int64)
        for a in range(0, len(total), ROWS):
            near = (terms.text[hit] >= a) & (terms.text[hit] < a + ROWS)
            high = np.zeros((min(ROWS, len(total) - a), len(self.names)))
            low = np.zeros_like(high)
            cells = terms.text[hit][near] - a, number[hit][near]
            high[cells], low[cells] = value[near] >> 10, value[near] & 1023
            total[a:a + ROWS] = (np.rint(high @ self.weights).astype(np.int64) << 10) + np.rint(
                low @ self.weights).astype(np.int64)
        return total


def _flat(column):
    """16-bit numbers of a binary column, and where each row's begin."""
    at = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    held = np.frombuffer(data, np.uint8)[at[0]:at[-1]] if data else np.empty(0, np.uint8)
    return np.frombuffer(held.tobytes(), "<u2").astype(np.int64), (at - at[0]) // 2


def _pairs(doc_ids, values, keep, name):
    """A batch (item, doc_id, value) of the kept cells."""
    row, item = np.nonzero(keep)
    return pa.RecordBatch.from_arrays(
        [pa.array(item, pa.int64()), doc_ids.take(pa.array(row, pa.int64())),
         pa.array(values[row, item], pa.float64() if name == "bound" else pa.int64())], ["item", "doc_id", name])


def _beats(values, ids, last):
    """Which cells come before the last place so far: more, or as much with a smaller doc_id."""
    score, holder = last
    return (values > 0) & ((values > score) | ((values == score) & (ids[:, None] < holder)))


def _ids(column):
    """doc_ids as doubles' neighbours: nulls come after all others."""
    return column.fill_null(np.iinfo(np.int64).max).to_numpy(zero_copy_only=False)


def _highest(sketches, block, places):
    """(item, doc_id, bound): each task's ``places`` highest bounds of every item."""
    def run(batches):
        best = None
        for batch in batches:
            for a in range(0, batch.num_rows, ROWS):
                part = batch.slice(a, ROWS)
                bounds, ids = block.value.bounds(part), part.column("doc_id")
                if best is not None:
                    bounds, ids = np.vstack([best[0], bounds]), pa.concat_arrays([best[1], ids])
                if len(bounds) > places:
                    top = np.unique(np.argpartition(-bounds, places - 1, axis=0)[:places])
                    bounds, ids = bounds[top], ids.take(pa.array(top))
                best = bounds, ids
        if best is not None:
            cut = np.sort(best[0], axis=0)[-places:][0]
            yield _pairs(best[1], best[0], (best[0] >= cut) & (best[0] > 0), "bound")

    return sketches.mapInArrow(run, "item long, doc_id long, bound double")


def _reaching(sketches, block, last):
    """(item, doc_id, bound) of all documents whose bound comes before the last place."""
    def run(batches):
        for batch in batches:
            for a in range(0, batch.num_rows, ROWS):
                part = batch.slice(a, ROWS)
                bounds = block.value.bounds(part)
                yield _pairs(part.column("doc_id"), bounds, _beats(bounds, _ids(part.column("doc_id")), last), "bound")

    return sketches.mapInArrow(run, "item long, doc_id long, bound double")


def _rescored(docs, doc_ids, block, last):
    """(item, doc_id, score) of the documents named, where they come before the last place."""
    def run(batches):
        for piece in pieces(batches):
            scores = block.value.scores(piece.column("text"))
            yield _pairs(piece.column("doc_id"), scores, _beats(scores, _ids(piece.column("doc_id")), last), "score")

    named = doc_ids.select(F.col("doc_id").alias("_id")).distinct()
    texts = _texts(docs).join(named, F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi")
    return texts.mapInArrow(run, "item long, doc_id long, score long")


def _top(scored, value, places):
    order = Window.partitionBy("item").orderBy(F.col(value).desc(), F.col("doc_id").asc_nulls_last())
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= places)


def _merged(best, scored, places):
    """The first ``places`` documents of every item; a doc_id counts once, with its best score."""
    found = scored if best is None else best.select("item", "doc_id", "score").union(scored)
    return stage(_top(found.groupBy("item", "doc_id").agg(F.max("score").alias("score")), "score", places))


def _last_places(best, items, places):
    """Score and doc_id of the last place of every item; 0 where fewer documents are known."""
    score, holder = np.zeros(items, np.int64), np.full(items, np.iinfo(np.int64).max)
    for row in best.where(F.col("rank") == places).collect():
        score[row["item"]] = row["score"]
        if row["doc_id"] is not None:
            holder[row["item"]] = row["doc_id"]
    return score, holder


def _next_tier(pairs, last, below, tier):
    """Open pairs, and for each item the bound down to which the next tier reaches."""
    spark = pairs.sparkSession
    limits = spark.createDataFrame(
        [(i, int(last[0][i]), float(below[i])) for i in range(len(below))], "item long, _last long, _below double")
    open_ = pairs.join(F.broadcast(limits), "item").where((F.col("bound") >= F.col("_last")) & (F.col("bound") < F.col("_below")))
    sizes = open_.groupBy("item").agg(
        F.count("*").alias("n"), F.percentile_approx("bound", list(SHARES), 10_000).alias("at")).collect()
    cut = np.full(len(below), np.inf)
    for row in sizes:
        wide = [at for share, at in zip(SHARES, row["at"]) if row["n"] * (1 - share) <= tier]
        cut[row["item"]] = row["at"][0] if row["n"] <= tier else wide[0] if wide else row["at"][-1]
    return open_.drop("_last", "_below"), cut, bool(sizes)


def _search_block(docs, sketches, items, statistics, places, tier):
    """The ranking of one block of items, as a written table."""
    spark = docs.sparkSession
    block = spark.sparkContext.broadcast(Block(items, statistics))
    nobody = np.zeros(len(items), np.int64), np.full(len(items), np.iinfo(np.int64).max)
    seeds = stage(_top(_highest(sketches, block, places), "bound", places).select("doc_id"))
    best = _merged(None, _rescored(docs, seeds, block, nobody), places)
    last = _last_places(best, len(items), places)
    pairs = stage(_reaching(sketches, block, last))
    below = np.full(len(items), np.inf)
    while True:
        open_, cut, more = _next_tier(pairs, last, below, tier)
        if not more:
            break
        cuts = spark.createDataFrame([(i, float(c)) for i, c in enumerate(cut)], "item long, _cut double")
        named = stage(open_.join(F.broadcast(cuts), "item").where(F.col("bound") >= F.col("_cut")).select("doc_id").distinct())
        best = _merged(best, _rescored(docs, named, block, last), places)
        last = _last_places(best, len(items), places)
        below, tier = np.minimum(below, cut), tier * 4
    names = spark.createDataFrame([(i, item_id) for i, (item_id, _) in enumerate(items)], "item long, item_id long")
    return best.join(F.broadcast(names), "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def search(docs, benchmark, places=10, items_per_block=ITEMS, item_bytes=ITEM_BYTES, tier=TIER):
    """``item_id, rank, doc_id, score``: the ``places`` best documents of every item.

    Scores are whole numbers as the weights and impacts above say; equal scores go by ascending
    doc_id, null last; scores of 0 are left out. ``docs`` needs doc_id and text, ``benchmark``
    item_id and text; further columns are ignored. Null and empty texts have no terms: such a
    document is never found, such an item has no rows. Every row counts as a document in the
    statistics; rows of one doc_id (null too) take one place, with their best score. Equal
    benchmark rows are one item; an item_id with different texts is ranked for each of them.
    Of an empty table the result is empty.

    Texts are read once for sketches and statistics (once more for every further ``item_bytes``
    of items), and those of the documents in a tier are read again to be rescored.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    items = stage(items.where("text is not null").distinct())
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    groups = -(-total // item_bytes) or 1
    sketches, found = None, None
    for group in range(groups):
        held = [tuple(row) for row in items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(groups)) == group)
                .orderBy("item_id", "text").collect()]
        vocabulary = terms_of(pa.array([text for _, text in held], pa.string())).names.to_pylist()
        indexed = index(docs, vocabulary, sketches is None)
        statistics = _statistics(indexed, vocabulary)
        if sketches is None:
            sketches = indexed.where("places is not null").select("doc_id", "size", "places", "peaks")
        for a in range(0, len(held) if statistics.documents else 0, items_per_block):
            part = _search_block(docs, sketches, held[a:a + items_per_block], statistics, places, tier)
            found = part if found is None else found.unionByName(part)
    if found is None:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return found
