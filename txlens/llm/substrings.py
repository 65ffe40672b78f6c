"""Substring dedup: hashes of every fixed-length word window, repeated windows removed.

Every window of ``length`` words gets a Rabin-Karp hash. Equal windows have the same
minimizer (the least hash of their ``GRAM``-word parts), so windows are first grouped by
minimizer, and only those whose minimizer occurs in two documents go further. Neighbouring
windows with one minimizer travel as a run. A run that also occurs, as a whole, in a smaller
document is repeated in all its windows; where a minimizer has several different runs, the
windows of each run's first holder are counted one by one. Keys are a minimizer and a hash of
a run or window, 128 bits together. That drops no repeated window.
"""

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import functions as F

from txlens.llm.textkit import Rolling, Words, mixed, pieces, sliding_min
from txlens.staging import stage

#: Words of the parts that a minimizer is chosen from.
GRAM = 8
#: A missing doc_id counts as larger than every other.
LAST = (1 << 63) - 1


def _windows(words, length, grams, whole=None):
    """Minimizer of every window, the first window of each text and, if asked, window hashes."""
    gram = min(GRAM, length)
    first, of = words.runs(length)
    begin, span = words.runs(gram)
    parts = grams.spans(words.data, words.start[begin], words.end[begin + gram - 1])
    width = length - gram + 1
    least = sliding_min(parts, width) if len(parts) >= width else parts[:0]
    # the windows of a text start where its parts start; windows across two texts fall away
    place = first - np.repeat(words.of[:-1] - span[:-1], np.diff(of))
    least = least[place]
    hashes = whole.spans(words.data, words.start[first], words.end[first + length - 1]) if whole else None
    return least, of, hashes


def _changes(values, of):
    """True where a value differs from the one before it in the same text."""
    new = np.ones(len(values), dtype=bool)
    new[1:] = values[1:] != values[:-1]
    new[of[:-1][of[:-1] < of[1:]]] = True
    return new


def _anchors(length):
    def run(batches):
        grams = Rolling(0x9E3779B97F4A7C15)
        for piece in pieces(batches):
            least, of, _ = _windows(Words(piece.column("text")), length, grams)
            new = _changes(least, of)
            ids = np.repeat(piece.column("doc_id").to_numpy(zero_copy_only=False), np.diff(of))
            yield pa.RecordBatch.from_arrays(
                [pa.array(least[new].view(np.int64)), pa.array(ids[new])], ["anchor", "doc_id"])
    return run


def _pack(batches):
    """Texts in canonical form, compressed, so that their shuffles stay small."""
    pack = zstandard.ZstdCompressor(level=3).compress
    for piece in pieces(batches):
        words = Words(piece.column("text"))
        packed = [pack(words.text(i)) for i in range(piece.num_rows)]
        yield pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array(packed, pa.binary())], ["doc_id", "packed"])


def _unpacked(batches, max_bytes=1 << 21):
    """Pieces of batches of packed texts, each with the texts as a column."""
    unpack = zstandard.ZstdDecompressor().decompress
    for batch in batches:
        texts, start, size = [], 0, 0
        for i, packed in enumerate(batch.column("packed")):
            texts.append(unpack(packed.as_buffer()))
            size += len(texts[-1])
            if size >= max_bytes or i + 1 == batch.num_rows:
                yield batch.slice(start, i + 1 - start), pa.array(texts, pa.binary()).cast(pa.string())
                texts, start, size = [], i + 1, 0


def _runs(length):
    def run(batches):
        grams, whole = Rolling(0x9E3779B97F4A7C15), Rolling(0xD1342543DE82EF95)
        for piece, texts in _unpacked(batches):
            least, of, hashes = _windows(Words(texts), length, grams, whole)
            shared, least = np.zeros(len(least), dtype=bool), least.view(np.int64)
            for i, known in enumerate(piece.column("anchors")):
                part = slice(of[i], of[i + 1])
                shared[part] = np.isin(least[part], known.values.to_numpy())
            at = np.flatnonzero(shared)
            if not len(at):
                continue
            text = np.searchsorted(of, at, side="right") - 1
            cut = np.ones(len(at), dtype=bool)
            cut[1:] = (least[at[1:]] != least[at[:-1]]) | (at[1:] != at[:-1] + 1) | (text[1:] != text[:-1])
            heads = np.flatnonzero(cut)
            ids = piece.column("doc_id").to_numpy(zero_copy_only=False)
            hashes = hashes[at]
            yield pa.RecordBatch.from_arrays([
                pa.array(ids[text[heads]]), pa.array(least[at[heads]]),
                pa.array(np.add.reduceat(mixed(hashes), heads).view(np.int64)),
                pa.array((at - of[text])[heads].astype(np.int32)),
                pa.array(np.diff(np.append(heads, len(at))).astype(np.int32)),
                pa.ListArray.from_arrays(pa.array(np.append(heads, len(at)).astype(np.int32)),
                                         pa.array(hashes.view(np.int64))),
            ], ["doc_id", "anchor", "run", "place", "size", "hashes"])
    return run


def _cut(length):
    def run(batches):
        for piece, texts in _unpacked(batches):
            words = Words(texts)
            removed, digests, kept_texts = [], [], []
            for i, late in enumerate(piece.column("late")):
                size, text = int(words.of[i + 1] - words.of[i]), words.text(i)
                gone = 0
                if late.is_valid and size >= length:
                    first = late.values.field("place").to_numpy()
                    last = np.minimum(first + late.values.field("size").to_numpy() + length - 1, size)
                    depth = np.zeros(size + 1, dtype=np.int64)
                    np.add.at(depth, np.minimum(first, size), 1)
                    np.add.at(depth, last, -1)
                    keep = np.cumsum(depth[:-1]) == 0
                    gone = size - int(keep.sum())
                    if gone:
                        text = b" ".join(compress(text.split(b" "), keep))
                removed.append(gone)
                digests.append(hashlib.sha256(text).hexdigest())
                kept_texts.append(text)
            yield pa.RecordBatch.from_arrays([
                piece.column("doc_id"), pa.array(np.diff(words.of), pa.int64()),
                pa.array(removed, pa.int64()), pa.array(digests, pa.string()),
                pa.array(kept_texts, pa.binary()).cast(pa.string()),
            ], ["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"])
    return run


def remove_repeated_windows(docs, length=50):
    """Remove every word covered by a window that also starts in a smaller doc_id.

    Takes ``doc_id`` and ``text`` (other columns are ignored) and returns one row per input row:
    doc_id, n_words, n_removed, kept_sha256, kept_text. A null text has no words; texts shorter
    than a window stay whole; rows that share a doc_id count as one document and never remove
    each other; a null doc_id counts as the largest. Windows are judged on the input. Copies
    and passages may be in any number of documents: counts are combined before the shuffle, and
    the joins are plain ones that adaptive execution splits where a window is common.
    """
    rows = docs.select(F.coalesce("doc_id", F.lit(LAST)).cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text"))
    anchors = stage(rows.mapInArrow(_anchors(length), "anchor long, doc_id long"))
    repeated = (anchors.groupBy("anchor").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
                .where("low < high").select("anchor"))
    known = (anchors.join(repeated, "anchor", "left_semi")
             .groupBy("doc_id").agg(F.collect_set("anchor").alias("anchors")))
    packed = rows.mapInArrow(_pack, "doc_id long, packed binary")
    runs = stage(packed.join(known, "doc_id").mapInArrow(
        _runs(length), "doc_id long, anchor long, run long, place int, size int, hashes array<long>"))
    holders = stage(runs.groupBy("anchor", "run").agg(F.min("doc_id").alias("low")))
    whole = (runs.select("doc_id", "anchor", "run", "place", "size").join(holders, ["anchor", "run"])
             .where("low < doc_id").select("doc_id", "place", "size"))
    several = holders.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor")
    firsts = holders.join(several, "anchor", "left_semi").withColumnRenamed("low", "doc_id")
    windows = stage(runs.select("doc_id", "anchor", "run", "place", "hashes")
                    .join(firsts, ["anchor", "run", "doc_id"], "left_semi")
                    .select("doc_id", "anchor", "place", F.posexplode("hashes").alias("step", "hash")))
    # written, so that the join with a window of all documents can be split
    earliest = stage(windows.groupBy("anchor", "hash")
                     .agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
                     .where("low < high").select("anchor", "hash", "low"))
    single = (windows.join(earliest, ["anchor", "hash"]).where("low < doc_id")
              .select("doc_id", (F.col("place") + F.col("step")).alias("place"), F.lit(1).alias("size")))
    late = whole.union(single).groupBy("doc_id").agg(F.collect_list(F.struct("place", "size")).alias("late"))
    cut = packed.join(late, "doc_id", "left").mapInArrow(
        _cut(length), "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string")
    return cut.withColumn("doc_id", F.when(F.col("doc_id") != LAST, F.col("doc_id")))
