"""SimHash near-dedup with pigeonring filtering.

Two 64-bit fingerprints with at most ``distance`` (3) differing bits, cut into four 16-bit
segments on a ring, have a segment from which the differences of the first 1, 2, 3, 4
segments stay within 0, 1, 2, 3: the chain's proportional budgets. So one segment is equal and
the next differs in at most one bit, which makes a 32-bit key with 17 forms; fingerprints that
share a key go through the longer chains and the full Hamming check.
"""

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

from txlens.llm.graphs import components
from txlens.llm.textkit import Words, pieces
from txlens.staging import stage

SEGMENTS = 4
WIDTH = 16
#: Shingles whose bits are counted at once.
BLOCK = 1 << 14


def _fingerprint(words, i, shingle, seed):
    """Majority bits of the shingle hashes of text ``i``; 0 without words."""
    a, b = int(words.of[i]), int(words.of[i + 1])
    if a == b:
        return 0
    last = max(b - shingle, a)
    start = words.start[a:last + 1] - words.start[a]
    end = (words.end[a + shingle - 1:b] if b - a >= shingle else words.end[b - 1:b]) - words.start[a]
    text, digest = words.text(i), xxhash.xxh64_intdigest
    return majority(np.fromiter((digest(text[s:e], seed) for s, e in zip(start.tolist(), end.tolist())),
                                dtype="<u8", count=len(start)))


def majority(hashes):
    """The fingerprint of 64-bit shingle hashes, as a signed long: the bits set in over half of them."""
    ones = np.zeros(64, np.int64)
    for k in range(0, len(hashes), BLOCK):
        block = hashes[k:k + BLOCK].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.uint32)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(docs, shingle=3, seed=42):
    """``doc_id`` and ``bits`` (the fingerprint as a signed long) of every row.

    Texts are lower-cased in A-Z only; words are runs without ASCII white space; a text of fewer
    words than a shingle is one shingle; a null text or one without words has fingerprint 0.
    """
    def run(batches):
        for piece in pieces(batches):
            words = Words(piece.column("text"), lower=True)
            bits = [_fingerprint(words, i, shingle, seed) for i in range(piece.num_rows)]
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), pa.array(bits, pa.int64())], ["doc_id", "bits"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, bits long")


def _ring(start):
    """The fingerprint turned so that segment ``start`` comes first."""
    by = WIDTH * start
    if not by:
        return F.col("bits")
    return F.shiftleft("bits", 64 - by).bitwiseOR(F.shiftrightunsigned("bits", by))


def links(different, distance=3):
    """Pairs ``(a, b)``, ``a < b``, of different fingerprints within ``distance`` bits.

    ``different`` has one row per fingerprint in ``bits``. Budgets of the chains are
    ``length * distance / 4`` rounded down, so ``distance`` is at most 3 here: with more, the
    first segment need not be equal.
    """
    if not 0 <= distance < SEGMENTS:
        raise ValueError("chains of four segments serve distances up to 3")
    budget = [length * distance // SEGMENTS for length in range(1, SEGMENTS + 1)]
    turned = different.select("bits", F.explode(F.array(*[
        F.struct(F.lit(i).alias("turn"), _ring(i).alias("ring")) for i in range(SEGMENTS)])).alias("r"))
    turned = turned.select("bits", "r.*").withColumn("key", F.col("ring").bitwiseAND(0xFFFFFFFF))
    flips = [0] + [1 << (WIDTH + k) for k in range(WIDTH)] if budget[1] else [0]
    left = turned.select(F.col("bits").alias("a"), "turn", F.col("ring").alias("a_ring"), F.explode(F.array(*[
        F.col("key").bitwiseXOR(F.lit(flip).cast("long")) for flip in flips])).alias("key"))
    right = turned.select(F.col("bits").alias("b"), "turn", F.col("ring").alias("b_ring"), "key")
    differ = F.col("a_ring").bitwiseXOR(F.col("b_ring"))
    chain = F.bit_count(differ.bitwiseAND((1 << 3 * WIDTH) - 1)) <= budget[2]
    near = chain & (F.bit_count(differ) <= distance)
    # both sides carry every fingerprint, so each pair is seen from the smaller one
    joined = left.join(right, (left["turn"] == right["turn"]) & (left["key"] == right["key"])
                       & (F.col("a") < F.col("b")) & near)
    return joined.select("a", "b").distinct()


def near_duplicates(docs, distance=3, shingle=3, seed=42):
    """One row per input row: doc_id, fingerprint (16 hex digits), component_id.

    ``component_id`` is the smallest doc_id that can be reached over links of at most
    ``distance`` bits. Texts with one fingerprint are one node, so a large group of copies costs
    one row in the search. Texts without words share fingerprint 0 and are linked like others.
    Rows may repeat; a null doc_id never is a component_id unless all of its group are null.
    """
    rows = stage(fingerprints(docs, shingle, seed))
    nodes = stage(rows.groupBy("bits").agg(F.min("doc_id").alias("first")))
    roots = components(links(nodes.select("bits"), distance), "a", "b")
    rooted = (nodes.join(roots.withColumnRenamed("node", "bits"), "bits", "left")
              .withColumn("root", F.coalesce("root", "bits")))
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = rooted.join(least, "root").select("bits", "component_id")
    return rows.join(named, "bits").select(
        "doc_id", F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), "component_id")
