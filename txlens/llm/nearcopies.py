"""Near-duplicate documents: word shingles with a Jaccard similarity of at least 4/5.

Texts with one set of shingles are one node. Two sets with a Jaccard of 4/5 or more differ in at
most a ninth of their sizes' sum; that gives filters that lose no pair:

1. A set with more than a fifth of its shingles in no other text has no near copy. This is
   first found from the shingles of the lowest hashes, the same share of all texts; most texts
   end here. The others are shingled again and counted in full.
2. SimHash fingerprints of the sets are linked by pigeonring chains (see ``simhash``), and the
   Jaccard of the linked sets is counted. These are links, but not all of them: a Jaccard of
   0.8 is about ten bits of 64, beyond the chains' three. The next steps find the others.
3. Ordered by how rare they are, the first fifth (and one) of two near sets have a shingle in
   common. So texts are looked at together only under their rare shared shingles.
4. Under such a shingle, all texts are compared with one of them, the one with the fewest
   shingles of its own. Those near to it are in one group and need no further comparison.
5. A text that is not near to its leader is near to another one of the leader's texts only if
   their differences from the leader overlap. How much is known from the sizes; so the same
   rule of rare first parts holds for the differences, which are small where texts are alike.
   Only pairs that pass it, and that the fingerprints have not linked, are compared.

So a large group of close texts costs a comparison a text and the few pairs whose differences
from the leader agree, not all pairs.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from txlens.llm import simhash
from txlens.llm.graphs import components
from txlens.llm.textkit import U64, Rolling, Words, mixed, pieces
from txlens.staging import stage

#: Sets differ in at most one of NINTH shingles of both; one of FIFTH of each.
FIFTH, NINTH = 5, 9
SHINGLE = 5
BASE = 0x9E3779B97F4A7C15
#: One of so many shingles is looked at to find the texts without near copies.
SAMPLE = 3


def shingle_sets(words, rolling, shingle=SHINGLE):
    """Sorted distinct shingle hashes of each text; a text of fewer words is one shingle."""
    of, last = words.of[:-1], words.of[1:]
    count = np.where(last > of, np.maximum(last - of - shingle + 1, 1), 0)
    places = np.concatenate([[0], np.cumsum(count)])
    first = np.arange(places[-1]) + np.repeat(of - places[:-1], count)
    end = np.minimum(first + shingle, np.repeat(last, count)) - 1
    hashes = rolling.spans(words.data, words.start[first], words.end[end])
    return [np.unique(hashes[a:b]) for a, b in zip(places, places[1:])]


def _digest(shingles):
    """The name of a set, as a signed long."""
    with np.errstate(over="ignore"):
        return int(mixed(np.array([mixed(shingles ^ U64(BASE)).sum(dtype=U64) + U64(len(shingles))], U64)).view(np.int64)[0])


def _texts(docs):
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("key"), text.alias("text"))


def _sets(texts, shingle, sample=None):
    """``doc_id, key, node, size, bits, shingles``; with ``sample`` only one of so many shingles and no fingerprint."""
    bound = U64((1 << 64) // sample) if sample else None

    def run(batches):
        rolling = Rolling(BASE)
        for piece in pieces(batches):
            sets = shingle_sets(Words(piece.column("text"), lower=True), rolling, shingle)
            held = sets if bound is None else [s[:np.searchsorted(s, bound)] for s in sets]
            yield pa.RecordBatch.from_arrays([
                piece.column("doc_id"), piece.column("key"), pa.array([_digest(s) for s in sets], pa.int64()),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array([simhash.majority(s) if bound is None else None for s in sets], pa.int64()),
                pa.array([s.view(np.int64) for s in held], pa.list_(pa.int64()))],
                ["doc_id", "key", "node", "size", "bits", "shingles"])

    return texts.mapInArrow(run, "doc_id long, key long, node long, size long, bits long, shingles array<long>")


def _perhaps_near(named):
    """(node, size) of the texts that may have a near copy, judged by a sample of shingles."""
    held = named.select("node", F.explode("shingles").alias("shingle"))
    owners = held.groupBy("shingle").agg(F.min("node").alias("node"), F.max("node").alias("other"))
    own = stage(owners.where("node = other").groupBy("node").agg(F.count("*").alias("own")))
    sizes = named.where("size > 0").groupBy("node").agg(F.max("size").alias("size"))
    return sizes.join(own, "node", "left").where(
        F.coalesce("own", F.lit(0)) <= F.floor(F.col("size") / FIFTH)).select("node", "size")


def _rare_first(rows, group, amount):
    """Adds ``at``: the place of a row's shingle in its set, rarest first; those in no other set come before."""
    place = Window.partitionBy(*group).orderBy(amount, "shingle")
    shared = Window.partitionBy(*group)
    own = F.col("size") - F.count("*").over(shared)
    return rows.withColumn("at", own + F.row_number().over(place) - 1)


def _under_rare_shingles(sets):
    """(shingle, node, share): the rare first part of each set, but for shingles in no other set."""
    held = sets.select("node", "size", F.explode("shingles").alias("shingle"))
    known = stage(held.groupBy("shingle").agg(F.count("*").alias("texts")).where("texts > 1"))
    placed = _rare_first(held.join(known, "shingle"), ["node"], "texts")
    allowed = F.floor(F.col("size") / FIFTH)
    own = F.col("size") - F.count("*").over(Window.partitionBy("node"))
    return placed.withColumn("own", own).where((F.col("at") <= allowed) & (F.col("own") <= allowed)).select(
        "shingle", "node", (F.col("own") / F.col("size")).alias("share"))


def _differences(sets, led):
    """(lead, node, size, lead_size, delta): how the sets differ from their leaders' sets."""
    one = led.join(sets.select("node", "size", F.col("shingles").alias("left")), "node")
    both = one.join(sets.select(F.col("node").alias("lead"), F.col("size").alias("lead_size"), F.col("shingles").alias("right")), "lead")
    delta = F.concat(F.array_except("left", "right"), F.array_except("right", "left"))
    return both.select("lead", "node", F.col("size").alias("words"), "lead_size", delta.alias("delta"))


def _agreeing(deltas):
    """(a, b): texts of one leader, one of them not near to it, whose differences from it may agree enough.

    With d and e the sizes of two differences and s that of both sets together, near sets' differences
    have ``(9 (d + e) - s) / 18`` shingles in common; if one text is not near to the leader, that is
    more than ``4 e / 9`` for the other one.
    """
    held = deltas.select("lead", "node", "words", "far", F.size("delta").cast("long").alias("size"), F.explode("delta").alias("shingle"))
    known = stage(held.groupBy("lead", "shingle").agg(F.count("*").alias("texts")).where("texts > 1"))
    placed = stage(_rare_first(held.join(known, ["lead", "shingle"]), ["lead", "node"], "texts").drop("texts"))
    one = placed.where("far").select("lead", "shingle", *[F.col(c).alias(f"a_{c}") for c in ("node", "words", "size", "at")])
    # (far text, any text): the other one's part is as short as the far one's distance allows
    other = placed.where(F.col("at") <= F.col("size") - F.ceil(4 * F.col("size") / NINTH)).select(
        "lead", "shingle", *[F.col(c).alias(f"b_{c}") for c in ("node", "words", "size", "at")])
    together = F.col("a_words") + F.col("b_words")
    common = NINTH * (F.col("a_size") + F.col("b_size")) - together
    fits = ((F.col("a_node") != F.col("b_node")) & (NINTH * F.abs(F.col("a_size") - F.col("b_size")) <= together)
            & (2 * NINTH * (F.col("a_size") - F.col("a_at")) >= common) & (2 * NINTH * (F.col("b_size") - F.col("b_at")) >= common))
    pairs = one.join(other, (one["lead"] == other["lead"]) & (one["shingle"] == other["shingle"]) & fits)
    return pairs.select(F.least("a_node", "b_node").alias("a"), F.greatest("a_node", "b_node").alias("b")).distinct()


def _near(sets, pairs):
    """The ``pairs`` (a, b) of nodes that are near."""
    both = (pairs.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("left")), "a")
            .join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("right")), "b"))
    total = F.size("left") + F.size("right")
    differ = total - 2 * F.size(F.array_intersect("left", "right"))
    return both.where(NINTH * differ <= total).select("a", "b")


def fingerprint_links(sets):
    """Near pairs (a, b), ``a < b``, among sets of equal fingerprints or linked by pigeonring chains.

    Sets of one fingerprint are compared with the first of them, and the first ones with each other.
    """
    first = stage(sets.groupBy("bits").agg(F.min("node").alias("first")))
    same = sets.join(first, "bits").where("node <> first").select(F.col("first").alias("a"), F.col("node").alias("b"))
    close = simhash.links(first.select("bits")).withColumnsRenamed({"a": "a_bits", "b": "b_bits"})
    across = (close.join(first.select(F.col("bits").alias("a_bits"), F.col("first").alias("x")), "a_bits")
              .join(first.select(F.col("bits").alias("b_bits"), F.col("first").alias("y")), "b_bits")
              .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")))
    return _near(sets, stage(same.union(across)))


def links(docs, shingle=SHINGLE):
    """``doc_id, key, node`` of the texts, and ``node, root`` of the nodes in a group with others."""
    named = stage(_sets(_texts(docs), shingle, SAMPLE).drop("bits"))
    left = stage(_perhaps_near(named))
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")
    chosen = named.join(left.select("node"), "node", "left_semi").groupBy("node").agg(F.min(first).alias("first"))
    chosen = stage(chosen.select(F.col("first.doc_id").alias("_id"), F.col("first.key").alias("_key")))
    texts = _texts(docs)
    texts = texts.join(chosen, texts["doc_id"].eqNullSafe(chosen["_id"]) & (texts["key"] == chosen["_key"]), "left_semi")
    sets = stage(_sets(texts, shingle).select("node", "size", "bits", "shingles").dropDuplicates(["node"]))
    printed = stage(fingerprint_links(sets))
    rare = stage(_under_rare_shingles(sets))
    leads = stage(rare.groupBy("shingle").agg(F.min(F.struct("share", "node")).alias("lead"), F.count("*").alias("n"))
                  .where("n > 1").select("shingle", F.col("lead.node").alias("lead")))
    led = rare.join(leads, "shingle").where("node <> lead").select("lead", "node").distinct()
    deltas = stage(_differences(sets, stage(led)).withColumn(
        "far", NINTH * F.size("delta") > F.col("words") + F.col("lead_size")))
    pairs = stage(_agreeing(deltas).join(printed, ["a", "b"], "left_anti"))
    led_links = deltas.where("not far").select(F.col("lead").alias("a"), F.col("node").alias("b"))
    found = printed.union(led_links).union(_near(sets, pairs))
    return named.select("doc_id", "key", "node"), components(found, "a", "b")


def keep_first(docs, shingle=SHINGLE):
    """One row of ``docs`` for each group: that of the least doc_id; all columns stay.

    A group is connected by pairs of 4/5 or more; texts without words are a group. Null
    doc_ids come last, rows of one doc_id with different texts in the order of the texts'
    hashes; every row is judged by its own text. Repeated rows leave one row.
    """
    named, roots = links(docs, shingle)
    rooted = named.join(roots, "node", "left").select("doc_id", "key", F.coalesce("root", "node").alias("root"))
    copies = rooted.groupBy("doc_id", "key", "root").agg(F.count("*").alias("copies"))
    least = stage(copies.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key", "copies")).alias("first"))
                  .select(F.col("first.doc_id").alias("_first"), F.col("first.key").alias("_key"), F.col("first.copies").alias("_copies")))
    key = F.xxhash64(F.col("text").cast("string"))
    rows = docs.withColumn("_text_key", key)
    kept = rows.join(least, rows["doc_id"].cast("long").eqNullSafe(least["_first"]) & (rows["_text_key"] == least["_key"]), "left_semi")
    if not least.where("_copies > 1").isEmpty():
        kept = kept.dropDuplicates(["doc_id", "_text_key"])
    return kept.select(*docs.columns)
