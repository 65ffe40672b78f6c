"""Quality classifier: a factorisation machine on hashed words and structure statistics.

score = sigmoid(w0 + sum w x + pairs), where the pairwise term of all features is half the
difference between the squared sum and the sum of squares of the factor vectors, so a text is
scored in time linear in its features.
"""

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from txlens.llm.textkit import U64, Rolling, Words, pieces, utf8

WORD_BITS = 16
#: Steps that a statistic is cut into.
STEPS = 16
#: Bytes counted as shares of the text: capitals, digits, symbols, calls, bars, line ends.
CLASSES = (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b"#*$%&<>", b"!?", b"|", b"\n")
STATISTICS = len(CLASSES) + 5
SIZE = (1 << WORD_BITS) + STATISTICS * STEPS


class Model(NamedTuple):
    bias: float
    weights: np.ndarray
    factors: np.ndarray


def _share_step(count, of):
    """Steps on a scale of halves: 0 for none, higher for a larger share."""
    with np.errstate(divide="ignore", invalid="ignore"):
        share = np.where(of > 0, count / np.maximum(of, 1), 0.0)
        step = np.where(share > 0, STEPS - 1 + np.round(np.log2(np.maximum(share, 1e-9))), 0)
    return np.clip(step, 0, STEPS - 1).astype(np.int64)


def features(column, rolling):
    """(text, feature, value) arrays of a batch, ordered by text.

    Words of lower-cased text are hashed; their counts are scaled to length 1 per text. Every
    statistic gives one feature of value 1. Empty and null texts have statistics only.
    """
    raw, offsets = utf8(column)
    sizes, rows = np.diff(offsets), len(offsets) - 1
    words = Words(column, lower=True)
    per_text = np.diff(words.of)
    text_of_word = np.repeat(np.arange(rows), per_text)
    hashes = rolling.spans(words.data, words.start, words.end) >> U64(64 - WORD_BITS)
    keys, counts = np.unique((text_of_word.astype(np.int64) << WORD_BITS) | hashes.astype(np.int64), return_counts=True)
    text = keys >> WORD_BITS
    length = np.sqrt(np.bincount(text, counts.astype(float) ** 2, rows))
    value = counts / length[text]
    steps = []
    for members in CLASSES:
        table = np.zeros(256, dtype=bool)
        table[list(members)] = True
        total = np.concatenate([[0], np.cumsum(table[raw])])
        steps.append(_share_step(total[offsets[1:]] - total[offsets[:-1]], sizes))
    total = np.concatenate([[0], np.cumsum(hashes[1:] == hashes[:-1])]) if len(hashes) else np.zeros(1, np.int64)
    first, last = words.of[:-1], np.maximum(words.of[1:] - 1, words.of[:-1])
    top = len(total) - 1
    repeats = total[np.minimum(last, top)] - total[np.minimum(first, top)]
    distinct = np.bincount(text, minlength=rows)
    word_bytes = np.bincount(text_of_word, words.end - words.start, rows)
    steps += [
        _share_step(repeats, per_text), np.where(per_text > 0, 15 * distinct // np.maximum(per_text, 1), 0),
        np.clip(np.log2(per_text + 1), 0, STEPS - 1).astype(np.int64),
        np.clip(np.log2(sizes + 1) - 4, 0, STEPS - 1).astype(np.int64),
        np.clip(word_bytes / np.maximum(per_text, 1), 0, STEPS - 1).astype(np.int64)]
    ids = np.stack([(1 << WORD_BITS) + k * STEPS + s for k, s in enumerate(steps)], axis=1).ravel()
    text = np.concatenate([text, np.repeat(np.arange(rows), len(steps))])
    feature = np.concatenate([keys & ((1 << WORD_BITS) - 1), ids])
    value = np.concatenate([value, np.ones(len(ids))])
    order = np.argsort(text, kind="stable")
    return text[order], feature[order], value[order]


def _forward(model, text, feature, value, rows):
    """Raw scores and the factor sums, from (text, feature, value) ordered by text."""
    at = np.searchsorted(text, np.arange(rows))
    part = model.factors[feature] * value[:, None]
    sums = np.add.reduceat(part, at, axis=0)
    squares = np.add.reduceat(part * part, at, axis=0)
    linear = np.add.reduceat(model.weights[feature] * value, at)
    return model.bias + linear + 0.5 * (sums * sums - squares).sum(axis=1), sums


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit(examples, factors=4, epochs=4, batch=64, rate=0.1, decay=1e-5, seed=7):
    """Train on ``(features, values, label)`` by minibatches with per-parameter rates.

    Without examples of both labels the model is the constant share of label 1 (0.5 without any).
    """
    labels = np.array([e[2] for e in examples], float)
    share = (labels.sum() + 0.5) / (len(labels) + 1)
    random = np.random.default_rng(seed)
    bias, seen = float(np.log(share / (1 - share))), 1e-6
    weights, factor = np.zeros(SIZE), random.normal(0, 0.05, (SIZE, factors))
    if len(set(labels.tolist())) < 2:
        return Model(bias, weights, np.zeros((SIZE, factors)))
    w_seen, f_seen = np.full(SIZE, 1e-6), np.full((SIZE, factors), 1e-6)
    for _ in range(epochs):
        order = random.permutation(len(examples))
        for k in range(0, len(order), batch):
            part = [examples[i] for i in order[k:k + batch]]
            feature = np.concatenate([p[0] for p in part])
            value = np.concatenate([p[1] for p in part])
            text = np.repeat(np.arange(len(part)), [len(p[0]) for p in part])
            score, sums = _forward(Model(bias, weights, factor), text, feature, value, len(part))
            error = (_sigmoid(score) - labels[order[k:k + batch]]) / len(part)
            used, slot = np.unique(feature, return_inverse=True)
            pull = error[text] * value
            g_weight = np.bincount(slot, pull, len(used)) + decay * weights[used]
            full = pull[:, None] * (sums[text] - factor[feature] * value[:, None])
            g_factor = np.stack([np.bincount(slot, full[:, f], len(used)) for f in range(factors)], axis=1)
            g_factor += decay * factor[used]
            w_seen[used] += g_weight ** 2
            f_seen[used] += g_factor ** 2
            seen += error.sum() ** 2
            weights[used] -= rate * g_weight / np.sqrt(w_seen[used])
            factor[used] -= rate * g_factor / np.sqrt(f_seen[used])
            bias -= rate * error.sum() / np.sqrt(seen)
    return Model(bias, weights, factor)


def held_out(doc_id="doc_id"):
    """True for the fifth of documents whose labels are never learned from; null counts as ''."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % 5 == 0


def _rows(docs):
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def train(docs, labels, max_rows=6000, **options):
    """Fit on at most ``max_rows`` labelled documents, chosen by a hash of their doc_id.

    Repeated labels of a document count as their highest; null labels and held-out rows are left
    out. Features of the chosen rows (a bounded number) come to the driver, where the model is
    fitted; the chosen ids are broadcast, which ``max_rows`` bounds to 16 bytes a row.
    """
    chosen = (labels.where("quality is not null and doc_id is not null").where(~held_out())
              .groupBy(F.col("doc_id").cast("long").alias("_id")).agg(F.max(F.col("quality").cast("int")).alias("label"))
              .orderBy(F.xxhash64("_id"), "_id").limit(max_rows))

    def run(batches):
        rolling = Rolling(0x9E3779B97F4A7C15)
        for piece in pieces(batches):
            text, feature, value = features(piece.column("text"), rolling)
            cuts = np.searchsorted(text, np.arange(piece.num_rows + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([
                piece.column("doc_id"), piece.column("label"),
                pa.ListArray.from_arrays(pa.array(cuts), pa.array(feature.astype(np.int32))),
                pa.ListArray.from_arrays(pa.array(cuts), pa.array(value.astype(np.float32)))],
                ["doc_id", "label", "feature", "value"])

    held = _rows(docs).join(F.broadcast(chosen), F.col("doc_id") == F.col("_id")).select("doc_id", "text", "label")
    table = held.mapInArrow(run, "doc_id long, label int, feature array<int>, value array<float>").toArrow()
    table = table.sort_by("doc_id")
    examples = [(f.values.to_numpy(), v.values.to_numpy().astype(float), y) for f, v, y in zip(
        table.column("feature"), table.column("value"), table.column("label").to_pylist())]
    return fit(examples, **options)


def score(docs, model, cut=0.3):
    """One row per input row: doc_id, held_out, score (0 to 1), predicted (1 from ``cut`` on).

    Only the text is looked at. A null text is scored as an empty one. The model's size is fixed
    by ``SIZE`` and broadcast once.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        rolling, known = Rolling(0x9E3779B97F4A7C15), shared.value
        for piece in pieces(batches):
            text, feature, value = features(piece.column("text"), rolling)
            raw, _ = _forward(known, text, feature, value, piece.num_rows)
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array(_sigmoid(raw))], ["doc_id", "score"])

    scored = _rows(docs).mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", held_out().alias("held_out"), "score",
                         F.when(F.col("score") >= cut, 1).otherwise(0).alias("predicted"))
