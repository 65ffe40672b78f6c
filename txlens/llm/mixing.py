"""Mixing sources to target weights: raking, then sampling by calibrated probabilities.

Token counts are summed by cell (source, language, topic). Iterative proportional fitting
scales the cells until their shares agree with the target shares of every dimension. Documents
are then drawn with probabilities in proportion to their cell's weight per token.
"""

from pyspark.sql import functions as F

from txlens.llm.textkit import WORD_GAP
from txlens.staging import stage

DIMENSIONS = ("source", "lang", "topic")
#: Stands for a missing value of a dimension.
NONE = "(none)"


def form_topic(text, words):
    """A topic by form: table, marked (symbols or calls), note, article or long text."""
    marks = F.length(text) - F.length(F.translate(text, "#*$%&!", ""))
    bars = F.length(text) - F.length(F.translate(text, "|", ""))
    return (F.when(10 * bars > words, "table").when(2 * marks > words, "marked")
            .when(words < 100, "note").when(words < 1000, "article").otherwise("long"))


def n_tokens(text="text"):
    """Words of the text; 0 for null."""
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    return F.size(F.filter(F.split(body, WORD_GAP), lambda w: w != "")).cast("long")


def tempered_targets(cells, power=0.7):
    """Target shares of every value of every dimension: token shares raised to ``power``."""
    out = {}
    for name in DIMENSIONS:
        sums = cells.groupBy(name).agg(F.sum("tokens").alias("t"))
        raised = sums.withColumn("raised", F.pow(F.col("t").cast("double"), F.lit(power)))
        total = raised.agg(F.sum("raised")).first()[0] or 1.0
        out[name] = raised.select(name, (F.col("raised") / total).alias("share"))
    return out


def count_cells(docs, topic=None):
    """Documents and tokens of every cell; nulls of a dimension count as ``NONE``."""
    return stage(_celled(docs, topic).groupBy(*DIMENSIONS).agg(
        F.sum("n_tokens").alias("tokens"), F.count("*").alias("docs")))


def _celled(docs, topic):
    """Rows with their cell and tokens; ``topic`` is a column of ``docs``, by form if None."""
    rows = docs.select(
        F.struct("*").alias("row"),
        *[F.coalesce(F.col(c).cast("string"), F.lit(NONE)).alias(c) for c in ("source", "lang")],
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("body"), n_tokens().alias("n_tokens"),
        F.col("doc_id").alias("doc_id"), (F.lit(None) if topic is None else topic).cast("string").alias("topic"))
    if topic is None:
        rows = rows.withColumn("topic", form_topic(F.col("body"), F.col("n_tokens")))
    return rows.drop("body").withColumn("topic", F.coalesce("topic", F.lit(NONE)))


def rake(cells, targets, rounds=10, tolerance=0.0):
    """``cells`` with ``weight``: the share each token of the cell should have.

    ``targets[dimension]`` has the value and its share; a value without a target gets none. Stops
    after ``rounds``, or when no weight moves by more than ``tolerance``. Cells without tokens
    follow the others of their values. A round is one written table: sums by value are aggregated in
    parts before they move, and joined back.
    """
    cells = cells.select(*DIMENSIONS, "tokens", "docs", F.lit(1.0).alias("weight"))
    for _ in range(rounds):
        fitted = cells.withColumn("before", F.col("weight"))
        for name in DIMENSIONS:
            mass = fitted.groupBy(name).agg(F.sum(F.col("tokens") * F.col("weight")).alias("mass"))
            scale = targets[name].join(mass, name).select(
                name, F.when(F.col("mass") > 0, F.col("share") / F.col("mass")).otherwise(0.0).alias("scale"))
            fitted = fitted.join(scale, name, "left").withColumn(
                "weight", F.col("weight") * F.coalesce("scale", F.lit(0.0))).drop("scale")
        fitted = stage(fitted)
        cells = fitted.drop("before")
        if tolerance:
            moved = fitted.where("before > 0").agg(F.max(F.abs(F.col("weight") / F.col("before") - 1))).first()[0]
            if (moved or 0.0) <= tolerance:
                break
    return cells


def chance(column, seed):
    """A number in [0, 1) from a hash of the column, the same wherever it is computed."""
    digits = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(column).cast("string"), F.lit(""))))
    return F.conv(F.substring(digits, 1, 13), 16, 10).cast("double") / float(16 ** 13)


def mix(docs, topic=None, targets=None, keep=0.5, power=0.7, rounds=10, tolerance=0.0, seed="mix"):
    """One row per document: doc_id, cell, n_tokens, probability, weight, sampled, row.

    Needs doc_id, text, source and lang; ``topic`` is a column expression (by form if None); ``row``
    is the input row as a struct. The expected tokens are ``keep`` of all; a probability that would
    pass 1 is cut to 1 and ``weight`` (else 1) makes up for it, so that weighted tokens meet the
    targets. A document is drawn or not by a hash of its doc_id: runs agree, and repeated rows
    go together. The table of cells is written, so Spark knows its size when it chooses the join;
    it has one row per cell. Texts without words belong to a cell too, and weigh nothing.
    """
    cells = count_cells(docs, topic)
    targets = {k: stage(v) for k, v in (targets or tempered_targets(cells, power)).items()}
    raked = rake(cells, targets, rounds, tolerance)
    total = raked.agg(F.sum("tokens")).first()[0] or 0
    wanted = F.round(F.col("cell_weight") * float(keep * total), 9)
    rows = _celled(docs, topic).join(
        raked.select(*DIMENSIONS, F.col("weight").alias("cell_weight")), list(DIMENSIONS), "left")
    rows = rows.withColumn("wanted", F.coalesce(wanted, F.lit(0.0)))
    probability = F.least(F.col("wanted"), F.lit(1.0))
    return rows.select(
        "doc_id", *DIMENSIONS, "n_tokens", probability.alias("probability"),
        F.greatest(F.col("wanted"), F.lit(1.0)).alias("weight"),
        (chance("doc_id", seed) < probability).alias("sampled"), "row")
