"""Quality rules whose cutoffs are chosen under a bound on false rejections.

Every rule rejects a text whose statistic passes a cutoff. The labelled good texts are split by
a hash of the doc_id into two holdouts. The choosing holdout proposes a few sets of cutoffs from the
fixed grids, from bold to cautious. The proving holdout tests the verdict of each set, that is, of
all its rules together: by the exact binomial bound, at most ``false_rejections`` of the good texts
of a stratum may be rejected. The error level is shared among all sets and strata (Bonferroni), so
all verdicts hold together with the stated confidence. A stratum uses its boldest proven set.
"""

import math

from pyspark.sql import functions as F

from txlens.llm.textkit import WORD_GAP, once
from txlens.staging import stage

SYMBOLS = "#*$%&|<>"
WINDOW = 8
#: Rule: (numerator, denominator, whether high values are rejected, grid of cutoffs).
RULES = {
    "symbols": ("n_symbols", "word_chars", True, (0.02, 0.04, 0.06, 0.08, 0.1, 0.15, 0.2, 0.3, 0.5)),
    "marks": ("n_marks", "n_words", True, (0.1, 0.2, 0.3, 0.5, 0.8, 1.0, 1.5, 2.0)),
    "long_words": ("word_chars", "n_words", True, (8, 9, 10, 12, 15, 20, 30)),
    "short_words": ("word_chars", "n_words", False, (1.5, 2, 2.5, 3, 3.5)),
    "repeated_lines": ("n_dup_lines", "n_lines", True, (0.1, 0.2, 0.3, 0.5, 0.7)),
    "repeated_words": ("n_repeat_words", "n_words", True, (0.05, 0.1, 0.15, 0.2, 0.25)),
}

#: The sets of cutoffs aim at these shares of the false rejections allowed, from bold to cautious.
SHARES = (1.0, 0.5, 0.25, 0.0)


def text_statistics(df, text="text"):
    """Add the statistics of the text column; a null text counts as empty.

    n_words, word_chars (code points in words), n_symbols, n_marks (``!`` and ``?``), n_lines (lines
    with a word), n_dup_lines (equal to an earlier one), n_repeat_words (words in 8-word windows
    that occur twice or more in the text), base_failed. Work and memory follow the text's length.
    """
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    df = df.withColumn("_body", body)
    df = df.withColumn("_words", F.filter(F.split("_body", WORD_GAP), lambda w: w != ""))
    df = df.withColumn("_lines", F.filter(F.split("_body", "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]")))
    df = df.withColumns({
        "n_words": F.size("_words").cast("long"),
        "word_chars": F.length(F.array_join("_words", "")).cast("long"),
        "n_symbols": (F.length("_body") - F.length(F.translate("_body", SYMBOLS, ""))).cast("long"),
        "n_marks": (F.length("_body") - F.length(F.translate("_body", "!?", ""))).cast("long"),
        "n_lines": F.size("_lines").cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "_windows": once(F.col("_words"), lambda words: F.when(F.size(words) >= WINDOW, F.transform(
            F.sequence(F.lit(1), F.size(words) - (WINDOW - 1)),
            lambda i: F.xxhash64(F.slice(words, i, WINDOW)))).otherwise(F.array().cast("array<bigint>"))),
    }).drop("_body", "_words", "_lines")
    # only texts with a repeated window go through the sort
    sorted_windows = F.when(
        F.size(F.array_distinct("_windows")) < F.size("_windows"),
        F.array_sort(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))

    def twice(order):
        marked = F.transform(order, lambda x, k: F.when(
            (x["h"] == F.get(order, k - 1)["h"]) | (x["h"] == F.get(order, k + 1)["h"]), x["i"]))
        return F.array_sort(F.filter(marked, lambda i: i.isNotNull()))

    df = df.withColumn("_twice", once(sorted_windows, twice))
    covered = F.aggregate(
        "_twice", F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("n")),
        lambda s, i: F.struct(i.alias("last"), (s["n"] + F.least(i - s["last"], F.lit(WINDOW))).alias("n")),
        lambda s: s["n"])
    df = df.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long"))
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return df.withColumn("base_failed", failed).drop("_windows", "_twice")


def _statistic(rule):
    above, below, _, _ = RULES[rule]
    return F.col(above) / F.when(F.col(below) > 0, F.col(below))


def _passes(rule, cutoff):
    value = _statistic(rule)
    return value > cutoff if RULES[rule][2] else value < cutoff


def binomial_tail(k, n, p):
    """P(X <= k) for X binomial(n, p); 1 where k is above the mean, which fails any test."""
    odds = math.log(p / (1 - p))
    start = n * math.log1p(-p)

    def step(s, i):
        term = s["term"] + F.log((n - i + 1) / i) + odds
        high, low = F.greatest(s["total"], term), F.least(s["total"], term)
        return F.struct(term.alias("term"), (high + F.log1p(F.exp(low - high))).alias("total"))

    below = F.when(k <= n * p, F.sequence(F.lit(0), k))
    terms = F.slice(below, 2, F.greatest(k, F.lit(1)).cast("int"))
    total = F.aggregate(terms, F.struct(start.alias("term"), start.alias("total")), step,
                        lambda s: F.exp(s["total"]))
    return F.coalesce(total, F.lit(1.0))


def _rejected(cutoffs):
    """Whether any rule rejects, given the column with its cutoff for each rule (null: unused)."""
    verdict = F.lit(False)
    for rule in RULES:
        verdict = verdict | F.coalesce(_passes(rule, cutoffs[rule]), F.lit(False))
    return verdict


def _half(doc_id):
    """0: the choosing holdout, 1: the proving one."""
    return F.conv(F.substring(F.md5(doc_id.cast("string")), 1, 8), 16, 10).cast("long") % 2


def choose_cutoffs(statistics, labels, stratum="lang", false_rejections=0.01, error=0.05):
    """One row per stratum of labelled good texts: stratum and ``cut_<rule>`` (null: rule unused).

    ``labels`` has doc_id and quality; conflicting or repeated labels of a document count as one
    good label if any is 1. Texts that fail the base rules are left out, as no learnt rule
    decides on them. A null stratum is a stratum of its own. In the set of share s a rule takes its
    boldest cutoff that rejects at most s * ``false_rejections`` / rules of the choosing holdout.
    """
    good = labels.where("quality = 1").select(F.col("doc_id").cast("long").alias("_good")).distinct()
    held = stage(statistics.join(good, F.col("doc_id") == F.col("_good"), "left_semi").where("not base_failed")
                 .withColumn("_half", _half(F.col("doc_id"))).withColumn("_stratum", F.col(stratum)))
    counts = {f"{rule}_{i}": F.count_if(F.coalesce(_passes(rule, c), F.lit(False)))
              for rule, (_, _, _, grid) in RULES.items() for i, c in enumerate(grid)}
    counted = held.where("_half = 0").groupBy(F.col("_stratum").alias("stratum")).agg(
        F.count("*").alias("n"), *[v.alias(k) for k, v in counts.items()])
    proposed = []
    for k, share in enumerate(SHARES):
        allowed = F.col("n") * (share * false_rejections / len(RULES))
        for rule, (_, _, high, grid) in RULES.items():
            safe = F.array(*[F.when(F.col(f"{rule}_{i}") <= allowed, F.lit(float(c))) for i, c in enumerate(grid)])
            proposed.append((F.array_min if high else F.array_max)(safe).alias(f"set{k}_{rule}"))
    sets = stage(counted.select("stratum", *proposed))
    failed = [F.count_if(_rejected({rule: F.col(f"set{k}_{rule}") for rule in RULES})).alias(f"failed{k}")
              for k in range(len(SHARES))]
    proving = (held.where("_half = 1").join(sets, F.col("_stratum").eqNullSafe(F.col("stratum")))
               .groupBy("stratum").agg(F.count("*").alias("n"), *failed))
    level = error / max(sets.count() * len(SHARES), 1)
    proven = F.coalesce(*[F.when(binomial_tail(F.col(f"failed{k}"), F.col("n"), false_rejections) <= level, F.lit(k))
                          for k in range(len(SHARES))])
    best = proving.select(F.col("stratum").alias("_proven"), proven.alias("_best"))
    joined = sets.join(best, F.col("stratum").eqNullSafe(F.col("_proven")), "left")
    return stage(joined.select("stratum", *[
        F.get(F.array(*[F.col(f"set{k}_{rule}") for k in range(len(SHARES))]), F.col("_best")).alias(f"cut_{rule}")
        for rule in RULES]))


def judge(docs, labels, stratum="lang", **options):
    """One row per input row: doc_id, the statistics, base_failed and kept.

    Needs doc_id, text and the stratum column. ``kept`` is false for base failures and for texts
    that pass a cutoff of their stratum's proven set; a stratum without enough labels has no proven
    set, so only the base rules act there. The table of cutoffs has one row per stratum; it is
    written, so that Spark sees its size before it decides how to join it.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(stratum).cast("string").alias(stratum),
                       F.col("text").cast("string").alias("text"))
    statistics = stage(text_statistics(rows).drop("text"))
    cutoffs = choose_cutoffs(statistics, labels, stratum, **options)
    judged = statistics.join(cutoffs, F.col(stratum).eqNullSafe(F.col("stratum")), "left")
    rejected = _rejected({rule: F.col(f"cut_{rule}") for rule in RULES})
    return judged.withColumn("kept", ~F.col("base_failed") & ~rejected).drop(
        stratum, "stratum", *[f"cut_{rule}" for rule in RULES])


def keep_good(docs, labels, **options):
    """The rows of ``docs`` whose doc_id is kept, all columns as they were."""
    kept = judge(docs, labels, **options).where("kept").select(F.col("doc_id").alias("_kept"))
    return docs.join(kept, docs["doc_id"].cast("long").eqNullSafe(kept["_kept"]), "left_semi")
