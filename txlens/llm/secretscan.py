"""Secret scans over a ledger of content-addressed blobs.

A version of a file is named by its path (here the doc_id) and its blob, the SHA-256 of its
text. The ledger lists the (blob, rule, rule version) that have been scanned, with what was
found. Only pairs that it lacks are scanned, once however many paths share the blob; findings
are joined back to all paths.
"""

from typing import NamedTuple

from pyspark.sql import functions as F

from txlens.llm.textkit import once
from txlens.staging import stage


class Rule(NamedTuple):
    kind: str
    version: int
    pattern: str
    #: The group whose length counts, and the least length of a finding.
    group: int
    least: int


BASE_RULES = (
    Rule("assign", 1, "((?i:password|passwd|secret|token|api_?key))[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 8),
    Rule("access", 1, "AKIA[A-Z0-9]+", 0, 16),
    # a run of hex digits is always matched whole, so its length may stand in the pattern
    Rule("hex", 1, "[0-9a-f]{32,}", 0, 32),
)
MORE_RULES = (
    Rule("github", 1, "gh[pousr]_[A-Za-z0-9]+", 0, 40),
    Rule("webtoken", 1, "eyJ[A-Za-z0-9_-]+\\.[A-Za-z0-9_-]+\\.[A-Za-z0-9_-]+", 0, 40),
    Rule("private_key", 1, "-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 27),
)
RULES = BASE_RULES + MORE_RULES
SPAN = "array<struct<start:int,rank:int,kind:string,end:int>>"
LEDGER = "blob binary, kind string, version int, spans " + SPAN


def _spans(rule, rank, text="text"):
    """Spans of one rule: leftmost matches that do not overlap, short ones dropped afterwards.

    Places come from the lengths of the pieces between the matches, in code points.
    """
    pattern = F.lit(rule.pattern)
    matches = F.regexp_extract_all(text, pattern, F.lit(0))
    gaps = F.split(text, rule.pattern, -1)
    long_enough = (lambda m: F.length(F.regexp_extract(m, rule.pattern, rule.group) if rule.group else m) >= rule.least)

    def walk(gaps):
        numbered = F.transform(matches, lambda m, i: F.struct(m.alias("m"), F.get(gaps, i).alias("gap")))
        nothing = F.array().cast(SPAN)

        def go(s, x):
            start = s["at"] + F.length(x["gap"])
            end = start + F.length(x["m"])
            span = F.struct(start.alias("start"), F.lit(rank).alias("rank"),
                            F.lit(rule.kind).alias("kind"), end.alias("end"))
            out = F.when(long_enough(x["m"]), F.concat(s["out"], F.array(span))).otherwise(s["out"])
            return F.struct(end.alias("at"), out.alias("out"))
        return F.aggregate(numbered, F.struct(F.lit(0).alias("at"), nothing.alias("out")), go, lambda s: s["out"])

    return F.when(F.regexp_like(text, pattern), once(gaps, walk)).otherwise(F.array().cast(SPAN))


def scan(docs, ledger=None, rules=RULES):
    """``(versions, ledger)``: the blob of every row, and the ledger with all pairs scanned.

    ``docs`` needs doc_id and text. ``versions`` has one row per row of ``docs``: doc_id, blob. A null
    text is an empty one; rows may repeat; a null doc_id is a path like any other. ``ledger`` is
    what an earlier call returned (``LEDGER``), or None. Several versions of a path are just
    several rows.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("blob", F.unhex(F.sha2("text", 256)))
    versions = stage(rows.select("doc_id", "blob"))
    pairs = versions.groupBy("blob").agg(F.min("doc_id").alias("holder")).select(
        "blob", "holder", F.explode(F.array(*[F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version"))
                                             for r in rules])).alias("r")).select("blob", "holder", "r.*")
    if ledger is not None:
        pairs = pairs.join(ledger, ["blob", "kind", "version"], "left_anti")
    todo = pairs.groupBy("blob", "holder").agg(F.collect_set("kind").alias("todo"))
    left, right = rows.alias("l"), todo.alias("r")
    unseen = left.join(right, F.col("l.doc_id").eqNullSafe(F.col("r.holder")) & (F.col("l.blob") == F.col("r.blob"))
                       ).select("l.blob", "l.text", "r.todo")
    results = F.array(*[F.when(F.array_contains("todo", r.kind), F.struct(
        F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version"), _spans(r, i).alias("spans")))
        for i, r in enumerate(rules)])
    fresh = (unseen.select("blob", F.explode(results).alias("r")).where("r is not null").select("blob", "r.*")
             .dropDuplicates(["blob", "kind", "version"]))
    fresh = stage(fresh if ledger is None else fresh.unionByName(ledger))
    return versions, fresh


def _digest(spans):
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _number(kind):
    return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")


def secrets(docs, ledger=None, rules=RULES):
    """One row per input row: doc_id, counts, base_sha256, spans (``kind:start:end``) and blob.

    Spans are code points, the end exclusive, ordered by start and then by the order of the
    rules. Texts without findings have an empty string and its digest.
    """
    versions, scanned = scan(docs, ledger, rules)
    current = F.array(*[F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version")) for r in rules])
    found = (scanned.where(F.size("spans") > 0)
             .where(F.array_contains(current, F.struct("kind", "version")))
             .select("blob", F.explode("spans").alias("span")).distinct()
             .groupBy("blob").agg(F.array_sort(F.collect_list("span")).alias("spans")))
    base = len(BASE_RULES)
    every = F.coalesce("spans", F.array().cast(SPAN))
    joined = versions.join(found, "blob", "left").withColumn("spans", every)
    return joined.select(
        "doc_id", *[_number(r.kind).alias(f"n_{r.kind}") for r in BASE_RULES],
        F.sha2(_digest(F.filter("spans", lambda s: s["rank"] < base)), 256).alias("base_sha256"),
        _digest(F.col("spans")).alias("spans"), F.lower(F.hex("blob")).alias("blob"))
