"""The corpus pipeline: five stages, each written as Parquet and read again by the next.

Quality rules reject documents, repeated line chunks leave their texts, one document of each
near-duplicate group stays, documents with parts of benchmark items go, and the rest is
sampled to target weights. All stages but the last return the columns of ``documents``.
"""

from txlens.llm import decontam, linechunks, mixing, nearcopies, quality
from txlens.staging import stage


def quality_rules(spark, docs, sf_dir):
    """Documents that pass the base rules and the risk-controlled cutoffs."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def line_dedup(spark, docs, sf_dir):
    """Texts without repeated line chunks; texts that were all repetition go."""
    cut = linechunks.dedup_lines(docs)
    return cut.where("n_removed_lines = 0 or text rlike '[^\\\\x20\\\\x09-\\\\x0D]'").select(*docs.columns)


def near_dedup(spark, docs, sf_dir):
    """The document with the smallest doc_id of each group of 5-word shingle similarity 0.8 or more."""
    return nearcopies.keep_first(docs)


def decontamination(spark, docs, sf_dir):
    """Documents without any part of a benchmark item."""
    return decontam.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def source_mixing(spark, docs, sf_dir):
    """Sampled documents with their probability, weight and topic, in place of columns with these names."""
    mixed = mixing.mix(docs, rounds=8).where("sampled")
    added = {f"mix_{name}": mixed[name] for name in ("topic", "probability", "weight")}
    return mixed.select(*[mixed["row"][name].alias(name) for name in docs.columns if name not in added],
                        *[column.alias(name) for name, column in added.items()])


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("mixing sources to target weights", source_mixing),
]

#: Near-duplicate components and banded alignment have no SQL form; the tests hold the pipeline
#: against a brute-force version.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over the documents of ``sf_dir``; returns the last stage's rows."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, step in STAGES:
        docs = stage(step(spark, docs, sf_dir))
    return docs
