"""The queries of this subpackage, each over its whole table, and their SQL twins."""

import public_tokenizers
from pyspark.sql import functions as F

from txlens.llm import (decontam, factormachine, licenses, linechunks, maxsketch, mixing, packing, quality, secretscan,
                        simhash, substrings, toolcalls, turnrepair)
from txlens.llm.twins import SQL  # noqa: F401


def _table(spark, folder, name):
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_source_mixing(spark, folder):
    """Sampling probability and decision of every document, raked in 8 rounds."""
    return mixing.mix(_table(spark, folder, "documents"), keep=0.5, power=0.7, rounds=8).drop("row")


def op2_secret_scan(spark, folder):
    return secretscan.secrets(_table(spark, folder, "documents"))


def op3_benchmark_decontamination(spark, folder):
    return decontam.find_leaks(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def op4_quality_classifier(spark, folder):
    docs = _table(spark, folder, "documents")
    return factormachine.score(docs, factormachine.train(docs, _table(spark, folder, "labels")))


def op5_line_dedup(spark, folder):
    cut = linechunks.dedup_lines(_table(spark, folder, "documents"))
    return cut.select("doc_id", "n_lines", "n_removed_lines",
                      F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op6_quality_rules(spark, folder):
    judged = quality.judge(_table(spark, folder, "documents"), _table(spark, folder, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "base_failed", "kept")


def op7_tool_calls(spark, folder):
    return toolcalls.link_calls(*toolcalls.calls_of_turns(_table(spark, folder, "conversations")))


def op8_substring_dedup(spark, folder):
    return substrings.remove_repeated_windows(_table(spark, folder, "documents")).drop("kept_text")


def op9_license_scan(spark, folder):
    return licenses.licenses(_table(spark, folder, "documents"))


def op10_simhash(spark, folder):
    return simhash.near_duplicates(_table(spark, folder, "documents"))


def op11_lexical_search(spark, folder):
    return maxsketch.search(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def op12_sequence_packing(spark, folder, tokenizer=None):
    tokenizer = tokenizer or public_tokenizers.path("word_bpe_49k.json")
    return packing.pack(_table(spark, folder, "documents"), tokenizer)


def op13_conversation_repair(spark, folder):
    return turnrepair.repair_damaged(_table(spark, folder, "conversations"))


QUERIES = {f.__name__: f for f in (
    op1_source_mixing, op2_secret_scan, op3_benchmark_decontamination, op4_quality_classifier, op5_line_dedup,
    op6_quality_rules, op7_tool_calls, op8_substring_dedup, op9_license_scan, op10_simhash,
    op11_lexical_search, op12_sequence_packing, op13_conversation_repair)}
