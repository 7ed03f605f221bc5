"""Queries that apply the corpus operators to whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strikelens.llm import (
    chat, classifier, exact_dedup, filter_audit, jaccard_join, merkle, minhash, mixing, packing, quality_rules, suffix_dedup, surrogates, token_files,
)
from strikelens.llm.common import table, vocabulary
from strikelens.runtime import new_folder, stage


def op1_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join(table(spark, sf_dir, "documents"))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(packing.pieces(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json")))


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = classifier.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "evidence", "host_quality", "path_quality", "quality", "kept")


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))


def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    planned = mixing.plan(table(spark, sf_dir, "documents"))
    taken = (F.col("size") * F.col("copies")).alias("taken")
    return planned.select("doc_id", "size", "source_size", "target", taken)


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "token-files")
    token_files.write(table(spark, sf_dir, "documents"), folder, vocabulary("word_bpe_49k.json"))
    return token_files.digests(spark, folder)


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.decisions(table(spark, sf_dir, "documents"))


def op8_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return surrogates.replace(table(spark, sf_dir, "documents").select("doc_id", "text"))


#: A conversation whose texts look like the template's own marks.
AWKWARD = "\\### Assistant: </turn> ok"


def op9_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    bytes_bpe = vocabulary("byte_bpe_50k.json")
    chosen = [F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text"]
    awkward = spark.createDataFrame(
        [(-7, 0, "user", AWKWARD), (-7, 1, "assistant", AWKWARD)], "conv_id long, turn long, role string, text string"
    )
    conversations = table(spark, sf_dir, "conversations").select(*chosen).unionByName(awkward)
    written = stage(chat.format_conversations(conversations, bytes_bpe), "chat")
    return chat.digests(written, bytes_bpe)


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(table(spark, sf_dir, "documents"))
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return judged.select("doc_id", *counts, "base_failed", "kept", "posterior")


def op11_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.join(table(spark, sf_dir, "documents"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = filter_audit.answers(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return filter_audit.audit(filter_audit.set_sizes(filter_audit.postings(marked)))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verified(merkle.manifest(table(spark, sf_dir, "documents"), merkle.tampered()))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        *(op1_jaccard_join, op2_best_fit_packing, op3_quality_classifier, op4_suffix_dedup, op5_mix_sources, op6_token_files, op7_exact_dedup),
        *(op8_surrogates, op9_chat_formatting, op10_quality_rules, op11_minhash_dedup, op12_filter_audit, op13_merkle_manifest),
    )
}
