"""Queries of the training-data operators: opN_<name>, each over its whole table, and pipeline."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cuefold.llm import chat_format, conversation_repair, cover_tree, exact_dedup, mixing, packing, periodic_runs, simhash, token_count, token_file, topk, toxicity, url_filter
from cuefold.llm.storage import table


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.count_tokens(table(spark, sf_dir, "documents"))


def op3_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one more whose texts hold control strings."""
    own = spark.createDataFrame(
        [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")], "conv_id long, turn long, role string, text string"
    )
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(own)
    return chat_format.read_back(chat_format.format_chats(rows))


def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_file.token_digests(table(spark, sf_dir, "documents"))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_dedup(table(spark, sf_dir, "documents"))


def op9_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op11_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cover_tree.near_dedup(table(spark, sf_dir, "embeddings"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations damaged by a checksum of their rows, repaired."""
    rows = conversation_repair.damaged(table(spark, sf_dir, "conversations"))
    return conversation_repair.repair_digests(conversation_repair.repair(rows, copy_col="copy", present_col="present"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents, a tenth of them with a repeated tail, and their runs."""
    return periodic_runs.run_digests(periodic_runs.collapse_runs(periodic_runs.planted(table(spark, sf_dir, "documents"))))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_url_filters": op1_url_filters,
    "op2_token_counts": op2_token_counts,
    "op3_chat_formatting": op3_chat_formatting,
    "op4_source_mixing": op4_source_mixing,
    "op5_best_fit_packing": op5_best_fit_packing,
    "op6_token_files": op6_token_files,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_simhash_near_dedup": op8_simhash_near_dedup,
    "op9_exact_top_k": op9_exact_top_k,
    "op10_toxicity": op10_toxicity,
    "op11_embedding_near_dedup": op11_embedding_near_dedup,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_periodic_runs": op13_periodic_runs,
}

ORACLES: dict[str, str] = {
    "op1_url_filters": url_filter.oracle(),
    "op3_chat_formatting": chat_format.oracle(),
    "op7_exact_dedup": exact_dedup.oracle(),
    "op9_exact_top_k": topk.oracle(),
    "op11_embedding_near_dedup": cover_tree.oracle(),
    "op12_conversation_repair": conversation_repair.oracle(),
    "op13_periodic_runs": periodic_runs.oracle(),
}
