"""The registered queries: each operator over the whole of its table, with its production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.llm import conversation_trie, importance, jaccard_join, language_id, lm_scoring, mixing, packing, pii, quality_divergence, sharding, topk_search, url_filter, warc
from pairloom.llm.common import id_remainder, stored, table
from pairloom.scratch import new_path

NEIGHBORS = 10


def op1_incremental_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), topk_search.sign_code(F.col("embedding")).alias("code")
    )
    found = topk_search.exact_topk(rows, rows.where("id % 20 = 0"), NEIGHBORS)
    return found.withColumnsRenamed({"id": "vec_id", "neighbor": "neighbor_id"})


def op2_distribution_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return quality_divergence.judged(docs).drop("text", "lang")


def op3_zstd_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_path(spark, "archives")
    warc.write_archives(table(spark, sf_dir, "pages").select("page_id", "url", "html"), folder)
    return warc.read_archives(spark, folder).drop("url")


def op4_min_cost_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select(
        "doc_id", F.array("source").alias("sources"), mixing.word_count(F.coalesce("text", F.lit(""))).alias("size"),
        mixing.place_in_order(mixing.SEED, F.col("doc_id"), F.xxhash64("text")).alias("h"),
    )
    mixed = mixing.mixed(stored(rows, "sized"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "times")


def op5_mixture_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "text", "lang", (id_remainder(F.col("doc_id"), 4) == 2).alias("held_out")
    )
    model = language_id.learned(docs.where("NOT held_out"))
    read = language_id.predicted(docs.select("doc_id", "held_out", F.col("text").alias("said")), model, "said")
    return read.drop("said")


def op6_multi_order_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(table(spark, sf_dir, "documents"))


def op7_virtual_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    body = F.coalesce("text", F.lit(""))
    rows = table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(body) + 1).cast("bigint").alias("size"), F.crc32(body.cast("binary")).alias("text_crc32")
    )
    placed = sharding.sharded(rows, ["doc_id", "size", "text_crc32"], "size", new_path(spark, "slot-map"))
    return placed.withColumns({"law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int")})


def op8_semi_markov_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.found(docs, pii.learned(docs)).drop("text")


def op9_cost_balanced_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"))


def op10_backoff_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("key"), "text", (id_remainder(F.col("doc_id"), 5) == 1).alias("held_out")
    )
    return lm_scoring.scored(docs).withColumnRenamed("key", "doc_id")


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, target = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return importance.resampled(docs, target)


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return conversation_trie.trie(conversation_trie.rebuilt(conversation_trie.sequences(turns)))


def op13_url_regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judged(pages, url_filter.learned(url_filter.labelled(pages)), ["page_id"])


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_incremental_multi_index, op2_distribution_divergence, op3_zstd_archive, op4_min_cost_flow,
        op5_mixture_language_id, op6_multi_order_jaccard, op7_virtual_slots, op8_semi_markov_pii,
        op9_cost_balanced_packing, op10_backoff_automaton, op11_importance_resampling,
        op12_conversation_trie, op13_url_regression,
    )
}
