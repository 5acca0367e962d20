"""Every operator as a query over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.constants import (
    BATCH_LENGTH,
    END_OF_PROMPT_ID,
    IGNORED_LABEL,
    SHARD_LENGTH,
)
from pairloom.functions import schedules, sequences, templates
from pairloom.functions.encoding import (
    BpeEncoder,
    ByteEncoder,
    build_encoding,
    decode_ids,
    encode_segments,
    join_vocabulary,
    pieces,
    vocabulary_literal,
)
from pairloom.functions.scores import softmax, token_logprob
from pairloom.operators import batches as B
from pairloom.operators import checks, sampling, steps
from pairloom.operators import scoring as R
from pairloom.operators.distribution import assign_batches, rank_split, steps_per_rank
from pairloom.operators.ordering import dense_index, seeded_shuffle, source_index, split_slice
from pairloom.plans import adapters as A
from pairloom.plans import flows
from pairloom.scratch import new_path
from pairloom.sources import log_store, logs, shards
from pairloom.sources.datasets import DPO_COLUMNS, SFT_COLUMNS, map_columns, null_rows, scan
from pairloom.sources.vocabulary import decode_ranks_file, installed_ranks_path
from pairloom.streaming import logs as live
from pairloom.streaming import prepare as stream_prepare
from pairloom.streaming import shards as stream_shards

# Parameters of the queries; the oracle uses the same.
RANKS = 4
BATCH = 4
SEED = 42
SHARD = 100
ACCUMULATION = 8
BASE_LR = 5e-4
LOG_EVERY = 2
SFT_LOG_EVERY = 16
STREAM_PARTS = 3
EVAL_EVERY = 500
SAVE_EVERY = 500
MIN_LR = 6e-5
MAX_LR = 6e-4
TOP_K = 50
PAIR_KEY = ["conv_id", "turn"]
DOCUMENT_SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"

BYTES = ByteEncoder()


def joined(ids: Column) -> Column:
    """A list of numbers as text, so that any engine prints it alike."""
    return F.array_join(ids.cast("array<string>"), " ")


def rounded(value: Column) -> Column:
    return F.round(value, 8)


# ---- sources -------------------------------------------------------------

def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents under the canonical names of a shard source."""
    return map_columns(_texts(spark, sf_dir), {"query": "source", "response": "text"}, ["doc_id"])


def _texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.dealt(A.table(spark, sf_dir, "documents"))


def indexed_documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return source_index(spark, f"{sf_dir}/documents.parquet", ["doc_id", *columns])


def _indexed_texts(spark: SparkSession, sf_dir: str, names: dict[str, str]) -> DataFrame:
    indexed = indexed_documents(spark, sf_dir, *names).withColumnsRenamed(names)
    return A.dealt(indexed, "idx")


def sft_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return map_columns(A.sft_pairs(spark, sf_dir), SFT_COLUMNS, PAIR_KEY)


def dpo_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return map_columns(A.preference_pairs(spark, sf_dir), DPO_COLUMNS, PAIR_KEY)


def dpo_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ("chosen_ids", "labels_chosen", "rejected_ids", "labels_rejected")
    return B.dpo_samples(dpo_rows(spark, sf_dir), BYTES).select(
        *PAIR_KEY, *[joined(F.col(c)).alias(c) for c in columns]
    )


def scan_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(
        spark, f"{sf_dir}/documents.parquet", split="en", split_column="lang"
    ).select("doc_id", "lang", "source", "text")


def split_slice_half(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_slice(indexed_documents(spark, sf_dir, "text"), 0, 50).select(
        "doc_id", "idx", "text"
    )


def column_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    return map_columns(
        A.table(spark, sf_dir, "documents"), {"prompt": "source", "answer": "text"}, ["doc_id"]
    )


def vocab_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.word_vocabulary(spark, sf_dir).select(
        F.hex("token").alias("token_hex"), "token_id", F.col("is_special").cast("int").alias("is_special")
    )


def shard_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    default = shards.assign_shards(indexed_documents(spark, sf_dir)).withColumnsRenamed(
        {"shard_id": "default_shard", "row_in_shard": "default_row"}
    )
    return shards.assign_shards(default, SHARD).select(
        "doc_id", "shard_id", "row_in_shard", "default_shard", "default_row",
        shards.shard_name("documents", "train", F.col("shard_id")).alias("shard"),
    )


def _shard_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    indexed = _indexed_texts(spark, sf_dir, {"source": "query", "text": "response"})
    return flows.shard_flow(indexed, BYTES, SHARD_LENGTH, SHARD)


def shard_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two splits written one after the other, and both read back."""
    folder, rows = new_path(spark, "shards"), _shard_table(spark, sf_dir)
    shards.write_shards(rows, folder, "documents")
    path = shards.write_shards(rows.where("shard_id % 2 = 0"), folder, "documents", "validation")
    return shards.read_shards(spark, path).select(
        "split", "shard", "shard_id", "row_in_shard", joined(F.col("tokens")).alias("tokens"), "length"
    )


# ---- templates, ids, labels ----------------------------------------------

def template_sft(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sft_rows(spark, sf_dir).select(
        *PAIR_KEY, templates.sft_text(F.col("prompt"), F.col("answer")).alias("text")
    )


def template_dpo(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dpo_rows(spark, sf_dir).select(
        *PAIR_KEY,
        *[templates.dpo_text(F.col("prompt"), F.col(s)).alias(s) for s in ("chosen", "rejected")],
    )


def template_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir).select(
        "doc_id", templates.shard_text(F.col("query"), F.col("response")).alias("text")
    )


def encode_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = _texts(spark, sf_dir).select("doc_id", BYTES(F.col("text")).alias("ids"))
    return encoded.select("doc_id", F.size("ids").alias("n_ids"), joined(F.col("ids")).alias("ids"))


def _vocabulary_ids(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    vocabulary = A.word_vocabulary(spark, sf_dir)
    encoder = A.word_encoder(vocabulary)
    return vocabulary, _texts(spark, sf_dir).select("doc_id", encoder(F.col("text")).alias("ids"))


def encode_vocab(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = _vocabulary_ids(spark, sf_dir)[1]
    return encoded.select("doc_id", F.size("ids").alias("n_ids"), joined(F.col("ids")).alias("ids"))


def vocab_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of single pieces joined with the vocabulary, counted per document and id."""
    tokens = _texts(spark, sf_dir).select("doc_id", F.explode(pieces(F.col("text"))).alias("piece"))
    known = A.lookup_pieces(A.word_vocabulary(spark, sf_dir))
    return join_vocabulary(tokens, known).groupBy("doc_id", "token_id").agg(F.count("*").alias("n"))


def bpe_encoder(spark: SparkSession) -> BpeEncoder:
    """The 50,256 byte-pair ranks; without their file there is no encoder."""
    path = installed_ranks_path()
    if path is None:
        raise FileNotFoundError("the byte-pair ranks are not installed")
    return BpeEncoder(spark, build_encoding(decode_ranks_file(path)))


def encode_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _texts(spark, sf_dir).select(
        "doc_id", bpe_encoder(spark)(F.col("text")).alias("ids")
    )


def decode_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-pair ids and back: the text comes out as it went in."""
    encoder = bpe_encoder(spark)
    return encode_bpe(spark, sf_dir).select(
        "doc_id", decode_ids(F.col("ids"), encoder.vocabulary()).alias("text")
    )


def decode_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary, encoded = _vocabulary_ids(spark, sf_dir)
    return encoded.select(
        "doc_id", decode_ids(F.col("ids"), vocabulary_literal(vocabulary)).alias("text")
    )


def label_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.sft_samples(sft_rows(spark, sf_dir), BYTES).select(
        *PAIR_KEY, joined(F.col("input_ids")).alias("input_ids"),
        joined(F.col("label_ids")).alias("label_ids"),
    )


def attention_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.size("input_ids")
    return B.sft_samples(sft_rows(spark, sf_dir), BYTES).select(
        *PAIR_KEY, n.alias("n_ids"),
        joined(F.col("attention_mask")).alias("mask"),
        joined(sequences.attention_mask(n, BATCH_LENGTH)).alias("padded_mask"),
    )


def pad_truncate(spark: SparkSession, sf_dir: str) -> DataFrame:
    sample = B.sft_samples(
        map_columns(_texts(spark, sf_dir), {"prompt": "source", "answer": "text"}, ["doc_id"]), BYTES
    )
    return sample.select(
        "doc_id",
        joined(sequences.pad_or_truncate(F.col("input_ids"), BATCH_LENGTH)).alias("x"),
        joined(sequences.attention_mask(F.size("input_ids"), BATCH_LENGTH)).alias("mask"),
        joined(
            sequences.pad_or_truncate(F.col("label_ids"), BATCH_LENGTH, IGNORED_LABEL)
        ).alias("y"),
    )


def _shard_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    segments = templates.shard_segments(F.col("query"), F.col("response"))
    return documents(spark, sf_dir).select(
        "doc_id", encode_segments(segments, BYTES).alias("ids")
    )


def pad_eot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shard_ids(spark, sf_dir).select(
        "doc_id",
        joined(
            sequences.pad_or_cut_with_end(F.col("ids"), SHARD_LENGTH, END_OF_PROMPT_ID)
        ).alias("tokens"),
    )


def check_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of the word vocabulary against the 16-bit limit and against the byte limit."""
    encoded = _vocabulary_ids(spark, sf_dir)[1]
    wide = sequences.out_of_range(F.col("ids"), 256)
    return checks.range_report(
        encoded.withColumn("n_beyond_bytes", wide), "ids", "doc_id", "n_beyond_bytes"
    )


def check_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that padding has to change, and that none is left after it."""
    rows = _shard_ids(spark, sf_dir).withColumn(
        "tokens", sequences.pad_or_cut_with_end(F.col("ids"), SHARD_LENGTH, END_OF_PROMPT_ID)
    )
    found = [
        checks.length_violations(rows, column, SHARD_LENGTH).select(
            "doc_id", F.lit(column).alias("checked"), F.size(column).alias("n")
        )
        for column in ("ids", "tokens")
    ]
    return found[0].unionByName(found[1])


def prompt_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.prompt_only(sft_rows(spark, sf_dir), BYTES, copies=4).select(
        *PAIR_KEY, "copy", joined(F.col("input_ids")).alias("input_ids")
    )


# ---- order, ranks, batches -----------------------------------------------

def dense_index_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = A.table(spark, sf_dir, "conversations").select("conv_id", "turn", "role")
    return dense_index(turns, PAIR_KEY)


def source_index_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return indexed_documents(spark, sf_dir, "lang")


def rank_split_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank_split(dense_index_query(spark, sf_dir), RANKS).select(
        *PAIR_KEY, "idx", "rank", "pos"
    )


def seeded_shuffle_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = A.table(spark, sf_dir, "conversations").select("conv_id", "turn")
    return seeded_shuffle(turns, PAIR_KEY, SEED)


def batch_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    shuffled = seeded_shuffle_query(spark, sf_dir)
    return assign_batches(rank_split(shuffled, RANKS), BATCH).select(
        *PAIR_KEY, "rank", "batch_id", "row_in_batch", "rank_steps"
    )


def sft_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dense_index(sft_rows(spark, sf_dir), PAIR_KEY)


def dpo_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dense_index(dpo_rows(spark, sf_dir), PAIR_KEY)


def batch_len_longest(spark: SparkSession, sf_dir: str) -> DataFrame:
    dealt = flows.into_batches(sft_index(spark, sf_dir), RANKS, BATCH, BYTES)
    return B.longest_length(B.encode_sft(dealt, BYTES), BATCH_LENGTH).select(
        "rank", "batch_id", "row_in_batch", "batch_len"
    )


def batch_len_shortest(spark: SparkSession, sf_dir: str) -> DataFrame:
    dealt = flows.into_batches(dpo_index(spark, sf_dir), RANKS, BATCH, BYTES)
    shortest = B.pair_length(B.encode_dpo(dealt, BYTES), BATCH_LENGTH)
    both = B.pair_length(
        shortest.withColumnRenamed("batch_len", "shortest_len"), BATCH_LENGTH, "longest"
    )
    return both.select(
        "rank", "batch_id", "row_in_batch", "shortest_len",
        F.col("batch_len").alias("longest_len"),
    )


def _rendered(rows: DataFrame, *key: str) -> DataFrame:
    return rows.select(*key, *[joined(F.col(c)).alias(c) for c in ("x", "mask", "y")])


def sft_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = flows.sft_flow(sft_index(spark, sf_dir), BYTES, RANKS, BATCH)
    return _rendered(rows, "rank", "batch_id", "row_in_batch")


def _document_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _indexed_texts(spark, sf_dir, {"source": "prompt", "text": "answer"})


def sft_batches_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source order needs no sort: the only shuffle gathers the batches."""
    rows = flows.sft_flow(_document_prompts(spark, sf_dir), BYTES, RANKS, BATCH)
    return _rendered(rows, "rank", "batch_id", "row_in_batch")


def sft_batches_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flows.sft_flow(_document_prompts(spark, sf_dir), bpe_encoder(spark), RANKS, BATCH)


def dpo_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = flows.dpo_flow(dpo_index(spark, sf_dir), BYTES, RANKS, BATCH)
    return _rendered(rows, "rank", "batch_id", "row_in_batch", "side")


def dpo_batches_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flows.dpo_flow(dpo_index(spark, sf_dir), bpe_encoder(spark), RANKS, BATCH).drop("rank_steps")


def shard_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Offline shards with byte-pair ids: a scan and its projections, no shuffle."""
    indexed = _indexed_texts(spark, sf_dir, {"source": "query", "text": "response"})
    return flows.shard_flow(indexed, bpe_encoder(spark), SHARD_LENGTH, SHARD).select(
        "shard_id", "row_in_shard", "tokens", "length"
    )


def dpo_interleave(spark: SparkSession, sf_dir: str) -> DataFrame:
    dealt = flows.into_batches(dpo_index(spark, sf_dir), RANKS, BATCH, BYTES)
    prefix, reply = F.col("prefix_ids"), F.col("reply_ids")
    return B.interleave(B.encode_dpo(dealt, BYTES)).select(
        "rank", "batch_id", "row_in_batch", "side",
        joined(F.concat(prefix, reply)).alias("ids"),
        joined(sequences.mask_labels(prefix, reply)).alias("labels"),
    )


# ---- scores --------------------------------------------------------------

def _logits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.dealt(A.table(spark, sf_dir, "embeddings"))


def _scored_sft(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.with_scores(flows.sft_flow(sft_index(spark, sf_dir), BYTES, RANKS, BATCH))


def _scored_dpo(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.with_scores(flows.dpo_flow(dpo_index(spark, sf_dir), BYTES, RANKS, BATCH))


def _position_scores(samples: DataFrame) -> DataFrame:
    """A score per position, made from the id that stands there."""
    return samples.withColumn(
        "scores", F.transform("input_ids", lambda x, i: A.policy_logp(x, i))
    )


def shift_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _position_scores(B.sft_samples(sft_rows(spark, sf_dir), BYTES))
    pairs = sequences.shifted_pairs(F.col("scores"), F.col("label_ids"))
    return rows.select(*PAIR_KEY, F.posexplode(pairs).alias("pos", "pair")).select(
        *PAIR_KEY, "pos", "pair.score", "pair.label"
    )


def shift_align_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _position_scores(B.sft_samples(sft_rows(spark, sf_dir), BYTES))
    scores = rows.select(*PAIR_KEY, F.posexplode("scores").alias("pos", "score"))
    labels = rows.select(*PAIR_KEY, F.posexplode("label_ids").alias("pos", "label"))
    return R.align_with_labels(scores, labels, PAIR_KEY)


def token_logprob_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _logits(spark, sf_dir).select(
        "vec_id", rounded(token_logprob(F.col("embedding"), F.col("label"))).alias("logp")
    )


def softmax_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _logits(spark, sf_dir)
    return rows.select(
        "vec_id", F.posexplode(softmax(F.col("embedding"))).alias("token_id", "p")
    ).select("vec_id", "token_id", rounded(F.col("p")).alias("p"))


def token_logprob_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from one row per vocabulary id."""
    rows = _logits(spark, sf_dir).select(
        "vec_id", "label", F.posexplode("embedding").alias("token_id", "logit")
    )
    return R.token_logprobs(rows, ["vec_id"]).select("vec_id", rounded(F.col("logp")).alias("logp"))


def _dpo_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per label: both models' scores, as score files would hold them."""
    rows = _scored_dpo(spark, sf_dir)
    following = F.slice("y", F.lit(2), F.greatest(F.size("y") - 1, F.lit(0)))
    per_label = F.arrays_zip(
        following.alias("label"),
        F.col("policy_logps").alias("policy"),
        F.col("reference_logps").alias("reference"),
    )
    return rows.select(
        "rank", "batch_id", "row_in_batch", "side", F.posexplode(per_label).alias("at", "t")
    ).select(
        "rank", "batch_id", "row_in_batch", "side", (F.col("at") + 1).alias("pos"),
        "t.label", "t.policy", "t.reference",
    )


def seq_logprob(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = _dpo_tokens(spark, sf_dir).withColumnRenamed("policy", "logp")
    return R.sequence_logprobs(tokens, ["rank", "batch_id", "row_in_batch", "side"])


def reference_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = ["rank", "batch_id", "row_in_batch", "side"]
    tokens = _dpo_tokens(spark, sf_dir)
    of_model = [
        R.sequence_logprobs(tokens.withColumnRenamed(model, "logp"), key) for model in R.MODELS
    ]
    return R.join_reference(*of_model, key)


def chosen_nll(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = _dpo_tokens(spark, sf_dir).withColumnRenamed("policy", "logp")
    chosen = tokens.where(F.col("side") == "chosen")
    return R.token_mean_loss(chosen, ["rank", "batch_id"]).select(
        "rank", "batch_id", rounded(F.col("loss")).alias("nll_loss"), "tokens"
    )


def _sft_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = _scored_sft(spark, sf_dir)
    summed = scored.withColumn("s", R.P.sequence_logprob(F.col("policy_logps"), F.col("y")))
    return summed.select("rank", "batch_id", "s.logp", "s.tokens")


def sft_batch_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.batch_loss(_sft_sequences(spark, sf_dir)).select(
        "rank", "batch_id", rounded(F.col("loss")).alias("loss"), "tokens"
    )


def validation_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    losses = R.batch_loss(_sft_sequences(spark, sf_dir))
    return R.validation_loss(losses).select(
        rounded(F.col("validation_loss")).alias("validation_loss"), "ranks"
    )


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    sequences_of = flows.sequence_scores(_scored_dpo(spark, sf_dir))
    return R.pair_scores(sequences_of, ["rank", "batch_id", "pair_in_batch"])


def _dpo_loss(spark: SparkSession, sf_dir: str, **options: object) -> DataFrame:
    return R.score_pairs(_pairs(spark, sf_dir), **options).select(
        "rank", "batch_id", "pair_in_batch", rounded(F.col("loss")).alias("loss")
    )


def dpo_rewards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.score_pairs(_pairs(spark, sf_dir)).select(
        "rank", "batch_id", "pair_in_batch",
        *[rounded(F.col(c)).alias(c) for c in ("chosen_reward", "rejected_reward")],
    )


def reward_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.score_pairs(_pairs(spark, sf_dir)).groupBy("rank", "batch_id").agg(
        rounded(R.reward_accuracy()).alias("reward_accuracy")
    )


def margins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pairs(spark, sf_dir).groupBy("rank", "batch_id").agg(
        rounded(R.margin("policy")).alias("margin"), rounded(R.margin("reference")).alias("margin_ref")
    )


REPORT_FIGURES = (
    "loss", "reward_accuracy", "chosen_reward", "rejected_reward", "logp_chosen",
    "logp_rejected", "logp_chosen_ref", "logp_rejected_ref", "margin", "margin_ref", "nll_loss",
)


def _report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flows.dpo_report_flow(_scored_dpo(spark, sf_dir), BASE_LR)


def dpo_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _report(spark, sf_dir).select(
        "rank", "batch_id", "pairs", *[rounded(F.col(c)).alias(c) for c in REPORT_FIGURES],
        F.round("lr", 9).alias("lr"),
    )


def dpo_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report over a held-out split: the last tenth of the pairs."""
    held_out = split_slice(dpo_index(spark, sf_dir), 90, 100)
    rows = A.with_scores(flows.dpo_flow(held_out, BYTES, 1, BATCH))
    sequences_of = flows.sequence_scores(rows)
    pairs = R.pair_scores(sequences_of, ["rank", "batch_id", "pair_in_batch"])
    return R.preference_report(R.score_pairs(pairs), ["rank"]).select(
        "pairs", *[rounded(F.col(c)).alias(c) for c in REPORT_FIGURES]
    )


# ---- top-k and draws -----------------------------------------------------

def topk_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _logits(spark, sf_dir)
    return sampling.topk_tokens(rows, ["vec_id"], "embedding", TOP_K).select(
        "vec_id", "place", "token_id", rounded(F.col("p")).alias("p")
    )


def topk_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from one row per id, among rounded probabilities."""
    return sampling.topk_rows(softmax_row(spark, sf_dir), ["vec_id"], k=TOP_K)


def topk_draw(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _logits(spark, sf_dir)
    return sampling.draw_token(rows, ["vec_id"], "embedding", SEED, TOP_K)


# ---- steps, schedules, logs ----------------------------------------------

def accum_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    return steps.accumulated_loss(A.step_table(spark, sf_dir), ACCUMULATION).select(
        "rank", "window_id", "step", "steps", rounded(F.col("loss")).alias("loss")
    )


def rank_mean_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    by_step = steps.rank_mean_loss(A.step_table(spark, sf_dir))
    return steps.accumulated_loss(by_step, ACCUMULATION, ()).select(
        "window_id", "step", "steps", rounded(F.col("loss")).alias("loss")
    )


def throughput(spark: SparkSession, sf_dir: str) -> DataFrame:
    rates = steps.throughput(A.step_table(spark, sf_dir), ACCUMULATION, BATCH, BATCH_LENGTH, RANKS)
    return rates.select(
        "rank", "window_id", "step",
        *[rounded(F.col(c)).alias(c) for c in ("tokens_per_s", "rows_per_s", "true_tokens_per_s")],
    )


def _total_steps(spark: SparkSession, sf_dir: str) -> int:
    return steps_per_rank(A.table(spark, sf_dir, "events").count(), A.STEP_RANKS, 1)


def _schedule(spark: SparkSession, sf_dir: str, **curves: Column) -> DataFrame:
    return A.step_table(spark, sf_dir).select(
        "rank", "step", *[F.round(lr, 9).alias(name) for name, lr in curves.items()]
    )


def lr_linear(spark: SparkSession, sf_dir: str) -> DataFrame:
    total = _total_steps(spark, sf_dir)

    def at(step: Column) -> Column:
        return schedules.linear_warmup_decay(step, total // 10, total, BASE_LR)

    # in training the schedule moves on once per window, while its length counts steps
    return _schedule(
        spark, sf_dir, lr=at(F.col("step")), lr_in_training=at(steps.closed_windows(ACCUMULATION))
    )


def lr_ramp(spark: SparkSession, sf_dir: str) -> DataFrame:
    lr = schedules.linear_ramp(F.col("step"), _total_steps(spark, sf_dir), BASE_LR)
    return _schedule(spark, sf_dir, lr=lr)


def lr_cosine(spark: SparkSession, sf_dir: str) -> DataFrame:
    total = _total_steps(spark, sf_dir)
    lr = schedules.cosine(F.col("step"), total // 10, total, MAX_LR, MIN_LR)
    return _schedule(spark, sf_dir, lr=lr)


CADENCE_FLAGS = ("closes_window", "logs_loss", "logs_preference", "evaluates", "saves")


def cadence(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged = steps.cadence(
        A.step_table(spark, sf_dir), ACCUMULATION, SFT_LOG_EVERY, EVAL_EVERY, SAVE_EVERY
    )
    return flagged.select(
        "rank", "step", *[F.col(c).cast("int").alias(c) for c in CADENCE_FLAGS]
    )


def _dpo_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log lines of every rank's report, rates from the times of the step table."""
    times = A.step_table(spark, sf_dir).select(
        "rank", F.col("step").alias("batch_id"),
        rounded(F.lit(float(BATCH * ACCUMULATION)) / F.col("dt")).alias("row_per_s"),
    )
    report = dpo_report(spark, sf_dir).join(times, ["rank", "batch_id"])
    return logs.dpo_log_lines(report.withColumnRenamed("batch_id", "step"), LOG_EVERY, "rank")


def dpo_log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dpo_lines(spark, sf_dir)


def _sft_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    by_step = steps.rank_mean_loss(A.step_table(spark, sf_dir))
    training = steps.accumulated_loss(by_step, ACCUMULATION, ())
    validation = by_step.where(schedules.due(F.col("step"), EVAL_EVERY))
    return logs.sft_log_lines(training, validation, SFT_LOG_EVERY)


def sft_log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sft_lines(spark, sf_dir)


def log_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Logs of all ranks appended to text files, one run per rank, and read back."""
    path = new_path(spark, "dpo-log")
    lines = _dpo_lines(spark, sf_dir).withColumn(
        "run_id", F.concat(F.lit("rank"), F.col("rank").cast("string"))
    )
    log_store.append_lines(lines, path)
    return logs.parse_dpo_log(log_store.read_lines(spark, path), "run_id")


def sft_log_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log of a run whose name has a blank and a percent sign, appended and read back."""
    path = new_path(spark, "sft-log")
    log_store.append_lines(_sft_lines(spark, sf_dir).withColumn("run_id", F.lit("run 5%")), path)
    return logs.parse_sft_log(log_store.read_lines(spark, path), "run_id")


def null_rows_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that a mapping refuses, where two columns have NULLs."""
    texts = documents_with_nulls(spark, sf_dir)
    return null_rows(texts, {"prompt": "source", "answer": "text"}, ["doc_id"]).select(
        "doc_id", F.array_join("null_columns", ",").alias("null_columns")
    )


def documents_with_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.table(spark, sf_dir, "documents").select(
        "doc_id", F.nullif("source", F.lit("src3")).alias("source"),
        F.when(F.col("lang") != "es", F.col("text")).alias("text"),
    )


def unmatched_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels without a score, and scores without a label, where both tables have gaps."""
    n = F.col("event_id")
    rows = A.table(spark, sf_dir, "events").select(
        F.floor(n / 16).alias("seq_id"), (n % 16).alias("pos"),
        F.when(n % 5 == 0, F.lit(IGNORED_LABEL)).otherwise(n % 97).cast("int").alias("label"),
        (-(n % 31) / 16.0).alias("logp"),
    )
    given = rows.where("(seq_id + pos) % 11 <> 0").select("seq_id", "pos", "logp")
    labels = rows.where("(seq_id + pos) % 13 <> 0").select("seq_id", "pos", "label")
    return R.unmatched(given, labels, ["seq_id"])


# ---- streaming -----------------------------------------------------------

def stream_prepare_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = new_path(spark, "stream-prepare")
    source = stream_prepare.read_stream(spark, stream_prepare.table_glob(f"{sf_dir}/documents.parquet"), DOCUMENT_SCHEMA)
    columns = {"query": "source", "response": "text"}
    segments = templates.shard_segments(F.col("query"), F.col("response"))

    def prepare(rows: DataFrame) -> DataFrame:
        named = map_columns(rows, columns, ["doc_id"])
        return B.shard_rows(named, segments, BYTES, SHARD_LENGTH, END_OF_PROMPT_ID).select(
            "doc_id", "tokens", "length"
        )

    stream_prepare.prepare_stream(source, prepare, f"{out}/rows", f"{out}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{out}/rows").select(
        "doc_id", joined(F.col("tokens")).alias("tokens"), "length"
    )


def stream_shards_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that arrive in several epochs; all rows of the second are refused for their NULLs."""
    out = new_path(spark, "stream-shards")
    folder = f"{out}/arrivals"
    texts = A.table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    columns = {"query": "source", "response": "text"}
    segments = templates.shard_segments(F.col("query"), F.col("response"))

    def prepare(rows: DataFrame) -> DataFrame:
        named = map_columns(rows, columns, ["doc_id"], on_null="drop")
        return B.shard_rows(named, segments, BYTES, SHARD_LENGTH, END_OF_PROMPT_ID).select(
            "doc_id", "tokens", "length"
        )

    # Every row arrives once, also with a negative id or none.
    arrival_of = F.coalesce(F.pmod("doc_id", F.lit(STREAM_PARTS)), F.lit(0))
    arrivals = [texts.where(arrival_of == part) for part in range(STREAM_PARTS)]
    arrivals.insert(1, arrivals[0].withColumn("text", F.lit(None).cast("string")))
    for arrival in arrivals:  # each call goes on where the one before ended
        arrival.write.mode("append").parquet(folder)
        source = stream_prepare.read_stream(spark, folder, "doc_id bigint, text string, source string")
        stream_shards.write_stream(source, prepare, ["doc_id"], out, SHARD).awaitTermination()
    return stream_shards.read_shards(spark, out).select(
        "epoch", "shard_id", "row_in_shard", "doc_id", joined(F.col("tokens")).alias("tokens"), "length"
    )


def stream_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Logs written in parts, read as a stream, summed per window of logged steps."""
    out = new_path(spark, "stream-log")
    lines = _sft_lines(spark, sf_dir).withColumn("run_id", F.lit("run0"))
    log_store.append_lines(lines, f"{out}/log")
    windows = live.live_windows(log_store.stream_lines(spark, f"{out}/log"), SFT_LOG_EVERY * 10)
    live.write_windows(windows, out).awaitTermination()
    return live.latest_windows(spark, out).select(
        "run_id", "window_id", rounded(F.col("loss")).alias("loss"), "lines"
    )


Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {
    # sources and sinks
    "scan_split": scan_split,
    "split_slice": split_slice_half,
    "column_mapping": column_mapping,
    "vocab_table": vocab_table,
    "shard_assign": shard_assign,
    "shard_sink": shard_sink,
    # templates, ids, labels
    "template_sft": template_sft,
    "template_dpo": template_dpo,
    "template_shard": template_shard,
    "encode_bytes": encode_bytes,
    "encode_vocab": encode_vocab,
    "vocab_join": vocab_join,
    "encode_bpe": encode_bpe,
    "decode_bpe": decode_bpe,
    "decode_ids": decode_words,
    "label_mask": label_mask,
    "dpo_samples": dpo_samples,
    "attention_mask": attention_mask,
    "pad_truncate": pad_truncate,
    "pad_eot": pad_eot,
    "check_range": check_range,
    "check_length": check_length,
    "prompt_only": prompt_only,
    # order, ranks, batches
    "dense_index": dense_index_query,
    "source_index": source_index_query,
    "rank_split": rank_split_query,
    "seeded_shuffle": seeded_shuffle_query,
    "batch_assign": batch_assign,
    "batch_len_longest": batch_len_longest,
    "batch_len_shortest": batch_len_shortest,
    "sft_batches": sft_batches,
    "sft_batches_documents": sft_batches_documents,
    "sft_batches_bpe": sft_batches_bpe,
    "dpo_batches": dpo_batches,
    "dpo_batches_bpe": dpo_batches_bpe,
    "shard_bpe": shard_bpe,
    "dpo_interleave": dpo_interleave,
    # scores
    "shift_align": shift_align,
    "shift_align_join": shift_align_join,
    "token_logprob": token_logprob_query,
    "token_logprob_rows": token_logprob_rows,
    "softmax_row": softmax_row,
    "seq_logprob": seq_logprob,
    "reference_join": reference_join,
    "chosen_nll": chosen_nll,
    "sft_batch_loss": sft_batch_loss,
    "validation_loss": validation_loss,
    "dpo_loss_sigmoid": partial(_dpo_loss),
    "dpo_loss_smoothed": partial(_dpo_loss, label_smoothing=0.1),
    "dpo_loss_hinge": partial(_dpo_loss, loss_type="hinge"),
    "dpo_loss_ipo": partial(_dpo_loss, loss_type="ipo"),
    "dpo_rewards": dpo_rewards,
    "reward_accuracy": reward_accuracy,
    "margins": margins,
    "dpo_report": dpo_report,
    "dpo_validation": dpo_validation,
    # top-k and draws
    "topk_tokens": topk_tokens,
    "topk_rows": topk_rows,
    "topk_draw": topk_draw,
    # steps, schedules, logs
    "accum_loss": accum_loss,
    "rank_mean_loss": rank_mean_loss,
    "throughput": throughput,
    "lr_linear": lr_linear,
    "lr_ramp": lr_ramp,
    "lr_cosine": lr_cosine,
    "cadence": cadence,
    "dpo_log_lines": dpo_log_lines,
    "sft_log_lines": sft_log_lines,
    "log_parse": log_parse,
    "sft_log_parse": sft_log_parse,
    "null_rows": null_rows_query,
    "unmatched_scores": unmatched_scores,
    # streaming
    "stream_prepare": stream_prepare_query,
    "stream_shards": stream_shards_query,
    "stream_log": stream_log,
}
