"""The three flows: offline shards, supervised batches, preference batches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.constants import (
    BATCH_LENGTH,
    BATCH_ROWS,
    BETA,
    END_OF_PROMPT_ID,
    LABEL_SMOOTHING,
    SHARD_LENGTH,
)
from pairloom.functions.encoding import Encoder
from pairloom.functions.scores import sequence_logprob
from pairloom.functions.templates import shard_segments
from pairloom.operators import batches as B
from pairloom.operators import scoring as R
from pairloom.operators.distribution import assign_batches, rank_split
from pairloom.sources.shards import assign_shards


def shard_flow(
    indexed: DataFrame,
    encoder: Encoder,
    length: int = SHARD_LENGTH,
    size: int | None = None,
    end_id: int = END_OF_PROMPT_ID,
    **formats: str,
) -> DataFrame:
    """Indexed ``query, response`` rows to shard rows; adds no shuffle."""
    segments = shard_segments(F.col("query"), F.col("response"), **formats)
    return assign_shards(B.shard_rows(indexed, segments, encoder, length, end_id), size)


def into_batches(
    indexed: DataFrame, ranks: int, batch_rows: int, encoder: Encoder
) -> DataFrame:
    """Deals an indexed table to batches, which are brought together by one shuffle.

    Lengths, padding, sequence scores and batch reports all group by the batch and
    need no other one.  With native ids the text is moved, before it is blown up
    into ids; the number of tasks is given, because it would else be merged down to
    the size of the text.  A Python step forgets how its input was partitioned, so
    after it the ids are moved, by the window that finds the batch length.
    """
    dealt = assign_batches(rank_split(indexed, ranks), batch_rows)
    if not encoder.native:
        return dealt
    tasks = int(dealt.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return dealt.repartition(tasks, *B.BATCH_KEY)


def sft_flow(
    indexed: DataFrame,
    encoder: Encoder,
    ranks: int = 1,
    batch_rows: int = BATCH_ROWS,
    limit: int = BATCH_LENGTH,
) -> DataFrame:
    """Indexed ``prompt, answer`` rows to padded batches."""
    return B.sft_batches(B.encode_sft(into_batches(indexed, ranks, batch_rows, encoder), encoder), limit)


def dpo_flow(
    indexed: DataFrame,
    encoder: Encoder,
    ranks: int = 1,
    batch_rows: int = BATCH_ROWS,
    limit: int = BATCH_LENGTH,
    batch_len: str = "shortest",
    carry: Sequence[str] = ("rank_steps",),
) -> DataFrame:
    """Indexed ``prompt, chosen, rejected`` rows to padded batches of pairs."""
    encoded = B.encode_dpo(into_batches(indexed, ranks, batch_rows, encoder), encoder)
    return B.dpo_batches(encoded, limit, batch_len, carry)


def sequence_scores(rows: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Batch rows with one list of scores per model to sums per model."""
    scored = rows
    for model in R.MODELS:
        scored = scored.withColumn(f"_{model}", sequence_logprob(F.col(f"{model}_logps"), F.col("y")))
    return scored.select(
        *B.BATCH_KEY, *carry, "row_in_batch", "pair_in_batch", "side",
        *[F.col(f"_{model}.logp").alias(f"{model}_logp") for model in R.MODELS],
        F.col("_policy.tokens").alias("tokens"),
    )


def dpo_report_flow(
    rows: DataFrame,
    base_lr: float,
    beta: float = BETA,
    label_smoothing: float = LABEL_SMOOTHING,
    loss_type: str = "sigmoid",
) -> DataFrame:
    """Scored batch rows to one report row per rank and step."""
    sequences = sequence_scores(rows, ["rank_steps"])
    pairs = R.pair_scores(sequences, [*B.BATCH_KEY, "rank_steps", "pair_in_batch"])
    scored = R.score_pairs(pairs, beta, label_smoothing, loss_type)
    report = R.preference_report(scored, [*B.BATCH_KEY, "rank_steps"])
    return R.with_ramp_lr(report, "rank_steps", base_lr)
