"""Token scores to sequence scores, batch losses and reports.

Scores come as a table, however they were made: either one list per sequence
(no shuffle needed to score it) or one row per token (one aggregation).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairloom.constants import BETA, IGNORED_LABEL, LABEL_SMOOTHING
from pairloom.functions import scores as P
from pairloom.functions.schedules import linear_ramp
from pairloom.operators.batches import BATCH_KEY

MODELS = ("policy", "reference")


def align_with_labels(
    scores: DataFrame, labels: DataFrame, key: Sequence[str], pos: str = "pos"
) -> DataFrame:
    """Rows of labels at ``pos + 1`` beside rows of scores at ``pos``.

    Every label but the first of a sequence stays, also where its score is missing;
    the sums below then refuse it.
    """
    moved = labels.withColumn(pos, F.col(pos) - 1).where(F.col(pos) >= 0)
    return moved.join(scores, [*key, pos], "left").select(
        *key, pos, *[c for c in scores.columns if c not in (*key, pos)],
        *[c for c in labels.columns if c not in (*key, pos)],
    )


def unmatched(
    scores: DataFrame, labels: DataFrame, key: Sequence[str], pos: str = "pos", label: str = "label",
    logp: str = "logp",
) -> DataFrame:
    """Per sequence the labels that count but have no score, and the scores that have no label."""
    moved = labels.withColumn(pos, F.col(pos) - 1).where(F.col(pos) >= 0).withColumn("_label", F.lit(True))
    sides = moved.select(*key, pos, label, "_label").join(
        scores.select(*key, pos, F.col(logp).alias("_logp"), F.lit(True).alias("_score")), [*key, pos], "full"
    )
    counted = F.col("_label") & (F.col(label) != IGNORED_LABEL) & F.col("_logp").isNull()
    return sides.groupBy(*key).agg(
        F.count_if(counted).alias("labels_without_score"),
        F.count_if(F.col("_score") & F.col("_label").isNull()).alias("scores_without_label"),
    ).where("labels_without_score > 0 OR scores_without_label > 0")


def _present(logp: str) -> Column:
    return F.coalesce(F.col(logp), F.raise_error(F.lit("a label that counts has no score")).cast("double"))


def token_logprobs(
    rows: DataFrame, key: Sequence[str], token: str = "token_id", logit: str = "logit",
    label: str = "label",
) -> DataFrame:
    """Log-probability of the label of each position, from one row per vocabulary id.

    A position has at most as many rows as there are ids, so one shuffle by
    position serves both the maximum and the sum.
    """
    x = F.col(logit).cast("double")
    topped = rows.withColumn("_top", F.max(x).over(Window.partitionBy(*key)))
    above = x - F.col("_top")
    return topped.groupBy(*key).agg(
        (F.max(F.when(F.col(token) == F.col(label), above)) - F.ln(F.sum(F.exp(above)))).alias("logp")
    )


def sequence_logprobs(
    tokens: DataFrame, key: Sequence[str], logp: str = "logp", label: str = "label"
) -> DataFrame:
    """Sum of log-probabilities and number of labels that count, from token rows."""
    counts = F.col(label) != IGNORED_LABEL
    return tokens.groupBy(*key).agg(
        F.sum(F.when(counts, _present(logp)).otherwise(F.lit(0.0))).alias("logp"),
        F.count_if(counts).alias("tokens"),
    )


def token_mean_loss(tokens: DataFrame, key: Sequence[str]) -> DataFrame:
    """Mean of -logp over the labels that count; NULL where there are none."""
    counts = F.col("label") != IGNORED_LABEL
    return tokens.groupBy(*key).agg(
        F.avg(F.when(counts, -_present("logp"))).alias("loss"),
        F.count_if(counts).alias("tokens"),
    )


def batch_loss(sequences: DataFrame, key: Sequence[str] = BATCH_KEY) -> DataFrame:
    """The same token mean, from sequence sums ``logp`` and ``tokens``."""
    return sequences.groupBy(*key).agg(
        F.try_divide(-F.sum("logp"), F.sum("tokens").cast("double")).alias("loss"),
        F.sum("tokens").alias("tokens"),
    )


def validation_loss(batch_losses: DataFrame, how: str = "sum") -> DataFrame:
    """Sum (or mean) of the batch losses of each rank, averaged over the ranks."""
    if how not in ("sum", "mean"):
        raise ValueError("how must be 'sum' or 'mean'")
    per_rank = batch_losses.groupBy("rank").agg(
        (F.sum if how == "sum" else F.avg)("loss").alias("loss")
    )
    return per_rank.agg(F.avg("loss").alias("validation_loss"), F.count("*").alias("ranks"))


def join_reference(
    policy: DataFrame, reference: DataFrame, key: Sequence[str]
) -> DataFrame:
    """Sequence sums of two models side by side; a sequence that one of them lacks fails the job."""
    joined = policy.select(*key, F.col("logp").alias("policy_logp"), "tokens").join(
        reference.select(*key, F.col("logp").alias("reference_logp")), list(key), "full"
    )
    sums = {
        c: F.coalesce(F.col(c), F.raise_error(F.lit(f"a sequence has no {c}")).cast("double"))
        for c in ("policy_logp", "reference_logp")
    }
    return joined.withColumns(sums)


def pair_scores(
    sequences: DataFrame, pair_key: Sequence[str], extra: Sequence[Column] = ()
) -> DataFrame:
    """One row per pair from its chosen and its rejected row."""

    def of(side: str, column: str) -> Column:
        return F.max(F.when(F.col("side") == side, F.col(column)))

    return sequences.groupBy(*pair_key).agg(
        *[
            of(side, f"{model}_logp").alias(f"{model}_{side}")
            for model in MODELS
            for side in ("chosen", "rejected")
        ],
        of("chosen", "tokens").alias("chosen_tokens"),
        of("rejected", "tokens").alias("rejected_tokens"),
        *extra,
    )


def score_pairs(
    pairs: DataFrame,
    beta: float = BETA,
    label_smoothing: float = LABEL_SMOOTHING,
    loss_type: str = "sigmoid",
) -> DataFrame:
    """Adds ``loss``, ``chosen_reward`` and ``rejected_reward`` to pair scores."""
    pc, pr, rc, rr = (
        F.col(f"{model}_{side}") for model in MODELS for side in ("chosen", "rejected")
    )
    return (
        pairs.withColumn("loss", P.preference_loss(pc, pr, rc, rr, beta, label_smoothing, loss_type))
        .withColumn("chosen_reward", P.reward(pc, rc, beta))
        .withColumn("rejected_reward", P.reward(pr, rr, beta))
    )


def reward_accuracy() -> Column:
    """Share of pairs whose chosen side has the larger reward; a tie does not count."""
    return F.avg((F.col("chosen_reward") > F.col("rejected_reward")).cast("double"))


def margin(model: str) -> Column:
    """|mean chosen| - |mean rejected|: positive means chosen is the *less* likely side."""
    return F.abs(F.avg(f"{model}_chosen")) - F.abs(F.avg(f"{model}_rejected"))


def chosen_nll() -> Column:
    """Token mean of -logp over the chosen sides; NULL where no token counts."""
    return F.try_divide(-F.sum("policy_chosen"), F.sum("chosen_tokens").cast("double"))


def preference_report(scored: DataFrame, key: Sequence[str] = BATCH_KEY) -> DataFrame:
    """All figures of a group of scored pairs in one aggregation."""
    return scored.groupBy(*key).agg(
        F.count("*").alias("pairs"),
        F.avg("loss").alias("loss"),
        reward_accuracy().alias("reward_accuracy"),
        F.avg("chosen_reward").alias("chosen_reward"),
        F.avg("rejected_reward").alias("rejected_reward"),
        F.avg("policy_chosen").alias("logp_chosen"),
        F.avg("policy_rejected").alias("logp_rejected"),
        F.avg("reference_chosen").alias("logp_chosen_ref"),
        F.avg("reference_rejected").alias("logp_rejected_ref"),
        margin("policy").alias("margin"),
        margin("reference").alias("margin_ref"),
        chosen_nll().alias("nll_loss"),
    )


def with_ramp_lr(report: DataFrame, total_steps: str, base: float) -> DataFrame:
    """Adds the learning rate in force at each step (a step is a batch of the rank)."""
    return report.withColumn("lr", linear_ramp(F.col("batch_id"), F.col(total_steps), base))
