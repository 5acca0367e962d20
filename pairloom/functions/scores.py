"""Scores of tokens, sequences and preference pairs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from pairloom.constants import BETA, IGNORED_LABEL, LABEL_SMOOTHING

LOSS_TYPES = ("sigmoid", "hinge", "ipo")


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda total, v: total + v)


def _once(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once per row.

    A column used inside a lambda is computed again for every element; the
    element of a one-element list is not.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _weights(logits: Column) -> Column:
    """``(top, weights)``: the largest score is subtracted before exp."""
    return _once(
        F.array_max(logits).cast("double"),
        lambda top: F.struct(
            top.alias("top"),
            F.transform(logits, lambda x: F.exp(x.cast("double") - top)).alias("weights"),
        ),
    )


def softmax(logits: Column) -> Column:
    """Probabilities of one row of scores."""
    return _once(
        _weights(logits)["weights"],
        lambda weights: _once(
            _sum(weights), lambda total: F.transform(weights, lambda w: w / total)
        ),
    )


def log_sum_exp(logits: Column) -> Column:
    return _once(_weights(logits), lambda w: w["top"] + F.ln(_sum(w["weights"])))


def token_logprob(logits: Column, label: Column) -> Column:
    """Log-probability of one label under one row of scores."""
    return F.get(logits, label).cast("double") - log_sum_exp(logits)


def sequence_logprob(logps: Column, labels: Column) -> Column:
    """Struct ``(logp, tokens)`` over the labels that count.

    ``logps[t]`` is the log-probability given at position t for the label at t+1.
    A list of the wrong length is an error, not a shorter sum.
    """
    wanted = F.greatest(F.size(labels) - 1, F.lit(0))
    following = F.slice(labels, F.lit(2), wanted)
    counted = F.zip_with(
        logps, following, lambda p, y: F.when(y != IGNORED_LABEL, p).otherwise(F.lit(0.0))
    )
    checked = F.when(F.size(logps) == wanted, counted).otherwise(
        F.raise_error(F.lit("scores and labels differ in length"))
    )
    return F.struct(
        _sum(checked).alias("logp"),
        F.size(F.filter(following, lambda y: y != IGNORED_LABEL)).cast("bigint").alias("tokens"),
    )


def negative_log_sigmoid(x: Column) -> Column:
    """-log(sigmoid(x)) without overflow for large |x|."""
    return F.greatest(-x, F.lit(0.0)) + F.log1p(F.exp(-F.abs(x)))


def preference_loss(
    policy_chosen: Column,
    policy_rejected: Column,
    reference_chosen: Column,
    reference_rejected: Column,
    beta: float = BETA,
    label_smoothing: float = LABEL_SMOOTHING,
    loss_type: str = "sigmoid",
) -> Column:
    """Loss of one pair from four sequence log-probabilities."""
    z = (policy_chosen - policy_rejected) - (reference_chosen - reference_rejected)
    if loss_type == "sigmoid":
        kept = negative_log_sigmoid(beta * z) * (1.0 - label_smoothing)
        if not label_smoothing:
            return kept
        return kept + negative_log_sigmoid(-beta * z) * label_smoothing
    if loss_type == "hinge":
        return F.greatest(F.lit(1.0) - beta * z, F.lit(0.0))
    if loss_type == "ipo":
        gap = z - 1.0 / (2.0 * beta)
        return gap * gap
    raise ValueError(f"loss_type must be one of {LOSS_TYPES}, not {loss_type!r}")


def reward(policy: Column, reference: Column, beta: float = BETA) -> Column:
    return beta * (policy - reference)


def top_k(probabilities: Column, k: int) -> Column:
    """The k most probable ids as ``(p, token_id)``, best first, ties by id."""
    numbered = F.transform(
        probabilities, lambda p, i: F.struct((-p).alias("cost"), i.alias("token_id"))
    )
    return F.transform(
        F.slice(F.sort_array(numbered), 1, k),
        lambda t: F.struct((-t["cost"]).alias("p"), t["token_id"].alias("token_id")),
    )


def hash_uniform(*parts: Column) -> Column:
    """A repeatable number strictly between 0 and 1 made from the md5 of the parts."""
    digits = F.substring(F.md5(F.concat_ws(":", *parts)), 1, 13)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / float(2**52)


def weighted_draw(candidates: Column, seed: int, *row_key: Column) -> Column:
    """One id of ``(p, token_id)`` candidates, drawn with weight p (Gumbel-max)."""

    def keyed(c: Column) -> Column:
        u = hash_uniform(F.lit(seed).cast("string"), *[k.cast("string") for k in row_key],
                         c["token_id"].cast("string"))
        return F.struct(
            (F.ln(c["p"]) - F.ln(-F.ln(u))).alias("score"), c["token_id"].alias("token_id")
        )

    return F.array_max(F.transform(candidates, keyed))["token_id"]
