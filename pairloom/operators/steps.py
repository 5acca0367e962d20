"""Step tables ``(rank, step, loss, dt)``: accumulation windows, rates, cadences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.functions.schedules import due


def accumulation_window(accumulation: int, step: str = "step") -> Column:
    """Number of the window a step falls into.

    A window closes on a positive multiple of ``accumulation``, so the first
    one holds one step more (step 0) than the others.
    """
    closing = F.ceil(F.col(step) / F.lit(float(accumulation)))
    return F.greatest(closing.cast("bigint"), F.lit(1).cast("bigint"))


def closed_windows(accumulation: int, step: str = "step") -> Column:
    """Windows closed up to a step: how often the learning rate was moved on."""
    return F.floor(F.col(step) / F.lit(float(accumulation))).cast("bigint")


def accumulated_loss(
    steps: DataFrame, accumulation: int, key: tuple[str, ...] = ("rank",)
) -> DataFrame:
    """Loss of every closed window; steps after the last close are not reported."""
    return (
        steps.groupBy(*key, accumulation_window(accumulation).alias("window_id"))
        .agg(
            F.sum(F.col("loss") / accumulation).alias("loss"),
            F.count("*").alias("steps"),
            F.max("step").alias("step"),
        )
        .where(F.col("step") == F.col("window_id") * accumulation)
    )


def rank_mean_loss(steps: DataFrame) -> DataFrame:
    """Mean loss over the ranks at every step."""
    return steps.groupBy("step").agg(
        F.avg("loss").alias("loss"), F.count("*").alias("ranks")
    )


def throughput(
    steps: DataFrame, accumulation: int, batch_rows: int, sequence_length: int, ranks: int
) -> DataFrame:
    """Rates at the close of every window.

    ``tokens_per_s`` and ``rows_per_s`` divide the nominal work of a window by the
    time of its last step, as the logs do; ``true_tokens_per_s`` divides the real
    tokens of the window by its whole time.
    """
    nominal = batch_rows * accumulation
    last_dt = F.max_by("dt", "step")
    return (
        steps.groupBy("rank", accumulation_window(accumulation).alias("window_id"))
        .agg(
            F.max("step").alias("step"),
            (F.lit(float(nominal * sequence_length * ranks)) / last_dt).alias("tokens_per_s"),
            (F.lit(float(nominal)) / last_dt).alias("rows_per_s"),
            (F.sum("tokens") / F.sum("dt")).alias("true_tokens_per_s"),
        )
        .where(F.col("step") == F.col("window_id") * accumulation)
    )


def cadence(
    steps: DataFrame, accumulation: int, log_every: int, eval_every: int, save_every: int
) -> DataFrame:
    """What is due at each step; a training loss is logged only where a window closes."""
    step = F.col("step")
    return steps.withColumns(
        {
            "closes_window": due(step, accumulation),
            "logs_loss": due(step, accumulation) & due(step, log_every),
            "logs_preference": due(step, log_every),
            "evaluates": due(step, eval_every),
            "saves": due(step, save_every),
        }
    )
