"""Rows to ranks, ranks to batches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.constants import BATCH_ROWS


def rank_split(
    df: DataFrame, ranks: int, index: str = "idx", total: str = "n_rows"
) -> DataFrame:
    """Deals rows round-robin to ``ranks``; all ranks get the same number of rows.

    Adds ``rank``, ``pos`` (place within the rank) and ``rank_rows``; the last
    ``N mod ranks`` rows are left out.
    """
    if ranks < 1:
        raise ValueError("ranks must be at least 1")
    each = F.floor(F.col(total) / ranks).cast("bigint")
    return (
        df.withColumn("rank_rows", each)
        .where(F.col(index) < F.col("rank_rows") * ranks)
        .withColumn("rank", (F.col(index) % ranks).cast("int"))
        .withColumn("pos", F.floor(F.col(index) / ranks).cast("bigint"))
    )


def assign_batches(df: DataFrame, batch_rows: int = BATCH_ROWS) -> DataFrame:
    """Adds ``batch_id``, ``row_in_batch`` and ``rank_steps``; a short last batch stays."""
    if batch_rows < 1:
        raise ValueError("batch_rows must be at least 1")
    return (
        df.withColumn("batch_id", F.floor(F.col("pos") / batch_rows).cast("bigint"))
        .withColumn("row_in_batch", (F.col("pos") % batch_rows).cast("int"))
        .withColumn("rank_steps", F.ceil(F.col("rank_rows") / batch_rows).cast("bigint"))
    )


def steps_per_rank(n_rows: int, ranks: int, batch_rows: int) -> int:
    """Number of batches each rank sees."""
    return -(-(n_rows // ranks) // batch_rows)
