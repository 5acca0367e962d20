"""Batches over a source without an end.

Rows are dealt round-robin to ranks and cut into batches, so ``ranks * batch_rows`` consecutive rows, a round,
make one batch of every rank.  An epoch numbers its rows from where the one before ended, gives out the batches of
all rounds that are full, and carries the rows of the last, open round: fewer than one round, whatever has come.

An epoch leaves its numbered rows, its batches, what it carries, and last a manifest row; it starts from the carried rows
and the manifest row of the epoch before.  Run again, it finds the same and overwrites its own output.
``finish`` gives out the open round of the last epoch as the batch form does: ranks with
equally many rows, a shorter last batch.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pairloom.operators.distribution import assign_batches, rank_split
from pairloom.operators.ordering import dense_index
from pairloom.streaming.prepare import ONCE

MANIFEST_SCHEMA = "rows_so_far bigint, rows_given bigint"


def manifest_row(spark: SparkSession, out: str, epoch: int) -> tuple[int, int]:
    """Rows that had come, and rows given out in full rounds, at the end of an epoch."""
    if epoch < 0:
        return 0, 0
    return tuple(spark.read.schema(MANIFEST_SCHEMA).parquet(f"{out}/manifest/epoch={epoch}").first())


def _deal(rows: DataFrame, total: int, ranks: int, batch_rows: int) -> DataFrame:
    """Ranks and batches of numbered rows, as if there were ``total`` of them in all."""
    counted = rows.withColumn("n_rows", F.lit(total).cast("bigint"))
    return assign_batches(rank_split(counted, ranks), batch_rows).drop("n_rows", "rank_rows", "rank_steps")


def write_epoch(
    batch: DataFrame,
    epoch: int,
    order_by: Sequence[str],
    out: str,
    collate: Callable[[DataFrame], DataFrame],
    ranks: int,
    batch_rows: int,
) -> None:
    """Gives out the full rounds up to this epoch; running it again changes nothing.

    ``collate`` makes batch rows of rows with ``rank``, ``batch_id`` and ``row_in_batch``.
    """
    spark, size = batch.sparkSession, ranks * batch_rows
    before, _ = manifest_row(spark, out, epoch - 1)
    arrived = f"{out}/arrived/epoch={epoch}"
    numbered = dense_index(batch, order_by).withColumn("idx", F.col("idx") + F.lit(before)).drop("n_rows")
    numbered.write.mode("overwrite").parquet(arrived)
    rows = spark.read.schema(numbered.schema).parquet(arrived)
    total = before + rows.count()
    if epoch > 0:
        rows = rows.unionByName(spark.read.schema(numbered.schema).parquet(f"{out}/carried/epoch={epoch - 1}"))
    full = total // size * size
    collate(_deal(rows.where(F.col("idx") < full), full, ranks, batch_rows)).write.mode("overwrite").parquet(f"{out}/batches/part={epoch}")
    # fewer rows than a round, in one file
    rows.where(F.col("idx") >= full).coalesce(1).write.mode("overwrite").parquet(f"{out}/carried/epoch={epoch}")
    # written last: an epoch without a manifest row is not finished
    spark.createDataFrame([(total, full)], MANIFEST_SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{out}/manifest/epoch={epoch}")


def finish(
    spark: SparkSession, out: str, collate: Callable[[DataFrame], DataFrame], ranks: int, batch_rows: int
) -> None:
    """Gives out what the last epoch carries; further epochs may follow, and ``finish`` again."""
    last = spark.read.parquet(f"{out}/manifest").agg(F.max("epoch")).first()[0]
    total, _ = manifest_row(spark, out, last)
    carried = spark.read.parquet(f"{out}/carried/epoch={last}")
    collate(_deal(carried, total, ranks, batch_rows)).write.mode("overwrite").parquet(f"{out}/batches/part=-1")


def write_stream(
    stream: DataFrame,
    prepare: Callable[[DataFrame], DataFrame],
    order_by: Sequence[str],
    out: str,
    collate: Callable[[DataFrame], DataFrame],
    ranks: int,
    batch_rows: int,
    trigger: Mapping[str, object] = ONCE,
) -> StreamingQuery:
    """Batches what arrives; a further call goes on where the last one ended."""

    def each(batch: DataFrame, epoch: int) -> None:
        write_epoch(prepare(batch), epoch, order_by, out, collate, ranks, batch_rows)

    return (
        stream.writeStream.foreachBatch(each)
        .option("checkpointLocation", f"{out}/checkpoint").trigger(**trigger).start()
    )


def read_batches(spark: SparkSession, out: str, finished: bool = True) -> DataFrame:
    """All batch rows given out so far; with ``finished`` also those of the last, open round if it was given out.

    An epoch after ``finish`` carries the same rows on, so until ``finish`` is called again its tail is out of date.
    """
    rows = spark.read.parquet(f"{out}/batches")
    return (rows if finished else rows.where("part >= 0")).drop("part")
