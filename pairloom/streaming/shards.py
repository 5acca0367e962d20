"""Shard numbering that goes on across micro-batches.

The only state is how many rows came before.  Every epoch leaves one manifest row
with the number of rows up to its end, and starts from that of the epoch before
it, so an epoch that is run again finds the same offset and overwrites its own
output; a shard may hold rows of several epochs.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pairloom.constants import SHARD_ROWS
from pairloom.operators.ordering import dense_index
from pairloom.sources.shards import assign_shards
from pairloom.streaming.prepare import ONCE

MANIFEST_SCHEMA = "rows_so_far bigint"


def rows_before(spark: SparkSession, manifest: str, epoch: int) -> int:
    """Rows of all epochs before this one."""
    if epoch == 0:
        return 0
    return spark.read.schema(MANIFEST_SCHEMA).parquet(f"{manifest}/epoch={epoch - 1}").first()[0]


def write_epoch(
    batch: DataFrame, epoch: int, order_by: Sequence[str], out: str, size: int = SHARD_ROWS
) -> None:
    """Numbers and writes one micro-batch; running it again changes nothing."""
    spark = batch.sparkSession
    manifest = f"{out}/manifest"
    offset = rows_before(spark, manifest, epoch)
    numbered = dense_index(batch, order_by).withColumn("idx", F.col("idx") + F.lit(offset))
    target = f"{out}/rows/epoch={epoch}"
    rows = assign_shards(numbered, size, total=None).drop("idx", "n_rows")
    rows.sortWithinPartitions("shard_id", "row_in_shard").write.mode(
        "overwrite"
    ).partitionBy("shard_id").parquet(target)
    # written last: an epoch without a manifest row is not finished; an epoch may have no rows
    spark.read.schema(rows.schema).parquet(target).agg(
        (F.count("*") + F.lit(offset)).alias("rows_so_far")
    ).write.mode("overwrite").parquet(f"{manifest}/epoch={epoch}")


def write_stream(
    stream: DataFrame,
    prepare: Callable[[DataFrame], DataFrame],
    order_by: Sequence[str],
    out: str,
    size: int = SHARD_ROWS,
    trigger: Mapping[str, object] = ONCE,
) -> StreamingQuery:
    """Shards what arrives; by default everything there is, and a further call goes on."""

    def each(batch: DataFrame, epoch: int) -> None:
        write_epoch(prepare(batch), epoch, order_by, out, size)

    return (
        stream.writeStream.foreachBatch(each)
        .option("checkpointLocation", f"{out}/checkpoint")
        .trigger(**trigger).start()
    )


def read_shards(spark: SparkSession, out: str) -> DataFrame:
    """Rows of all epochs with ``epoch`` and ``shard_id``."""
    return spark.read.parquet(f"{out}/rows")
