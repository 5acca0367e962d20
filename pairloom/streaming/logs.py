"""Loss windows kept up to date from log parts as they arrive.

The file source reads each file once, so it takes logs rolled into parts; lines
appended to a file that was already read are for the batch form.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pairloom.operators.steps import accumulation_window
from pairloom.sources.logs import parse_sft_log
from pairloom.streaming.prepare import ONCE


def read_log_stream(spark: SparkSession, path: str) -> DataFrame:
    return spark.readStream.format("text").schema("value string, run_id string").load(path)


def live_windows(lines: DataFrame, accumulation: int) -> DataFrame:
    """Sum and number of the logged training losses per run and window so far."""
    training = parse_sft_log(lines, "run_id").where(F.col("kind") == "train")
    return training.groupBy(
        "run_id", accumulation_window(accumulation).alias("window_id")
    ).agg(F.sum("loss").alias("loss"), F.count("*").alias("lines"))


def write_windows(
    windows: DataFrame, out: str, trigger: Mapping[str, object] = ONCE
) -> StreamingQuery:
    """Writes the windows that changed, one folder per epoch; a retry overwrites its own."""

    def each(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/windows/epoch={epoch}")

    return (
        windows.writeStream.outputMode("update").foreachBatch(each)
        .option("checkpointLocation", f"{out}/checkpoint")
        .trigger(**trigger).start()
    )


def latest_windows(spark: SparkSession, out: str) -> DataFrame:
    """The newest figures of every window."""
    return (
        spark.read.parquet(f"{out}/windows")
        .groupBy("run_id", "window_id")
        .agg(F.max_by("loss", "epoch").alias("loss"), F.max_by("lines", "epoch").alias("lines"))
    )
