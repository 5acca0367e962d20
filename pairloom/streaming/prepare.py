"""Stateless preparation of an unbounded source."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery


# The default trigger: everything there is, in as many batches as it takes, then stop.
ONCE = {"availableNow": True}


def read_stream(
    spark: SparkSession,
    path: str,
    schema: str,
    format: str = "parquet",
    files_per_trigger: int | None = None,
    **options: str,
) -> DataFrame:
    """New files below ``path``, each read once."""
    reader = spark.readStream.format(format).schema(schema).options(**options)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def table_glob(path: str) -> str:
    """A pattern that only ``path`` fits: a stream reads it where the table is one file and where it is a folder of files."""
    folder, name = path.rsplit("/", 1)
    return f"{folder}/{{{name}}}"


def prepare_stream(
    stream: DataFrame,
    prepare: Callable[[DataFrame], DataFrame],
    out: str,
    checkpoint: str,
    trigger: Mapping[str, object] = ONCE,
) -> StreamingQuery:
    """Applies a batch preparation to every new row and appends the result."""
    return (
        prepare(stream).writeStream.format("parquet").outputMode("append")
        .option("path", out).option("checkpointLocation", checkpoint)
        .trigger(**trigger).start()
    )
