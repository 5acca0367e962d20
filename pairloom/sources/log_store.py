"""Logs written by many tasks at once, whose lines still have one order, and whose appends count once.

Every append has a number and a folder of its own.  Its lines are cut into ranges of (run, step, place in the step), so
a run with most of the lines is written by many tasks, and its files' names are in the order of the ranges: (append, file,
place in the file) is the order of the lines of a run.  A manifest row with the append's id and its number of lines is
written last.  An append without it did not finish and is not read; the next one takes its place.  An
append whose id is in the manifest has been made and is not made again.  There is one writer at a time.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from pairloom.sources.logs import run_name
from pairloom.streaming import log_tail

MANIFEST_SCHEMA = "append_id string, lines bigint, append int"
# Below the log, where readers of the folder do not look.
MANIFEST = "_appends"


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """``append_id, lines, append`` of all finished appends."""
    try:
        return spark.read.schema(MANIFEST_SCHEMA).parquet(f"{path}/{MANIFEST}")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], MANIFEST_SCHEMA)


def append_lines(
    lines: DataFrame, path: str, append_id: str | None = None, run: str = "run_id", tasks: int | None = None
) -> int:
    """Appends ``value`` lines in the order of their steps, header first; returns how many, 0 if this id was appended before."""
    spark = lines.sparkSession
    append_id = append_id or uuid.uuid4().hex
    known = manifest(spark, path)
    if known.where(F.col("append_id") == append_id).head() is not None:
        return 0
    number = (known.agg(F.max("append")).first()[0] or 0) + 1
    order = [run, *[c for c in ("step", "line_in_step", "kind") if c in lines.columns]]
    if tasks is None:
        tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    seen = Observation()
    # counted behind the shuffle: what is before it is also read for the ranges' borders
    placed = lines.repartitionByRange(tasks, *order).sortWithinPartitions(*order).observe(seen, F.count("*").alias("lines"))
    placed.select(run, "value").write.mode("overwrite").partitionBy(run).text(f"{path}/append={number}")
    count = seen.get["lines"]
    row = spark.createDataFrame([(append_id, count)], "append_id string, lines bigint").coalesce(1)
    # written last, and never over another one
    row.write.parquet(f"{path}/{MANIFEST}/append={number}")
    return count


def _appends(spark: SparkSession, path: str) -> list[int]:
    return sorted(r["append"] for r in manifest(spark, path).select("append").collect())


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """``value, run_id, append`` of all finished appends, in no order."""
    folders = [f"{path}/append={n}" for n in _appends(spark, path)]
    if not folders:
        return spark.createDataFrame([], "value string, run_id string, append int")
    found = spark.read.option("recursiveFileLookup", "true").text(folders)
    place = F.col("_metadata.file_path")
    return found.select("value", run_name(place).alias("run_id"), F.regexp_extract(place, r"/append=(\d+)/", 1).cast("int").alias("append"))


def read_ordered(spark: SparkSession, path: str) -> DataFrame:
    """``value, run_id`` with ``append, file, at``, whose order is that of the lines of a run.

    Reads through the file system, for the places of the lines in their files.
    """
    done = manifest(spark, path).select("append")
    number = F.regexp_extract("file", r"/append=(\d+)/", 1).cast("int")
    lines = log_tail.read_tail(spark, path).withColumn("append", number)
    return lines.join(done, "append", "left_semi").select("value", "run_id", "append", "file", "at")


def stream_lines(spark: SparkSession, path: str) -> DataFrame:
    """A stream of the lines of new appends.

    The files of an append appear when all of its tasks are done; one that failed between that and its manifest
    row has been seen, and is seen again when it is repeated.
    """
    return spark.readStream.format("text").schema("value string, append int, run_id string").load(path)
