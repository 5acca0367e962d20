"""A row number for every row of a data set that is kept while files are added.

The index is a manifest: one row a file, with its number of rows and the number of its first row.  Every delivery adds a
version that holds the new files only, behind the rows of all versions before, so a row keeps its number.  Row counts come from a
scan without columns, which looks at file footers only, and only at those of new files.

A reader of rows ``[start, stop)`` picks the files from the manifest: others are not opened.  Files that were changed or
removed after they were indexed are errors.  One writer at a time: a version that exists is not written again.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

MANIFEST_SCHEMA = "file string, bytes bigint, rows bigint, first bigint, version int"
# A schema that is given need not be looked for in any file; its column is not read.
NO_COLUMNS = "_none int"
# The manifest's file names pass through the driver, and those of a read are joined to its rows.
MAX_FILES = 1_000_000


def plain_name(uri: str) -> str:
    """A file's name as a reader takes it: not encoded, and local ones spelled in one way."""
    return re.sub("^file:/+", "file:/", unquote(uri))


def plain_column(uri: Column) -> Column:
    """The same of a column; a plus sign is no blank in a path."""
    return F.regexp_replace(F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B"))), "^file:/+", "file:/")


def manifest(spark: SparkSession, index: str) -> DataFrame:
    """``file, bytes, rows, first, version`` of all indexed files; none before the first delivery."""
    try:
        return spark.read.schema(MANIFEST_SCHEMA).parquet(index)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], MANIFEST_SCHEMA)


def indexed_rows(known: DataFrame) -> int:
    return known.agg(F.max(F.col("first") + F.col("rows"))).first()[0] or 0


def add_files(spark: SparkSession, path: str | Sequence[str], index: str, max_files: int = MAX_FILES) -> int:
    """Indexes the Parquet files below ``path`` that are new, by path; returns the number of rows added."""
    paths = [path] if isinstance(path, str) else list(path)
    there = sorted(map(plain_name, spark.read.schema(NO_COLUMNS).parquet(*paths).inputFiles()))
    if len(there) > max_files:
        raise ValueError(f"more than {max_files} files")
    known = manifest(spark, index)
    old = {r.file for r in known.select("file").collect()}
    new = [f for f in there if f not in old]
    if not new:
        return 0
    before, version = indexed_rows(known), (known.agg(F.max("version")).first()[0] or 0) + 1
    counted = spark.read.schema(NO_COLUMNS).parquet(*new).groupBy(plain_column(F.col("_metadata.file_path")).alias("file")).agg(
        F.max("_metadata.file_size").alias("bytes"), F.count("*").alias("rows")
    )
    earlier = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)  # one row a file
    first = F.coalesce(F.sum("rows").over(earlier), F.lit(0)) + F.lit(before)
    # a file without rows is not seen by the scan and needs no number
    counted.select("file", "bytes", "rows", first.alias("first")).coalesce(1).write.parquet(f"{index}/version={version}")
    return indexed_rows(manifest(spark, index)) - before


def read_rows(
    spark: SparkSession,
    index: str,
    columns: Sequence[str],
    start: int = 0,
    stop: int | None = None,
    idx: str = "idx",
    total: str = "n_rows",
) -> DataFrame:
    """``columns`` of rows ``start <= idx < stop`` with ``idx`` and the number ``total`` of all rows.

    Only the files that hold such rows are opened; of those at the two borders, rows outside are left out.
    """
    known = manifest(spark, index)
    n = indexed_rows(known)
    stop = n if stop is None else min(stop, n)
    wanted = known.where((F.col("first") < stop) & (F.col("first") + F.col("rows") > start) & F.lit(start < stop))
    files = [r.file for r in wanted.select("file").orderBy("first").collect()]
    if not files:
        anything = known.select("file").first()
        if anything is None:
            raise ValueError(f"nothing is indexed in {index}")
        files, stop = [anything.file], start
    placed = spark.read.parquet(*files).select(
        *columns, plain_column(F.col("_metadata.file_path")).alias("file"), F.col("_metadata.row_index").alias("_place"),
        F.col("_metadata.file_size").alias("_bytes"),
    )
    number = F.when(F.col("_bytes") == F.col("bytes"), F.col("first") + F.col("_place")).otherwise(
        F.raise_error(F.concat(F.lit("changed since it was indexed: "), F.col("file")))
    )
    return (
        placed.join(F.broadcast(known.select("file", "first", "bytes")), "file")
        .withColumn(idx, number.cast("bigint"))
        .where((F.col(idx) >= start) & (F.col(idx) < stop))
        .select(*columns, idx, F.lit(n).cast("bigint").alias(total))
    )
