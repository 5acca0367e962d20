"""Fixed-size shards of token rows.

Shards are runs of consecutive row numbers.  No shuffle is needed: every task writes
the shards it overlaps, a shard has at most one file of each task, and the rows of a
file are in order.  Splits lie side by side; writing one leaves the others alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.constants import SHARD_ROWS


SHARD_SCHEMA = (
    "shard_id int, row_in_shard int, tokens array<int>, length int, split string, shard string"
)

MANIFEST_SCHEMA = (
    "split string, shard_id int, rows bigint, first int, last int, places bigint, files bigint, checksum bigint"
)
# Beside the splits, where readers of the shards do not look.
SHARD_MANIFEST = "_manifest"
# A checksum is a number base CHECK_FACTOR modulo this prime; products stay below 2**63.
CHECK_PRIME = 2_147_483_647
CHECK_FACTOR = 65_599


def shard_size(total: Column | None, given: int | None = None) -> Column:
    """The given size, else N but at most a million, else a million if N is unknown."""
    if given is not None:
        if given < 1:
            raise ValueError("a shard holds at least one row")
        return F.lit(given).cast("bigint")
    if total is None:
        return F.lit(SHARD_ROWS).cast("bigint")
    return F.least(F.lit(SHARD_ROWS).cast("bigint"), total)


def shard_name(dataset: str, split: str, shard: Column) -> Column:
    return F.format_string(f"{dataset}_{split}_%06d", shard)


def assign_shards(
    df: DataFrame,
    size: int | None = None,
    index: str = "idx",
    total: str | None = "n_rows",
) -> DataFrame:
    """Adds ``shard_id`` and ``row_in_shard`` to an indexed table."""
    of = shard_size(None if total is None else F.col(total), size)
    return df.withColumn("_size", of).withColumns(
        {
            "shard_id": F.floor(F.col(index) / F.col("_size")).cast("int"),
            "row_in_shard": (F.col(index) % F.col("_size")).cast("int"),
        }
    ).drop("_size")


def write_shards(df: DataFrame, folder: str, dataset: str, split: str = "train", one_file: bool = False) -> str:
    """Writes ``shard_id, row_in_shard, tokens, length`` in place of this split; returns the data set's path.

    With ``one_file`` the rows are shuffled, so that a shard is one file, written by one task.
    """
    path = f"{folder}/datasets/{dataset}"
    dealt = df.repartition("shard_id") if one_file else df
    (
        dealt.select(
            "shard_id", "row_in_shard", "tokens", "length",
            shard_name(dataset, split, F.col("shard_id")).alias("shard"),
        )
        .sortWithinPartitions("shard", "row_in_shard")
        .write.mode("overwrite").partitionBy("shard").parquet(f"{path}/split={split}")
    )
    return path


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """Rows of all splits of a data set, also where they are none."""
    return spark.read.schema(SHARD_SCHEMA).parquet(path)


def row_checksum() -> Column:
    """A whole number below ``CHECK_PRIME`` of a row's place, length and tokens."""
    p = F.lit(CHECK_PRIME).cast("bigint")
    start = (F.col("row_in_shard").cast("bigint") * 31 + F.col("length")) % p
    return F.aggregate("tokens", start, lambda sum, t: (sum * CHECK_FACTOR + t) % p)


def _shard_facts(rows: DataFrame) -> DataFrame:
    """Per shard what a manifest keeps: ``rows, first, last, places, files, checksum``."""
    facts = rows.select("split", "shard_id", "row_in_shard", row_checksum().alias("_sum"), F.col("_metadata.file_path").alias("_file"))
    # by file first: a shard of many files is not one group of rows
    by_file = facts.groupBy("split", "shard_id", "_file").agg(
        F.count("*").alias("rows"), F.min("row_in_shard").alias("first"), F.max("row_in_shard").alias("last"),
        F.sum(F.col("row_in_shard").cast("bigint")).alias("places"), F.sum("_sum").alias("checksum"),
    )
    return by_file.groupBy("split", "shard_id").agg(
        F.sum("rows").alias("rows"), F.min("first").alias("first"), F.max("last").alias("last"),
        F.sum("places").alias("places"), F.count("*").alias("files"), F.sum("checksum").alias("checksum"),
    )


def commit_shards(spark: SparkSession, path: str) -> DataFrame:
    """Writes the manifest of a data set, one row a shard, in place of an older one; returns it.

    Written after all shards: a data set without it, or with shards that are not in it, is not finished.
    A shard whose rows are not ``0 .. n-1`` is not committed but an error.
    """
    facts = _shard_facts(read_shards(spark, path))
    whole = (F.col("first") == 0) & (F.col("last") == F.col("rows") - 1) & (F.col("places") * 2 == F.col("rows") * (F.col("rows") - 1))
    name = F.concat_ws("/", "split", F.col("shard_id").cast("string"))
    broken = F.raise_error(F.concat(F.lit("rows are missing or there twice in shard "), name)).cast("bigint")
    checked = facts.withColumn("rows", F.when(whole, F.col("rows")).otherwise(broken))
    # one row a shard, in few files
    checked.coalesce(8).write.mode("overwrite").parquet(f"{path}/{SHARD_MANIFEST}")
    return spark.read.schema(MANIFEST_SCHEMA).parquet(f"{path}/{SHARD_MANIFEST}")


def verify_shards(spark: SparkSession, path: str) -> DataFrame:
    """Every shard of the manifest or the folder with ``state``: ok, missing, unknown, or changed."""
    known = spark.read.schema(MANIFEST_SCHEMA).parquet(f"{path}/{SHARD_MANIFEST}")
    facts = F.struct("rows", "first", "last", "places", "files", "checksum")
    there = _shard_facts(read_shards(spark, path)).select("split", "shard_id", facts.alias("there"))
    both = known.select("split", "shard_id", facts.alias("known")).join(there, ["split", "shard_id"], "full")
    state = (
        F.when(F.col("there").isNull(), "missing").when(F.col("known").isNull(), "unknown")
        .when(F.col("there") == F.col("known"), "ok").otherwise("changed")
    )
    kept = F.coalesce("known", "there")
    return both.select("split", "shard_id", kept["rows"].alias("rows"), kept["files"].alias("files"), kept["checksum"].alias("checksum"), state.alias("state"))


def read_committed(spark: SparkSession, path: str) -> DataFrame:
    """Rows of a data set of which every shard is as it was committed; otherwise an error that names some."""
    wrong = verify_shards(spark, path).where("state <> 'ok'").limit(10).collect()
    if wrong:
        raise ValueError("; ".join(sorted(f"{r.split}/{r.shard_id}: {r.state}" for r in wrong)))
    return read_shards(spark, path)
