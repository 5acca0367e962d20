"""Dense row numbers without a one-task sort.

A plain ``row_number()`` over the whole table sorts it in one task.  Here the
rows are cut into key ranges, the ranges are counted, and each range numbers its
own rows from its offset.  The ranges cut the *full* ordering key, so one very
common leading value is spread over many ranges; they are fixed before the
shuffle, so a retried task numbers its rows the same way.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pairloom.scratch import new_path

# At most this many ranges: bounds the literal array of cut points, the table of
# offsets that is broadcast, and the one-task running sum over it.
MAX_RANGES = 32_768
ROWS_PER_RANGE = 100_000
SAMPLES_PER_RANGE = 10
# The offsets per file are broadcast, so an index over more files is refused.
MAX_INDEXED_FILES = 1_000_000


def dense_index(
    df: DataFrame,
    order_by: Sequence[str],
    index: str = "idx",
    total: str = "n_rows",
    rows_per_range: int = ROWS_PER_RANGE,
    ranges: int | None = None,
    max_ranges: int = MAX_RANGES,
) -> DataFrame:
    """Adds ``index`` 0..N-1 in the order of a unique key, and N as ``total``.

    ``max_ranges`` bounds the cut points; with more than ``max_ranges * rows_per_range`` rows
    the ranges get larger, so raise it there.

    The input is evaluated twice: once for its key columns alone, which are written to the shared folder
    and from there counted, sampled and counted by range; and once for the rows themselves, which are shuffled once.
    """
    keys = _stored_keys(df.select(*order_by))
    n_rows = keys.count()
    if ranges is None:
        shuffle_tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        ranges = max(2 * shuffle_tasks, -(-n_rows // rows_per_range))
    ranges = max(1, min(ranges, max_ranges, n_rows))
    in_range = _range_of(_cut_points(keys, n_rows, ranges), ranges, order_by)
    return _number(df.withColumn("_range", in_range), keys.withColumn("_range", in_range), order_by, index, total)


def seeded_shuffle(
    df: DataFrame,
    key: Sequence[str],
    seed: int,
    index: str = "idx",
    total: str = "n_rows",
    ranges: int | None = None,
) -> DataFrame:
    """Dense index in an order that depends on the seed and is the same on every run.

    The order is that of ``md5(seed:key)``, whose values are even, so the ranges
    are even cuts of its first 32 bits and need no look at the data.  The input is evaluated twice,
    once for its key columns alone, to count the ranges.
    """
    if ranges is None:
        ranges = 2 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = max(1, min(ranges, MAX_RANGES))
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.col(k).cast("string") for k in key]))
    leading = F.conv(F.substring(F.col("_digest"), 1, 8), 16, 10).cast("bigint")
    placed = df.withColumn("_digest", digest).withColumn(
        "_range", F.shiftright(leading * F.lit(ranges), 32).cast("int")
    )
    return _number(placed, placed, ["_digest", *key], index, total).drop("_digest")


def source_index(
    spark: SparkSession,
    path: str | Sequence[str],
    columns: Sequence[str],
    index: str = "idx",
    total: str = "n_rows",
    max_files: int = MAX_INDEXED_FILES,
) -> DataFrame:
    """Dense index in source order: files by path, rows as they lie in the file.

    Parquet gives every row its place in the file, so only the row counts of the
    files are needed: no row is shuffled or sorted.
    """
    paths = [path] if isinstance(path, str) else list(path)
    source = spark.read.parquet(*paths)
    placed = source.select(
        *columns,
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.row_index").alias("_place"),
    )
    rows_of = placed.groupBy("_file").agg(F.count("*").alias("_rows"))
    if rows_of.limit(max_files + 1).count() > max_files:
        raise ValueError(f"more than {max_files} files: raise max_files, or order by a key with dense_index")
    offsets = _offsets(rows_of, "_file", total)
    return (
        placed.join(F.broadcast(offsets), "_file")
        .withColumn(index, F.col("_offset") + F.col("_place"))
        .drop("_file", "_place", "_offset")
    )


def split_slice(
    df: DataFrame,
    start_percent: float = 0,
    stop_percent: float = 100,
    index: str = "idx",
    total: str = "n_rows",
) -> DataFrame:
    """Rows of an indexed table between two percentages, numbered from 0 again.

    The bounds round half to even.
    """

    def bound(percent: float) -> Column:
        return F.bround(F.col(total) * F.lit(float(percent)) / 100.0).cast("bigint")

    first, last = bound(start_percent), bound(stop_percent)
    kept = df.where((F.col(index) >= first) & (F.col(index) < last))
    return kept.withColumns({index: F.col(index) - first, total: last - first})


def _cut_points(keys: DataFrame, n_rows: int, ranges: int) -> Column | None:
    """Sorted literal array of ``ranges - 1`` keys from a sample of bounded size.

    Any cut points give right numbers; the sample only decides how even they are.
    """
    if ranges <= 1:
        return None
    fraction = min(1.0, SAMPLES_PER_RANGE * ranges / max(1, n_rows))
    sample = keys if fraction >= 1.0 else keys.sample(fraction, seed=17)
    as_json = [
        r.key for r in sample.orderBy(*keys.columns)
        .select(F.to_json(F.struct(*keys.columns)).alias("key")).collect()
    ]
    if not as_json:
        return None
    step = len(as_json) / ranges
    chosen = [as_json[int(step * i)] for i in range(1, ranges)]
    schema = F.lit(f"array<{keys.schema.simpleString()}>")
    return F.sort_array(F.from_json(F.lit("[" + ",".join(chosen) + "]"), schema))


def _range_of(cuts: Column | None, ranges: int, order_by: Sequence[str]) -> Column:
    """How many cut points are not above the key, by halving steps."""
    if cuts is None:
        return F.lit(0)
    key = F.struct(*order_by)
    halving = F.array(*[F.lit(1 << b) for b in reversed(range(ranges.bit_length()))])
    return F.aggregate(
        halving,
        F.lit(0),
        # a place past the end reads NULL, which leaves the position as it is
        lambda at, step: F.when(F.get(cuts, at + step - 1) <= key, at + step).otherwise(at),
    )


def _offsets(counts: DataFrame, part: str, total: str) -> DataFrame:
    """Rows before each part, and the sum.  One row per part: a bounded table."""
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(part).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    return counts.select(
        part,
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"),
        F.sum("_rows").over(everything).alias(total),
    )


def _stored_keys(keys: DataFrame) -> DataFrame:
    """The key columns, written once and read back."""
    path = new_path(keys.sparkSession, "keys")
    keys.write.parquet(path)
    return keys.sparkSession.read.schema(keys.schema).parquet(path)


def _number(placed: DataFrame, keys: DataFrame, order_by: Sequence[str], index: str, total: str) -> DataFrame:
    counts = keys.groupBy("_range").agg(F.count("*").alias("_rows"))
    within = Window.partitionBy("_range").orderBy(*order_by)
    key = F.struct(*order_by)
    number = F.when(
        F.lag(key).over(within) == key,
        F.raise_error(F.lit(f"order key {list(order_by)} is not unique")),
    ).otherwise(F.row_number().over(within) - 1)
    return (
        placed.withColumn("_number", number)
        .join(F.broadcast(_offsets(counts, "_range", total)), "_range")
        .withColumn(index, (F.col("_offset") + F.col("_number")).cast("bigint"))
        .drop("_range", "_number", "_offset")
    )
