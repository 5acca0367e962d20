"""Checks on prepared rows, as tables of what was found."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from pairloom.constants import ID_LIMIT
from pairloom.functions.sequences import out_of_range


def range_report(df: DataFrame, ids: str, *key: str, limit: int = ID_LIMIT) -> DataFrame:
    """Per row: number of ids, and how many of them are outside ``[0, limit)``."""
    return df.select(
        *key,
        F.size(ids).alias("n_ids"),
        out_of_range(F.col(ids), limit).alias("n_out_of_range"),
    )


def length_violations(df: DataFrame, tokens: str, length: int) -> DataFrame:
    """Rows whose list does not have exactly ``length`` entries, or is NULL."""
    return df.where(~F.size(tokens).eqNullSafe(F.lit(length)))


def null_checks(columns: Sequence[str]) -> dict[str, Column]:
    """One check a column: its value is there."""
    return {f"null {c}": F.col(c).isNull() for c in columns}


def reasons_of(checks: Mapping[str, Column]) -> Column:
    """The names of the checks that find something wrong; a condition that is NULL finds nothing."""
    return F.array_compact(F.array(*[F.when(wrong, F.lit(name)) for name, wrong in checks.items()]))


def write_checked(rows: DataFrame, out: str, checks: Mapping[str, Column]) -> dict[str, int]:
    """Writes rows that pass to ``out/refused=false`` and the others, with their ``reasons``, to ``out/refused=true``.

    One pass: the counts that are returned (``rows``, ``refused``, and one for every check) are collected by the
    job that writes.  A row that fails several checks counts in each.
    """
    if not checks or {"rows", "refused"} & set(checks):
        raise ValueError("checks must have names of their own")
    seen = Observation()
    judged = rows.withColumn("reasons", reasons_of(checks)).withColumn("refused", F.size("reasons") > 0)
    counted = judged.observe(
        seen, F.count("*").alias("rows"), F.count_if("refused").alias("refused"),
        *[F.count_if(F.array_contains("reasons", name)).alias(name) for name in checks],
    )
    counted.write.mode("overwrite").partitionBy("refused").parquet(out)
    return dict(seen.get)


def read_checked(rows: DataFrame, out: str, refused: bool = False) -> DataFrame:
    """What ``write_checked`` wrote of frames like ``rows``: those that passed, or those refused with ``reasons``."""
    spark = rows.sparkSession
    schema = rows.select("*", F.lit(None).cast("array<string>").alias("reasons"), F.lit(None).cast("boolean").alias("refused")).schema
    found = spark.read.schema(schema).parquet(out).where(F.col("refused") == refused).drop("refused")
    return found if refused else found.drop("reasons")
