"""Datasets: scanning, splits, and columns under their canonical names."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SFT_COLUMNS = {"prompt": "instruction", "answer": "response"}
DPO_COLUMNS = {"prompt": "prompt", "chosen": "chosen", "rejected": "rejected"}
SHARD_COLUMNS = {"query": "query", "response": "response"}


def scan(
    spark: SparkSession,
    path: str | Sequence[str],
    format: str = "parquet",
    schema: str | None = None,
    split: str | None = None,
    split_column: str = "split",
    **options: str,
) -> DataFrame:
    """A named dataset; ``split`` selects the rows of one split and reaches the scan."""
    reader = spark.read.format(format).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.load(path if isinstance(path, str) else list(path))
    return df if split is None else df.where(F.col(split_column) == split)


def map_columns(
    df: DataFrame,
    mapping: Mapping[str, str],
    keep: Sequence[str] = (),
    on_null: str = "fail",
) -> DataFrame:
    """Text columns under canonical names: ``{canonical: source}``.

    A missing column fails when the plan is made.  A NULL fails the job
    (``fail``), or its row is left out (``drop``).
    """
    if on_null not in ("fail", "drop"):
        raise ValueError("on_null must be 'fail' or 'drop'")
    missing = [c for c in (*mapping.values(), *keep) if c not in df.columns]
    if missing:
        raise ValueError(f"no column {missing} among {df.columns}")
    if on_null == "drop":
        df = df.dropna(subset=list(dict.fromkeys(mapping.values())))

    def text(source: str) -> Column:
        if on_null == "drop":
            return F.col(source)
        return F.coalesce(F.col(source), F.raise_error(F.lit(f"NULL in column {source}")))

    return df.select(*keep, *[text(source).alias(name) for name, source in mapping.items()])


def null_rows(
    df: DataFrame, mapping: Mapping[str, str], keep: Sequence[str] = ()
) -> DataFrame:
    """The rows that ``map_columns`` would refuse or drop, with the NULL columns' source names."""
    columns = list(dict.fromkeys(mapping.values()))
    missing = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in columns]))
    return df.select(*keep, missing.alias("null_columns")).where(F.size("null_columns") > 0)


def refuse_nulls(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """``df`` itself if no mapped column holds a NULL; otherwise an error with the number of rows."""
    found = null_rows(df, mapping).count()
    if found:
        raise ValueError(f"{found} rows have a NULL in {sorted(set(mapping.values()))}")
    return df
