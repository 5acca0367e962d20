"""Vocabulary tables ``(token BINARY, token_id INT, is_special BOOLEAN)``."""

from __future__ import annotations

import base64

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.constants import ID_LIMIT
from pairloom.functions.encoding import SPECIAL_TOKENS

SCHEMA = "token binary, token_id int, is_special boolean"


def read_ranks(spark: SparkSession, path: str) -> DataFrame:
    """Base ranks from a text file of ``base64-token rank`` lines."""
    fields = F.split("value", " ")
    return spark.read.text(path).where(F.col("value") != "").select(
        F.unbase64(fields[0]).alias("token"),
        fields[1].cast("int").alias("token_id"),
        F.lit(False).alias("is_special"),
    )


def with_special_tokens(base: DataFrame) -> DataFrame:
    """The base ranks plus the special tokens."""
    specials = base.sparkSession.createDataFrame(
        [(bytearray(t.encode()), i, True) for t, i in SPECIAL_TOKENS.items()], SCHEMA
    )
    return base.unionByName(specials)


def ranks_of(vocabulary: DataFrame) -> dict[bytes, int]:
    """Base ranks on the driver; a vocabulary is bounded by the 16-bit id range."""
    rows = (
        vocabulary.where(~F.col("is_special")).select("token", "token_id")
        .limit(ID_LIMIT + 1).collect()
    )
    if len(rows) > ID_LIMIT:
        raise ValueError(f"a vocabulary has at most {ID_LIMIT} ids")
    return {bytes(r.token): r.token_id for r in rows}


def installed_ranks_path() -> str | None:
    """The file of 50,256 byte-pair ranks, where its package is installed."""
    try:
        import public_tokenizers
    except ImportError:
        return None
    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def decode_ranks_file(path: str) -> dict[bytes, int]:
    """The same ranks read without Spark, for a file that only the driver has."""
    with open(path, "rb") as lines:
        return {
            base64.b64decode(token): int(rank) for token, rank in (x.split() for x in lines if x.strip())
        }
