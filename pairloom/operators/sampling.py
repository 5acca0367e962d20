"""Drawing the next token from rows of scores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pairloom.functions.scores import softmax, top_k, weighted_draw


def topk_tokens(df: DataFrame, key: Sequence[str], logits: str, k: int = 50) -> DataFrame:
    """The ``k`` most probable ids of each row, one row per id."""
    best = df.select(*key, F.posexplode(top_k(softmax(F.col(logits)), k)).alias("place", "t"))
    return best.select(*key, "place", F.col("t.token_id"), F.col("t.p"))


def topk_rows(
    df: DataFrame, key: Sequence[str], p: str = "p", token: str = "token_id", k: int = 50
) -> DataFrame:
    """The same from one row per id; each task keeps its ``k`` best before the shuffle."""
    order = Window.partitionBy(*key).orderBy(F.desc(p), token)
    ranked = df.withColumn("_place", F.row_number().over(order)).where(F.col("_place") <= k)
    return ranked.select(*key, (F.col("_place") - 1).alias("place"), token, p)


def draw_token(
    df: DataFrame, key: Sequence[str], logits: str, seed: int, k: int = 50
) -> DataFrame:
    """One id of each row, drawn among its ``k`` best by their probability."""
    candidates = top_k(softmax(F.col(logits)), k)
    return df.select(
        *key, weighted_draw(candidates, seed, *[F.col(c) for c in key]).alias("token_id")
    )
