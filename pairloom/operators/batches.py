"""Samples, dynamic batch lengths and padded batches.

A batch row is ``(rank, batch_id, row_in_batch, [side,] x, mask, y)``; the
training matrix is the rows of a batch sorted by ``row_in_batch``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairloom.constants import BATCH_LENGTH, END_OF_TEXT_ID, IGNORED_LABEL
from pairloom.functions import sequences as S
from pairloom.functions.encoding import Encoder, encode_segments, int_array
from pairloom.functions.templates import Segment, dpo_prefix, sft_prefix

BATCH_KEY = ("rank", "batch_id")
SIDES = ("chosen", "rejected")


def encode_sft(df: DataFrame, encoder: Encoder, append_end: bool = False) -> DataFrame:
    """Adds ``prefix_ids`` and ``answer_ids`` to ``prompt, answer`` rows.

    These two are all that has to travel: ids, labels and masks follow from them.
    """
    answer = encoder(F.col("answer"))
    if append_end:
        answer = F.concat(answer, int_array([END_OF_TEXT_ID]))
    return df.withColumns(
        {
            "prefix_ids": encode_segments(sft_prefix(F.col("prompt")), encoder),
            "answer_ids": answer,
        }
    )


def sft_samples(df: DataFrame, encoder: Encoder, append_end: bool = False) -> DataFrame:
    """``prompt, answer`` rows to ``input_ids, label_ids, attention_mask``."""
    prefix, answer = F.col("prefix_ids"), F.col("answer_ids")
    return encode_sft(df, encoder, append_end).withColumns(
        {
            "input_ids": F.concat(prefix, answer),
            "label_ids": S.mask_labels(prefix, answer),
            "attention_mask": F.array_repeat(F.lit(1), F.size(prefix) + F.size(answer)),
        }
    ).drop("prefix_ids", "answer_ids")


def encode_dpo(df: DataFrame, encoder: Encoder) -> DataFrame:
    """Adds ``prefix_ids``, ``chosen_reply_ids`` and ``rejected_reply_ids``.

    The prompt is encoded once and shared by the two sides.
    """
    return df.withColumns(
        {
            "prefix_ids": encode_segments(dpo_prefix(F.col("prompt")), encoder),
            **{f"{side}_reply_ids": encoder(F.col(side)) for side in SIDES},
        }
    )


def dpo_samples(df: DataFrame, encoder: Encoder) -> DataFrame:
    """``prompt, chosen, rejected`` rows to ids and labels of both sides."""
    prefix = F.col("prefix_ids")
    out = encode_dpo(df, encoder)
    for side in SIDES:
        reply = F.col(f"{side}_reply_ids")
        out = out.withColumns(
            {
                f"{side}_ids": F.concat(prefix, reply),
                f"labels_{side}": S.mask_labels(prefix, reply),
            }
        )
    return out.drop("prefix_ids", *[f"{side}_reply_ids" for side in SIDES])


def prompt_only(df: DataFrame, encoder: Encoder, copies: int = 1) -> DataFrame:
    """Rows to start a generation from: prefix ids without an answer, ``copies`` times."""
    return df.withColumn(
        "input_ids", encode_segments(sft_prefix(F.col("prompt")), encoder)
    ).withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))


def shard_rows(
    df: DataFrame, segments: Sequence[Segment], encoder: Encoder, length: int, end_id: int
) -> DataFrame:
    """Adds ``tokens`` of exactly ``length`` ids and ``length``, the real ids among them."""
    check_power_of_two(length)
    encoded = df.withColumn("_ids", encode_segments(segments, encoder))
    in_range = F.when(S.all_in_range(F.col("_ids")), F.col("_ids")).otherwise(
        F.raise_error(F.lit("a token id does not fit into 16 bits"))
    )
    # a column of its own: the ids are checked once, not at every place where the tokens are made of them
    return (
        encoded.withColumn("_ids", in_range)
        .withColumn("tokens", S.pad_or_cut_with_end(F.col("_ids"), length, end_id))
        .withColumn("length", F.least(F.size("_ids"), F.lit(length)))
        .drop("_ids")
    )


def check_power_of_two(length: int) -> None:
    if length < 1 or length & (length - 1):
        raise ValueError("the sequence length must be a power of 2")


def cut_to_limit(df: DataFrame, limit: int, replies: Sequence[str]) -> DataFrame:
    """Encoded rows with at most ``limit`` ids: the prefix first, then each reply as far as it fits.

    No batch is longer than ``limit``, so the ids beyond it are in no batch; what is left is
    as long as the whole or as ``limit``, hence lengths, masks and padding come out the same.
    """
    cut = df.withColumn("prefix_ids", F.slice("prefix_ids", 1, limit))
    room = F.lit(limit) - F.size("prefix_ids")
    return cut.withColumns({name: F.slice(name, F.lit(1), room) for name in replies})


def longest_length(df: DataFrame, limit: int = BATCH_LENGTH) -> DataFrame:
    """Adds ``batch_len`` to encoded rows: the longest of the batch, at most ``limit``."""
    n = F.size("prefix_ids") + F.size("answer_ids")
    batch = Window.partitionBy(*BATCH_KEY)
    return df.withColumn("batch_len", F.least(F.lit(limit), F.max(n).over(batch)))


def pair_length(
    df: DataFrame, limit: int = BATCH_LENGTH, batch_len: str = "shortest"
) -> DataFrame:
    """Adds ``batch_len`` of a batch of encoded pairs.

    ``shortest`` cuts all pairs to the shortest pair of the batch (a pair is as
    long as its longer side); ``longest`` cuts none but by ``limit``.
    """
    if batch_len not in ("shortest", "longest"):
        raise ValueError("batch_len must be 'shortest' or 'longest'")
    replies = [F.size(f"{side}_reply_ids") for side in SIDES]
    of_pair = F.size("prefix_ids") + F.greatest(*replies)
    over_batch = (F.min if batch_len == "shortest" else F.max)(of_pair)
    return df.withColumn(
        "batch_len",
        F.least(F.lit(limit), over_batch.over(Window.partitionBy(*BATCH_KEY))),
    )


def _padded(prefix: Column, reply: Column, length: Column) -> dict[str, Column]:
    return {
        "x": S.pad_or_truncate(F.concat(prefix, reply), length),
        "mask": S.attention_mask(F.size(prefix) + F.size(reply), length),
        "y": S.pad_or_truncate(S.mask_labels(prefix, reply), length, IGNORED_LABEL),
    }


def sft_batches(df: DataFrame, limit: int = BATCH_LENGTH) -> DataFrame:
    """Pads or cuts every encoded row to the length of its batch."""
    padded = _padded(F.col("prefix_ids"), F.col("answer_ids"), F.col("batch_len"))
    cut = cut_to_limit(df, limit, ["answer_ids"])
    return longest_length(cut, limit).select(
        *BATCH_KEY, "row_in_batch", *[c.alias(name) for name, c in padded.items()]
    )


def interleave(df: DataFrame, *carry: str) -> DataFrame:
    """Two rows per encoded pair: chosen is row ``2 * i``, rejected row ``2 * i + 1``."""
    sides = F.array(
        *[
            F.struct(
                F.lit(side).alias("side"),
                (2 * F.col("row_in_batch") + offset).cast("int").alias("row_in_batch"),
                F.col("row_in_batch").alias("pair_in_batch"),
                F.col(f"{side}_reply_ids").alias("reply_ids"),
            )
            for offset, side in enumerate(SIDES)
        ]
    )
    return df.select(*BATCH_KEY, *carry, "prefix_ids", F.inline(sides))


def dpo_batches(
    df: DataFrame, limit: int = BATCH_LENGTH, batch_len: str = "shortest", carry: Sequence[str] = ()
) -> DataFrame:
    """Pads or cuts both sides of every encoded pair to the length of its batch."""
    padded = _padded(F.col("prefix_ids"), F.col("reply_ids"), F.col("batch_len"))
    cut = cut_to_limit(df, limit, [f"{side}_reply_ids" for side in SIDES])
    return interleave(pair_length(cut, limit, batch_len), "batch_len", *carry).select(
        *BATCH_KEY, *carry, "row_in_batch", "pair_in_batch", "side",
        *[c.alias(name) for name, c in padded.items()],
    )
