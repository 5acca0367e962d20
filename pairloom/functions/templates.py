"""Prompt templates.

Each template lists its segments, because every segment is tokenized alone and
the ids are concatenated: no token may span a border.  A plain ``str`` segment
is constant, a ``Column`` segment comes from the row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from pairloom.constants import (
    DPO_ANSWER_KEY,
    DPO_PROMPT_KEY,
    SFT_ANSWER_KEY,
    SFT_PROMPT_KEY,
    SHARD_ASSISTANT_FORMAT,
    SHARD_USER_FORMAT,
)

Segment = str | Column


def sft_prefix(prompt: Column) -> list[Segment]:
    return [SFT_PROMPT_KEY, prompt, SFT_ANSWER_KEY]


def dpo_prefix(prompt: Column) -> list[Segment]:
    return [DPO_PROMPT_KEY, prompt, DPO_ANSWER_KEY]


def shard_segments(
    query: Column,
    response: Column,
    user_format: str = SHARD_USER_FORMAT,
    assistant_format: str = SHARD_ASSISTANT_FORMAT,
) -> list[Segment]:
    return [
        user_format,
        F.concat(F.lit(" "), query, F.lit(" ")),
        assistant_format,
        F.concat(F.lit(" "), response),
    ]


def as_text(segments: Sequence[Segment]) -> Column:
    """The text a sequence of segments spells."""
    return F.concat(*[F.lit(s) if isinstance(s, str) else s for s in segments])


def sft_text(prompt: Column, answer: Column) -> Column:
    return as_text([*sft_prefix(prompt), answer])


def dpo_text(prompt: Column, reply: Column) -> Column:
    return as_text([*dpo_prefix(prompt), reply])


def shard_text(query: Column, response: Column, **formats: str) -> Column:
    return as_text(shard_segments(query, response, **formats))
