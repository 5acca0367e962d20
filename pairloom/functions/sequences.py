"""Lists of ids: labels, masks, padding, shifting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pairloom.constants import (
    END_OF_PROMPT_ID,
    END_OF_TEXT_ID,
    ID_LIMIT,
    IGNORED_LABEL,
)


def _as_column(value: int | Column) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def mask_labels(prefix_ids: Column, answer_ids: Column) -> Column:
    """Labels of one row: the prefix does not count, the answer does."""
    return F.concat(F.array_repeat(F.lit(IGNORED_LABEL), F.size(prefix_ids)), answer_ids)


def pad_or_truncate(
    ids: Column, length: int | Column, fill: int = END_OF_TEXT_ID
) -> Column:
    """Exactly ``length`` entries: the head of a long list, a filled up short one."""
    length = _as_column(length)
    missing = length - F.size(ids)
    return F.when(
        missing > 0, F.concat(ids, F.array_repeat(F.lit(fill), missing))
    ).otherwise(F.slice(ids, F.lit(1), length))


def attention_mask(count: Column, length: int | Column) -> Column:
    """1 for every real id among the first ``length``, then 0."""
    length = _as_column(length)
    return F.concat(
        F.array_repeat(F.lit(1), F.least(count, length)),
        F.array_repeat(F.lit(0), length - count),
    )


def pad_or_cut_with_end(
    ids: Column, length: int, end_id: int = END_OF_PROMPT_ID
) -> Column:
    """Exactly ``length`` ids; a list that was cut or filled ends with ``end_id``."""
    n = F.size(ids)
    cut = F.concat(F.slice(ids, 1, length - 1), F.array(F.lit(end_id)))
    filled = F.concat(ids, F.array_repeat(F.lit(end_id), F.lit(length) - n))
    return F.when(n > length, cut).when(n < length, filled).otherwise(ids)


def out_of_range(ids: Column, limit: int = ID_LIMIT) -> Column:
    """How many ids do not lie in ``[0, limit)``."""
    return F.size(F.filter(ids, lambda i: (i < 0) | (i >= limit)))


def all_in_range(ids: Column, limit: int = ID_LIMIT) -> Column:
    """Whether ids are there and none lies outside ``[0, limit)``; it looks at every id, but lists none."""
    bounds = (F.array_min(ids) >= 0) & (F.array_max(ids) < limit)
    return ids.isNotNull() & F.coalesce(bounds, F.lit(True))


def shifted_pairs(scores: Column, labels: Column) -> Column:
    """Score at position t beside the label at t+1; the last score has no label."""
    count = F.greatest(F.size(labels) - 1, F.lit(0))
    return F.arrays_zip(
        F.slice(scores, F.lit(1), count).alias("score"),
        F.slice(labels, F.lit(2), count).alias("label"),
    )


def lookup_label(label: Column) -> Column:
    """An ignored label is looked up as id 0; its score is masked away later."""
    return F.when(label == IGNORED_LABEL, F.lit(0)).otherwise(label)
