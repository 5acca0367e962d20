"""Slices of splits, written as text: ``train[:50%]``, ``train[10:20]+validation[-10%:]``.

A bound is a number of rows or a percentage, which is rounded half to even; a negative one counts from the end; without one the
slice goes to the split's border; bounds beyond it are the border.  Parts of a sum follow each
other in the order they are written, and may overlap.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from fractions import Fraction
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.sources import file_index

_BOUND = r"\s*(-?\d+(?:\.\d+)?%|-?\d+)?\s*"
_PART = re.compile(rf"\s*([\w.-]+?)\s*(?:\[{_BOUND}:{_BOUND}\])?\s*")


@dataclass(frozen=True)
class Slice:
    """A split and its bounds as written, None for the border."""

    split: str
    start: str | None = None
    stop: str | None = None

    def rows(self, n: int) -> tuple[int, int]:
        """First row and the row after the last, of ``n``."""
        first, last = _bound(self.start, n, 0), _bound(self.stop, n, n)
        return first, max(first, last)


def _bound(text: str | None, n: int, border: int) -> int:
    if text is None:
        return border
    # a Fraction is exact, and rounds half to even
    at = round(Fraction(text[:-1]) * n / 100) if text.endswith("%") else int(text)
    return min(max(at + n if text.startswith("-") else at, 0), n)


def parse_slices(expression: str) -> list[Slice]:
    """The parts of a sum of slices, in order."""
    found = [_PART.fullmatch(part) for part in expression.split("+")]
    if not all(found):
        raise ValueError(f"not a slice of a split: {expression!r}")
    return [Slice(*m.groups()) for m in found]


def read_slices(
    spark: SparkSession,
    indexes: Mapping[str, str],
    expression: str,
    columns: Sequence[str],
    idx: str = "idx",
    total: str = "n_rows",
) -> DataFrame:
    """The rows of a sum of slices, numbered from 0, with their ``split``.

    ``indexes`` has the file index of every split.  Files without a wanted row are not opened.
    """
    parts = parse_slices(expression)
    unknown = sorted({p.split for p in parts} - set(indexes))
    if unknown:
        raise ValueError(f"no split {unknown} among {sorted(indexes)}")
    sizes = {s: file_index.indexed_rows(file_index.manifest(spark, indexes[s])) for s in {p.split for p in parts}}
    frames, before = [], 0
    for part in parts:
        first, last = part.rows(sizes[part.split])
        rows = file_index.read_rows(spark, indexes[part.split], columns, first, last, idx, total)
        frames.append(rows.withColumns({idx: F.col(idx) + F.lit(before - first), "split": F.lit(part.split)}))
        before += last - first
    return reduce(DataFrame.unionByName, frames).withColumn(total, F.lit(before).cast("bigint"))
