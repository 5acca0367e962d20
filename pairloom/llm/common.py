"""Small helpers the operators share: stored tables, word hashes, learning folds."""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.scratch import new_path

#: Code points that separate words: blank, tab, line feed, vertical tab, form feed, return.
SPACES = " \t\n\x0b\x0c\r"
#: Rows of text are hashed in slices of about this many bytes; a longer text is cut between words.
SLICE_BYTES = 1 << 18
#: Rows go to Python workers and come back in batches of about this many bytes; a longer text is a batch.
BATCH_BYTES = 8 << 20

_ODD = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0x5851F42D4C957F2D  # odd, 5 modulo 8: its powers have the longest period
_STEPS = np.array(
    [0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB],
    dtype=np.uint64,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> str:
    """From now on the session's Arrow batches have a bound that suits rows of text, since both sides of a worker hold one; returns the last bound."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, BATCH_BYTES)
    return before


def stored(df: DataFrame, name: str) -> DataFrame:
    """The frame written once to the shared folder and read back: its lineage ends there."""
    spark = df.sparkSession
    path = new_path(spark, name)
    before = small_batches(spark)
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", before)
    return spark.read.schema(df.schema).parquet(path)


def give_back() -> None:
    """Memory that is free goes back to the system: a worker waits between tasks, and may wait long."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the C library on Linux
    if trim:
        trim(0)


def frugal(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """The same function over a task's batches, which gives memory back at the end."""

    @functools.wraps(run)
    def task(batches: Iterator) -> Iterator:
        yield from run(batches)
        give_back()

    return task


def shuffle_tasks(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def id_remainder(doc_id: Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % divisor


def mix(x: np.ndarray) -> np.ndarray:
    """A fixed bijection of 64-bit values in which every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@functools.cache
def _kept_powers() -> tuple[np.ndarray, np.ndarray]:
    return _new_powers(2 * SLICE_BYTES)


def _new_powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    found = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        powers = np.full(n, base, np.uint64)
        powers[0] = 1
        found.append(np.multiply.accumulate(powers, out=powers))
    return found[0], found[1]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """At least ``n`` powers of the base and of its inverse modulo 2**64; only those that a slice needs are kept."""
    return _kept_powers() if n <= 2 * SLICE_BYTES else _new_powers(n)


def _byte_values() -> np.ndarray:
    values = mix(np.arange(1, 257, dtype=np.uint64) * _ODD)
    values[ord("A"):ord("Z") + 1] = values[ord("a"):ord("z") + 1]
    return values


_VALUES = _byte_values()
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[ord(c) for c in SPACES]] = True


def text_slices(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Slices of a text column: first row, the bytes, and where each text begins and the last ends."""
    column = pc.fill_null(texts, b"" if pa.types.is_large_binary(texts.type) else "").cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    row = 0
    while row < len(column):
        stop = int(np.searchsorted(offsets, offsets[row] + SLICE_BYTES, "right")) - 1
        stop = min(max(stop, row + 1), len(column))
        yield row, data[offsets[row]:offsets[stop]], offsets[row:stop + 1] - offsets[row]
        row = stop


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of every word of the texts (A-Z as a-z), and where each text's words begin.

    A word's hash is a polynomial over random byte values, taken as a difference of
    running sums, so all words of a slice are hashed at once.  One long text is hashed part by part.
    """
    if len(offsets) == 2 and len(data) > 2 * SLICE_BYTES:
        found = [_slice_hashes(part, np.array([0, len(part)]))[0] for part in _parts(data)]
        return np.concatenate(found), np.array([0, sum(map(len, found))])
    return _slice_hashes(data, offsets)


def _slice_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    bounds = np.zeros(len(offsets), np.int64)
    if len(data) == 0:
        return np.zeros(0, np.uint64), bounds
    up, down = _powers(len(data))
    letter = ~_IS_SPACE[data]
    first = letter.copy()
    first[1:] &= ~letter[:-1]
    heads = offsets[:-1][offsets[:-1] < offsets[1:]]
    first[heads] = letter[heads]
    last = letter.copy()
    last[:-1] &= ~letter[1:]
    tails = heads[1:] - 1
    last[tails] = letter[tails]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_VALUES[data] * up[:len(data)], out=sums[1:])
    hashes = (sums[ends] - sums[starts]) * down[starts]
    bounds[:] = np.searchsorted(starts, offsets)
    return mix(hashes + (ends - starts).astype(np.uint64) * _ODD), bounds


def _parts(data: np.ndarray) -> Iterator[np.ndarray]:
    """A text in parts of ``SLICE_BYTES`` and the rest of their last word."""
    start = 0
    while start < len(data):
        stop = start + SLICE_BYTES
        while stop < len(data):
            spaces = np.flatnonzero(_IS_SPACE[data[stop:stop + 4096]])
            if len(spaces):
                stop += int(spaces[0])
                break
            stop += 4096
        yield data[start:stop]
        start = stop


def shingle_sets(texts: pa.Array, size: int = 5) -> Iterator[np.ndarray]:
    """Per text the sorted distinct hashes of its word windows of ``size`` words.

    With fewer words the whole sequence is one window; without words the set is empty.
    """
    steps = mix(np.arange(1, size + 1, dtype=np.uint64) * _STEPS[0]) | np.uint64(1)
    for _, data, offsets in text_slices(texts):
        words, bounds = word_hashes(data, offsets)
        n = max(0, len(words) - size + 1)
        windows = np.zeros(n, np.uint64)
        for i in range(size):
            windows += words[i:i + n] * steps[i]
        windows = mix(windows)
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            if b - a >= size:
                one = np.sort(windows[a:b - size + 1])
                keep = np.ones(len(one), bool)
                np.not_equal(one[1:], one[:-1], out=keep[1:])
                yield one[keep]
            elif b > a:
                whole = np.sum(words[a:b] * steps[:b - a], dtype=np.uint64) + np.uint64(b - a)
                yield mix(np.array([whole]) ^ _STEPS[1])
            else:
                yield np.zeros(0, np.uint64)
