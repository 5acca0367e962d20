"""Importance resampling towards a target: documents whose word runs look like the target's are drawn first.

A text's features are its runs of 1 to ``longest`` consecutive words, joined by one blank; a feature's
bucket is its CRC-32 modulo ``buckets``.  No run is put together as text.  Texts are read in blocks: a block's
distinct words, each between two blanks, make up an Aho-Corasick automaton whose matches carry the word's CRC and
length; one scan gives the payloads of all words in order, and the CRC of a longer run is composed
of those of its neighbours (a CRC is linear, so its first part only has to be moved by the length of what follows).

The buckets of each text are written once, packed.  Their counts over all documents and over the target
texts give each bucket a gain, and a document's weight is the floored mean gain of its features.  Noise of the
Gumbel distribution from a hash of its id turns the weight into a score, and the highest scores are a
draw without replacement.  What the driver holds are two counts a bucket; ranks come from key ranges.

Blocks hold at most ``BLOCK_BYTES`` (a longer text is cut between words, or lies in one block if it has
no blank), an automaton's words at most ``WORD_BYTES``: a longer word stands in the
block under a short name that no text can hold, with the CRC and length of the whole word.

Defined cases: a null text, an empty one and one of separators have no features, weight 0 and a score from noise alone;
a null id is hashed as the empty text and comes last among ties; repeated rows are ranked one after the
other; an empty table gives no rows, an empty target counts as 0 in every bucket; other columns are not touched.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.llm.common import stored
from pairloom.operators.ordering import dense_index

BUCKETS = 10_000
LONGEST_RUN = 1
SEED = 2024
LEAST_WORDS = 20
PERCENT = 10
MAX_BUCKETS = 1 << 20  # two counts of each come to the driver

BLOCK_BYTES = 8 << 20
WORD_BYTES = 64
BLANK = ord(" ")


def _separators() -> bytes:
    """Byte map: A-Z as a-z, and every ASCII character but letters and digits as a blank."""
    one = [ord(chr(i).lower()) if chr(i).isalnum() else BLANK for i in range(128)]
    return bytes(one + list(range(128, 256)))


NORMAL = _separators()


@lru_cache(maxsize=512)
def _moved_by(length: int) -> np.ndarray:
    """4 x 256 table: what each byte of a CRC becomes when ``length`` bytes follow.

    For bytes of zeros, crc(x + zeros) ^ crc(zeros) is linear in the CRC of x; the images of the
    32 single bits come from squaring the map of one zero bit.
    """
    def times(matrix: list[int], vector: int) -> int:
        total, i = 0, 0
        while vector:
            if vector & 1:
                total ^= matrix[i]
            vector >>= 1
            i += 1
        return total

    power = [0xEDB88320] + [1 << i for i in range(31)]  # one zero bit
    result = [1 << i for i in range(32)]
    bits = 8 * length
    while bits:
        if bits & 1:
            result = [times(power, column) for column in result]
        power = [times(power, column) for column in power]
        bits >>= 1
    table = np.zeros((4, 256), np.uint32)
    for byte in range(4):
        for value in range(256):
            table[byte, value] = times(result, value << 8 * byte)
    return table


def composed(first: np.ndarray, second: np.ndarray, length: np.ndarray) -> np.ndarray:
    """CRCs of joined texts from the CRCs of the two parts and the length of the second."""
    out = second.copy()
    order = np.argsort(length, kind="stable")
    at = np.flatnonzero(np.diff(length[order], prepend=-1))
    for a, b in zip(at.tolist(), [*at[1:].tolist(), len(order)]):
        rows = order[a:b]
        table, crc = _moved_by(int(length[rows[0]])), first[rows]
        for byte in range(4):
            out[rows] ^= table[byte][(crc >> np.uint32(8 * byte)) & np.uint32(255)]
    return out


def _blocks(texts: list[bytes]) -> Iterator[list[tuple[int, bytes]]]:
    """(text, part) lists of at most ``BLOCK_BYTES``; texts are cut at blanks."""
    block, size = [], 0
    for i, text in enumerate(texts):
        start = 0
        while start < len(text):
            room = BLOCK_BYTES - size
            if len(text) - start <= room:
                stop = len(text)
            elif size:
                yield block
                block, size = [], 0
                continue
            else:
                stop = text.rfind(b" ", start, start + room) + 1
                if stop <= start:
                    stop = text.find(b" ", start + room) + 1 or len(text)
            block.append((i, text[start:stop]))
            size += stop - start
            start = stop
    if block:
        yield block


def payloads(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per word of all texts, in order: its text's number, its CRC, its length."""
    owners, crcs, lengths = [], [], []
    for block in _blocks([t.translate(NORMAL) for t in texts]):
        joined = b" " + b" ".join(part for _, part in block) + b" "
        inside = np.frombuffer(joined, np.uint8) != BLANK
        starts = np.flatnonzero(inside[1:] & ~inside[:-1]) + 1
        ends = np.flatnonzero(inside[:-1] & ~inside[1:]) + 1
        if not len(starts):
            continue
        firsts = np.cumsum([1] + [len(part) + 1 for _, part in block[:-1]])
        part_of = np.searchsorted(firsts, starts, "right") - 1
        owners.append(np.array([i for i, _ in block])[part_of])
        names = {}
        for w in np.flatnonzero(ends - starts > WORD_BYTES).tolist():
            word = joined[starts[w]:ends[w]]
            names.setdefault(word, (b"\x01%d" % len(names), zlib.crc32(word) | len(word) << 32, []))[2].append(w)
        if names:
            joined = _renamed(joined, starts, ends, names)
        payload = _scanned(joined, {name: value for name, value, _ in names.values()})
        if len(payload) != len(starts):
            raise AssertionError(f"{len(payload)} matches for {len(starts)} words")
        crcs.append((payload & np.uint64(0xFFFFFFFF)).astype(np.uint32))
        lengths.append((payload >> np.uint64(32)).astype(np.int64))
    if not owners:
        return np.zeros(0, np.int64), np.zeros(0, np.uint32), np.zeros(0, np.int64)
    return np.concatenate(owners), np.concatenate(crcs), np.concatenate(lengths)


def _renamed(joined: bytes, starts: np.ndarray, ends: np.ndarray, names: dict) -> bytes:
    """The block with each long word under its short name."""
    places = sorted((w, name) for name, _, found in names.values() for w in found)
    out, at = [], 0
    for w, name in places:
        out += [joined[at:starts[w]], name]
        at = ends[w]
    return b"".join([*out, joined[at:]])


def _scanned(joined: bytes, long_words: dict[bytes, int]) -> np.ndarray:
    """Payloads that an automaton of the block's distinct words gives out over the block."""
    automaton = ahocorasick.Automaton()
    for word in set(joined.split()):
        value = long_words.get(word)
        automaton.add_word(f" {word.decode('latin-1')} ", zlib.crc32(word) | len(word) << 32 if value is None else value)
    automaton.make_automaton()
    return np.fromiter((value for _, value in automaton.iter(joined.decode("latin-1"))), np.uint64)


def run_buckets(owner: np.ndarray, crc: np.ndarray, length: np.ndarray, longest: int, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text, bucket) of all runs, one length of runs after the other."""
    run = crc
    yield owner, run % np.uint32(buckets)
    blank = np.uint32(zlib.crc32(b" "))
    for words in range(2, longest + 1):
        n = max(0, len(crc) - words + 1)
        same = owner[:n] == owner[words - 1:words - 1 + n]
        spaced = composed(run[:n], np.full(n, blank), np.ones(n, np.int64))
        run = composed(spaced, crc[words - 1:words - 1 + n], length[words - 1:words - 1 + n])
        yield owner[:n][same], run[same] % np.uint32(buckets)


def with_buckets(df: DataFrame, key: list[str], text: str, longest: int = LONGEST_RUN, buckets: int = BUCKETS) -> DataFrame:
    """``key`` columns with ``n_words``, ``n_features`` and the buckets of all features, packed as 32-bit numbers."""
    rows = df.select(*key, F.col(text).cast("binary").alias("_text"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("_text")
            kept = batch.select(key)
            for a, b in _row_slices(column):
                texts = [t.as_py() or b"" for t in column.slice(a, b - a)]
                owner, crc, length = payloads(texts)
                runs = list(run_buckets(owner, crc, length, longest, buckets))
                owners = np.concatenate([o for o, _ in runs])
                order = np.argsort(owners, kind="stable")
                values = np.concatenate([v for _, v in runs])[order].astype("<u4")
                n_features = np.bincount(owners, minlength=len(texts))
                ends = np.concatenate(([0], np.cumsum(n_features)))
                packed = [values[x:y].tobytes() for x, y in zip(ends[:-1], ends[1:])]
                yield pa.RecordBatch.from_arrays(
                    [*kept.slice(a, b - a).columns, pa.array(np.bincount(owner, minlength=len(texts)), pa.int64()),
                     pa.array(n_features, pa.int64()), pa.array(packed, pa.binary())],
                    names=[*key, "n_words", "n_features", "features"],
                )

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return rows.mapInArrow(read, f"{schema}{', ' if key else ''}n_words bigint, n_features bigint, features binary")


def _row_slices(column: pa.Array) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``BLOCK_BYTES`` of text."""
    start, size = 0, 0
    for i, text in enumerate(column):
        size += len(text.as_buffer()) if text.is_valid else 0
        if size >= BLOCK_BYTES:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(column):
        yield start, len(column)


def bucket_counts(features: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Features per bucket over all rows; tasks count on their own, so a hot bucket is ``tasks`` rows."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for packed in batch.column(0):
                if packed.is_valid:
                    total += np.bincount(np.frombuffer(packed.as_buffer(), "<u4"), minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at])], names=["bucket", "n"])

    counted = features.select("features").mapInArrow(count, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for row in counted.limit(buckets).collect():
        out[row.bucket] = row.n
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of smoothed shares, floored."""
    s, t, b = corpus.astype(float), target.astype(float), float(len(corpus))
    return np.floor(1000 * np.log((t + 1) * (s.sum() + b) / ((s + 1) * (t.sum() + b)))).astype(np.int64)


def with_weight(features: DataFrame, gain: np.ndarray) -> DataFrame:
    """The rows with ``weight``, the floored mean gain of their features (0 without any), in place of the features."""
    names = [f.name for f in features.schema.fields if f.name != "features"]

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.frombuffer(p.as_buffer(), "<u4") for p in batch.column("features")]
            weight = [int(gain[f].sum()) // len(f) if len(f) else 0 for f in found]
            yield pa.RecordBatch.from_arrays([*batch.select(names).columns, pa.array(weight, pa.int64())], names=[*names, "weight"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in features.schema.fields if f.name != "features")
    return features.mapInArrow(weigh, f"{schema}, weight bigint")


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """Gumbel noise in thousandths, floored, from the first 32 bits of sha256(``seed:doc_id``)."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")
    return F.floor(-1000 * F.ln(-F.ln((h + 0.5) / 4294967296.0)))


def resampled(
    docs: DataFrame,
    target: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    target_text: str = "text",
    longest: int = LONGEST_RUN,
    buckets: int = BUCKETS,
    least_words: int = LEAST_WORDS,
    percent: int = PERCENT,
    seed: int = SEED,
) -> DataFrame:
    """Every document with ``n_features``, ``weight``, ``score`` and, if drawn, its ``rank`` from 1.

    Of the documents with at least ``least_words`` words ``percent`` in a hundred are drawn, ties to the smaller id.
    """
    if not 1 <= buckets <= MAX_BUCKETS:
        raise ValueError(f"buckets must be 1 to {MAX_BUCKETS}")
    features = stored(with_buckets(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("_said")), ["doc_id"], "_said", longest, buckets), "features")
    wanted = with_buckets(target.select(F.col(target_text).alias("_said")), [], "_said", longest, buckets)
    gain = gains(bucket_counts(features, buckets), bucket_counts(wanted, buckets))
    scored = with_weight(features, gain).withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))
    scored = stored(scored, "scored")
    result = ["doc_id", "n_features", "weight", "score"]
    # (file, place) makes the key of repeated rows unique; stored files do not change
    ranked = dense_index(
        scored.where(F.col("n_words") >= least_words).select(
            *result, (-F.col("score")).alias("_last"), F.col("doc_id").isNull().alias("_none"),
            F.coalesce("doc_id", F.lit(0)).alias("_id"), F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_place"),
        ),
        ["_last", "_none", "_id", "_file", "_place"], "_idx", "_n",
    )
    drawn = F.col("_idx") < F.floor(F.col("_n") * percent / F.lit(100)).cast("bigint")
    taken = ranked.select(*result, F.when(drawn, F.col("_idx") + 1).alias("rank"))
    short = scored.where(F.col("n_words") < least_words).select(*result, F.lit(None).cast("bigint").alias("rank"))
    return taken.unionByName(short)
