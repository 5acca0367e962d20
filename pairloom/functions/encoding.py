"""Text to token ids and back.

An encoder turns a string column into ``ARRAY<INT>`` (``encoder(col)``) and a
constant string into a literal array (``encoder.constant(text)``), so that the
template pieces are encoded once on the driver and not again for every row.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.constants import (
    BPE_PATTERN,
    END_OF_PROMPT,
    END_OF_PROMPT_ID,
    END_OF_TEXT,
    END_OF_TEXT_ID,
    ID_LIMIT,
    PAD,
    PAD_ID,
)
from pairloom.functions.templates import Segment

# Word pieces for whole-piece lookup; a leading " ?" keeps one blank in front.
PIECE_PATTERN = r" ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+"

SPECIAL_TOKENS = {
    END_OF_TEXT: END_OF_TEXT_ID,
    END_OF_PROMPT: END_OF_PROMPT_ID,
    PAD: PAD_ID,
}


def int_array(values: Sequence[int]) -> Column:
    return F.array(*[F.lit(int(v)) for v in values]).cast("array<int>")


class ByteEncoder:
    """One id per UTF-8 byte, computed by Spark expressions alone."""

    native = True

    def __call__(self, text: Column) -> Column:
        # Latin-1 maps every byte to the character with the same code point.
        one_char_per_byte = F.decode(F.encode(text, "UTF-8"), "ISO-8859-1")
        ids = F.transform(F.split(one_char_per_byte, ""), lambda c: F.ascii(c))
        return F.when(text == "", int_array([])).otherwise(ids)

    def constant(self, text: str) -> Column:
        return int_array(list(text.encode("utf-8")))


class ArrowByteEncoder(ByteEncoder):
    """The same ids made in Arrow batches: for whole texts, where one string for every byte takes the time."""

    native = False

    def __init__(self) -> None:
        self._udf = _bytes_udf()

    def __call__(self, text: Column) -> Column:
        return self._udf(text)


def _bytes_udf() -> Callable[[Column], Column]:
    def spell(texts: pa.Array) -> pa.Array:
        spelled = texts.cast(pa.binary()).fill_null(b"")
        ends = np.cumsum(np.concatenate([[0], pc.binary_length(spelled).to_numpy()]), dtype=np.int32)
        joined = pc.binary_join(pa.ListArray.from_arrays([0, len(spelled)], spelled), b"")[0].as_py()
        return pa.ListArray.from_arrays(
            pa.array(ends), pa.array(np.frombuffer(joined, np.uint8).astype(np.int32)),
            mask=texts.is_null() if texts.null_count else None,
        )

    spell.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    return F.arrow_udf(spell, "array<int>")


class BpeEncoder:
    """Byte-pair ids of any given encoding; special-token text is ordinary text.

    The encoding is broadcast: its size is bounded by the 16-bit id range, and a
    Python worker builds it once for all its tasks.
    """

    native = False

    def __init__(self, spark: SparkSession, encoding: tiktoken.Encoding) -> None:
        if encoding.n_vocab > ID_LIMIT:
            raise ValueError(f"ids up to {encoding.max_token_value} do not fit below {ID_LIMIT}")
        self._encoding = encoding
        self._udf = _bpe_udf(spark.sparkContext.broadcast(encoding))

    def __call__(self, text: Column) -> Column:
        return self._udf(text)

    def constant(self, text: str) -> Column:
        return int_array(self._encoding.encode_ordinary(text))

    def vocabulary(self) -> Column:
        """Token bytes by id, for :func:`decode_ids`."""
        by_id = {}
        for i in range(self._encoding.n_vocab):
            try:
                by_id[i] = self._encoding.decode_single_token_bytes(i).hex()
            except KeyError:  # an id that is not used
                continue
        return _hex_literal(by_id)


def build_encoding(ranks: Mapping[bytes, int]) -> tiktoken.Encoding:
    """The encoding of a ranks table, with the fixed pattern and special tokens."""
    return tiktoken.Encoding(
        name="pairloom",
        pat_str=BPE_PATTERN,
        mergeable_ranks=dict(ranks),
        special_tokens=SPECIAL_TOKENS,
    )


def _bpe_udf(encoding: Broadcast) -> Callable[[Column], Column]:
    # The nested function travels by value, so executors need only tiktoken.
    def encode_batch(texts: pa.Array) -> pa.Array:
        encode = encoding.value.encode_to_numpy
        none = np.zeros(0, np.uint32)
        # no special token is allowed and none is refused: their text is ordinary
        ids = [
            none if t is None else encode(t, allowed_special=set(), disallowed_special=())
            for t in texts.to_pylist()
        ]
        ends = np.cumsum([0, *map(len, ids)], dtype=np.int32)
        return pa.ListArray.from_arrays(
            pa.array(ends),
            pa.array(np.concatenate([none, *ids]).astype(np.int32)),
            mask=texts.is_null() if texts.null_count else None,
        )

    encode_batch.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    return F.arrow_udf(encode_batch, "array<int>")


class WordEncoder:
    """Whole-piece lookup; a piece that is not in the vocabulary becomes its bytes.

    Spark splits the text; the lookup runs on whole Arrow batches, so no token ever
    becomes a row and nothing is shuffled.
    """

    native = False

    def __init__(self, spark: SparkSession, words: Mapping[str, int]) -> None:
        if len(words) > ID_LIMIT or any(not 0 <= i < ID_LIMIT for i in words.values()):
            raise ValueError(f"token ids must lie in [0, {ID_LIMIT})")
        self._spark = spark
        self._udf = _lookup_udf(
            spark.sparkContext.broadcast(
                (pa.array(list(words), pa.string()), np.array(list(words.values()), np.int32))
            )
        )

    def __call__(self, text: Column) -> Column:
        return self._udf(pieces(text))

    def constant(self, text: str) -> Column:
        return int_array(self._spark.range(1).select(self(F.lit(text))).first()[0])


def _lookup_udf(words: Broadcast) -> Callable[[Column], Column]:
    def look_up(rows: pa.Array) -> pa.Array:
        known, ids = words.value
        flat = rows.flatten()
        place = pc.index_in(flat, value_set=known)
        missing = place.is_null().to_numpy(zero_copy_only=False)
        place = place.fill_null(0).to_numpy()
        spelled = flat.filter(pa.array(missing)).cast(pa.binary())
        lengths = pc.binary_length(spelled).to_numpy()
        width = np.ones(len(flat), np.int64)
        width[missing] = lengths
        ends = np.concatenate([[0], np.cumsum(width)])
        out = np.empty(ends[-1], np.int32)
        out[ends[:-1][~missing]] = ids[place[~missing]]
        # bytes of the missing pieces: place of each piece, then of each byte in it
        first = np.repeat(ends[:-1][missing] - np.cumsum(lengths) + lengths, lengths)
        # joined by Arrow: a Python object for every missing piece took most of the time
        joined = pc.binary_join(pa.ListArray.from_arrays([0, len(spelled)], spelled), b"")[0].as_py()
        out[first + np.arange(lengths.sum())] = np.frombuffer(joined, np.uint8)
        sizes = rows.value_lengths().fill_null(0).to_numpy()
        borders = ends[np.concatenate([[0], np.cumsum(sizes)])].astype(np.int32)
        return pa.ListArray.from_arrays(
            pa.array(borders), pa.array(out), mask=rows.is_null() if rows.null_count else None
        )

    look_up.__annotations__ = {"rows": pa.Array, "return": pa.Array}
    return F.arrow_udf(look_up, "array<int>")


Encoder = ByteEncoder | BpeEncoder | WordEncoder


def encode_segments(segments: Sequence[Segment], encoder: Encoder) -> Column:
    """Ids of each segment on its own, joined in order."""
    return F.concat(
        *[encoder.constant(s) if isinstance(s, str) else encoder(s) for s in segments]
    )


def pieces(text: Column) -> Column:
    """Word pieces; they cover the text completely."""
    return F.regexp_extract_all(text, F.lit(PIECE_PATTERN), F.lit(0))


def join_vocabulary(tokens: DataFrame, vocabulary: DataFrame, piece: str = "piece") -> DataFrame:
    """Adds ``token_id`` to rows that hold one piece each; NULL if it is not known.

    ``vocabulary`` holds ``token`` and a unique ``token_id`` below ``ID_LIMIT``,
    which bounds what is broadcast; both are checked before.
    """
    held = vocabulary.select("token", "token_id").limit(ID_LIMIT + 1)
    n, n_tokens, n_ids = held.agg(F.count("*"), F.countDistinct("token"), F.countDistinct("token_id")).first()
    if n > ID_LIMIT or not n == n_tokens == n_ids:
        raise ValueError(f"a vocabulary has at most {ID_LIMIT} rows, and each token and id once")
    token_id = F.col("token_id").cast("int")
    by_piece = vocabulary.select(
        F.col("token").alias(piece),
        F.when(token_id.between(0, ID_LIMIT - 1), token_id).otherwise(
            F.raise_error(F.lit(f"a token id is not in [0, {ID_LIMIT})"))
        ).alias("token_id"),
    )
    return tokens.join(F.broadcast(by_piece), piece, "left")


def vocabulary_literal(vocabulary: DataFrame) -> Column:
    """The token bytes (hex) by id as one literal array, for lookups without a join.

    The table is bounded by ``ID_LIMIT`` rows; that is checked before it is used.
    """
    rows = vocabulary.select(
        F.col("token_id").cast("int").alias("token_id"), F.hex("token").alias("token")
    ).limit(ID_LIMIT + 1).collect()
    if len(rows) > ID_LIMIT or any(not 0 <= r.token_id < ID_LIMIT for r in rows):
        raise ValueError(f"token ids must lie in [0, {ID_LIMIT})")
    return _hex_literal({r.token_id: r.token for r in rows})


def _hex_literal(by_id: Mapping[int, str]) -> Column:
    joined = ",".join(by_id.get(i, "") for i in range(max(by_id, default=-1) + 1))
    return F.split(F.lit(joined), ",")


def decode_ids(ids: Column, vocabulary: Column) -> Column:
    """Text of a list of ids; bytes that are no valid UTF-8 become U+FFFD."""
    spelled = F.array_join(F.transform(ids, lambda i: F.get(vocabulary, i)), "")
    return F.make_valid_utf8(F.unhex(spelled).cast("string"))
