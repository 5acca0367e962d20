"""Cost-balanced packing: pieces in descending cost go to the cheapest sequence with room.

A piece of n tokens costs ``n + n * n / QUADRATIC`` (linear layers, and attention inside the
piece).  Tokens beyond whole sequences of 2048 are a document's last piece; pools of such
pieces are packed together into as many sequences as their tokens fill.  A piece that fits no
sequence whole is cut: the cheapest sequence with room takes what it can hold.  What does not
fill a last sequence goes into sequences of powers of two, so nothing is padded.

Each task packs its own documents, pool by pool: no document is shuffled, and a task holds
one pool.  The same input split gives the same sequences on every attempt.

Words are encoded once a task and looked up afterwards, as long as they are kept; that is exact, as the tokenizer's
pieces never reach over ASCII white space.

Defined cases: a null or empty text is its end token alone; repeated rows and null ids are
documents of their own; a text longer than a sequence is cut; an empty table gives no rows.
"""

from __future__ import annotations

import re
import string
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.llm.common import frugal

CAPACITY = 2048
QUADRATIC = 2048  # tokens at which attention costs as much as the linear layers
POOL_PIECES = 4096
END = 1
KNOWN_BYTES = 32 << 20  # of words and ids in each of two generations that a task keeps, and those of one group of texts
ENTRY_BYTES = 150  # what a word takes besides
WORDS_A_CALL = 2000
MARKS = string.punctuation  # of ASCII
GROUP_BYTES = 1 << 20  # texts are split into words by so much
SPACE = re.compile(rb"[ \t\n\x0b\x0c\r]")

COLUMNS = ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "sequence_length")


class WordIds:
    """The ids of words, as the bytes of little-endian 32-bit numbers, kept for the words seen lately.

    Words are kept in two generations: when the young one is full it becomes the old one, whose words go unless they
    are seen again, so what is kept has a bound in bytes and frequent words stay.  New words are encoded by the
    hundred.  A word of letters with marks behind it is those letters and those marks, which are pieces of their own, so
    letters are encoded once for all their marks, and marks once.  Letters are parted by the ids that end a piece; other
    words by a control character between them, which has one id; words that hold it, or may hold a special token, are encoded alone.
    """

    BETWEEN = b"\x01"

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        between = self.tokenizer.encode(self.BETWEEN.decode(), add_special_tokens=False).ids
        self.between = between[0] if len(between) == 1 else None
        # ids that end a piece of the tokenizer: every piece of a word has one, its last
        self.ends = np.zeros(self.tokenizer.get_vocab_size(), bool)
        self.ends[[i for token, i in self.tokenizer.get_vocab().items() if token.endswith("</w>")]] = True
        self.forget()

    @classmethod
    def of(cls, path: str) -> WordIds:
        """This worker's, without words: a worker runs many tasks, and keeps the tokenizer of one vocabulary."""
        if path not in _KEPT:
            _KEPT.clear()
            _KEPT[path] = cls(path)
        _KEPT[path].forget()
        return _KEPT[path]

    def forget(self) -> None:
        self.young, self.old, self.size = {}, {}, 0

    def _alone(self, word: bytes) -> bytes:
        return np.array(self.tokenizer.encode(word.decode(), add_special_tokens=False).ids, "<u4").tobytes()

    def _encoded(self, words: list[bytes]) -> list[bytes]:
        """Ids of a few hundred words, in one call where that can part them."""
        joined = b" \x01 ".join(words)
        if self.between is None or b"<|" in joined or joined.count(self.BETWEEN) != len(words) - 1:
            return [self._alone(w) for w in words]
        ids = np.array(self.tokenizer.encode_batch_fast([joined.decode()], add_special_tokens=False)[0].ids, "<u4")
        stops = [*np.flatnonzero(ids == self.between).tolist(), len(ids)]
        packed = ids.tobytes()
        return [packed[4 * (a + 1):4 * b] for a, b in zip([-1, *stops[:-1]], stops)]

    def _plain(self, words: list[bytes]) -> list[bytes]:
        """Ids of words of one piece each, at least: they follow each other, and the ends of pieces part them."""
        ids = np.array(self.tokenizer.encode_batch_fast([b" ".join(words).decode()], add_special_tokens=False)[0].ids, "<u4")
        ends = np.flatnonzero(self.ends[ids])
        if len(ends) != len(words):  # some word has more pieces
            return self._encoded(words)
        stops = (4 * ends + 4).tolist()
        packed = ids.tobytes()
        return [packed[a:b] for a, b in zip([0, *stops[:-1]], stops)]

    def _keep(self, words: list[bytes], ids: list[bytes]) -> None:
        self.young.update(zip(words, ids))
        self.size += sum(map(len, words)) + sum(map(len, ids)) + ENTRY_BYTES * len(words)

    def _unseen(self, words: Iterable[bytes]) -> list[bytes]:
        """The words that are in no generation; those of the old one are young again."""
        found, unseen = [], []
        for word in words:
            (found if word in self.old else unseen).append(word)
        self._keep(found, [self.old[word] for word in found])
        return unseen

    def _learn(self, words: list[bytes]) -> None:
        """Keeps new words with their ids.

        A word of letters is one piece at least, also if it is not ASCII; marks behind it never belong to its piece,
        if it is of letters in lower case too: the tokenizer makes that first.
        """
        letters, others, parted = {}, {}, []
        for word in words:
            if word.isalpha():
                core, tail = word.lower(), b""
            else:
                text = word.decode()
                core = text.rstrip(MARKS)
                if not core.lower().isalpha() if core else "<|" in text:
                    others[word] = None
                    continue
                # beyond ASCII the tokenizer's rules for lower case are its own
                core, tail = (core.lower() if core.isascii() else core).encode(), text[len(core):].encode()
                others[tail] = None
            letters[core] = None
            if core != word:
                parted.append((word, core, tail))
        others.pop(b"", None)
        letters.pop(b"", None)
        for parts, encoded in ((letters, self._plain), (others, self._encoded)):
            new = self._unseen(parts.keys() - self.young.keys())
            for i in range(0, len(new), WORDS_A_CALL):
                some = new[i:i + WORDS_A_CALL]
                self._keep(some, encoded(some))
        get = self.young.get
        self._keep([word for word, _, _ in parted], [get(core, b"") + get(tail, b"") for _, core, tail in parted])

    def ids(self, texts: list[bytes]) -> list[bytes]:
        """The ids of each text."""
        split = [t.split() for t in texts]
        self._learn(self._unseen(set().union(*split).difference(self.young)))
        out = [b"".join(map(self.young.__getitem__, words)) for words in split]
        if self.size > KNOWN_BYTES:
            self.young, self.old, self.size = {}, self.young, 0
        return out


_KEPT: dict[str, WordIds] = {}


def _groups(texts: pa.Array) -> Iterator[tuple[int, list[bytes]]]:
    """(first text, texts) of about ``GROUP_BYTES``; a longer text is a group of its own."""
    held, size, first = [], 0, 0
    for i, text in enumerate(texts):
        held.append(text.as_py())
        size += len(held[-1])
        if size >= GROUP_BYTES:
            yield first, held
            held, size, first = [], 0, i + 1
    if held:
        yield first, held


def _ids(words: WordIds, text: bytes) -> bytes:
    """The ids of a long text, part by part; parts end between words."""
    out, start = [], 0
    while start < len(text):
        stop = start + GROUP_BYTES
        space = SPACE.search(text, stop) if stop < len(text) else None
        stop = space.end() if space else len(text)
        out += words.ids([text[start:stop]])
        start = stop
    return b"".join(out)


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def cost(tokens: int) -> float:
    return tokens + tokens * tokens / QUADRATIC


def capacities(tokens: int, capacity: int = CAPACITY) -> list[int]:
    """Sequence lengths that hold exactly so many tokens: whole ones, then powers of two."""
    whole, rest = divmod(tokens, capacity)
    return [capacity] * whole + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def assign(lengths: list[int], capacity: int = CAPACITY) -> Iterator[tuple[int, int, int, int, int]]:
    """(piece, start in the piece, length, sequence, offset) for pieces of at most ``capacity`` tokens."""
    sizes = np.array(capacities(sum(lengths), capacity), np.int64)
    room, spent = sizes.copy(), np.zeros(len(sizes))
    for piece in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        start, left = 0, lengths[piece]
        while left:
            fits = room >= left
            if not fits.any():
                fits = room > 0
            at = int(np.where(fits, spent, np.inf).argmin())
            n = min(left, int(room[at]))
            yield piece, start, n, at, int(sizes[at] - room[at])
            room[at] -= n
            spent[at] += cost(n)
            start, left = start + n, left - n


def packed(docs: DataFrame, text: str = "text", key: str = "doc_id", path: str | None = None) -> DataFrame:
    """One row per piece: ``key``, start, length, ids_crc32, doc_tokens, sequence_id, offset, sequence_length."""
    path = path or vocabulary_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordIds.of(path)
        end = np.array([END], "<u4").tobytes()
        first = TaskContext.get().partitionId() << 32
        pool: list[tuple] = []
        rows: list[tuple] = []
        kind = None

        def row(key, ids: bytes, start: int, n: int, tokens: int, sequence: int, offset: int, size: int) -> None:
            rows.append((key, start, n, zlib.crc32(ids), tokens, sequence, offset, size))

        def empty_pool() -> None:
            nonlocal first
            lengths = [len(ids) // 4 for _, ids, _, _ in pool]
            sizes = capacities(sum(lengths))
            for piece, start, n, at, offset in assign(lengths):
                key, ids, before, tokens = pool[piece]
                row(key, ids[4 * start:4 * (start + n)], before + start, n, tokens, first + at, offset, sizes[at])
            first += len(sizes)
            pool.clear()

        def flushed() -> pa.RecordBatch:
            columns = list(zip(*rows))
            rows.clear()
            kinds = [kind, *[pa.int64()] * 7]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["key", *COLUMNS])

        for batch in batches:
            kind = batch.schema.field("key").type
            texts = pc.fill_null(batch.column("text"), "").cast(pa.binary())
            keys = batch.column("key").to_pylist()
            for at, group in _groups(texts):
                found = words.ids(group) if len(group) > 1 else [_ids(words, group[0])]
                for key, ids in zip(keys[at:at + len(group)], found):
                    ids += end
                    tokens = len(ids) // 4
                    whole = tokens // CAPACITY
                    for i in range(whole):
                        row(key, ids[4 * CAPACITY * i:4 * CAPACITY * (i + 1)], CAPACITY * i, CAPACITY, tokens, first, 0, CAPACITY)
                        first += 1
                    if tokens % CAPACITY:
                        pool.append((key, ids[4 * CAPACITY * whole:], CAPACITY * whole, tokens))
                    if len(pool) >= POOL_PIECES:
                        empty_pool()
                    if len(rows) >= 10_000:
                        yield flushed()
        words.forget()  # later tasks of this worker may be those of other stages
        if pool:
            empty_pool()
        if rows:
            yield flushed()

    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    made = rows.mapInArrow(frugal(run), f"key {kind}, " + ", ".join(f"{c} bigint" for c in COLUMNS))
    return made.withColumnRenamed("key", key)
