"""Language model scores by a weighted backoff automaton.

Counts: all words, pairs and triples of all training texts.  An n-gram that was seen ``FLOOR`` times is an arc; a
history with arcs is a state.  Counts are discounted by an absolute amount.  What a history saves is the weight of its
failure arc, which leads to the state of its shorter history, and so to the root, where every word has an arc.  An arc
carries the word's probability with the shorter history's share mixed in, so the probabilities after a history add up to one.

The steps, over blocks of texts:

1. Texts are cut into blocks and written once, as numbers of the block's words, in a table bucketed by block: what
   comes back for a block meets it without moving it again.
2. Words, then pairs, then triples are counted.  They are known by 64-bit hashes and dealt by them, packed and in order, into
   parts; a part adds up the counts of all blocks and answers each of them.  A pair is asked for only if both of its words
   were seen ``FLOOR`` times, a triple only if both of its pairs were, so no arc is lost.
3. Of the blocks that have an n-gram in a training text the first one owns it, so each arc adds to what its history
   has given away once; these sums take the same way.
4. A block makes states, arcs and failure arcs of its own n-grams, and goes through its texts from left to right: each
   word takes the state's arc, or the failure arcs until one is found, and the log10 probabilities are added up.  A state
   knows at most two words, so long texts are cut into lanes that begin two words early, and all lanes go side by side.

Neither words nor arcs are bounded, so they are never broadcast.  The largest things in a task are a block and a part.

Defined cases: a null or empty text is its end token alone; a word that was never seen has count 0; without training
texts all counts are 0 and the scores are those of the root; a null id counts as the empty text; repeated rows are scored
each; an empty table gives no rows.  A text is never parted: one longer than a block is a block, of some 50 bytes a token.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.llm.common import mix, shuffle_tasks, stored
from pairloom.scratch import new_path

BLOCK_TOKENS = 2_000_000  # some 50 bytes of memory each
PART_TOKENS = 1_000_000  # n-grams of about as many tokens come to one part
LANE = 256
FLOOR = 2  # an n-gram seen less often is no arc
DISCOUNT = 0.5
END = b""  # no word is empty
WORDS, PAIRS, TRIPLES, AFTER_WORDS, AFTER_PAIRS = 1, 2, 3, 4, 5  # what is counted: n-grams, then what histories gave away
_CODEC = pa.Codec("zstd", compression_level=1)
_STEPS = mix(np.arange(1, 6, dtype=np.uint64)) | np.uint64(1)
_SENT = "block bigint, kind int, part int, many int, keys binary, often binary"
_ANSWER = "block bigint, kind int, part int, many int, n binary, arcs bigint"


def tokens_of(text: bytes) -> list[bytes]:
    return text.lower().split() + [END]


# Packed numbers --------------------------------------------------------------------

def _packed(values: np.ndarray) -> bytes:
    """Compressed, all first bytes first: the upper bytes of small numbers are alike."""
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(-1, values.itemsize).T)
    return _CODEC.compress(planes, asbytes=True)


def _unpacked(packed: bytes, size: int, kind: type) -> np.ndarray:
    wide = np.dtype(kind).itemsize
    planes = np.frombuffer(_CODEC.decompress(packed, decompressed_size=wide * size), np.uint8).reshape(wide, size)
    return np.ascontiguousarray(planes.T).view(kind).reshape(-1)


def _all_unpacked(packed: Iterable[bytes], sizes: Iterable[int]) -> np.ndarray:
    return np.concatenate([np.zeros(0, np.int64), *(_unpacked(x, n, np.int64) for x, n in zip(packed, sizes))])


# Blocks ----------------------------------------------------------------------------

class _Local(dict):
    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        return n


def blocks(docs: DataFrame) -> DataFrame:
    """One row a block, in a table bucketed by ``block``; ``docs`` has key, text, held_out.

    keys, held and sizes by text; ids of all tokens, as numbers of the block's words; the words' hashes; tokens, those of training.
    """
    spark = docs.sparkSession
    kind = docs.schema["key"].dataType.simpleString()
    schema = (
        f"block bigint, tokens bigint, trained bigint, words int, keys array<{kind}>, held array<boolean>, sizes array<int>, "
        "ids binary, hashes binary"
    )
    names = ["block", "tokens", "trained", "words", "keys", "held", "sizes", "ids", "hashes"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, size = TaskContext.get().partitionId() << 32, 0
        local, found, keys, held = _Local(), [], [], []

        def row() -> pa.RecordBatch:
            sizes = pa.array([len(x) for x in found], pa.int32())
            flags, ids = pa.concat_arrays(held), np.concatenate(found)
            trained = sum(len(x) for x, h in zip(found, flags.to_pylist()) if not h)
            hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, local), np.uint64, len(local))
            ends = pa.array([0, len(found)], pa.int32())
            return pa.RecordBatch.from_arrays([
                pa.array([block]), pa.array([size]), pa.array([trained]), pa.array([len(local)], pa.int32()),
                pa.ListArray.from_arrays(ends, pa.concat_arrays(keys)), pa.ListArray.from_arrays(ends, flags),
                pa.ListArray.from_arrays(ends, sizes), pa.array([_packed(ids)], pa.binary()), pa.array([_packed(hashes)], pa.binary()),
            ], names)

        for batch in batches:
            texts = pc.fill_null(batch.column("text"), "").cast(pa.binary())
            start = 0
            for i, one in enumerate(texts):
                words = tokens_of(one.as_py())
                ids = np.fromiter(map(local.__getitem__, words), np.int32, len(words))
                found.append(ids)
                size += len(ids)
                if size >= BLOCK_TOKENS or i == len(texts) - 1:
                    keys.append(batch.column("key").slice(start, i + 1 - start))
                    held.append(batch.column("held_out").slice(start, i + 1 - start))
                    start = i + 1
                if size >= BLOCK_TOKENS:
                    yield row()
                    block, size = block + 1, 0
                    local, found, keys, held = _Local(), [], [], []
        if size:
            yield row()

    name = f"blocks_{uuid.uuid4().hex}"
    cut = docs.select("key", "text", "held_out").mapInArrow(run, schema)
    cut.write.bucketBy(shuffle_tasks(spark), "block").option("path", new_path(spark, "blocks")).format("parquet").saveAsTable(name)
    return spark.table(name)


class Block:
    """The texts of a block, and what is known of its words, pairs and triples so far."""

    def __init__(self, row: pa.Table, answers: pd.DataFrame):
        one = {name: row.column(name)[0] for name in row.column_names}
        self.number = one["block"].as_py()
        self.keys = one["keys"].values
        self.held = np.asarray(one["held"].values.to_numpy(zero_copy_only=False), bool)
        self.sizes = one["sizes"].values.to_numpy().astype(np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.ids = _unpacked(one["ids"].as_py(), one["tokens"].as_py(), np.int32)
        self.hashes = _unpacked(one["hashes"].as_py(), one["words"].as_py(), np.uint64)
        self.trained = np.repeat(~self.held, self.sizes)
        self.answers = answers
        self.n: dict[int, np.ndarray] = {}
        self.owned: dict[int, np.ndarray] = {}
        self.words, self.word_of = np.unique(self.hashes, return_inverse=True)
        if self._answered(WORDS):
            self._pairs()
        if self._answered(PAIRS):
            self._triples()
        self._answered(TRIPLES)

    def _answered(self, kind: int) -> bool:
        """Takes the parts' answers, which are in the order of the hashes."""
        mine = self.answers[self.answers["kind"] == kind].sort_values("part")
        found = _all_unpacked(mine["n"], mine["many"])
        self.n[kind], self.owned[kind] = found >> 1, (found & 1).astype(bool)
        return kind in self.answers.attrs["kinds"]

    def _distinct(self, at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the n-grams that end at ``at``, in order, and by position the number of its own, or -1."""
        keys = np.full(len(at), size, np.uint64)
        for i in range(size):
            keys += self.hashes[self.ids[at - i]] * _STEPS[i + size - 2]
        keys, where = np.unique(mix(keys), return_inverse=True)
        of = np.full(len(self.ids), -1, np.int32)
        of[at] = where
        return keys, of

    def _pairs(self) -> None:
        self.c = self.n[WORDS][self.word_of]
        often = (self.c >= FLOOR)[self.ids]
        inner = np.ones(len(self.ids), bool)
        inner[self.starts] = False
        inner[1:] &= often[1:] & often[:-1]
        self.pairs, self.pair_of = self._distinct(np.flatnonzero(inner), 2)

    def _triples(self) -> None:
        known = np.zeros(len(self.ids), bool)
        at = np.flatnonzero(self.pair_of >= 0)
        known[at] = self.n[PAIRS][self.pair_of[at]] >= FLOOR
        # The pair that ends at a word's predecessor lies in the same text, as the pair that ends at the word does.
        at = np.flatnonzero(known[1:] & known[:-1]) + 1
        self.triples, self.triple_of = self._distinct(at, 3)

    def counts(self, kind: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes in order, and occurrences in training texts."""
        if kind == WORDS:
            return self.words, np.bincount(self.word_of[self.ids[self.trained]], minlength=len(self.words))
        keys, of = (self.pairs, self.pair_of) if kind == PAIRS else (self.triples, self.triple_of)
        return keys, np.bincount(of[self.trained & (of >= 0)], minlength=len(keys))

    def _last(self, of: np.ndarray, many: int) -> np.ndarray:
        """For each n-gram a position where it ends."""
        at = np.flatnonzero(of >= 0)
        where = np.zeros(many, np.int64)
        where[of[at]] = at
        return where

    def given(self, kind: int) -> tuple[np.ndarray, np.ndarray]:
        """Histories in the order of their hashes, and twice what they keep for the arcs that this block owns."""
        if kind == AFTER_WORDS:
            mine = np.flatnonzero(self.owned[PAIRS])
            before = self.ids[self._last(self.pair_of, len(self.pairs))[mine] - 1]
            sums = np.bincount(self.word_of[before], 2 * self.n[PAIRS][mine] - 2 * DISCOUNT, len(self.words))
            asked = self.n[WORDS] >= FLOOR
            return self.words[asked], sums[asked].astype(np.int64)
        mine = np.flatnonzero(self.owned[TRIPLES])
        before = self.pair_of[self._last(self.triple_of, len(self.triples))[mine] - 1]
        sums = np.bincount(before, 2 * self.n[TRIPLES][mine] - 2 * DISCOUNT, len(self.pairs))
        asked = self.n[PAIRS] >= FLOOR
        return self.pairs[asked], sums[asked].astype(np.int64)


# Counting in parts -----------------------------------------------------------------

def _dealt(block: int, kind: int, parts: int, keys: np.ndarray, often: np.ndarray) -> Iterator[tuple]:
    """A row for each part: the packed steps of ``keys``, which are in order, and their numbers."""
    step = (1 << 64) // parts + 1
    cuts = [0, *np.searchsorted(keys, np.array([i * step for i in range(1, parts)], np.uint64)).tolist(), len(keys)]
    for part, (a, b) in enumerate(zip(cuts, cuts[1:])):
        if a < b:
            steps = np.diff(keys[a:b], prepend=np.uint64(0))
            yield block, kind, part, b - a, _packed(steps), _packed(often[a:b].astype(np.int64))


def _added(rows: pd.DataFrame) -> pd.DataFrame:
    """The answer of a part to each block: twice the sum over all blocks, and one more for the n-gram's owner."""
    rows = rows.sort_values("block")
    steps = [np.cumsum(_unpacked(x, n, np.uint64), dtype=np.uint64) for x, n in zip(rows["keys"], rows["many"])]
    keys, where = np.unique(np.concatenate(steps), return_inverse=True)
    often = _all_unpacked(rows["often"], rows["many"])
    n = np.bincount(where, often, len(keys)).astype(np.int64)  # whole below 2 ** 53
    if rows["kind"].iloc[0] in (PAIRS, TRIPLES):
        n[n < FLOOR] = 0
    seen = np.flatnonzero(often)
    first = np.full(len(keys), -1, np.int64)
    first[where[seen[::-1]]] = seen[::-1]
    owned = np.zeros(len(where), np.int64)
    owned[first[n > 0]] = 1
    cuts = np.cumsum([0, *rows["many"]])
    found = 2 * n[where] + owned
    made = rows[["block", "kind", "part", "many"]].copy()
    made["n"] = [_packed(found[a:b]) for a, b in zip(cuts, cuts[1:])]
    made["arcs"] = np.add.reduceat(owned, cuts[:-1])
    return made


def _per_block(texts: DataFrame, answers: DataFrame | None, kinds: tuple[int, ...], run: Callable[[Block], pa.Table], schema: str) -> DataFrame:
    """``run`` of each block, which knows ``answers`` of ``kinds``; the blocks stay where they are."""
    none = pd.DataFrame({"kind": [], "part": [], "many": [], "n": []})

    def knowing(row: pa.Table, found: pd.DataFrame) -> pa.Table:
        found.attrs["kinds"] = kinds
        return run(Block(row, found))

    if answers is None:
        def alone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(batch.num_rows):
                    yield from knowing(pa.Table.from_batches([batch.slice(i, 1)]), none.copy()).to_batches()

        return texts.mapInArrow(alone, schema)
    given = answers.select("block", "kind", "part", "many", "n").groupBy("block")
    return texts.groupBy("block").cogroup(given).applyInArrow(lambda row, found: knowing(row, found.to_pandas()), schema)


def _counted(texts: DataFrame, answers: DataFrame | None, kinds: tuple[int, ...], wanted: tuple[int, ...], parts: int) -> DataFrame:
    """The parts' answers on ``wanted``, from blocks that know ``kinds``."""
    names = [x.split()[0] for x in _SENT.split(", ")]
    types = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]

    def send(made: Block) -> pa.Table:
        rows = []
        for kind in wanted:
            keys, often = made.counts(kind) if kind <= TRIPLES else made.given(kind)
            rows.extend(_dealt(made.number, kind, parts, keys, often))
        columns = zip(*rows) if rows else [[]] * len(names)
        return pa.table([pa.array(list(x), t) for x, t in zip(columns, types)], names=names)

    return _per_block(texts, answers, kinds, send, _SENT).groupBy("kind", "part").applyInPandas(_added, _ANSWER)


# The automaton ---------------------------------------------------------------------

class Automaton:
    """States and arcs of a block's own n-grams; numbers of words are those of the block.

    State 0 is the root, then come words and pairs that have arcs.  Arcs are in the order of ``state * words + word``.
    """

    def __init__(self, block: Block, after: dict[int, np.ndarray], scale: float):
        words, pairs = len(block.hashes), len(block.pairs)
        root = (block.c + 0.5) / scale
        self.words, self.root = words, np.log10(root)
        kept = {AFTER_WORDS: np.zeros(len(block.words), np.int64), AFTER_PAIRS: np.zeros(pairs, np.int64)}
        kept[AFTER_WORDS][block.n[WORDS] >= FLOOR] = after[AFTER_WORDS]
        kept[AFTER_PAIRS][block.n[PAIRS] >= FLOOR] = after[AFTER_PAIRS]
        of_word = kept[AFTER_WORDS][block.word_of]
        state = np.cumsum(of_word > 0)
        self.after_word = np.where(of_word > 0, state, 0)
        states = 1 + int(state[-1])
        state = states - 1 + np.cumsum(kept[AFTER_PAIRS] > 0)
        of_pair = np.where(kept[AFTER_PAIRS] > 0, state, 0)
        states = max(states, 1 + int(state[-1]) if pairs else 0)
        pair_at, triple_at = block._last(block.pair_of, pairs), block._last(block.triple_of, len(block.triples))
        head, tail = block.ids[pair_at - 1], block.ids[pair_at]
        after_pair = np.where(of_pair > 0, of_pair, self.after_word[tail])
        # What a history leaves to its shorter one is one less what it gives to its arcs.
        left_word = 1 - of_word / np.maximum(1, 2 * block.c)
        left_pair = 1 - kept[AFTER_PAIRS] / np.maximum(1, 2 * block.n[PAIRS])
        self.fail, weight = np.zeros(states, np.int64), np.ones(states)
        weight[self.after_word] = left_word
        weight[of_pair] = left_pair
        self.fail[of_pair] = self.after_word[tail]
        weight[0], self.fail[0] = 1, 0
        self.weight = np.log10(weight)
        pair = (block.n[PAIRS] - DISCOUNT) / np.maximum(1, block.c[head]) + left_word[head] * root[tail]
        is_pair, is_triple = block.n[PAIRS] >= FLOOR, block.n[TRIPLES] >= FLOOR
        triple_at = triple_at[is_triple]
        before, last = block.pair_of[triple_at - 1], block.pair_of[triple_at]
        triple = (block.n[TRIPLES][is_triple] - DISCOUNT) / block.n[PAIRS][before] + left_pair[before] * pair[last]
        keys = np.concatenate([
            self.after_word[head[is_pair]] * words + tail[is_pair], of_pair[before] * words + block.ids[triple_at],
        ])
        order = np.argsort(keys)
        self.arcs = np.append(keys[order], -1)  # the last one ends a search that goes beyond
        self.gain = np.append(np.log10(np.concatenate([pair[is_pair], triple]))[order], 0)
        self.next = np.append(np.concatenate([after_pair[is_pair], after_pair[last]])[order], 0)

    def step(self, state: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """log10 probabilities of words after states, and the states after them."""
        total, after = np.zeros(len(state)), np.zeros(len(state), np.int64)
        todo, state = np.arange(len(state)), state.copy()
        while len(todo):
            at_root = state[todo] == 0
            rest = todo[at_root]
            total[rest] += self.root[word[rest]]
            after[rest] = self.after_word[word[rest]]
            todo = todo[~at_root]
            wanted = state[todo] * self.words + word[todo]
            arc = np.searchsorted(self.arcs[:-1], wanted)
            found = self.arcs[arc] == wanted
            hit, arc = todo[found], arc[found]
            total[hit] += self.gain[arc]
            after[hit] = self.next[arc]
            todo = todo[~found]
            total[todo] += self.weight[state[todo]]
            state[todo] = self.fail[state[todo]]
        return total, after


def traversed(automaton: Automaton, ids: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """By position the log10 probability of its token; texts go from left to right, in lanes side by side."""
    lanes = -(-sizes // LANE)
    text = np.repeat(np.arange(len(sizes)), lanes)
    begin = starts[text] + LANE * (np.arange(len(text)) - np.repeat(np.cumsum(lanes) - lanes, lanes))
    end = np.minimum(begin + LANE, (starts + sizes)[text])
    early = np.where(begin > starts[text], begin - 2, begin)  # two words bring a lane to its state
    order = np.argsort(early - end, kind="stable")
    begin, end, early = begin[order], end[order], early[order]
    left = early - end  # ascending, the longest lanes first
    state, out = np.zeros(len(early), np.int64), np.zeros(len(ids))
    for t in range(int(-left[0]) if len(left) else 0):
        going = int(np.searchsorted(left, -t))
        at = early[:going] + t
        gain, state[:going] = automaton.step(state[:going], ids[at])
        own = at >= begin[:going]
        out[at[own]] = gain[own]
    return out


# Scores ----------------------------------------------------------------------------

def gathered(docs: DataFrame) -> tuple[DataFrame, DataFrame, int, int, int]:
    """Blocks, their answers on words, pairs and triples (``arcs`` of a row: n-grams it owns), N, V and the number of parts."""
    texts = blocks(docs)
    row = texts.agg(F.sum("tokens").alias("tokens"), F.sum("trained").alias("trained")).first()
    total, parts = row["trained"] or 0, max(1, math.ceil((row["tokens"] or 0) / PART_TOKENS))
    words = stored(_counted(texts, None, (), (WORDS,), parts), "words")
    vocabulary = words.agg(F.sum("arcs").alias("n")).first()["n"] or 0
    pairs = words.unionByName(stored(_counted(texts, words, (WORDS,), (PAIRS,), parts), "pairs"))
    triples = pairs.unionByName(stored(_counted(texts, pairs, (WORDS, PAIRS), (TRIPLES,), parts), "triples"))
    return texts, triples, total, vocabulary, parts


def scored(docs: DataFrame) -> DataFrame:
    """key, held_out, n_tokens, n_known, train_tokens, base_score, score for ``docs`` (key, text, held_out)."""
    texts, answers, total, vocabulary, parts = gathered(docs)
    scale = total + 0.5 * (vocabulary + 1)
    kind = docs.schema["key"].dataType.simpleString()
    ngrams, histories = (WORDS, PAIRS, TRIPLES), (AFTER_WORDS, AFTER_PAIRS)
    given = _counted(texts, answers, ngrams, histories, parts)

    def score(made: Block) -> pa.Table:
        for history in histories:
            made._answered(history)
        automaton = Automaton(made, made.n, scale)
        out = traversed(automaton, made.ids, made.starts, made.sizes)
        return pa.table({
            "key": made.keys, "held_out": made.held, "n_tokens": made.sizes,
            "n_known": np.add.reduceat((made.c > 0)[made.ids].astype(np.int64), made.starts),
            "base_score": np.add.reduceat(automaton.root[made.ids], made.starts), "score": np.add.reduceat(out, made.starts),
            "train_tokens": np.full(len(made.sizes), total, np.int64),
        })

    return _per_block(
        texts, answers.unionByName(given), (*ngrams, *histories), score,
        f"key {kind}, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double, train_tokens bigint",
    )
