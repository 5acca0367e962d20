"""Language identification of mixed texts: expectation-maximisation over language proportions.

The model is one table of letter trigram counts per language.  A document's words are taken as
drawn from a mixture of languages; EM estimates the proportions from the words' trigram
likelihoods.  Then the set of languages is chosen: a further language must raise the log
likelihood by more than ``PENALTY * log(1 + words)``.  The prediction is the language with
the largest share of the chosen set, and the share is its score.

Trigrams are counted in ``BUCKETS`` hashed cells, so the model has a fixed size per
language; there may be ``MAX_LANGUAGES``, more raise an error.

Defined cases: a null or empty text, or one without a letter, is ``und`` with score 0; without
any labelled document everything is ``und``; equal shares go to the first language in
code point order; documents without a language, repeated rows and an empty table are no
special case.  A text is never cut.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.llm.common import frugal

BUCKETS = 1 << 16
MAX_LANGUAGES = 256
SMOOTHING = 0.5
PENALTY = 2.0
TURNS = 20
SETTLED = 1e-3
KNOWN_WORDS = 200_000  # words whose likelihoods a task remembers before it begins anew
BATCH_WORDS = 200_000  # distinct words of documents that go through EM together, about
UNKNOWN = "und"

_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> Counter:
    """Lower-cased runs of letters, counted; empty where there is no letter."""
    found = Counter(_WORD.findall(text.lower())) if text else Counter()
    return found if any(w.isalpha() or any(map(str.isalpha, w)) for w in found) else Counter()


def trigram_cells(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Cells of the letter trigrams of each word (with a blank on either side), and where each word's begin."""
    points = np.frombuffer(("".join(f" {w} " for w in words)).encode("utf-32-le"), np.uint32).astype(np.uint64)
    lengths = np.fromiter(map(len, words), np.int64, len(words))  # a word of n letters has n trigrams
    ends = np.cumsum(lengths + 2)
    hashed = points[:-2] * np.uint64(0x9E3779B1) ^ points[1:-1] * np.uint64(0x85EBCA77C2B2) ^ points[2:] * np.uint64(0xD6E8FEB86659FD)
    hashed = (hashed * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(48)
    inside = np.ones(len(points), bool)
    inside[ends - 1] = inside[ends - 2] = False
    return hashed[inside[:-2]].astype(np.int64), np.cumsum(lengths) - lengths


# The model -------------------------------------------------------------------------

class Model:
    """Languages in code point order, and the log probability of every cell in each."""

    def __init__(self, languages: list[str], counts: np.ndarray):
        self.languages = languages
        self.log = np.log((counts + SMOOTHING) / (counts.sum(1, keepdims=True) + SMOOTHING * BUCKETS)).T.copy()

    def likelihoods(self, words: list[str]) -> np.ndarray:
        cells, starts = trigram_cells(words)
        return np.add.reduceat(self.log[cells], starts, axis=0)


def learned(docs: DataFrame, text: str = "text", lang: str = "lang") -> Model:
    """The model of all documents with a language; only its cells come to the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells: dict[str, np.ndarray] = defaultdict(lambda: np.zeros(BUCKETS, np.int64))
        for batch in batches:
            seen: dict[str, Counter] = defaultdict(Counter)
            for language, one in zip(batch.column(0).to_pylist(), batch.column(1)):
                seen[language].update(words_of(one.as_py()))
            for language, words in seen.items():
                if words:
                    at, starts = trigram_cells(list(words))
                    often = np.repeat(np.fromiter(words.values(), np.int64, len(words)), np.diff(np.append(starts, len(at))))
                    cells[language] += np.bincount(at, often, BUCKETS).astype(np.int64)
            if len(cells) > MAX_LANGUAGES:
                raise ValueError(f"more than {MAX_LANGUAGES} languages")
        for language, n in cells.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array([language] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(n[at], pa.int64())],
                ["lang", "cell", "n"],
            )

    rows = docs.where(F.col(lang).isNotNull()).select(F.col(lang).alias("lang"), F.col(text).alias("text"))
    sums = rows.mapInArrow(frugal(count), "lang string, cell int, n bigint").groupBy("lang", "cell").agg(F.sum("n").alias("n"))
    found = sums.limit(MAX_LANGUAGES * BUCKETS + 1).toPandas()
    languages = sorted(found["lang"].unique())
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    counts = np.zeros((len(languages), BUCKETS))
    place = {language: i for i, language in enumerate(languages)}
    counts[found["lang"].map(place).to_numpy(np.int64), found["cell"].to_numpy(np.int64)] = found["n"]
    return Model(languages, counts)


# Mixtures --------------------------------------------------------------------------

def expectation_maximisation(log: np.ndarray, often: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Proportions [documents, languages] and log likelihoods of documents whose words lie one after another.

    ``log`` holds a word's log likelihood in each language, ``often`` its count.  Documents
    whose proportions have settled take no part in further turns.
    """
    n_docs, sizes = len(starts), np.diff(np.append(starts, len(log)))
    top = log.max(1)
    near = np.exp(log - top[:, None])
    totals = np.add.reduceat(often, starts)
    shares = np.full((n_docs, log.shape[1]), 1 / log.shape[1])
    open_ = np.arange(n_docs)
    rows, here, at, sized = near, often, starts, sizes
    for _ in range(TURNS):
        weighed = rows * np.repeat(shares[open_], sized, axis=0)
        weighed *= (here / weighed.sum(1))[:, None]
        new = np.add.reduceat(weighed, at, axis=0) / totals[open_, None]
        moving = np.abs(new - shares[open_]).max(1) > SETTLED
        shares[open_] = new
        if not moving.any():
            break
        if moving.mean() < 0.7:
            keep = np.repeat(moving, sized)
            rows, here, open_, sized = rows[keep], here[keep], open_[moving], sized[moving]
            at = np.cumsum(sized) - sized
    mixed = np.log((near * np.repeat(shares, sizes, axis=0)).sum(1)) + top
    return shares, np.add.reduceat(mixed * often, starts)


def chosen(log: np.ndarray, often: np.ndarray, starts: np.ndarray) -> list[dict[int, float]]:
    """Per document the chosen languages and their shares."""
    shares, best_of_all = expectation_maximisation(log, often, starts)
    single = np.add.reduceat(log * often[:, None], starts, axis=0)
    price = PENALTY * np.log1p(np.add.reduceat(often, starts))
    ends = np.append(starts[1:], len(log))
    found = []
    for i, (a, b) in enumerate(zip(starts.tolist(), ends.tolist())):
        pick = int(single[i].argmax())
        result, value = {pick: 1.0}, single[i, pick] - price[i]
        # No set can do better than all languages without a price, so one is enough here.
        if best_of_all[i] - 2 * price[i] > value:
            ranked = np.argsort(-shares[i], kind="stable")
            for size in range(2, len(ranked) + 1):
                some = ranked[:size]
                part, likelihood = expectation_maximisation(log[a:b, some], often[a:b], np.zeros(1, np.int64))
                if likelihood[0] - size * price[i] > value:
                    value = likelihood[0] - size * price[i]
                    result = {int(s): float(p) for s, p in zip(some, part[0])}
                if best_of_all[i] - (size + 1) * price[i] <= value:
                    break
        found.append(result)
    return found


class Reader:
    """Predicts documents, remembering the likelihoods of the words it has seen."""

    def __init__(self, model: Model):
        self.model = model
        self.forget()

    def forget(self) -> None:
        self.rows: dict[str, int] = {}
        self.table = np.zeros((0, len(self.model.languages)))

    def predict(self, documents: list[Counter]) -> list[dict[str, float]]:
        out: list[dict[str, float]] = [{} for _ in documents]
        if not self.model.languages:
            return out
        some, size = [], 0
        for i, words in enumerate(documents):
            if words:
                some.append(i)
                size += len(words)
            if size >= BATCH_WORDS or (i == len(documents) - 1 and some):
                self._together([documents[j] for j in some], some, out)
                some, size = [], 0
        if some:
            self._together([documents[j] for j in some], some, out)
        return out

    def _together(self, documents: list[Counter], places: list[int], out: list) -> None:
        if len(self.rows) > KNOWN_WORDS:
            self.forget()
        new = list(dict.fromkeys(w for words in documents for w in words if w not in self.rows))
        if new:
            self.rows.update(zip(new, range(len(self.rows), len(self.rows) + len(new))))
            self.table = np.concatenate([self.table, self.model.likelihoods(new)])
        sizes = np.fromiter(map(len, documents), np.int64, len(documents))
        at = np.fromiter((self.rows[w] for words in documents for w in words), np.int64, int(sizes.sum()))
        often = np.fromiter((n for words in documents for n in words.values()), np.float64, len(at))
        for place, result in zip(places, chosen(self.table[at], often, np.cumsum(sizes) - sizes)):
            out[place] = {self.model.languages[k]: p for k, p in result.items()}


def predicted(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with lang_pred, score and ``languages`` (the chosen set, as ``name:share`` by share)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(shared.value)
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("_lang_text"))
            found = []
            for i in range(0, len(texts), 512):
                found += reader.predict([words_of(t.as_py()) for t in texts[i:i + 512]])
            ranked = [sorted(f.items(), key=lambda x: (-x[1], x[0])) for f in found]
            rest = batch.drop_columns(["_lang_text"])
            yield pa.RecordBatch.from_arrays(
                rest.columns + [
                    pa.array([r[0][0] if r else UNKNOWN for r in ranked], pa.string()),
                    pa.array([min(1.0, r[0][1]) if r else 0.0 for r in ranked], pa.float64()),
                    pa.array([",".join(f"{k}:{v:.3f}" for k, v in r) for r in ranked], pa.string()),
                ], rest.schema.names + ["lang_pred", "score", "languages"],
            )

    rows = docs.withColumn("_lang_text", F.col(text))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return rows.mapInArrow(frugal(run), f"{kinds}, lang_pred string, score double, languages string")
