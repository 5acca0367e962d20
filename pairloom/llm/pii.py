"""Personal data by a semi-Markov conditional random field over candidate segments.

Base spans come from four patterns (e-mail, IP address, card, phone).  Around every digit or @
a text has a region; inside it, segments of at most ``MAX_PIECES`` pieces are scored as
whole spans (number groups, separators, checks, neighbours) for each kind, and one
dynamic program over the region chooses boundaries and kinds together.  What it finds beside
the base spans is added: two numbers that one pattern swallowed together come apart here.

The weights maximise the conditional likelihood of regions that the base patterns label.
They are fitted on a bounded sample: the regions of ``SAMPLE_DOCS`` documents with a digit or
@, those with the smallest hashes, at most ``SAMPLE_REGIONS``.

Defined cases: a null or empty text has no spans; spans of different kinds may overlap, those of
one kind do not; repeated rows are judged each; without any sample the weights are those of a
few rules written as scores; offsets are code points, ends exclusive.  Texts are never cut.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.llm.common import frugal

KINDS = ("email", "ip", "card", "phone")
MAX_PIECES = 24
SAMPLE_DOCS = 1500
SAMPLE_REGIONS = 4000
EPOCHS = 6
RATE = 0.2
DECAY = 1e-4

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_MARK = re.compile(r"[0-9@]")
_PIECE = re.compile(r"[0-9]+|[A-Za-z]+|[^0-9A-Za-z]")


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = ord(c) - 48
        total += (n * 2 - 9 * (n > 4)) if i % 2 else n
    return total % 10 == 0


def octets(text: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p[-20:]) <= 255 for p in text.split("."))


# Base spans ------------------------------------------------------------------------

def _emails(text: str) -> Iterator[tuple[int, int]]:
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        match = _DOMAIN.match(text, at) if start < at else None
        if match:
            end = match.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Valid matches, leftmost and non-overlapping per kind, by kind and start; failing ones are dropped."""
    found = [("email", a, b) for a, b in _emails(text)]
    found += [("ip", *m.span()) for m in _IP.finditer(text) if octets(m.group())]
    for m in _CARD.finditer(text):
        digits = digits_of(m.group())
        if 13 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", *m.span()))
    if "+" in text:
        found += [("phone", *m.span()) for m in _PHONE.finditer(text) if 9 <= len(digits_of(m.group())) <= 15]
    return found


# Regions and segments ----------------------------------------------------------------

def regions(text: str) -> Iterator[tuple[int, int]]:
    """Stretches of chunks (by white space) that hold a digit or @, joined where one blank is between."""
    start = end = -1
    match = _MARK.search(text)
    while match:
        a = b = match.start()
        while a > max(end, 0) and not text[a - 1].isspace():
            a -= 1
        while b < len(text) and not text[b].isspace():
            b += 1
        if start >= 0 and a == end + 1 and text[end] == " ":
            end = b
        else:
            if start >= 0:
                yield start, end
            start, end = a, b
        match = _MARK.search(text, b)
    if start >= 0:
        yield start, end


def _class(char: str) -> str:
    if not char:
        return "edge"
    if char.isalpha():
        return "letter"
    return "digit" if char.isdigit() else "space" if char.isspace() else char if char in "+@.-_=\"'/:" else "mark"


def _features(kind: str, part: str, left: str, right: str) -> list[str] | None:
    """Features of a whole segment for a kind, or None where it is no candidate of that kind."""
    digits = digits_of(part)
    if kind == "email":
        if part.count("@") != 1 or " " in part or not (part[0].isalnum() and part[-1].isalnum()):
            return None
        name, domain = part.split("@")
        ends = domain.rsplit(".", 1)
        own = [f"dots={min(domain.count('.'), 3)}", f"name={bool(name) and set(name) <= _LOCAL}", f"last={ends[-1].isalpha()}{min(len(ends[-1]), 5)}"]
    else:
        if not digits or not part[-1].isdigit():
            return None
        groups = re.findall("[0-9]+", part)
        if kind == "ip":
            if set(part) - set("0123456789.") or len(groups) < 3 or not part[0].isdigit():
                return None
            own = [f"groups={min(len(groups), 6)}", f"octets={octets(part)}", f"dots={part.count('.') == len(groups) - 1}"]
        elif kind == "card":
            if not 12 <= len(digits) <= 20 or set(part) - set("0123456789 -") or not part[0].isdigit():
                return None
            own = [f"luhn={luhn(digits)}", f"n={len(digits)}", f"even={len(groups) == 1 or {len(g) for g in groups[:-1]} == {4}}"]
        else:
            if not 7 <= len(digits) <= 16 or set(part) - set("0123456789+(). -") or part[0] not in "+(0123456789":
                return None
            own = [f"plus={part[0] == '+'}", f"n={len(digits)}", f"groups={min(len(groups), 6)}",
                   f"longest={min(max(map(len, groups)), 8)}", f"paired={part.count('(') == part.count(')')}"]
    around = [f"left={_class(left)}", f"right={_class(right)}"]
    return [f"{kind}|{x}" for x in ["", *own, *around]]


class Lattice:
    """The pieces of a region and its candidate segments: (first piece, end piece, kind, features)."""

    def __init__(self, text: str, start: int, end: int):
        self.bounds = [start + m.start() for m in _PIECE.finditer(text[start:end])] + [end]
        self.single = ["out|" + ("digit" if text[b].isdigit() else _class(text[b])) for b in self.bounds[:-1]]
        self.segments: list[tuple[int, int, str, list[str]]] = []
        n = len(self.single)
        solid = [not text[b].isspace() for b in self.bounds[:-1]]
        for i in range(n):
            if not solid[i]:
                continue
            for j in range(i + 1, min(n, i + MAX_PIECES) + 1):
                if not solid[j - 1]:
                    continue
                a, b = self.bounds[i], self.bounds[j]
                part = text[a:b]
                if sum("0" <= c <= "9" for c in part) > 20 and "@" not in part:
                    break
                left, right = text[a - 1:a] if a else "", text[b:b + 1]
                for kind in KINDS:
                    features = _features(kind, part, left, right)
                    if features:
                        self.segments.append((i, j, kind, features))

    def ending(self) -> list[list[int]]:
        at: list[list[int]] = [[] for _ in range(len(self.bounds))]
        for s, (_, j, _, _) in enumerate(self.segments):
            at[j].append(s)
        return at

    def best(self, weights: dict[str, float]) -> list[tuple[str, int, int]]:
        """Spans of the highest-scoring segmentation."""
        if not self.segments:
            return []
        score, back = [0.0] * len(self.bounds), [-1] * len(self.bounds)
        ending = self.ending()
        for j in range(1, len(self.bounds)):
            score[j] = score[j - 1] + weights.get(self.single[j - 1], 0.0)
            for s in ending[j]:
                i, _, _, features = self.segments[s]
                value = score[i] + sum(weights.get(f, 0.0) for f in features)
                if value > score[j]:
                    score[j], back[j] = value, s
        found, j = [], len(self.bounds) - 1
        while j > 0:
            if back[j] < 0:
                j -= 1
            else:
                i, end, kind, _ = self.segments[back[j]]
                found.append((kind, self.bounds[i], self.bounds[end]))
                j = i
        return found[::-1]

    def learn(self, gold: set[tuple[str, int, int]], weights: dict[str, float], rate: float) -> None:
        """One step up the gradient of the region's conditional log likelihood."""
        n, ending = len(self.bounds), self.ending()
        single = [weights[f] for f in self.single]
        values = [sum(weights[f] for f in features) for *_, features in self.segments]
        add = lambda a, b: max(a, b) + math.log1p(math.exp(-abs(a - b)))
        ahead = [0.0] * n
        for j in range(1, n):
            ahead[j] = ahead[j - 1] + single[j - 1]
            for s in ending[j]:
                ahead[j] = add(ahead[j], ahead[self.segments[s][0]] + values[s])
        rest: list[float | None] = [None] * n
        rest[n - 1] = 0.0
        for j in range(n - 1, 0, -1):
            for i, value in [(j - 1, single[j - 1])] + [(self.segments[s][0], values[s]) for s in ending[j]]:
                through = value + rest[j]
                rest[i] = through if rest[i] is None else add(rest[i], through)
        whole = ahead[n - 1]
        covered = [False] * n
        step: dict[str, float] = defaultdict(float)
        for s, (i, j, kind, features) in enumerate(self.segments):
            true = (kind, self.bounds[i], self.bounds[j]) in gold
            if true:
                covered[i:j] = [True] * (j - i)
            delta = true - math.exp(ahead[i] + values[s] + rest[j] - whole)
            if abs(delta) > 1e-4:
                for f in features:
                    step[f] += delta
        for j in range(n - 1):
            delta = (not covered[j]) - math.exp(ahead[j] + single[j] + rest[j + 1] - whole)
            if abs(delta) > 1e-4:
                step[self.single[j]] += delta
        for f, delta in step.items():
            weights[f] += rate * (delta - DECAY * weights[f])


#: Where no region can be had to learn from: each kind only in its full form.
PRIOR = {
    "email|": -2.0, "email|name=True": 3.0, "ip|": -4.0, "ip|groups=4": 3.0, "ip|octets=True": 3.0, "card|": -4.0,
    "card|luhn=True": 6.0, "phone|": -4.0, "phone|plus=True": 4.0, "phone|paired=True": 1.0,
}


def gold_of(text: str, start: int, end: int) -> set[tuple[str, int, int]] | None:
    """The base spans of a region as labels; None where a pattern has swallowed more than one entity."""
    part = text[start:end]
    for m in _PHONE.finditer(part):
        if len(digits_of(m.group())) > 15:
            return None
    taken: list[tuple[str, int, int]] = []
    for kind, a, b in sorted(base_spans(part), key=lambda s: ({"email": 0, "ip": 1, "phone": 2, "card": 3}[s[0]], s[1])):
        if all(b <= c or d <= a for _, c, d in taken):
            taken.append((kind, a, b))
    return {(kind, start + a, start + b) for kind, a, b in taken}


def fitted(examples: list[tuple[str, int, int]]) -> dict[str, float]:
    """Weights from regions, each as (text around it, start, end)."""
    lattices = []
    for text, start, end in examples:
        gold = gold_of(text, start, end)
        lattice = Lattice(text, start, end)
        if gold is not None and lattice.segments:
            lattices.append((lattice, gold))
    weights: dict[str, float] = defaultdict(float)
    weights.update(PRIOR)
    for epoch in range(EPOCHS):
        for lattice, gold in lattices:
            lattice.learn(gold, weights, RATE / (1 + epoch))
    return dict(weights)


def learned(docs: DataFrame, text: str = "text") -> dict[str, float]:
    """Weights from a bounded sample of the documents' regions, which alone come to the driver."""

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for h, one in zip(batch.column(0).to_pylist(), batch.column(1)):
                whole = one.as_py()
                for a, b in regions(whole):
                    if b - a <= 200:
                        low = max(0, a - 1)
                        rows.append((h, whole[low:b + 1], a - low, b - low))
            columns = list(zip(*rows)) or [()] * 4
            kinds = (pa.int64(), pa.string(), pa.int32(), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["h", "part", "a", "b"])

    with_marks = docs.select(F.xxhash64(text).alias("h"), F.col(text).alias("text")).where(F.col("text").rlike("[0-9@]"))
    last = with_marks.select("h").distinct().orderBy("h").limit(SAMPLE_DOCS).agg(F.max("h")).first()[0]
    if last is None:
        return dict(PRIOR)
    chosen = with_marks.where(F.col("h") <= last).mapInArrow(frugal(sample), "h bigint, part string, a int, b int")
    rows = chosen.distinct().orderBy("h", "a", "part", "b").limit(SAMPLE_REGIONS).collect()
    return fitted([(r["part"], r["a"], r["b"]) for r in rows])


def all_spans(text: str, weights: dict[str, float]) -> tuple[list, list]:
    """Base spans and all spans, both by kind and start."""
    base = base_spans(text)
    found = list(base)
    for a, b in regions(text):
        left, right = text[a - 1:a] if a else "", text[b:b + 1]
        for kind, c, d in Lattice(left + text[a:b] + right, len(left), len(left) + b - a).best(weights):
            c, d = c + a - len(left), d + a - len(left)
            if all(d <= x or y <= c for _, x, y in base):
                found.append((kind, c, d))
    order = {kind: i for i, kind in enumerate(KINDS)}
    return base, sorted(found, key=lambda s: (order[s[0]], s[1], s[2]))


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for kind, a, b in spans)


def redacted(text: str, spans: list[tuple[str, int, int]]) -> str:
    """Every span, or run of overlapping spans, replaced by the name of its first kind."""
    out, end = [], 0
    merged: list[list] = []
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if merged and a < merged[-1][2]:
            merged[-1][2] = max(merged[-1][2], b)
        else:
            merged.append([kind, a, b])
    for kind, a, b in merged:
        out += [text[end:a], f"<{kind.upper()}>"]
        end = b
    return "".join(out) + text[end:]


def found(docs: DataFrame, weights: dict[str, float], text: str = "text", redact: bool = False) -> DataFrame:
    """``docs`` with n_email, n_ip, n_card, n_phone, base_sha256, spans; ``redact`` adds ``redacted``."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = {kind: [] for kind in KINDS}
            digests, spans, texts = [], [], []
            for one in batch.column(batch.schema.get_field_index("_pii_text")):
                whole = one.as_py() or ""
                base, every = all_spans(whole, shared.value) if _MARK.search(whole) else ([], [])
                for kind in KINDS:
                    counts[kind].append(sum(k == kind for k, _, _ in base))
                digests.append(hashlib.sha256(joined(base).encode()).hexdigest())
                spans.append(joined(every))
                if redact:
                    texts.append(redacted(whole, every) if one.is_valid else None)
            rest = batch.drop_columns(["_pii_text"])
            columns = [pa.array(counts[k], pa.int64()) for k in KINDS] + [pa.array(digests, pa.string()), pa.array(spans, pa.string())]
            names = [f"n_{k}" for k in KINDS] + ["base_sha256", "spans"]
            if redact:
                columns, names = [*columns, pa.array(texts, pa.string())], [*names, "redacted"]
            yield pa.RecordBatch.from_arrays(rest.columns + columns, rest.schema.names + names)

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    added = ", ".join(f"n_{k} bigint" for k in KINDS) + ", base_sha256 string, spans string" + (", redacted string" if redact else "")
    return docs.withColumn("_pii_text", F.col(text)).mapInArrow(frugal(run), f"{kinds}, {added}")
