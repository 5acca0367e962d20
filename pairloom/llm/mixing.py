"""Mixing overlapping sources to target weights by a min-cost flow over membership patterns.

Documents that belong to the same set of sources form a pattern.  Only the patterns' sizes
leave Spark: a flow network sends each pattern's words to the quotas of the sources that it
belongs to.  The first use of a pattern's words costs 1 a word, the second 3, the r-th
2 r - 1, so words are repeated only where nothing fresh is left, and evenly.  Then documents are
taken: every document as often as its pattern's flow covers whole rounds, and of the
rest those first in a seeded order, up to the hash that fills the flow; documents after it
that still fit, and a few exchanges among the nearest, close the gap.

Defined cases: a null or empty text has size 0 and takes 0 words; documents without a source
belong to the null source; equal rows have one place in the seeded order and are taken or
left together; an empty table gives no rows.  More than ``MAX_PATTERNS`` patterns are refused.
"""

from __future__ import annotations

import heapq
from collections.abc import Sequence
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairloom.llm.common import SPACES, stored

MAX_PATTERNS = 5_000  # patterns and sources that the driver solves for; more raise an error
REPEATS = 2
WEIGHTS = (5, 2, 1)
SHARE = Fraction(3, 2)  # of all words, that the targets share
SEED = 20
BIN_ROWS = 5_000  # documents of a pattern among which the seeded order's cut is looked for
FILLERS = 64
EXCHANGES = 16


def word_count(text: Column) -> Column:
    inner = F.btrim(text, F.lit(SPACES))
    return F.when(inner != "", F.size(F.split(inner, f"[{SPACES}]+"))).otherwise(0).cast("bigint")


# Targets and flow, on numbers of patterns and sources --------------------------------

def filled(sizes: Sequence[int], weights: Sequence[int], total, limit: int = REPEATS) -> list[Fraction]:
    """Shares of ``total`` by weight; what exceeds ``limit`` times a size is shared again by the others."""
    targets = [Fraction(0)] * len(sizes)
    left, open_ = Fraction(total), set(range(len(sizes)))
    while open_:
        scale = left / sum(weights[i] for i in open_)
        over = [i for i in open_ if weights[i] * scale > limit * sizes[i]]
        for i in over or open_:
            targets[i] = Fraction(limit * sizes[i]) if over else weights[i] * scale
        if not over:
            break
        left -= sum(targets[i] for i in over)
        open_ -= set(over)
    return targets


def flow(patterns: Sequence[tuple[Sequence[int], int]], quotas: Sequence[int], repeats: int = REPEATS) -> dict[tuple[int, int], int]:
    """Words from pattern p to source s that fill the quotas at the least cost.

    ``patterns`` holds each one's sources and words.  Successive shortest paths with
    potentials; the r-th use of a pattern's words is an arc of cost 2 r - 1.
    """
    n_p, n_s = len(patterns), len(quotas)
    source, sink = n_p + n_s, n_p + n_s + 1
    graph: list[list[list]] = [[] for _ in range(n_p + n_s + 2)]  # [to, capacity, cost, index of the arc back]

    def arc(a: int, b: int, capacity: int, cost: int) -> None:
        graph[a].append([b, capacity, cost, len(graph[b])])
        graph[b].append([a, 0, -cost, len(graph[a]) - 1])

    for p, (members, words) in enumerate(patterns):
        for r in range(1, repeats + 1):
            arc(source, p, words, 2 * r - 1)
        for s in members:
            arc(p, n_p + s, repeats * words, 0)
    for s, quota in enumerate(quotas):
        arc(n_p + s, sink, quota, 0)

    potential = [0] * len(graph)
    while True:
        distance = {source: 0}
        back: dict[int, tuple[int, int]] = {}
        queue = [(0, source)]
        while queue:
            d, a = heapq.heappop(queue)
            if d > distance[a]:
                continue
            for k, (b, capacity, cost, _) in enumerate(graph[a]):
                through = d + cost + potential[a] - potential[b]
                if capacity > 0 and through < distance.get(b, through + 1):
                    distance[b], back[b] = through, (a, k)
                    heapq.heappush(queue, (through, b))
        if sink not in distance:
            break
        far = distance[sink]
        for a, d in distance.items():
            potential[a] += min(d, far)
        for a in range(len(graph)):
            if a not in distance:
                potential[a] += far
        path, at = [], sink
        while at != source:
            path.append(back[at])
            at = back[at][0]
        amount = min(graph[a][k][1] for a, k in path)
        for a, k in path:
            graph[a][k][1] -= amount
            graph[graph[a][k][0]][graph[a][k][3]][1] += amount
    return {
        (p, b - n_p): repeats * words - capacity
        for p, (_, words) in enumerate(patterns)
        for b, capacity, _, _ in graph[p] if n_p <= b < n_p + n_s and capacity < repeats * words
    }


# Documents -------------------------------------------------------------------------

def planned(rows: DataFrame) -> DataFrame:
    """Per pattern how its documents are taken: rounds, the last hash taken, and further hashes.

    ``rows`` has ``sources`` (sorted array of the sources of a document), ``size`` and
    ``h`` (the document's place in the seeded order).  The sources weigh ``WEIGHTS`` in
    turn, by code point, null last.
    """
    spark = rows.sparkSession
    patterns = rows.groupBy("sources").agg(F.sum("size").alias("words"), F.count("*").alias("rows")).limit(MAX_PATTERNS + 1).collect()
    if len(patterns) > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} patterns of sources: name coarser sources")
    names = sorted({s for p in patterns for s in p["sources"]}, key=lambda s: (s is None, s or ""))
    place = {s: i for i, s in enumerate(names)}
    sizes = [0] * len(names)
    for p in patterns:
        for s in p["sources"]:
            sizes[place[s]] += p["words"]
    total = sum(p["words"] for p in patterns)
    targets = filled(sizes, [WEIGHTS[i % len(WEIGHTS)] for i in range(len(names))], SHARE * total) if names else []
    sent = flow([([place[s] for s in p["sources"]], p["words"]) for p in patterns], [round(t) for t in targets])
    used = [0] * len(patterns)
    for (p, _), words in sent.items():
        used[p] += words
    plan = spark.createDataFrame(
        [
            (p["sources"], *divmod(used[i], p["words"] or 1), max(1, p["rows"] // BIN_ROWS),
             sizes[place[p["sources"][0]]], float(targets[place[p["sources"][0]]]))
            for i, p in enumerate(patterns)
        ],
        "sources array<string>, rounds bigint, rest bigint, bins bigint, source_size bigint, target double",
    )
    # The plan has at most MAX_PATTERNS rows, so it may be broadcast.
    binned = rows.join(F.broadcast(plan.select("sources", "rest", "bins")), "sources").where("rest > 0").withColumn(
        "bin", F.floor((F.shiftrightunsigned("h", 32) * F.col("bins")) / (1 << 32))
    )
    per_bin = binned.groupBy("sources", "rest", "bin").agg(F.sum("size").alias("words"))
    ordered = Window.partitionBy("sources").orderBy("bin")
    cut = (
        per_bin.withColumn("upto", F.sum("words").over(ordered)).where(F.col("upto") >= F.col("rest"))
        .withColumn("nth", F.row_number().over(ordered)).where("nth = 1")
        .select("sources", "bin", (F.col("rest") - F.col("upto") + F.col("words")).alias("room"))
    )
    inside = binned.join(F.broadcast(cut), ["sources", "bin"]).groupBy("sources", "room", "h").agg(F.sum("size").alias("size"))

    def close(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        room, last, fill, open_ = int(group["room"].iloc[0]), None, [], True
        in_order = sorted(zip(group["h"].tolist(), group["size"].tolist()), key=lambda x: x[0] % (1 << 64))  # unsigned, as bins are
        taken: dict[int, int] = {}
        for h, size in in_order:
            if size > room:
                open_ = False  # from here on only what still fits
            elif open_:
                last, room = h, room - size
                taken[h] = size
            elif size and len(fill) < FILLERS:
                fill.append(h)
                room -= size
        skip, room = _exchanged(in_order, taken, fill, room)
        return pd.DataFrame({"sources": [list(key[0])], "first": [in_order[0][0]], "last": [last], "fill": [fill], "skip": [skip]})

    closed = inside.groupBy("sources").applyInPandas(close, "sources array<string>, first bigint, last bigint, fill array<bigint>, skip array<bigint>")
    return stored(plan.join(closed, "sources", "left"), "mix")


def _exchanged(in_order: list[tuple[int, int]], taken: dict[int, int], fill: list[int], room: int) -> tuple[list[int], int]:
    """Exchanges single documents of the order for larger ones outside it while that narrows the gap."""
    skip: list[int] = []
    for _ in range(EXCHANGES):
        inside = sorted((size, h) for h, size in taken.items())
        outside = [(size, h) for h, size in in_order if h not in taken and h not in fill and h not in skip]
        if not room or not inside or not outside:
            break
        sizes = np.array([size for size, _ in inside])
        larger = np.array([size for size, _ in outside])
        at = np.searchsorted(sizes, larger - room)  # the smallest one that leaves room for the larger
        gain = np.where(at < len(sizes), larger - sizes[np.minimum(at, len(sizes) - 1)], 0)
        best = int(gain.argmax())
        if gain[best] <= 0:
            break
        gone = inside[int(at[best])][1]
        skip.append(gone)
        del taken[gone]
        fill.append(outside[best][1])
        room -= int(gain[best])
    return skip, room


def place_in_order(seed: int, *columns: Column) -> Column:
    return F.xxhash64(F.lit(seed), *columns)


def times() -> Column:
    """How often a row joined with its plan is taken."""
    before = lambda a, b: F.expr(f"{a} ^ {-(1 << 63)}L") < F.expr(f"{b} ^ {-(1 << 63)}L")  # noqa: E731  unsigned order
    taken = (F.col("rest") > 0) & (
        before("h", "first") | F.array_contains("fill", F.col("h"))
        | (F.col("last").isNotNull() & ~before("last", "h") & ~F.array_contains("skip", F.col("h")))
    )
    return F.col("rounds") + F.when(taken, 1).otherwise(0)  # a null condition counts as not taken


def with_times(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """``rows`` with ``times`` and their pattern's source_size and target; the plan's size is bounded."""
    joined = rows.join(F.broadcast(plan), "sources").withColumn("times", times())
    return joined.drop("rounds", "rest", "bins", "first", "last", "fill", "skip", "h")


def mixed(rows: DataFrame) -> DataFrame:
    """``rows`` (with sources, size, h) and ``times``, ``taken``, source_size, target."""
    return with_times(rows, planned(rows)).withColumn("taken", F.col("times") * F.col("size"))
