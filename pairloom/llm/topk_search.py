"""Exact top-k search on 64-bit binary codes by incremental multi-index hashing.

A code is cut into segments, and each segment indexes the codes by its value.  For a query
the search radius of the segments grows one at a time; once ``s`` is done for the first j
segments and ``s - 1`` for the others, every code within ``m * s + j - 1`` bits has been
seen (a nearer code would differ by fewer bits in some segment).  The search of a query
ends when its k-th verified distance is covered so, however large the radius: segments are as
wide as the logarithm of the number of codes, so their values are never many more than the codes.

Equal codes are searched once, whoever they belong to, and only their k + 1 smallest ids
can be in an answer; so a code that a third of all rows share is one entry.  The distinct
codes are dealt into blocks of bounded size, the distinct query codes into blocks too, and each
pair of blocks is one task, which makes the index once; the best of all blocks win.  Few queries
are cut into more blocks, so that all tasks of a shuffle have some.

Defined cases: a null vector, one of another length, or a null id has no code, and is neither
found nor answered; a null or NaN component counts as 0 and as 1 bit; ties go to the
smaller id; repeated rows count once; a row is not its own neighbour; fewer than k others
give fewer than k rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairloom.llm.common import shuffle_tasks, stored

BITS = 64
INDEX_CODES = 1 << 20  # codes of a block, some 60 bytes each with the index
QUERY_CODES = 1 << 16
FEW_QUERIES = 256  # no block of queries is cut below about as many
PROBES = 1 << 20  # codes that are looked at side by side; one query's are at most the block


def sign_code(vector: Column, dimensions: int = BITS) -> Column:
    """The signs of a vector's components as a 64-bit code; null for another length."""
    bit = F.transform(
        vector, lambda v, i: F.when(v > 0, F.call_function("shiftleft", F.lit(1).cast("bigint"), i)).otherwise(F.lit(0).cast("bigint"))
    )
    code = F.aggregate(bit, F.lit(0).cast("bigint"), lambda a, b: a.bitwiseOR(b))
    return F.when(F.size(vector) == dimensions, code)


def exact_topk(
    rows: DataFrame, queries: DataFrame, k: int, key: str = "id", code: str = "code",
    index_codes: int = INDEX_CODES, query_codes: int = QUERY_CODES,
) -> DataFrame:
    """``key``, rank 1..k, ``neighbor``, ``distance`` of the k nearest rows of every query row."""
    rows = rows.select(F.col(key).alias("id"), F.col(code).alias("code")).dropna().distinct()
    asked = stored(queries.select(F.col(key).alias("id"), F.col(code).alias("code")).dropna().distinct(), "queries")
    by_code = Window.partitionBy("code").orderBy("id")
    members = stored(rows.withColumn("nth", F.row_number().over(by_code)).where(F.col("nth") <= k + 1), "members")

    codes = members.where("nth = 1").select("code", "id")
    n_codes, n_asked = codes.count(), asked.select("code").distinct().count()
    shards = -(-n_codes // index_codes) or 1
    spread = min(-(-shuffle_tasks(rows.sparkSession) // shards), -(-n_asked // FEW_QUERIES))
    blocks = max(1, -(-n_asked // query_codes), spread)

    def pack(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        found = group.sort_values("code")
        return pd.DataFrame({"part": [key[0]], "codes": [found["code"].to_numpy(np.int64).tobytes()],
                             "ids": [found["id"].to_numpy(np.int64).tobytes()]})

    packed = "part bigint, codes binary, ids binary"
    index = codes.withColumn("part", F.pmod(F.xxhash64("code"), F.lit(shards))).groupBy("part").applyInPandas(pack, packed)
    blocked = asked.groupBy("code").agg(F.min("id").alias("id")).withColumn(
        "part", F.pmod(F.xxhash64("code", F.lit(1)), F.lit(blocks))
    ).groupBy("part").applyInPandas(pack, packed)
    # A block of queries meets each block of the index: a few rows of packed codes, never pairs of rows.
    tasks = blocked.select(
        F.col("part").alias("block"), F.col("codes").alias("asked"), F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(shards - 1))).alias("part")
    ).join(index, "part").repartition(shards * blocks, "block", "part")

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for wanted, held, ids in zip(batch["asked"], batch["codes"], batch["ids"]):
                yield _search(np.frombuffer(held, np.int64), np.frombuffer(ids, np.int64), np.frombuffer(wanted, np.int64), k + 1)

    near = tasks.mapInPandas(search, "asked bigint, code bigint, first bigint, distance int")
    best = Window.partitionBy("asked").orderBy("distance", "first")
    near = near.withColumn("nth", F.row_number().over(best)).where(F.col("nth") <= k + 1).select("asked", "code", "distance")
    ids = members.groupBy("code").agg(F.sort_array(F.collect_list("id")).alias("ids"))  # at most k + 1 each
    ranked = Window.partitionBy("id").orderBy("distance", "neighbor")
    return (
        asked.withColumnRenamed("code", "asked").join(near, "asked").join(ids, "code")
        .select("id", "distance", F.explode("ids").alias("neighbor")).where("neighbor <> id")
        .withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)
        .select(F.col("id").alias(key), "rank", "neighbor", "distance")
    )


class SegmentIndex:
    """The distinct codes of a block, indexed by the values of segments about as wide as the logarithm of their number."""

    def __init__(self, codes: np.ndarray, ids: np.ndarray):
        self.codes, self.ids = codes, ids
        segments = -(-BITS // max(1, len(codes).bit_length()))
        cuts = np.arange(segments + 1) * BITS // segments
        self.widths, self.shifts = np.diff(cuts).tolist(), cuts[:-1].astype(np.uint64)
        self.masks, self.orders, self.starts = [], [], []
        unsigned = codes.view(np.uint64)
        for width, shift in zip(self.widths, self.shifts):
            values = np.arange(1 << width, dtype=np.int64)
            weights = np.bitwise_count(values)
            self.masks.append([values[weights == s] for s in range(width + 1)])
            part = self._segment(unsigned, width, shift)
            self.orders.append(np.argsort(part, kind="stable"))
            self.starts.append(np.append(0, np.cumsum(np.bincount(part, minlength=1 << width))))

    @staticmethod
    def _segment(codes: np.ndarray, width: int, shift: np.uint64) -> np.ndarray:
        return ((codes >> shift) & np.uint64((1 << width) - 1)).astype(np.int64)

    def search(self, queries: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of each query's k nearest codes the query's number, the code's, and the distance; and how many codes were verified by query."""
        wanted = queries.view(np.uint64)
        best = [np.zeros(0, np.int64)] * 3  # query, code, distance
        verified = np.zeros(len(queries), np.int64)
        open_ = np.arange(len(queries))
        for s in range(max(self.widths) + 1):
            for j, width in enumerate(self.widths):
                if not len(open_) or s > width:  # a segment whose values are all done has shown every code
                    return *best, verified
                best = self._grown(best, wanted, open_, s, j, k, verified)
                # Within this distance every code has been seen.
                covered = len(self.widths) * s + j
                near = np.bincount(best[0][best[2] <= covered], minlength=len(queries))
                open_ = open_[near[open_] < k]
        return *best, verified

    def _grown(self, best: list, wanted: np.ndarray, open_: np.ndarray, s: int, j: int, k: int, verified: np.ndarray) -> list:
        """The best codes after segment ``j`` of the open queries has the radius ``s``."""
        masks, starts = self.masks[j][s], self.starts[j]
        mine = self._segment(wanted[open_], self.widths[j], self.shifts[j])
        first = 0
        step = max(1, PROBES // len(masks))
        found = [best]
        while first < len(open_):
            probes = mine[first:first + step, None] ^ masks
            begin = starts[probes]
            size = starts[probes + 1] - begin
            # As many queries as have few enough codes together, or one.
            fits = max(1, int(np.searchsorted(np.cumsum(size.sum(axis=1)), PROBES, "right")))
            begin, size = begin[:fits].ravel(), size[:fits].ravel()
            at = np.arange(size.sum()) + np.repeat(begin - np.cumsum(size) + size, size)
            row = self.orders[j][at]
            query = np.repeat(np.repeat(open_[first:first + fits], len(masks)), size)
            differs = self.codes[row].view(np.uint64) ^ wanted[query]
            new = np.ones(len(row), bool)
            for i, (width, shift) in enumerate(zip(self.widths, self.shifts)):
                if i != j and (s or i < j):  # those that another segment showed before are not new
                    new &= np.bitwise_count(self._segment(differs, width, shift)) > (s if i < j else s - 1)
            row, query, distance = row[new], query[new], np.bitwise_count(differs[new]).astype(np.int64)
            verified += np.bincount(query, minlength=len(verified))
            found.append([query, row, distance])
            if sum(len(x[0]) for x in found) > PROBES:
                found = [self._nearest(found, k)]
            first += fits
        return self._nearest(found, k)

    def _nearest(self, found: list, k: int) -> list:
        query, row, distance = (np.concatenate(x) for x in zip(*found))
        order = np.lexsort((self.ids[row], distance, query))
        query = query[order]
        place = np.arange(len(query)) - np.searchsorted(query, query)
        order = order[place < k]
        return [query[place < k], row[order], distance[order]]


def _search(codes: np.ndarray, ids: np.ndarray, queries: np.ndarray, k: int) -> pd.DataFrame:
    """The k nearest codes of each query in one block, by (distance, id)."""
    query, row, distance, _ = SegmentIndex(codes, ids).search(queries, k)
    return pd.DataFrame({"asked": queries[query], "code": codes[row], "first": ids[row], "distance": distance.astype(np.int32)})
