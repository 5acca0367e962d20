"""A prefix trie of conversations: one row per distinct beginning, with what sharing it would save.

A turn is known by the 128-bit digest of its role and text, and a conversation is one row of digests and
text lengths (20 bytes a turn), so texts are hashed where they are read and never travel.  Rows are cut into shards by ranges of
(digests, conv_id): a beginning lies in neighbouring shards only, and a conversation that
very many share is cut, too.  A shard pads its turn numbers to matrices, ``TILE`` columns at a time, sorts
the rows by ``lexsort``, and finds by OR-accumulated column changes how many turns each row has in common with the one before.
All figures of a node are sums over its rows once that is known:

* a row whose common part ends above a depth starts a new node there, hence a new child of the node above;
* a row that the next one does not continue is a leaf;
* what the row's turns cost down to the end of the common part is what it saves.

``reduceat`` takes these sums for all nodes of a depth.  Only nodes on the path of a shard's first or last row can go on next door:
these are given out as parts, and are added up by their digest.

Defined cases: a null role or text is empty; rows of equal ``turn`` (null first) are ordered by digest; repeated rows are repeated
turns; rows without a conversation id belong to none; a conversation without turns is a member of the root; an empty table has no
node, not even a root; other columns are not touched.  A conversation is one row and must fit into a task (100 million turns
are 2 GB); the ids of conversations that are all alike pass through one task as a stream of pieces, since their digest is sequential.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pairloom.llm.common import shuffle_tasks, stored

FAMILY = 5  # a conversation begins as the first of its five does
HEADS = 9  # for 0 to 8 turns
DIGEST = 16
TILE = 16
SHARD_BYTES = 32 << 20
PIECE_IDS = 10_000
NOTHING = hashlib.sha256(b"").hexdigest()

COMPLETE, ORPHAN, PART, PIECE = range(4)
SCHEMA = pa.schema([
    ("shard", pa.int32()), ("kind", pa.int32()), ("node", pa.binary()), ("parent", pa.binary()), ("conv_id", pa.int64()),
    ("depth", pa.int64()), ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()),
    ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("ends_sha256", pa.string()),
])
SPARK_SCHEMA = (
    "shard int, kind int, node binary, parent binary, conv_id bigint, depth bigint, parent_conv_id bigint, "
    "n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, ends_sha256 string"
)
RESULT = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
FIGURES = ("n_convs", "n_children", "n_leaves", "saved_tokens")


def sequences(turns: DataFrame) -> DataFrame:
    """One row per ``conv_id``: ``ids``, the digests of its turns in order, and ``sizes``, the bytes of their texts."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary")))
    known = turns.where("conv_id IS NOT NULL").select(
        "conv_id", F.struct("turn", digest.alias("id"), F.octet_length(text).alias("size")).alias("t")
    )
    ordered = known.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    ids = F.unhex(F.array_join(F.transform("t", lambda t: F.hex(t["id"])), ""))
    return ordered.select("conv_id", ids.alias("ids"), F.transform("t", lambda t: t["size"]).alias("sizes"))


def rebuilt(rows: DataFrame) -> DataFrame:
    """Sequences that begin with the first ``h`` turns of the first of their family and go on with their own after ``h``."""
    heads = rows.select(
        F.col("conv_id").alias("first"),
        F.substring("ids", 1, DIGEST * (HEADS - 1)).alias("head_ids"), F.slice("sizes", 1, HEADS - 1).alias("head_sizes"),
    )
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS).cast("int")
    own = rows.withColumns({"first": F.col("conv_id") - F.col("conv_id") % FAMILY, "h": h})
    return own.join(heads, "first", "left").select(
        "conv_id",
        F.concat(
            F.coalesce(F.substr("head_ids", F.lit(1), DIGEST * F.col("h")), F.lit(b"")), F.substr("ids", DIGEST * F.col("h") + 1)
        ).alias("ids"),
        F.concat(
            F.coalesce(F.slice("head_sizes", F.lit(1), F.col("h")), F.array().cast("array<int>")),
            F.slice("sizes", F.col("h") + 1, F.greatest(F.size("sizes") - F.col("h"), F.lit(0))),
        ).alias("sizes"),
    )


def common_turns(a: bytes, b: bytes) -> int:
    """Number of leading turns that two digest sequences share."""
    n = min(len(a), len(b))
    differ = np.frombuffer(a[:n], np.uint8) != np.frombuffer(b[:n], np.uint8)
    return int(differ.argmax()) // DIGEST if differ.any() else n // DIGEST


class Shard:
    """The sorted rows of one shard, and the figures of each row that nodes add up."""

    def __init__(self, conv_id: np.ndarray, ids: list[bytes], sizes: list[np.ndarray], before: bytes | None, after: bytes | None):
        self.n_turns = np.array([len(i) // DIGEST for i in ids], np.int64)
        self.offsets = np.concatenate(([0], np.cumsum(self.n_turns)))
        self.numbers = self._numbered(np.frombuffer(b"".join(ids), ">u8").reshape(-1, 2))
        order = np.lexsort((conv_id, self._rank()))
        self.first, self.last = ids[order[0]], ids[order[-1]]
        self.to_before = -1 if before is None else common_turns(before, self.first)
        self.to_after = -1 if after is None else common_turns(self.last, after)
        self.common = self._common(order)
        self.common[0] = self.to_before
        self.conv_id, self.n_turns, self.offsets = conv_id[order], self.n_turns[order], self.offsets[order]
        self.leaf = np.append(self.common[1:], self.to_after) < self.n_turns
        self.paid = np.concatenate(([0], np.cumsum(np.concatenate([*sizes, np.zeros(0, np.int64)]), dtype=np.int64)))
        self.shared = self.paid[self.offsets + np.maximum(self.common, 0)]

    @staticmethod
    def _numbered(digests: np.ndarray) -> np.ndarray:
        """Turn numbers from 1 in the order of the digests."""
        order = np.lexsort((digests[:, 1], digests[:, 0]))
        ordered = digests[order]
        numbers = np.zeros(len(order), np.int32)
        numbers[order] = 1 + np.cumsum(np.any(ordered != np.roll(ordered, 1, 0), axis=1) & (np.arange(len(order)) > 0))
        return numbers

    def _padded(self, rows: np.ndarray, tile: int) -> np.ndarray:
        """Turn numbers of the rows in the columns of a tile, 0 beyond their end."""
        column = tile * TILE + np.arange(TILE)
        inside = column < self.n_turns[rows][:, None]
        at = np.where(inside, self.offsets[rows][:, None] + column, 0)
        return np.where(inside, self.numbers[at] if len(self.numbers) else 0, 0).astype(np.int32)

    def _rank(self) -> np.ndarray:
        """Rank of every row's sequence: equal ones share it.  The last columns first, so only long rows have many."""
        rank = np.zeros(len(self.n_turns), np.int64)
        for tile in reversed(range(-(-int(self.n_turns.max()) // TILE))):
            rows = np.flatnonzero(self.n_turns > tile * TILE)
            matrix, rest = self._padded(rows, tile), rank[rows]
            order = np.lexsort((rest, *matrix.T[::-1]))
            changes = np.any(matrix[order[1:]] != matrix[order[:-1]], axis=1) | (rest[order[1:]] != rest[order[:-1]])
            rank = np.zeros(len(self.n_turns), np.int64)
            rank[rows[order]] = 1 + np.concatenate(([0], np.cumsum(changes)))
        return rank

    def _common(self, order: np.ndarray) -> np.ndarray:
        """Turns that each row in order shares with the one before."""
        common = np.zeros(len(order), np.int64)
        alive, tile = np.arange(1, len(order)), 0
        while len(alive):
            above, row = self._padded(order[alive - 1], tile), self._padded(order[alive], tile)
            changed = np.logical_or.accumulate((above != row) | (row == 0), axis=1)
            same = TILE - changed.sum(axis=1)
            common[alive] += same
            alive, tile = alive[same == TILE], tile + 1
        return common

    def _keys(self, ids: bytes, depth: int) -> list[bytes]:
        """Digests of the beginnings with 0 to ``depth`` turns."""
        state, keys = hashlib.md5(), []
        for d in range(depth + 1):
            keys.append(state.digest())
            state.update(ids[DIGEST * d:DIGEST * (d + 1)])
        return keys

    def nodes(self, shard: int) -> Iterator[pa.Table]:
        """The nodes of one depth after the other."""
        first_keys, last_keys = self._keys(self.first, self.to_before), self._keys(self.last, self.to_after)
        rows, depth = np.arange(len(self.conv_id)), 0
        above = np.zeros(len(rows), np.int64)  # each row's node one level higher
        above_id, above_key = np.zeros(0, np.int64), {}
        while len(rows):
            begins = self.common[rows] < depth
            begins[0] = True
            at = np.flatnonzero(begins)
            total = lambda values: np.add.reduceat(values.astype(np.int64), at)
            common, n_turns = self.common[rows], self.n_turns[rows]
            saved = self.shared[rows] - self.paid[self.offsets[rows] + max(depth - 1, 0)]
            figures = (
                np.diff(np.append(at, len(rows))), total((common <= depth) & (n_turns > depth)), total(self.leaf[rows]), total(np.maximum(saved, 0)),
            )
            ending = total(n_turns == depth)
            least = np.minimum.reduceat(self.conv_id[rows], at)
            key = {}
            if rows[0] == 0 and self.to_before >= depth:
                key[0] = first_keys[depth]
            if rows[-1] == len(self.conv_id) - 1 and self.to_after >= depth:
                key[len(at) - 1] = last_keys[depth]
            parent = above[rows[at]]
            kind = np.full(len(at), COMPLETE)
            kind[np.isin(parent, list(above_key))] = ORPHAN
            kind[list(key)] = PART
            ends = [NOTHING] * len(at)
            pieces = []
            for node in np.flatnonzero(ending).tolist():
                ids = self.conv_id[rows[at[node]]:rows[at[node]] + ending[node]].tolist()
                if node in key:
                    pieces += [(key[node], ids[i], ",".join(map(str, ids[i:i + PIECE_IDS]))) for i in range(0, len(ids), PIECE_IDS)]
                else:
                    ends[node] = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
            yield pa.Table.from_arrays([
                pa.array(np.full(len(at), shard), pa.int32()), pa.array(kind, pa.int32()),
                pa.array([key.get(i) for i in range(len(at))] if key else [None] * len(at), pa.binary()),
                pa.array([above_key.get(p) for p in parent.tolist()] if above_key else [None] * len(at), pa.binary()),
                pa.array(least, pa.int64()), pa.array(np.full(len(at), depth), pa.int64()),
                pa.array(above_id[parent], pa.int64()) if depth else pa.nulls(len(at), pa.int64()),
                *[pa.array(f, pa.int64()) for f in figures], pa.array(ends, pa.string()),
            ], schema=SCHEMA)
            if pieces:
                yield pa.Table.from_pylist(
                    [{"shard": shard, "kind": PIECE, "node": k, "conv_id": i, "ends_sha256": text} for k, i, text in pieces], schema=SCHEMA
                )
            above[rows] = np.cumsum(begins) - 1
            above_id, above_key, depth = least, key, depth + 1
            rows = rows[self.n_turns[rows] >= depth]


def _shard_nodes(shard: pa.Table, edge: pa.Table) -> pa.Table:
    """All nodes of a shard, from its rows and the sequences next to it."""
    if not shard.num_rows:
        return SCHEMA.empty_table()
    before, after = edge.column("before")[0].as_py(), edge.column("after")[0].as_py()
    sizes = shard.column("sizes").combine_chunks()
    made = Shard(
        shard.column("conv_id").to_numpy(), shard.column("ids").to_pylist(), [sizes.flatten().to_numpy().astype(np.int64)], before, after
    )
    return pa.concat_tables(made.nodes(shard.column("shard")[0].as_py()))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's pieces; the rows come by node, in the order of the ids."""
    node, state = None, None

    def done() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([state.hexdigest()])], names=["node", "ends"])

    for batch in batches:
        for key, text in zip(batch.column("node").to_pylist(), batch.column("ends_sha256")):
            if key == node:
                state.update(b",")
            else:
                if node is not None:
                    yield done()
                node, state = key, hashlib.sha256()
            state.update(text.as_buffer())
    if node is not None:
        yield done()


def trie(rows: DataFrame, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """The nodes of ``conv_id, ids, sizes`` rows with unique ids."""
    spark = rows.sparkSession
    rows = stored(rows, "sequences")
    size = rows.agg(F.sum(F.octet_length("ids"))).first()[0] or 0
    shards = max(shuffle_tasks(spark), -(-size // shard_bytes))
    dealt = stored(rows.repartitionByRange(shards, "ids", "conv_id").withColumn("shard", F.spark_partition_id()), "shards")
    ends = dealt.groupBy("shard").agg(F.min("ids").alias("least"), F.max("ids").alias("most"))
    neighbours = Window.orderBy("shard")  # one row a shard
    edges = ends.select("shard", F.lag("most").over(neighbours).alias("before"), F.lead("least").over(neighbours).alias("after"))
    found = stored(dealt.groupBy("shard").cogroup(edges.groupBy("shard")).applyInArrow(_shard_nodes, SPARK_SCHEMA), "nodes")
    return _recombined(found)


def _recombined(found: DataFrame) -> DataFrame:
    """Complete nodes as they are, those of several shards added up, and parents' ids where the parent is of several shards."""
    parts = found.where(F.col("kind") == PART)
    pieces = found.where(F.col("kind") == PIECE).select("node", "conv_id", "ends_sha256")
    ends = pieces.repartition("node").sortWithinPartitions("node", "conv_id").select("node", "ends_sha256").mapInArrow(_digests, "node binary, ends string")
    totals = parts.groupBy("node").agg(
        F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"), F.max("parent").alias("parent"),
        *[F.sum(c).alias(c) for c in FIGURES],
    )
    whole = totals.join(ends, "node", "left").withColumn("ends_sha256", F.coalesce("ends", F.lit(NOTHING)))
    ids = totals.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    # every shard has the ids of its own parts: a parent with very many children is looked up shard by shard
    local = parts.select("shard", F.col("node").alias("parent")).join(ids, "parent")
    orphans = found.where(F.col("kind") == ORPHAN).drop("parent_conv_id").join(local, ["shard", "parent"])
    complete = found.where(F.col("kind") == COMPLETE)
    joined = whole.join(ids, "parent", "left")
    return complete.select(*RESULT).unionByName(orphans.select(*RESULT)).unionByName(joined.select(*RESULT))
