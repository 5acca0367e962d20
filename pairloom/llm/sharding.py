"""Shards by fixed virtual slots: rows hash into thousands of slots, a table maps slots to shards.

The hash of a row never changes, only the map does.  It is stored in versions: version 0
deals the slots round; each rebalancing moves single slots, as few as it needs, from shards
that hold too many bytes to those that hold too few, and is the next version.

The hash covers the row's id, size and checksum, and copies of one row beyond the 64th
go to further slots, so neither a common id nor a row repeated without end fills one slot.
Inside its shard a row has a number without gaps: slots have offsets, and only a part of a
slot is ever sorted in one task.

Defined cases: a null text has size 1 and the checksum of no bytes; a null id is a value like
any other; repeated rows are rows of their own; an empty table has a map and no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pairloom.llm.common import stored

SLOTS = 4096  # fixed for the life of a data set
COPIES = 64
PART_ROWS = 50_000


def hashed(rows: DataFrame, columns: list[str], size: str, slots: int = SLOTS) -> DataFrame:
    """Distinct rows with their number of copies ``n``, their virtual slot, and their bytes."""
    same = rows.groupBy(*columns).agg(F.count("*").alias("copies"))
    return same.withColumn("piece", F.explode(F.sequence(F.lit(0), F.floor((F.col("copies") - 1) / COPIES)))).withColumns({
        "n": F.least(F.lit(COPIES), F.col("copies") - F.col("piece") * COPIES),
        "slot_hash": F.xxhash64(*columns, "piece"),
    }).withColumns({
        "virtual_slot": F.pmod("slot_hash", F.lit(slots)).cast("int"), "slot_bytes": F.col("n") * F.col(size),
    }).drop("copies", "piece")


def first_map(slots: int, shards: int) -> list[int]:
    return [slot % shards for slot in range(slots)]


def rebalanced(current: list[int], loads: list[int], shards: int) -> list[int]:
    """The map edited slot by slot: while it narrows the gap, one slot leaves the fullest shard.

    The slot that moves is the largest whose move does not overfill the emptiest shard by
    more than the fullest had; shards that are new (none of the slots) begin empty.
    """
    edited = list(current)
    held: list[list[tuple[int, int]]] = [[] for _ in range(shards)]
    for slot, shard in enumerate(edited):
        if loads[slot]:
            held[shard].append((loads[slot], slot))
    for one in held:
        one.sort()
    full = [sum(load for load, _ in one) for one in held]
    while True:
        most, least = max(range(shards), key=full.__getitem__), min(range(shards), key=full.__getitem__)
        gap = full[most] - full[least]
        # The best single slot is the one nearest to half the gap; any below the gap helps.
        best = min((x for x in held[most] if x[0] < gap), key=lambda x: abs(2 * x[0] - gap), default=None)
        if best is None:
            return edited
        held[most].remove(best)
        held[least].append(best)
        full[most] -= best[0]
        full[least] += best[0]
        edited[best[1]] = least


def store_map(spark: SparkSession, version: int, current: list[int], path: str) -> DataFrame:
    """Adds a version of the map to the table at ``path``: (version, virtual_slot, shard)."""
    rows = spark.createDataFrame(
        [(version, slot, shard) for slot, shard in enumerate(current)], "version int, virtual_slot int, shard int"
    )
    rows.coalesce(1).write.mode("append").parquet(path)
    return rows


def latest_map(spark: SparkSession, path: str) -> DataFrame:
    every = spark.read.parquet(path)
    return every.join(every.agg(F.max("version").alias("version")), "version").select("virtual_slot", "shard")


def sharded(rows: DataFrame, columns: list[str], size: str, path: str, shards: int = 8, slots: int = SLOTS) -> DataFrame:
    """Every row of ``columns`` with virtual_slot, shard, and its number ``slot`` in the shard.

    The map's versions are kept at ``path``: the first one, and the one that the bytes asked for.
    """
    spark = rows.sparkSession
    placed = stored(hashed(rows, columns, size, slots), "hashed")
    found = {r["virtual_slot"]: r["b"] for r in placed.groupBy("virtual_slot").agg(F.sum("slot_bytes").alias("b")).collect()}
    loads = [found.get(slot, 0) for slot in range(slots)]  # one number a slot, whatever the input
    current = first_map(slots, shards)
    store_map(spark, 0, current, path)
    store_map(spark, 1, rebalanced(current, loads, shards), path)
    mapped = placed.join(F.broadcast(latest_map(spark, path)), "virtual_slot")

    parts = max(1, -(-placed.count() // (slots * PART_ROWS)))
    mapped = mapped.withColumn("part", F.pmod(F.shiftrightunsigned("slot_hash", 20), F.lit(parts)))
    sizes = mapped.groupBy("shard", "virtual_slot", "part").agg(F.sum("n").alias("rows"))
    before = Window.partitionBy("shard").orderBy("virtual_slot", "part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.withColumn("offset", F.coalesce(F.sum("rows").over(before), F.lit(0))).select("virtual_slot", "part", "offset")
    inside = Window.partitionBy("virtual_slot", "part").orderBy("slot_hash", *columns).rowsBetween(Window.unboundedPreceding, -1)
    return (
        mapped.withColumn("ahead", F.coalesce(F.sum("n").over(inside), F.lit(0)))
        .join(offsets, ["virtual_slot", "part"])
        .withColumn("copy", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1)))
        .select(*columns, "virtual_slot", "shard", (F.col("offset") + F.col("ahead") + F.col("copy")).alias("slot"))
    )
