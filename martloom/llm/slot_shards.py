"""Sharding by fixed virtual slots.

A record's id is hashed into one of ``SLOTS`` virtual slots; a small versioned map says which shard holds a
slot. Adding a shard edits the map: the new shard takes some slots from each of the others and nothing else
moves, so the id and the number of shards decide where a row goes. Rebalancing by weight edits the map as
well, from the bytes counted per slot.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from martloom.session import write_once

SLOTS = 4096
SHARDS = 16


def first_map(slots: int = SLOTS) -> list[int]:
    """The map of one shard."""
    return [0] * slots


def with_one_more(held: list[int]) -> list[int]:
    """The map with one more shard, which takes slots in turn from whichever shard has most; the highest slots go."""
    shards = max(held) + 1
    by_shard: list[list[int]] = [[] for _ in range(shards)]
    for slot, shard in enumerate(held):
        by_shard[shard].append(slot)
    out = list(held)
    for _ in range(len(held) // (shards + 1)):
        giver = max(range(shards), key=lambda s: (len(by_shard[s]), -s))
        out[by_shard[giver].pop()] = shards
    return out


def map_for(shards: int, slots: int = SLOTS) -> list[int]:
    """The map after growing from one shard to ``shards``."""
    if not 1 <= shards <= slots:
        raise ValueError("there must be at least one slot a shard")
    held = first_map(slots)
    for _ in range(shards - 1):
        held = with_one_more(held)
    return held


def rebalanced(held: list[int], weights: dict[int, int], tolerance: float = 0.05) -> list[int]:
    """Move slots from heavy shards to light ones until the heaviest is within ``tolerance`` of the mean or no move helps."""
    shards = max(held) + 1
    load = [0] * shards
    slots: list[list[tuple[int, int]]] = [[] for _ in range(shards)]
    for slot, shard in enumerate(held):
        load[shard] += weights.get(slot, 0)
        heapq.heappush(slots[shard], (weights.get(slot, 0), slot))
    out, mean = list(held), sum(load) / shards
    while True:
        heavy, light = max(range(shards), key=lambda s: (load[s], -s)), min(range(shards), key=lambda s: (load[s], s))
        room = min(load[heavy] - mean, mean - load[light])
        fitting = [x for x in slots[heavy] if 0 < x[0] <= max(room, 0)]
        if load[heavy] <= mean * (1 + tolerance) or not fitting:
            return out
        best = max(fitting)
        slots[heavy].remove(best)
        slots[light].append(best)
        load[heavy] -= best[0]
        load[light] += best[0]
        out[best[1]] = light


def slot_of(column: str, slots: int = SLOTS):
    """Virtual slot of an id; a null id has a slot like any other value."""
    return F.pmod(F.xxhash64(F.coalesce(F.col(column).cast("string"), F.lit(""))), F.lit(slots)).cast("int")


def slot_bytes(records: DataFrame) -> DataFrame:
    """``virtual_slot, slot_bytes, slot_rows``; counted in each task first, so a heavy slot is no heavy task."""
    return records.groupBy("virtual_slot").agg(F.sum("size").alias("slot_bytes"), F.count("*").alias("slot_rows"))


def map_table(spark: SparkSession, versions: dict[int, list[int]]) -> DataFrame:
    """``version, virtual_slot, shard``: every version of the map, so that an older placement can be read."""
    return spark.createDataFrame([(v, slot, shard) for v, held in versions.items() for slot, shard in enumerate(held)],
                                 "version int, virtual_slot int, shard int")


def place(docs: DataFrame, shards: int = SHARDS, slots: int = SLOTS) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` and the row's virtual_slot with its bytes.

    The law is ``key``. ``slot`` numbers the rows of a shard from 0 without gaps: by scanned partition, then id and checksum.
    A null text has size 1 and the checksum of nothing. Rows with one id, null included, share a shard; repeated rows have a
    place each. Only doc_id and text are read; text itself is never moved.
    """
    spark = docs.sparkSession
    body = F.coalesce("text", F.lit("")).cast("binary")
    records = write_once(docs.select(
        "doc_id", (F.octet_length(body).cast("bigint") + 1).alias("size"), F.crc32(body).alias("text_crc32"),
        slot_of("doc_id", slots).alias("virtual_slot"), F.spark_partition_id().alias("part")), "slot-records")
    versions = write_once(map_table(spark, {shards: map_for(shards, slots), shards + 1: map_for(shards + 1, slots)}), "slot-map")
    now = versions.where(F.col("version") == shards).select(F.col("virtual_slot").alias("s"), "shard")
    then = versions.where(F.col("version") == shards + 1).select(F.col("virtual_slot").alias("g"), F.col("shard").alias("grown_shard"))
    loads = slot_bytes(records).select(F.col("virtual_slot").alias("b"), "slot_bytes")
    # The map has as many rows as there are slots, whatever the data.
    table = now.join(then, F.col("s") == F.col("g")).join(loads, F.col("s") == F.col("b"), "left").select("s", "shard", "grown_shard", "slot_bytes")
    placed = records.join(F.broadcast(table), F.col("virtual_slot") == F.col("s")).drop("s")
    # A part is what one task scanned, so no group of (shard, part) is larger than that.
    counts = placed.groupBy(F.col("shard").alias("c_shard"), F.col("part").alias("c_part")).agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("c_shard").orderBy("c_part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("c_shard", "c_part", F.coalesce(before, F.lit(0)).alias("offset"))
    ordered = placed.withColumn("at", F.row_number().over(Window.partitionBy("shard", "part").orderBy("doc_id", "text_crc32", "size")))
    numbered = ordered.join(offsets, (F.col("shard") == F.col("c_shard")) & (F.col("part") == F.col("c_part")))
    return numbered.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
                           (F.col("offset") + F.col("at") - 1).cast("bigint").alias("slot"), "grown_shard", "virtual_slot", "slot_bytes")
