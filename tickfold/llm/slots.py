"""Sharding by fixed virtual slots.

A record is hashed into one of ``SLOTS`` slots for good. Bytes are summed per slot, and a table says which shard holds a
slot. The table is small (one row per slot, whatever the data), versioned, and edited when shards are added or have grown
apart; records themselves are never looked at again. A slot that a repeated record has made heavier than a small part of a
shard is cut into pieces, each with its own row in the table.

Null texts have size 8 and the checksum of the empty text; null ids are hashed like any value. Repeated rows are separate
records of the same slot (and may lie in different pieces of it). An empty table gives an empty result and a table of
empty slots.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickfold.llm.common import stage

SLOTS = 4096
#: A piece of a slot holds at most this part of a shard's fair share of the bytes (but for a single record).
PIECE_SHARE = 0.02
#: Every record costs this many bytes beside its text.
OVERHEAD = 8


def records(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, size, text_crc32, slot and ``task`` (the writing task) of every record, written to the shared folder."""
    content = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(doc_id).alias("doc_id"),
        (F.octet_length(content) + OVERHEAD).cast("long").alias("size"),
        F.crc32(content).alias("text_crc32"),
    ).select(
        "*",
        F.pmod(F.xxhash64("doc_id", "text_crc32", "size"), F.lit(SLOTS)).cast("int").alias("virtual_slot"),
        F.spark_partition_id().alias("task"),
    )
    return stage(rows, "slot-records")


def pieces(rows: DataFrame, shards: int) -> DataFrame:
    """``rows`` with ``piece``: 0, or the part of a heavy slot. Cut by running bytes, so pieces are about equal.

    Running sums go over (slot, task) groups first and then inside one group, so that no task sees a whole heavy slot.
    """
    total = rows.agg(F.sum("size")).first()[0] or 0
    most = max(1, int(total / shards * PIECE_SHARE))
    groups = rows.groupBy("virtual_slot", "task").agg(F.sum("size").alias("bytes"))
    earlier = Window.partitionBy("virtual_slot").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = groups.select("virtual_slot", "task", F.coalesce(F.sum("bytes").over(earlier), F.lit(0)).alias("before"))
    # equal records are interchangeable, so ties need no further order
    within = Window.partitionBy("virtual_slot", "task").orderBy("doc_id", "text_crc32", "size")
    running = F.sum("size").over(within.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (
        rows.withColumn("so_far", running)
        .join(offsets, ["virtual_slot", "task"])
        .withColumn("piece", F.floor((F.col("before") + F.col("so_far") - F.col("size")) / most).cast("int"))
        .drop("so_far", "before")
    )


def assign(sizes: dict[tuple[int, int], int], shards: int) -> dict[tuple[int, int], int]:
    """A first table: slots by falling size, each to the shard with the fewest bytes so far."""
    load = [(0, shard) for shard in range(shards)]
    out = {}
    for key in sorted(sizes, key=lambda k: (-sizes[k], k)):
        held, shard = heapq.heappop(load)
        out[key] = shard
        heapq.heappush(load, (held + sizes[key], shard))
    return out


def rebalance(table: dict[tuple[int, int], int], sizes: dict[tuple[int, int], int], shards: int) -> dict[tuple[int, int], int]:
    """The table edited for ``shards`` shards and today's sizes: slots of overfull shards move to the emptiest ones.

    Only moves that lessen the spread are made, so few slots move; slots new to the table are placed first.
    """
    out = {k: s for k, s in table.items() if k in sizes}
    load = [0] * shards
    for k, s in out.items():
        load[s] += sizes[k]
    for k in sorted(sizes.keys() - out.keys(), key=lambda k: (-sizes[k], k)):
        out[k] = load.index(min(load))
        load[out[k]] += sizes[k]
    held: list[list[tuple[int, tuple[int, int]]]] = [[] for _ in range(shards)]
    for k, s in out.items():
        held[s].append((sizes[k], k))
    for own in held:
        own.sort()
    while True:
        high, low = load.index(max(load)), load.index(min(load))
        gap = load[high] - load[low]
        fit = next((i for i in range(len(held[high]) - 1, -1, -1) if 0 < held[high][i][0] < gap), None)
        if fit is None or gap <= max(load) * 0.001:
            return out
        # the largest slot of at most half the gap, else the smallest that still lessens it
        fit = next((i for i in range(fit, -1, -1) if held[high][i][0] * 2 <= gap), 0)
        n, k = held[high].pop(fit)
        if not 0 < n < gap:
            return out
        out[k] = low
        load[high] -= n
        load[low] += n
        held[low].append((n, k))
        held[low].sort()


def slot_sizes(cut: DataFrame) -> dict[tuple[int, int], int]:
    """Bytes per slot and piece: at most ``SLOTS`` + shards / ``PIECE_SHARE`` rows, whatever the data."""
    found = cut.groupBy("virtual_slot", "piece").agg(F.sum("size")).collect()
    return {(s, p): n for s, p, n in found}


def table_of(cut: DataFrame, assigned: dict[tuple[int, int], int], version: int) -> DataFrame:
    """The slot table as rows, to be stored: version, virtual_slot, piece, shard."""
    rows = [(version, s, p, shard) for (s, p), shard in sorted(assigned.items())]
    return cut.sparkSession.createDataFrame(rows, "version int, virtual_slot int, piece int, shard int")


def numbered(cut: DataFrame, table: DataFrame) -> DataFrame:
    """Records with ``shard`` and their position in it from 0 on, without gaps, in ``slot``.

    Positions are counted inside (slot, piece, task) groups and moved by the counts of the groups before, so no task
    sorts a whole shard.
    """
    group = ["virtual_slot", "piece", "task"]
    counts = cut.groupBy(group).agg(F.count("*").alias("n"))
    per_piece = Window.partitionBy("virtual_slot", "piece").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    in_piece = counts.select(*group, F.coalesce(F.sum("n").over(per_piece), F.lit(0)).alias("in_piece"))
    # one row per slot and piece: bounded by the table
    per_shard = Window.partitionBy("shard").orderBy("virtual_slot", "piece").rowsBetween(Window.unboundedPreceding, -1)
    in_shard = (
        counts.groupBy("virtual_slot", "piece")
        .agg(F.sum("n").alias("n"))
        .join(F.broadcast(table), ["virtual_slot", "piece"])
        .select("virtual_slot", "piece", "shard", "version", F.coalesce(F.sum("n").over(per_shard), F.lit(0)).alias("in_shard"))
    )
    position = F.row_number().over(Window.partitionBy(group).orderBy("doc_id", "text_crc32", "size")) - 1
    return (
        cut.withColumn("own", position)
        .join(in_piece, group)
        .join(F.broadcast(in_shard), ["virtual_slot", "piece"])
        .withColumn("slot", (F.col("own") + F.col("in_piece") + F.col("in_shard")).cast("long"))
        .drop("own", "in_piece", "in_shard", "task")
    )


def shard(docs: DataFrame, shards: int = 24, text: str = "text", doc_id: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """(records with shard and position, the stored slot table of version 1) for shards of nearly equal bytes."""
    cut = stage(pieces(records(docs, text, doc_id), shards), "slot-pieces")
    table = stage(table_of(cut, assign(slot_sizes(cut), shards), 1), "slot-table")
    return numbered(cut, table), table
