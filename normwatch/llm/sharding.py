"""Shards of nearly equal bytes: longest processing time first, groups of equal texts together.

Groups are taken from the largest to the smallest, each to the shard with the least load, which a
heap yields.  At scale the groups stay in Spark: the driver sees only how many groups there are of
each size class and how many bytes they hold.  A class is one size below 1,024 bytes and a range of
1/1,024 of the size above, so there are at most some 40,000 classes (times ``SPREAD``) however many
documents there are.  Groups of one class are interchangeable for the schedule, which therefore
says how many of them go to each shard; ranks within the class turn that into shards of groups.
"""

from __future__ import annotations

import heapq
from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from normwatch.llm.common import binary_text, bounded_side, stored, table
from normwatch.session import literal_table

SHARDS = 16
# Parts that the groups of one class are ranked in, so that a frequent size is not one task's.
SPREAD = 32
# Rows that get their slots in one task.
SLOT_ROWS = 500_000
_EXACT_BITS = 10


def lpt_counts(
    classes: Sequence[tuple[int, int]], shards: int
) -> list[list[int]]:
    """How many groups of each class go to each shard.

    ``classes`` holds (number of groups, bytes of all) from the largest class to the smallest.  The
    counts are those of giving the groups out one by one to the shard on top of the heap, with
    every group of a class at its mean size.  Full rounds are given out at once: all shards first
    fill up to the level that the class certainly reaches, the rest goes through the heap.
    """
    load = [0.0] * shards
    plan = []
    for number, total in classes:
        mean = total / number
        counts = [0] * shards
        if number > shards:
            # The highest level at which no more than the available groups have been given out.
            low, high = min(load), max(load) + total
            for _ in range(100):
                level = (low + high) / 2
                if sum(int(max(0.0, (level - x) // mean)) for x in load) <= number:
                    low = level
                else:
                    high = level
            counts = [int(max(0.0, (low - x) // mean)) for x in load]
        left = number - sum(counts)
        heap = [(x + c * mean, s) for s, (x, c) in enumerate(zip(load, counts))]
        heapq.heapify(heap)
        for _ in range(left):
            weight, shard = heap[0]
            counts[shard] += 1
            heapq.heapreplace(heap, (weight + mean, shard))
        load = [x + c * mean for x, c in zip(load, counts)]
        plan.append(counts)
    return plan


def _size_class(size: F.Column) -> F.Column:
    """A number that grows with the size and keeps its leading bits."""
    shift = F.greatest(F.lit(0), F.length(F.bin(size)) - F.lit(_EXACT_BITS + 1))
    lead = F.call_function("shiftright", size, shift)
    return F.call_function("shiftleft", shift.cast("long"), F.lit(32)) + lead


def lpt_shards(docs: DataFrame, shards: int = SHARDS, spread: int = SPREAD) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot for every row of ``docs``.

    A row weighs the UTF-8 bytes of its text plus 1.  Rows of equal texts form a group and share a
    shard; null texts count as empty.  Slots of a shard run from 0 without a gap.  Repeated rows
    and null doc_ids are rows like any other.  An empty table gives no rows.
    """
    text = binary_text()
    rows = stored(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text).alias("text_crc32"),
            F.unhex(F.sha2(text, 256)).alias("group"),
        ),
        "sized",
    )
    groups = rows.groupBy("group").agg(F.sum("size").alias("bytes"))
    groups = stored(
        groups.select(
            "group",
            "bytes",
            _size_class(F.col("bytes")).alias("cls"),
            F.pmod(F.xxhash64("group"), F.lit(spread)).cast("int").alias("sub"),
        ),
        "groups",
    )
    # Bounded by the number of size classes, not by the data.
    seen = (
        groups.groupBy("cls", "sub").agg(F.count("*").alias("n"), F.sum("bytes").alias("b")).collect()
    )
    seen.sort(key=lambda r: (-r["cls"], r["sub"]))
    classes: dict[int, list] = {}
    offsets = []
    for r in seen:
        c = classes.setdefault(r["cls"], [0, 0])
        offsets.append((r["cls"], r["sub"], c[0]))
        c[0] += r["n"]
        c[1] += r["b"]
    counts = lpt_counts([tuple(c) for c in classes.values()], shards)
    # Ranks up to ``upto`` of a class belong to the shard.
    ends = [
        (cls, shard, int(upto - n), int(upto))
        for cls, row in zip(classes, counts)
        for shard, (n, upto) in enumerate(zip(row, np.cumsum(row)))
        if n
    ]
    spark = docs.sparkSession
    starts = literal_table(spark, offsets, "o_cls bigint, o_sub int, before bigint")
    plan = literal_table(spark, ends, "p_cls bigint, shard int, lo bigint, hi bigint")
    ranked = groups.selectExpr(
        "group", "cls", "sub", "row_number() over (partition by cls, sub order by group) - 1 as r"
    )
    ranked = ranked.join(
        F.broadcast(starts), (F.col("cls") == F.col("o_cls")) & (F.col("sub") == F.col("o_sub"))
    ).withColumn("r", F.col("r") + F.col("before"))
    placed = ranked.join(
        F.broadcast(plan), (F.col("cls") == F.col("p_cls")) & F.col("r").between(F.col("lo"), F.col("hi") - 1)
    ).select("group", "shard")
    placed = stored(placed, "placed")
    sharded = rows.join(bounded_side(placed, 48), "group").drop("group")
    return with_slots(sharded)


def with_slots(rows: DataFrame, slot_rows: int = SLOT_ROWS) -> DataFrame:
    """Adds ``slot``: 0, 1, 2, ... within each ``shard``.

    Rows are cut by a hash into parts of a bounded size; counts of the parts give each part its
    first slot, and each part numbers its own rows.
    """
    rows = stored(rows, "sharded")
    parts = max(1, -(-rows.count() // slot_rows))
    # A doc_id that many rows repeat is spread by the other columns and a written random number.
    part = F.pmod(F.xxhash64(*rows.columns, F.col("salt")), F.lit(parts)).cast("int")
    rows = stored(rows.withColumn("salt", F.rand(7)).withColumn("part", part), "parts")
    counted = rows.groupBy("shard", "part").agg(F.count("*").alias("n"))
    before = counted.selectExpr(
        "shard as b_shard",
        "part as b_part",
        "sum(n) over (partition by shard order by part) - n as before",
    )
    numbered = rows.selectExpr(
        "*", "row_number() over (partition by shard, part order by doc_id, salt) - 1 as r"
    )
    joined = numbered.join(
        before, (F.col("shard") == F.col("b_shard")) & (F.col("part") == F.col("b_part"))
    )
    return joined.withColumn("slot", (F.col("r") + F.col("before")).cast("long")).drop(
        "part", "salt", "r", "before", "b_shard", "b_part"
    )


def op3_lpt_sharding(spark, sf_dir: str) -> DataFrame:
    """All rows of ``documents`` in 16 shards by the law of equal bytes."""
    return lpt_shards(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
