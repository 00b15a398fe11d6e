"""Sharding by longest-processing-time scheduling: groups, largest first, to the least-loaded shard."""

from __future__ import annotations

import heapq
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from hailgrid.llm.ranking import numbered
from hailgrid.llm.scratch import partitions, stored

OVERHEAD = 16


def longest_first(sizes: list[tuple[int, int]], shards: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """For each size, how many of its groups each shard takes: (size, [(groups up to here, shard), ...]).

    sizes: (size, number of groups), any order. Groups of one size are alike, so
    a shard takes as many at once as it would get one by one, and when all loads
    lie within one size of each other, whole rounds are dealt at once.
    """
    heap = [(0, shard) for shard in range(shards)]
    out = []
    for size, left in sorted(sizes, reverse=True):
        given: Counter[int] = Counter()
        while left:
            load, shard = heap[0]
            if left >= shards and max(heap)[0] - load <= size:
                rounds = left // shards
                heap = [(own + rounds * size, k) for own, k in heap]  # all grow alike: still a heap
                given.update({k: rounds for _, k in heap})
                left -= rounds * shards
                continue
            gap = min(heap[1:3], default=(load + left * size, 0))[0] - load
            n = min(left, max(1, -(-gap // size)))
            heapq.heapreplace(heap, (load + n * size, shard))
            given[shard] += n
            left -= n
        upto, runs = 0, []
        for shard, n in sorted(given.items()):
            upto += n
            runs.append((upto, shard))
        out.append((size, runs))
    return out


RUNS = pa.list_(pa.struct([("upto", pa.int64()), ("shard", pa.int32())]))


def lpt_shards(docs: DataFrame, shards: int = 40) -> DataFrame:
    """Deal documents over shards of nearly equal bytes; equal texts stay together.

    docs: doc_id, text; other columns are ignored. Returns doc_id, size (UTF-8
    bytes of the text plus 16), text_crc32, shard, and slot (the place in the
    shard, without gaps from 0), one row per row of ``docs``. Null counts as
    the empty text and is grouped with it. Repeated rows are members of their
    group like any other. No rows give no shards.

    The driver schedules sizes, not groups: n different sizes need n * n / 2
    bytes of text at least, so a terabyte has no more than 1.4 million of them.
    Groups of one size are numbered and matched with the schedule in Spark.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = stored(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            (F.octet_length(text) + OVERHEAD).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.unhex(F.md5(text.cast("binary"))).alias("text_id"),
        ),
        "shard-rows",
    )
    groups = stored(rows.groupBy("text_id").agg(F.sum("size").alias("weight")), "shard-groups")
    sizes = groups.groupBy("weight").count().collect()
    plan = longest_first([(r["weight"], r["count"]) for r in sizes], shards)
    schedule = spark.createDataFrame(
        pa.table(
            {
                "weight": pa.array([size for size, _ in plan], pa.int64()),
                "runs": pa.array([[{"upto": n, "shard": k} for n, k in runs] for _, runs in plan], RUNS),
            }
        )
    )
    buckets = partitions(spark)
    placed = numbered(groups, ["weight"], ["text_id"], "rank", buckets).join(schedule, "weight")
    shard = F.expr("element_at(filter(runs, r -> r.upto > rank), 1).shard")
    members = stored(rows.join(placed.select("text_id", shard.alias("shard")), "text_id"), "shard-members")
    return numbered(members, ["shard"], ["doc_id", "text_id"], "slot", buckets).select("doc_id", "size", "text_crc32", "shard", "slot")


def shard_digest(docs: DataFrame, shards: int = 40) -> DataFrame:
    return lpt_shards(docs, shards).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
