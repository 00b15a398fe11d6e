"""Connected components by alternating star contraction.

Each round every node hands its larger neighbours to its smallest neighbour
(large star), then its smaller ones (small star). The number of rounds grows
with the logarithm of the longest chain, and each round is written to the
shared folder, so a lost executor costs one round. Smallest neighbours are
written too: a hub then meets them in a plain join of two tables, which Spark
can broadcast or split, and not behind a grouping that has gathered the hub.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from hailgrid.llm.scratch import stored


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("v", "u")).toDF("node", "near")
    least = stored(both.groupBy("node").agg(F.least(F.min("near"), F.col("node")).alias("least")), "least")
    return both.filter("near > node").join(least, "node").select(F.col("near").alias("u"), F.col("least").alias("v")).filter("u <> v")


def _small_star(edges: DataFrame) -> DataFrame:
    down = stored(edges.select(F.greatest("u", "v").alias("node"), F.least("u", "v").alias("near")), "down")
    least = stored(down.groupBy("node").agg(F.min("near").alias("least")), "least")
    moved = down.join(least, "node")
    return (
        moved.select(F.col("near").alias("u"), F.col("least").alias("v"))
        .union(least.select(F.col("node").alias("u"), F.col("least").alias("v")))
        .filter("u <> v")
        .distinct()
    )


def _signature(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def connected(links: DataFrame) -> DataFrame:
    """node and root (the smallest node of its component) for every node of the links (u, v).

    Self links and repeated links are harmless; no links give an empty table.
    """
    edges = stored(links.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    before = _signature(edges)
    while before[0]:
        edges = stored(_small_star(_large_star(edges)), "links")
        now = _signature(edges)
        if now == before:
            break
        before = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
