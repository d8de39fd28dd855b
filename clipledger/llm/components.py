"""Connected components of an edge table, by turns of large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipledger.llm.support import discard, stage


def connected(edges: DataFrame, name: str = "stars") -> DataFrame:
    """node and label (the least node of its component) for all nodes of ``edges`` (u, v).

    Each round points the larger neighbours of a node to its least one, then a node and its smaller ones; rounds end once
    nothing changes, after about log(nodes) of them. A node with very many neighbours is one row on the small side of
    each join. Every round is written to the shared folder.
    """
    now = stage(_small_star(_oriented(edges)), name)
    mark = _mark(now)
    while True:
        old, now = now, stage(_small_star(_large_star(now)), name)
        discard(old)
        seen, mark = mark, _mark(now)
        if seen == mark:
            break
    # Now every node but the least points to the least.
    return now.select(F.col("v").alias("node"), F.col("u").alias("label")).unionByName(
        now.select(F.col("u").alias("node"), F.col("u").alias("label")).distinct()
    )


def _oriented(edges: DataFrame) -> DataFrame:
    return (
        edges.where("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()
    )


def _mark(edges: DataFrame) -> tuple:
    # Sums of 32-bit pieces can't overflow before 2 ** 31 rows of each; decimals hold them beyond.
    h = F.xxhash64("u", "v").cast("decimal(20,0)")
    return tuple(edges.agg(F.count("*"), F.sum(h)).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("m").alias("u"), "v").where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    # u < v throughout: v points to its least neighbour, and so do its other smaller neighbours.
    least = edges.groupBy("v").agg(F.min("u").alias("m"))
    return edges.join(least, "v").select(
        F.col("m").alias("u"), F.when(F.col("u") == F.col("m"), F.col("v")).otherwise(F.col("u")).alias("v")
    ).distinct()
