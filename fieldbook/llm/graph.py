"""Connected components of an edge table, computed by alternating star joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldbook.llm.storage import Scratch, dealt


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select(F.explode(F.array(
        F.struct(F.col("u").alias("u"), F.col("v").alias("v")),
        F.struct(F.col("v").alias("u"), F.col("u").alias("v")),
    )).alias("e")).select("e.u", "e.v")


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest node around it."""
    around = _both_ways(edges)
    least = around.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
    return (around.join(dealt(least, "u"), "u").where("v > u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """Link every smaller neighbour of a node, and the node, to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    turned = (down.join(dealt(least, "u"), "u")
              .select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v")))
    return turned.where("u <> v").distinct()


def components(edges: DataFrame, scratch: Scratch, max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v: bigint); root is the smallest node reachable.

    Large and small star steps alternate until the edge set is stable (a logarithmic
    number of rounds).  Each round is stored in the shared folder; the driver sees two
    numbers a round, never nodes or edges.  Self-edges are dropped, an empty edge
    table gives an empty result.
    """
    current = scratch.store(edges.where("u <> v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    mark = None
    for _ in range(max_rounds):
        following = scratch.store(_small_star(_large_star(current)), "stars")
        scratch.drop(current)
        current = following
        row = current.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if (row[0], row[1]) == mark or row[0] == 0:
            break
        mark = (row[0], row[1])
        scratch.tidy()
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
