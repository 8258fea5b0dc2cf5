"""Connected components of a table of links, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandlake.llm.runtime import Scratch


def _large_star(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """Every larger neighbour of a node is linked to the least of the node and its neighbours. The least ones are
    written first: the join then reads two plain tables, and Spark may split a node with very many neighbours."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = scratch.write(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), name)
    larger = both.filter(F.col("v") > F.col("u"))
    return larger.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the least of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter(F.col("u") != F.col("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    rest = down.join(least, "u").filter(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return rest.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def connected_components(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(node, label) of every node that has a link; the label is the least node of its component. ``edges`` has two
    columns of one orderable type. The number of rounds grows with the logarithm of the longest chain."""
    a, b = edges.columns
    now = scratch.write(edges.select(F.col(a).alias("u"), F.col(b).alias("v")).filter(F.col("u") != F.col("v")), f"{name}0")
    before, k = None, 0
    while True:
        k += 1
        following = scratch.write(_small_star(_large_star(now, scratch, f"{name}_least")), f"{name}{k}")
        scratch.drop(f"{name}{k - 1}")
        state = following.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
        now = following
        if state == before or not state["n"]:
            break
        before = state
    scratch.drop(f"{name}_least")
    return now.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("label"))).distinct()
