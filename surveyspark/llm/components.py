"""Connected components of an edge table by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveyspark.llm.scratch import Scratch


def _towards_least(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the least node of the neighbourhood."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("least"))
    return (both.filter("b > a").join(least, "a")
            .select(F.col("b").alias("a"), F.col("least").alias("b")).distinct())


def _smaller_to_least(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the least of them; edges have a > b."""
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    joined = edges.join(least, "a")
    return (joined.filter("b > least").select(F.col("b").alias("a"), F.col("least").alias("b"))
            .union(least.select("a", F.col("least").alias("b"))).distinct())


def components(edges: DataFrame, scratch: Scratch, name: str = "components") -> DataFrame:
    """(node, component) for every node of `edges` (a, b); a component is its least node.

    Rows with a null end, loops and repeated edges are ignored. No node's neighbours are
    gathered: each step is a grouped minimum and a join, written out. A node that is its
    own component's least node is returned as well.
    """
    flat = (edges.filter("a <> b")
            .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    step, last = 0, None
    now = scratch.stage(flat, f"{name}-{step}")
    while True:
        # a star forest maps to itself, so an unchanged checksum ends the loop
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark[0] == 0 or tuple(mark) == last:
            break
        last, step = tuple(mark), step + 1
        after = scratch.stage(_smaller_to_least(_towards_least(now)), f"{name}-{step}")
        scratch.drop(f"{name}-{step - 1}")
        now = after
    return (now.select(F.col("a").alias("node"), F.col("b").alias("component"))
            .union(now.select("b", "b").distinct()))
