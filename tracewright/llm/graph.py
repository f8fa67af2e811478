"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step over edges (u, v), u > v. A node's least neighbour is found with a partial aggregate, so a node with very many neighbours is never gathered; the join back to the edges leaves skew to adaptive execution."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    if large:
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        out = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        out = edges.join(least, "u").select(F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("e")).select(F.col("e.v").alias("u"), F.col("e.m").alias("v"))
    return out.where("u <> v").distinct()


def components(edges: DataFrame, scratch: Scratch, name: str = "cc") -> DataFrame:
    """(node, component): the least node that each node of an edge reaches; nodes that are their own component are left out.

    edges: columns u, v of one orderable type, without nulls; loops and repeats are harmless.
    Both steps run until the edges no longer change; each pair of steps is written, which cuts the lineage.
    """
    now = scratch.table(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), f"{name}-0")
    mark, k = None, 0
    while True:
        was, mark = mark, now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == was or not mark[0]:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component"))
        k += 1
        now = scratch.table(_star(_star(now, True), False), f"{name}-{k}")
        if k > 1:
            scratch.drop(f"{name}-{k - 2}")
