"""Connected components of a table of links, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop, written


def star(edges: DataFrame, large: bool) -> DataFrame:
    """One step: neighbours of a node move to the smallest of them; edges are (u, v) with u > v."""
    flipped = edges.select(F.col("v").alias("u"), F.col("u").alias("v"))
    ends = edges.unionAll(flipped) if large else edges
    least = ends.groupBy(F.col("u").alias("_u")).agg(F.least(F.min("v"), F.min("u")).alias("m"))
    least = written(least, "least", few_files=True)
    joined = ends.join(least, F.col("u") == F.col("_u"))
    if large:
        moved = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        own = least.select(F.col("_u").alias("u"), F.col("m").alias("v"))
        moved = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(own)
    out = written(moved.where("u <> v").distinct(), "star", few_files=True)
    drop(least)
    return out


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every end of a link (a, b); the component is named by its smallest node.

    Steps go on until the edges no longer change; each is written, so none repeats another one's work. No node's
    neighbours are gathered: a step is a minimum by node and a join.
    """
    edges = written(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges", few_files=True)
    seen = None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen or state[0] == 0:
            break
        seen = state
        wide = star(edges, large=True)
        narrow = star(wide, large=False)
        drop(edges, wide)
        edges = narrow
    roots = edges.select(F.col("v").alias("node")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(roots.withColumn("component", F.col("node")))
