"""Connected components of an edge table by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnloom.session import cut_lineage, drop_scratch


def _fingerprint(edges: DataFrame) -> tuple:
    mark = F.xxhash64("u", "v").cast("decimal(20,0)")
    return tuple(edges.agg(F.count("*"), F.sum(mark)).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (u, v); root is the component's smallest node.

    Each round hangs the larger neighbours of a node on the smallest one it
    knows, then the smaller ones (large star, small star); rounds grow with the
    logarithm of a component's width.  Minima are pre-aggregated and joined, so
    a node with very many edges is no group of its own.  Each round's table is
    written to the shared folder and the one before it deleted.
    """
    spark = edges.sparkSession
    clean = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct()
    current, path = cut_lineage(clean, "edges")
    seen = _fingerprint(current)
    while seen[0]:
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        down = large.join(least, "u").select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
        after, new_path = cut_lineage(down.where("u <> v").distinct(), "edges")
        mark = _fingerprint(after)
        drop_scratch(spark, path)
        current, path = after, new_path
        if mark == seen:
            break
        seen = mark
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
