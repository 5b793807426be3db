"""Connected components by alternating stars, with every round written to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import scratch_root, written


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """Hang each node's larger (or smaller) neighbours on the least of its neighbours and itself.

    ``edges``: u > v.  The minimum is combined before the shuffle, and the join
    back on a node with very many neighbours is one that Spark splits.
    """
    both = edges.select("u", "v")
    if large:
        both = both.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    hung = both.join(least, "u")
    if large:
        out = hung.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = hung.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
    return out.filter("u > v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """node, component (the least node that links reach) for every node with a link.  ``edges``: a, b."""
    root = scratch_root(edges.sparkSession)
    e = edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    e = written(e, "0", root)
    state, n = None, 0
    while True:
        now = e.agg(F.count("*"), F.sum(F.hash("u", "v").cast("long"))).first()
        if now == state or not now[0]:
            break
        state, n = now, n + 1
        e = written(_stars(written(_stars(e, True), f"{n}-large", root), False), f"{n}", root)
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(e.select("v", "v").distinct())
