"""Connected components of an edge table by alternating large and small stars.

Every round points the neighbours of a node at their smallest, first the larger
neighbours (large star), then the smaller (small star). Minima are taken by a
partly aggregated groupBy and joined back, so a node with very many edges is never
one window or one group. Rounds end when the edges no longer change; then each node
is joined to its component's smallest. Each round is a staged table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from registrar.llm.common import staged


def _stamp(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(edges: DataFrame) -> DataFrame:
    """``edges``: u, v (long). Gives node, component for every node of an edge to
    another node; component is the smallest node reachable. Loops and repeated edges
    count once, edges with a null end are ignored."""
    e = staged(edges.filter("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    was = _stamp(e)
    while was[0]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = staged(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
        now = _stamp(e)
        if now == was:
            break
        was = now
    roots = e.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
