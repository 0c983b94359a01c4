"""Connected components of a graph that is only ever held as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierlake.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """Rows (node, root) for each node of the edges (a, b): root is the smallest node that it is connected with.

    Large-star and small-star steps in turn: each links the neighbours of a node to the smallest of them, until only
    stars are left. A node with very many neighbours is never gathered: minima are taken before the shuffle, and the
    join that uses them can be split where a key is hot.
    """
    edges = stored(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None
    while True:
        large = _to_smallest(edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))).filter("b > a")
        edges = stored(large.select(F.col("b").alias("a"), F.col("low").alias("b")).distinct())
        small = _to_smallest(edges)
        links = small.filter("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
        edges = stored(links.union(small.select("a", F.col("low").alias("b"))).distinct())
        state = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if state == before:
            break
        before = state
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)


def _to_smallest(edges: DataFrame) -> DataFrame:
    """Each edge (a, b) with the smallest node of a and its neighbours as `low`."""
    low = edges.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
    return edges.join(low, "a")
