"""Connected components of a large edge list, by alternating star steps.

Each step is a grouped minimum and a join on one vertex, both spread over the
cluster.  A vertex with very many edges is pre-aggregated for the minimum; the
minima are written before they are joined, so that both sides of the join are
plain tables and the skew join can split such a vertex.  Every step's result
lies in the shared folder, in as many files as its rows need, so lost executors
cost one step at most.  Steps go on until nothing changes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickpulse.llm.common import files_for, remove, stored

def _handed(arcs: DataFrame, least: DataFrame) -> DataFrame:
    """Arcs (u, v) as edges (v, m): what is around u goes to its minimum m."""
    return arcs.join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))


def connected_components(edges: DataFrame, vertices: int | None = None) -> DataFrame:
    """``edges`` (a, b), any order, repeats allowed -> (node, component): the
    smallest vertex reachable, for every vertex but the smallest ones themselves.
    ``vertices``: how many there are at most, from which follows the number of
    files that the edges are first written to."""
    pairs = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    pairs = stored(pairs, "edges", None if vertices is None else files_for(vertices))
    n = pairs.count()
    before = (0, None)
    while n:
        known, files = pairs, files_for(n)
        both = pairs.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
            pairs.select(F.col("b").alias("u"), F.col("a").alias("v")))
        # large star: a vertex hands its larger neighbours to its minimum
        least = stored(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least", files)
        large = stored(_handed(both.where("v > u"), least).where("a <> b").distinct(), "star", files)
        # small star: a vertex hands its smaller neighbours, and itself, over
        small = large.select(F.col("a").alias("u"), F.col("b").alias("v"))
        lower = stored(small.groupBy("u").agg(F.min("v").alias("m")), "least", files)
        pairs = stored(_handed(small, lower).union(lower.select(F.col("u").alias("a"), F.col("m").alias("b")))
                       .where("a <> b").distinct(), "edges", files)
        for used in (known, least, large, lower):
            remove(used)
        now = tuple(pairs.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first())
        if now == before:
            break
        before, n = now, now[0]
    return pairs.select(F.col("a").alias("node"), F.col("b").alias("component"))
