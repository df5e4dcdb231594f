"""Connected components by alternating large-star and small-star steps (Kiveris et al. 2014), as joins and groupings.

Hubs are never gathered: each step takes the least neighbour by a partial aggregation and joins it back, and every
round is written to the shared folder, so a lost executor costs one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickertide.llm.common import park, unpark


def _trace(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """edges (a, b) of any orderable type -> (node, root): each node that has an edge, and its component's least node.

    Self loops, repeated and reversed edges and nulls do no harm; no edges give no rows.
    """
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = park(edges, "edges")
    before = _trace(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.*").where("a <> b").distinct()
        after = park(small, "edges")
        unpark(edges.sparkSession, edges)
        edges, last, before = after, before, _trace(after)
        if last == before:
            break
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
