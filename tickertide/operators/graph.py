"""Connected components, as joins and groupings: every node takes the least label it knows of (large star, small star)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickertide.sources.shared import park, unpark


def components(edges: DataFrame) -> DataFrame:
    """edges (a, b) of any orderable type -> (node, root): each node that has an edge, and its component's least node.

    Alternating large and small stars (Kiveris et al. 2014). Hubs are never gathered: each step takes the least
    neighbour by a partial aggregation and joins it back, and every round is written to the shared folder.
    """
    spark = edges.sparkSession
    down = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    down, before = park(down, "edges"), None
    while True:
        state = tuple(down.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if state == before or not state[0]:
            break
        both = down.unionByName(down.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        hung = F.inline(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b"))))
        after = park(large.join(least, "a").select(hung).where("a <> b").distinct(), "edges")
        unpark(spark, down)
        down, before = after, state
    roots = down.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return down.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
