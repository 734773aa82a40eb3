"""Connected components by repeated contraction to the smallest neighbour."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from care_analytics.llm.common import dropped, written


def components(links: DataFrame) -> DataFrame:
    """``node``, ``component`` (smallest node reachable) for the ends ``a``, ``b`` of ``links``.

    Each round every node moves to its smallest neighbour and the links are
    redrawn between the new places; links within a place go.  The number of
    rounds grows with the logarithm of the longest chain; every round is written.
    """
    edges = written(links.select("a", "b").where("a <> b").distinct(), "links")
    ends = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
    places = written(ends.withColumn("component", F.col("node")), "places")
    while edges.take(1):
        both = edges.union(edges.select("b", "a"))
        step = both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("from"), F.least("a", "b").alias("to"))
        jump = step.select(F.col("from").alias("to"), F.col("to").alias("further"))
        step = written(step.join(jump, "to", "left").select("from", F.least("to", "further").alias("to")), "step")
        moved = written(places.join(step, F.col("component") == F.col("from"), "left")
                        .select("node", F.coalesce("to", "component").alias("component")), "places")
        redrawn = written(edges.join(step.select(F.col("from").alias("a"), F.col("to").alias("a2")), "a")
                          .join(step.select(F.col("from").alias("b"), F.col("to").alias("b2")), "b")
                          .where("a2 <> b2").select(F.col("a2").alias("a"), F.col("b2").alias("b")).distinct(), "links")
        dropped(edges, places, step)
        edges, places = redrawn, moved
    return places
