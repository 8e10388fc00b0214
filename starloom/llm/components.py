"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .stored import stored, tasks_for

#: Links of a task, about.
LINKS = 100_000


def components(links: DataFrame) -> DataFrame:
    """For links (a, b) the smallest node that each node reaches: (node, component), without nodes that are their own smallest.

    Large-star and small-star rounds in turn: every node points its larger neighbours, then its smaller ones, at the smallest of all. The
    rounds grow with the logarithm of a component's size. All steps are joins and aggregations; a hub's links are never gathered.
    A null on either side drops the link, as do links of a node with itself.
    """
    ends = F.greatest("a", "b").alias("high"), F.least("a", "b").alias("low")
    edges = stored(links.where("a IS NOT NULL AND b IS NOT NULL AND a <> b").select(*ends).distinct(), "links")
    before = None
    while True:
        # No step makes more than two links of one.
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("high", "low").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            return edges.select(F.col("high").alias("node"), F.col("low").alias("component"))
        before = state
        both = edges.select(F.col("high").alias("node"), F.col("low").alias("other")).union(edges.select("low", "high"))
        smallest = both.groupBy("node").agg(F.min("other").alias("other")).select(F.col("node").alias("low"), F.least("node", "other").alias("to"))
        large = edges.join(smallest, "low").select("high", F.col("to").alias("low")).distinct()
        least = large.groupBy("high").agg(F.min("low").alias("to"))
        small = large.join(least, "high").select(F.explode(F.array(F.struct(F.col("low").alias("high"), F.col("to").alias("low")), F.struct("high", F.col("to").alias("low")))).alias("e"))
        edges = stored(small.select("e.*").where("high <> low").distinct(), "links", tasks_for(2 * state[0], LINKS))

