"""Connected components of a link table, by alternating large and small stars (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import drop_written, written


def components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for every node of the links (a, b).

    Each round joins links with the smallest neighbour of a node; nothing is gathered per node or on the driver, so a
    hub is only a skewed join key. Rounds are written to the shared folder. An empty table has no components.
    """
    ends = links.where("a is not null and b is not null and a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges, before = written(ends.distinct()), None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            break
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        small = large.groupBy("a").agg(F.min("b").alias("m"))
        chained = large.join(small, "a").where("b <> m").select(F.greatest("b", "m").alias("a"), F.least("b", "m").alias("b"))
        after = written(chained.unionByName(small.select("a", F.col("m").alias("b"))).distinct())
        drop_written(edges)
        edges, before = after, state
    inner = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return inner.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
