"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shotlake.llm.common import materialise


def _mark(pairs: DataFrame) -> tuple:
    r = pairs.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return r[0], r[1]


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node in links (a, b): component is the smallest node reachable. Links may repeat,
    run either way or lead to their own node; null ends are left out.

    Alternating large and small stars: each round joins a node's links with the least node near it, so that a hot
    node is only ever a hot join key, which adaptive execution splits. Each round is written to the shared folder.
    """
    links = links.where("a is not null and b is not null")
    nodes = links.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    pairs = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    pairs = materialise(pairs, "pairs")
    mark = _mark(pairs)
    while mark[0]:
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        pairs = materialise(small.unionByName(least.select("a", F.col("m").alias("b"))).distinct(), "pairs")
        was, mark = mark, _mark(pairs)
        if was == mark:
            break
    found = pairs.groupBy("a").agg(F.min("b").alias("component"))
    return nodes.join(found, nodes["node"] == found["a"], "left").select("node", F.coalesce("component", "node").alias("component"))
