"""Connected components of a graph given as rows of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import stored


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, component (the smallest node reachable) for every node that has a link; ids are integers.

    Alternates the large-star and small-star steps of Kiveris et al. (2014) until the links are stars: the
    steps are minima by node and joins, so a node with any number of links is spread over tasks.
    Each round is written out; a handful of numbers come to the driver.
    """
    now = links.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v")
    now = stored(now.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    mark = _mark(now)
    while mark[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(low, "u").where("v <> m").select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v"))
        now = stored(joined.unionByName(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct(), "stars")
        before, mark = mark, _mark(now)
        if before == mark:
            break
    nodes = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return nodes.unionByName(roots)


def _mark(links: DataFrame) -> tuple:
    h = F.xxhash64("u", "v")
    return tuple(links.agg(F.count("*"), F.sum(h.bitwiseAND(0xFFFFFFFF)), F.sum(F.shiftrightunsigned(h, 32))).first())
