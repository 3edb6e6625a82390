"""Connected components of an edge table, by large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stintlog.llm.common import written


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 40)))).first())


def components(edges: DataFrame) -> DataFrame:
    """node, label (the smallest node reachable) of every node of an edge that is no loop.

    ``edges`` has long columns a and b. Each step is two aggregations and joins back; a hub's
    neighbours are combined before the shuffle and never collected. Steps are written to the
    shared folder; only a row count and a checksum reach the driver. Steps needed grow with the
    logarithm of a component's size.
    """
    u, v = F.col("u"), F.col("v")
    now = written(
        edges.filter("a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct(),
        "edges",
    )
    state = _state(now)
    while state[0]:
        # Large star: every larger neighbour of u is linked to the smallest node around u.
        both = now.union(now.select(v.alias("u"), u.alias("v")))
        smallest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(smallest, "u").select(v.alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").distinct()
        # Small star: every smaller neighbour of u, and u, are linked to the smallest of them.
        smallest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(smallest, "u").select(v.alias("u"), F.col("m").alias("v")).filter("u <> v")
        now = written(small.union(smallest.select("u", F.col("m").alias("v"))).distinct(), "edges")
        before, state = state, _state(now)
        if state == before:
            break
    return now.select(u.alias("node"), v.alias("label")).union(now.select(v, v).distinct()).distinct()
