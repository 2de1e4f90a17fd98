"""Connected components by alternating large-star and small-star steps, on settled edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweave.plans.sizing import settled


def _pairs(u, v) -> list:
    return [u.alias("u"), v.alias("v")]


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``node`` and ``root`` (the least node of its component) of every node that has an edge.

    Both steps are a minimum per node (combined before the shuffle) and a join
    back, whose skewed partitions Spark splits; each round is written to the
    shared scratch folder.  Nulls and loops make no edge.
    """
    u, v = F.col("u"), F.col("v")
    pairs = edges.select(*_pairs(F.greatest(a, b), F.least(a, b))).filter(F.col(a).isNotNull() & F.col(b).isNotNull())
    now = settled(pairs.filter(u > v).distinct(), "edges")
    state = _state(now)
    while state[0]:
        both = now.select("u", "v").union(now.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("least"))
        large = both.join(least, "u").filter(v > u).select(*_pairs(v, F.col("least"))).filter(u != v).distinct()
        large = settled(large, "edges")
        least = large.groupBy("u").agg(F.min("v").alias("least"))
        small = large.join(least, "u").select(*_pairs(v, F.col("least"))).union(least.select(*_pairs(u, F.col("least"))))
        now = settled(small.filter(u != v).distinct(), "edges")
        last, state = state, _state(now)
        if state == last:
            break
    return now.select(u.alias("node"), v.alias("root"))
