"""Connected components of a link table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeframe.sources.scratch import materialize


def _nearest(edges: DataFrame, name: str) -> DataFrame:
    """Per end ``u`` its smallest neighbour, stored: a join of stored tables can be split
    where one end has very many links."""
    return materialize(edges.groupBy("u").agg(F.min("v").alias("low")), name)


def _state(edges: DataFrame):
    return edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).head()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(id, component)`` for every id that has a link; the component is its smallest id.

    ``links`` holds long ids in two columns. Each round stores its edges, so nothing depends on
    blocks of one executor. A round at least halves the distance to the smallest id, and the
    number of edges never grows.
    """
    pair = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    edges = materialize(pair.where("u <> v").distinct(), "edges")
    state = _state(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = _nearest(both, "low")
        large = both.where("v > u").join(
            low.withColumn("low", F.least("u", "low")), "u").select(
                F.col("v").alias("u"), F.col("low").alias("v"))
        large = materialize(large.where("u <> v").distinct(), "large")
        low = _nearest(large, "low")
        small = large.join(low, "u").select(
            F.col("v").alias("u"), F.col("low").alias("v")).where("u <> v").unionByName(
                low.select("u", F.col("low").alias("v")))
        edges = materialize(small.distinct(), "edges")
        last, state = state, _state(edges)
        if state == last:
            break
    ends = edges.groupBy("u").agg(F.min("v").alias("component"))
    roots = edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return ends.select(F.col("u").alias("id"), "component").unionByName(roots)
