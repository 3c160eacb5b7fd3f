"""Connected components of an edge list by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import written


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable from every node of ``edges`` (u, v).

    Each step is a partial minimum per node and a join back; steps are written to the shared
    scratch folder and end when an alternation changes nothing. Only a few numbers per step
    come to the driver."""
    e = written(_canonical(edges.select("u", "v")), "components")
    state = _state(e)
    while True:
        e = written(_small_star(_large_star(e)), "components")
        now = _state(e)
        if now == state:
            break
        state = now
    return (e.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct())


def _canonical(e: DataFrame) -> DataFrame:
    """Edges from the larger to the smaller end, each once, without loops."""
    return e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u > v").distinct()


def _state(e: DataFrame) -> tuple:
    return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _large_star(e: DataFrame) -> DataFrame:
    """Neighbours above a node are tied to the smallest of its neighbourhood."""
    both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return _canonical(e.select(F.col("v").alias("u"), F.col("u").alias("w")).join(least, "u")
                      .select(F.col("w").alias("u"), F.col("m").alias("v")))


def _small_star(e: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the smallest of them."""
    least = e.groupBy("u").agg(F.min("v").alias("m"))
    tied = e.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return _canonical(tied.unionByName(least.select("u", F.col("m").alias("v"))))
