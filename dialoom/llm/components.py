"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from dialoom.llm.common import hub_join, save


def components(edges: DataFrame) -> DataFrame:
    """(a, b) to (node, component), component being the smallest node; only nodes with an edge appear.

    Every step is a grouped minimum and a join, so no neighbourhood is collected; the centre of a star meets its
    neighbours by ``hub_join``, so they stay in the tasks they are in. The edges of a step are written to the shared folder,
    which cuts the lineage. The number of steps grows with the logarithm of the size of the largest component, and the end
    is when a step changes nothing.
    """
    edges = edges.select("a", "b").filter("a != b")
    edges, before = _saved(edges.select(F.least("a", "b").alias("b"), F.greatest("a", "b").alias("a")).distinct())
    while before[0]:
        both = edges.select(F.col("a").alias("x"), F.col("b").alias("y")).unionAll(edges.select(F.col("b").alias("x"), F.col("a").alias("y")))
        lowest = both.groupBy("x").agg(F.least(F.min("y"), F.col("x")).alias("m"), F.count(F.lit(1)).alias("degree"))
        large = hub_join(both.filter("y > x"), lowest, "x", "degree", 2 * before[0]).select(F.col("y").alias("a"), F.col("m").alias("b")).filter("a != b")
        down = large.groupBy(F.col("a").alias("x")).agg(F.min("b").alias("m"))
        small = large.join(down, large["a"] == down["x"]).select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a != b").unionAll(down.select(F.col("x").alias("a"), F.col("m").alias("b")))
        edges, after = _saved(small.distinct())
        if after == before:
            break
        before = after
    lows = edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component"))
    return lows.unionAll(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


def relabelled(first: DataFrame, then: DataFrame) -> DataFrame:
    """(node, component) of ``first`` after its components were joined by ``then`` (the same for components)."""
    then = then.select(F.col("node").alias("component"), F.col("component").alias("joined"))
    both = first.join(then, "component", "left").select("node", F.coalesce("joined", "component").alias("component"))
    alone = then.join(first.select("component").distinct(), "component", "left_anti").select(F.col("component").alias("node"), F.col("joined").alias("component"))
    return both.unionByName(alone)


def _saved(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """The written edges, with their number and a digest that the write took on its way."""
    state = Observation()
    out = save(edges.observe(state, F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("digest")), "edges")
    found = state.get
    return out, (found["n"], found["digest"])
