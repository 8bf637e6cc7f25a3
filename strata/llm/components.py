"""Connected components by alternating large-star and small-star steps.

Each step is a grouped minimum and a join on the node, so no component is
ever gathered in one task or on the driver.  A step's edges are written to
the shared folder (a lost executor repeats one step) and the step before is
deleted.  A node with very many links is one hot join key with one row on
the other side, which AQE's skew join splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import discard, written


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges(a, b)`` (any order, repeats and loops allowed) to ``(node, component)``.

    The component is the smallest node reachable.  Nodes without a link to
    another node do not appear.  No edges: an empty result.
    """
    spark = edges.sparkSession
    pairs = (edges.where(F.col("a") != F.col("b"))
             .select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct())
    now, path = written(pairs, "edges")
    mark = _mark(now)
    while True:
        step, step_path = written(_small_star(_large_star(now)), "edges")
        step_mark = _mark(step)
        discard(spark, path)
        now, path = step, step_path
        if step_mark == mark:
            break
        mark = step_mark
    centres = now.select(F.col("lo").alias("node")).distinct()
    return (now.select(F.col("hi").alias("node"), F.col("lo").alias("component"))
            .unionByName(centres.select("node", F.col("node").alias("component"))))


def _mark(pairs: DataFrame) -> tuple:
    r = pairs.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
    return tuple(r)


def _large_star(pairs: DataFrame) -> DataFrame:
    both = pairs.select("hi", "lo").unionAll(pairs.select("lo", "hi")).toDF("node", "other")
    least = both.groupBy("node").agg(F.min("other").alias("m"))
    least = least.select("node", F.least("node", "m").alias("m"))
    return (both.join(least, "node").where(F.col("other") > F.col("node"))
            .select(F.col("other").alias("hi"), F.col("m").alias("lo")).distinct())


def _small_star(pairs: DataFrame) -> DataFrame:
    least = pairs.groupBy("hi").agg(F.min("lo").alias("m"))
    moved = (pairs.join(least, "hi").where(F.col("lo") != F.col("m"))
             .select(F.col("lo").alias("hi"), F.col("m").alias("lo")))
    return moved.unionAll(least.select("hi", F.col("m").alias("lo"))).distinct()
