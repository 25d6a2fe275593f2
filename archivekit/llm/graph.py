"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from archivekit.operators.workspace import stage


def _least(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))


def _large(edges: DataFrame) -> DataFrame:
    """Each vertex hands its larger neighbours its smallest one."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    out = both.join(_least(both), "u").filter(F.col("v") > F.col("u"))
    return out.select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").distinct()


def _small(edges: DataFrame) -> DataFrame:
    """Each vertex hands itself and its smaller neighbours the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    out = down.join(_least(down), "u")
    return out.select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v")).filter("u != v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(a, b) to (v, root): the smallest vertex of each vertex's component.

    Roots and isolated vertices have no row. Each round is written to the shared folder, so a
    lost executor costs one round; the number of rounds grows with the logarithm of
    the longest path.
    """
    now = stage(edges.filter("a != b").select(F.col("a").alias("u"), F.col("b").alias("v")).distinct(), "cc")
    mark = None
    while True:
        now = stage(_small(_large(now)), "cc")
        new = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if new == mark:
            return now.select(F.col("u").alias("v"), F.col("v").alias("root"))
        mark = new
