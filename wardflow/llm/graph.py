"""Connected components of a link table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def components(edges: DataFrame) -> DataFrame:
    """``(a, b)`` links to ``(node, comp)``: the smallest node reachable from each node that has a link.

    Each round links the neighbours of every node to its smallest neighbour, first the larger ones, then
    the smaller ones; the table only shrinks, and O(log n) rounds leave one star per component.  Hub nodes
    are no burden: the smallest neighbour is a partial aggregate, and the join back splits at run time.
    Self links and nulls are ignored; no links give an empty table.

    The table is one star per component once no node has both a smaller neighbour and another one.  The result is the
    written table that shows it, so plans on it hold no part of the rounds.
    """
    now = edges.where("a is not null and b is not null and a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    while True:
        now = written(now, "links")
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        near = written(both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")), "nearest")
        low = near.select("u", F.least("m", "u").alias("m"))
        if near.where("m < u and n > 1").isEmpty():
            return low.select(F.col("u").alias("node"), F.col("m").alias("comp"))
        large = both.join(low, "u").where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("e"))
        now = small.select(F.col("e.v").alias("u"), F.col("e.m").alias("v")).where("u <> v").distinct()
