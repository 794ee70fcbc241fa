"""Connected components by alternating stars, over edges in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import discard, saved


def _towards_least(edges: DataFrame, name: str) -> DataFrame:
    """u, v and the least of u and its v's. The least ones are a table of their own, so that a join with a hot u is split."""
    least = saved(edges.groupBy("u").agg(F.least("u", F.min("v")).alias("m")), f"{name}_least")
    return edges.join(least, "u"), least


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """class, label: for each class of the edges (class, parent) the least class it is connected with.

    Large stars hang every greater neighbour of a class below the least neighbour, small stars do so
    for the lesser ones; both keep the components, and rounds go on until each of them is one star. Their number grows
    with the logarithm of the longest path; there is no bound at which the work stops. An edge
    of a class with itself names it as a component.
    """
    alone = edges.filter("class = parent").select("class")
    now = saved(edges.filter("class <> parent").select(F.greatest("class", "parent").alias("u"), F.least("class", "parent").alias("v")).distinct(), name)
    while True:
        both = saved(now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v"))), f"{name}_both")
        wide, least = _towards_least(both, name)
        large = saved(wide.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), f"{name}_large")
        for old in (now, both, least):
            discard(old)
        wide, least = _towards_least(large, name)
        small = wide.select(F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("e"))
        now = saved(small.select(F.col("e.v").alias("u"), F.col("e.m").alias("v")).filter("u <> v").distinct(), name)
        discard(large)
        discard(least)
        tops = now.select(F.col("v").alias("u")).distinct()
        if now.join(tops, "u", "left_semi").isEmpty() and now.groupBy("u").count().filter("count > 1").isEmpty():
            break
    roots = now.select(F.col("v").alias("class")).distinct()
    rest = alone.distinct().join(now.select(F.col("u").alias("class")).unionByName(roots), "class", "left_anti")
    same = roots.unionByName(rest).select("class", F.col("class").alias("label"))
    return now.select(F.col("u").alias("class"), F.col("v").alias("label")).unionByName(same)
