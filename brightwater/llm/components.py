"""Connected components by alternating large-star and small-star steps, as joins and minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import join_by_size


def _is_forest_of_stars(edges: DataFrame) -> bool:
    """Whether every vertex points at one centre and no centre points on."""
    doubled = edges.groupBy("u").count().filter("count > 1").select("u").limit(1)
    centres = edges.select(F.col("v").alias("u")).distinct()
    return not doubled.unionByName(edges.select("u").join(centres, "u", "left_semi").limit(1)).take(1)


def components(edges: DataFrame, a: str = "a", b: str = "b", rounds: int = 60) -> DataFrame:
    """(id, component) of every vertex that has an edge to another; component is its least id.

    Each round is a few joins keyed by vertex over a table written to the shared folder, and
    the number of rounds grows with the logarithm of the graph's diameter.
    """
    lo, hi = F.least(a, b), F.greatest(a, b)
    now = materialize(edges.filter(F.col(a) != F.col(b)).select(hi.alias("u"), lo.alias("v")).distinct(), "edges")
    for _ in range(rounds):
        if _is_forest_of_stars(now):
            break
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n")).select("u", F.least("u", "m").alias("m"), "n")
        large = join_by_size(both, materialize(least, "edges-least"), ["u"], "n").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = materialize(large, "edges-large")
        least = materialize(large.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n")), "edges-least")
        small = join_by_size(large, least, ["u"], "n").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v")
        now = materialize(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return now.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(
        now.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
