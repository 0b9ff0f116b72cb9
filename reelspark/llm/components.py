"""Connected components of an edge table, by alternating star contraction with a written table after each round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import discard, materialize


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node points its larger neighbours at the smallest node around it."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node points its smaller neighbours, and itself, at the smallest of them. Edges come with v < u."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """edges: (u, v) of comparable ids, loops allowed. Gives (node, root) for each node that has an edge to another one,
    with root the smallest node it reaches. Rounds grow with the logarithm of the longest path; each is written to the
    shared folder, where the one before it is deleted, and no group is ever held in one task: both stars are aggregations and equi-joins."""
    current = materialize(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    before = None
    for _ in range(most_rounds):
        if current.isEmpty():
            break
        following = materialize(_small_star(_large_star(current)), "stars")
        now = following.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        discard(current)
        current = following
        if before == (now["n"], now["h"]):
            break
        before = (now["n"], now["h"])
    else:
        raise RuntimeError("the components didn't settle")
    return current.select(F.col("u").alias("node"), F.col("v").alias("root")).union(current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
