"""Connected components of a graph given as edges: alternating large-star and small-star rounds.

Each round rewrites the edges so that nodes point at smaller ones, and the rounds end when all point at the smallest
of their component. A round is two joins and two aggregates on the node; nothing is gathered by node, so a node with
very many edges is an ordinary skewed join key. Rounds are written to shared storage; the driver sees counts only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import written


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of u is tied to the least of u and its neighbours."""
    both = edges.union(edges.select("b", "a")).toDF("u", "v")
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """u and its smaller neighbours are tied to the least of them. Edges point from the larger to the smaller node."""
    least = edges.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
    moved = edges.withColumnRenamed("a", "u").join(least, "u").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("u", "m")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component): for each node with an edge, the smallest node it reaches. ``edges`` has two columns of one
    ordered type; order, repeats, loops and nulls in them do not matter (a null ends no edge)."""
    a, b = edges.columns
    now = written(
        edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where(f"`{a}` is not null and `{b}` is not null and a <> b").distinct(), "edges"
    )
    state = None
    while True:
        counted = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if counted == state or not counted[0]:
            return now.select(F.col("a").alias("node"), F.col("b").alias("component"))
        state, now = counted, written(_small_star(_large_star(now)), "edges")
