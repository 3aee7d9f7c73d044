"""Connected components of a link table by alternating star contraction.

Each round points every node's larger neighbours at its smallest one, then every node at the
smallest of its smaller ones.  A node with very many links costs an aggregate and a join, so
adaptive execution can split it; no neighbourhood is ever gathered in one place."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barwright.llm.common import drop_staged, staged


def _oriented(edges: DataFrame) -> DataFrame:
    """Distinct edges with u > v; loops go."""
    return edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    smallest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return _oriented(both.join(smallest, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")))


def _small_star(edges: DataFrame) -> DataFrame:
    smallest = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(smallest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return _oriented(moved.unionByName(smallest.select("u", F.col("m").alias("v"))))


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every linked node but the smallest of its component, which is
    the component's name.  ``edges`` has long columns u, v; repeats and loops are harmless."""
    now = staged(_oriented(edges), "edges")
    seen = None
    while True:
        mark = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v") % 1_000_000_007)).first()
        if mark == seen or mark[0] == 0:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component"))
        seen = mark
        after = staged(_small_star(_large_star(now)), "edges")
        drop_staged(now)
        now = after
