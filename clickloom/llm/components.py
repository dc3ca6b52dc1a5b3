"""Connected components of a graph of numbered nodes, without collecting it anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """node, label: the smallest node of its component, for every node of an edge (a, b).

    Alternates large-star and small-star steps until no edge changes. A node with very many
    neighbours meets its least neighbour in a join, never in one collected list.
    """
    now = stored(_oriented(edges.select("a", "b")), "edges")
    state = _state(now)
    while True:
        both = now.union(now.select("b", "a"))
        large = _relinked(both, F.col("b") > F.col("a"))
        now = stored(_relinked(large, F.lit(True)), "edges")
        fresh = _state(now)
        if fresh == state:
            break
        state = fresh
    # Every edge now leads from a node to the least node of its component.
    return now.select(F.col("a").alias("node"), F.col("b").alias("label")).union(
        now.select(F.col("b"), F.col("b"))).distinct()


def _oriented(edges: DataFrame) -> DataFrame:
    """Distinct edges from the larger node to the smaller."""
    return edges.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _relinked(edges: DataFrame, moved) -> DataFrame:
    """Links the chosen neighbours of each node to the least node among it and them all."""
    least = edges.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    linked = edges.join(least, "a")
    kept = linked.where(moved).select(F.greatest("b", "m").alias("a"), F.least("b", "m").alias("b"))
    own = least.select("a", F.col("m").alias("b"))
    return _oriented(kept.union(own))


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
