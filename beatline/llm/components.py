"""Connected components of an edge table, star by star, without a hot node in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beatline.llm.common import attach
from beatline.runtime import store


def _unsettled(edges: DataFrame) -> DataFrame:
    """Nodes that keep ``edges`` from being stars: with two smaller neighbours, or one on either side."""
    one, none = F.lit(1), F.lit(0)
    ends = edges.select(F.col("u").alias("x"), one.alias("up"), none.alias("down")).unionByName(
        edges.select(F.col("v").alias("x"), none.alias("up"), one.alias("down"))
    )
    return ends.groupBy("x").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 or up + down > 1")


def _star(pairs: DataFrame, rows: int, keep: Column) -> DataFrame:
    """Link the neighbours of each node to the smallest node around it.

    ``pairs`` (u, v), at most ``rows``: v is a neighbour of u. ``keep``: which
    neighbours move.
    """
    least = store(
        pairs.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"), F.count("*").alias("n")), "cc-least"
    )
    moved = attach(pairs, least, "u", ["v"], rows).where(keep).select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = least.select("u", F.col("m").alias("v"))
    return store(moved.unionByName(own).where("u > v").distinct(), "cc-edges")


def stars(edges: DataFrame) -> DataFrame:
    """Each node (u) of the edges (u, v) but the smallest of its component, with that smallest (v).

    Alternating large and small stars: every node links its larger neighbours,
    then its smaller ones, to the least node around it, until only stars are left.
    Minima are combined before they are shuffled, and a node with very many
    neighbours is split, so no task gathers a component.
    """
    edges = store(
        edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u > v").distinct(), "cc-edges"
    )
    while _unsettled(edges).limit(1).count():
        rows = 2 * edges.count()
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        edges = _star(both, rows, F.col("v") > F.col("u"))
        edges = _star(edges, rows, F.lit(True))
    return edges
