"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.sources.writers import land


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``edges (a long, b long)``: the smallest node it reaches.

    Each round points every node at the smallest of itself and its neighbours, follows these pointers
    to their ends, and keeps the edges between different ends; a star or a path is done in one round.
    Rounds are written tables: the lineage ends there, a lost executor costs no earlier
    round, and both join sides are plain shuffles that AQE may split at a hub. The driver sees
    only whether anything is left to do. No edges give an empty table.
    """
    edges = land(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b").distinct(), "edges")
    moves: list[DataFrame] = []
    while not edges.isEmpty():
        ways = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        nearest = ways.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low"))
        move = _followed(land(nearest.select("node", F.least("node", "low").alias("place")), "moves"))
        moves.append(move)
        low, high = (move.select(F.col("node").alias(c), F.col("place").alias(f"{c}_place")) for c in ("a", "b"))
        moved = edges.join(low, "a").join(high, "b").select(F.col("a_place").alias("a"), F.col("b_place").alias("b"))
        edges = land(
            moved.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b").distinct(), "edges"
        )
    if not moves:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    places = moves[0]
    for move in moves[1:]:
        further = move.select(F.col("node").alias("place"), F.col("place").alias("__next"))
        places = places.join(further, "place", "left").select("node", F.coalesce("__next", "place").alias("place"))
    return places.select("node", F.col("place").alias("component"))


def _followed(move: DataFrame) -> DataFrame:
    """Pointers to the ends of their chains; chains halve with each step, and every pointer leads to a smaller node."""
    while True:
        further = move.select(F.col("node").alias("place"), F.col("place").alias("__next"))
        steps = move.join(further, "place").select("node", "place", "__next")
        if steps.filter("__next < place").limit(1).isEmpty():
            return move
        move = land(steps.select("node", F.col("__next").alias("place")), "moves")
