"""Connected components of a distributed edge table by alternating large-star and small-star
(Kiveris et al., SoCC 2014).  A node's neighbours are never gathered: each step is a minimum per
node and a join.  Every round is written to the shared folder, so lineage stays short, and replaces the round
before it.  Rounds grow with the logarithm of the longest chain; ``rounds`` = 60 is far beyond what any chain
needs, and passing it is an error, never a partial result."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curalis.llm._store import discard, materialise


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Edges ``u > v``.  Large: each greater neighbour of a node moves to the node's least neighbour.
    Small: the node and its lesser neighbours do."""
    if large:
        both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        out = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        moved = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        out = moved.unionAll(least.select("u", F.col("m").alias("v")))
    return out.where("u > v").distinct()


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """``u, v``: each node that has an edge to a lesser one, and the least node of its component."""
    now = materialise(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u > v").distinct(), "edges")
    seen = None
    for _ in range(rounds):
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen or not state[0]:
            return now
        seen = state
        before, now = now, materialise(_star(_star(now, True), False), "edges")
        discard(before)
    raise RuntimeError(f"components did not settle in {rounds} rounds")
