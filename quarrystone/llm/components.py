"""Connected components of an edge table by alternating stars.

Each round hangs every node's larger neighbours, then its smaller ones, on its
least neighbour; it ends when a round changes nothing. Edges stay distributed and
each round's are written, so lineage doesn't grow. A node with very many
neighbours meets its least one by a join that Spark can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import keep, materialize

MOST_ROUNDS = 60  # more than enough: rounds grow with the logarithm of the nodes


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v") % 1_000_000_007)).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of edges (a, b); root is the least node of the component."""
    e = materialize(
        edges.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges", compact=True
    )
    before = _mark(e)
    for _ in range(MOST_ROUNDS):
        # least neighbours are kept apart from the joins, so that Spark can split a hub's edges there
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = keep(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), now=True)
        large = keep(both.join(least.hint("merge"), "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).where(F.col("u") != F.col("v")))
        low = keep(large.groupBy("u").agg(F.min("v").alias("m")), now=True)
        small = large.join(low.hint("merge"), "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v")))
        e = materialize(small.where(F.col("u") != F.col("v")).distinct(), "small-star", compact=True)
        for x in (least, large, low):
            x.unpersist()
        now = _mark(e)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components did not settle")
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
