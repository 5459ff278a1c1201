"""Connected components of an edge table, as Spark joins.

Alternates two steps until nothing changes: every node hangs its larger
neighbours on the smallest node it sees, then its smaller ones.  Each step is a
pre-aggregated minimum and one join, so a node with very many neighbours costs
a row per task and its join partition is split by adaptive execution.  Each
round is written down, which cuts the lineage on shared storage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..staging import stage


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """`node`, `component` (smallest node reachable) for every node of an edge.

    Self-loops and repeated edges do no harm; null ends are left out.  No edges
    give an empty table.
    """
    whole = edges.dropna(subset=[a, b])
    links = whole.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo"))
    loops = links.where("hi = lo").select(F.col("hi").alias("node")).distinct()
    links = stage(links.where("hi > lo").distinct(), "links")
    state = _state(links)
    for _ in range(max_rounds):
        links = stage(_hang_smaller(_hang_larger(links)), "links")
        before, state = state, _state(links)
        if state == before:
            break
    else:
        raise RuntimeError(f"components not settled after {max_rounds} rounds")
    grown = links.select(F.col("hi").alias("node"), F.col("lo").alias("component"))
    roots = links.select(F.col("lo").alias("node")).union(loops).distinct()
    alone = roots.join(grown.select("node"), "node", "left_anti")
    return grown.union(alone.select("node", F.col("node").alias("component")))


def _state(links: DataFrame) -> tuple:
    """A fingerprint of the edge set: one row."""
    return tuple(links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("hi", "lo"))).first())


def _hang_larger(links: DataFrame) -> DataFrame:
    """Each larger neighbour goes to the smallest node that its neighbour sees."""
    both = links.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(
        links.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
    )
    smallest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    moved = both.where("v > u").join(smallest, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo"))
    return moved.distinct()


def _hang_smaller(links: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours go to the smallest of them."""
    smallest = links.groupBy("hi").agg(F.min("lo").alias("m"))
    own = smallest.select("hi", F.col("m").alias("lo"))
    moved = links.join(smallest, "hi").where("lo > m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
    return own.union(moved).distinct()
