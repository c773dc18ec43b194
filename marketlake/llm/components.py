"""Connected components of an edge table, without gathering any group.

Alternating large-star / small-star rounds: every round is two aggregations
(min neighbour, pre-aggregated before the shuffle) and two equi-joins, whose
hot keys AQE can split. Edges are written to the shared folder after each
round, so lineage stays short and a lost executor repeats at most one round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.llm.common import discard, stored


def _large_star(e: DataFrame) -> DataFrame:
    both = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    least = least.select("u", F.least("u", "m").alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(e: DataFrame) -> DataFrame:
    least = e.groupBy("u").agg(F.min("v").alias("m"))
    moved = e.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v")))


def _state(e: DataFrame) -> tuple:
    return tuple(e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node with an edge to another node.

    The component is the smallest node reachable. Self loops, repeated edges
    and edges with a null end are ignored; no edges give an empty table.
    """
    clean = edges.filter(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    e = stored(clean.distinct(), "edges")
    state = _state(e)
    for _ in range(max_rounds):
        if not state[0]:
            break
        after = stored(_small_star(_large_star(e).distinct()).distinct(), "edges")
        new_state = _state(after)
        discard(e)
        e, old, state = after, state, new_state
        if old == state:
            break
    else:
        raise RuntimeError("components did not settle")
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
