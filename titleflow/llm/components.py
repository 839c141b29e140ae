"""Connected components of a distributed edge list (DataFrame operations
only): alternating large-star and small-star rounds.

Each round is two map-side combined minima and two joins of the edges with
one row per node, so a node with a third of all edges is a skewed join
with a unique other side, which Spark splits. Rounds are written below
``spark.checkpoint.dir``; the superseded table is deleted. The number of
rounds grows with the logarithm of the node count; edges that are stars
already (as local union-find hands them over) need two or three.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from titleflow.llm.common import discard, stored


def _directed(edges: DataFrame) -> DataFrame:
    """Distinct (hi, lo), hi > lo; loops and nulls go."""
    return edges.where("hi <> lo").select(
        F.greatest("hi", "lo").alias("hi"), F.least("hi", "lo").alias("lo")).distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node links its larger neighbours to its smallest neighbour (or itself)."""
    both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(
        edges.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return _directed(edges.select(F.col("lo").alias("u"), F.col("hi").alias("v")).join(least, "u")
                     .select(F.col("v").alias("hi"), F.col("m").alias("lo")))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node links itself and its smaller neighbours to the smallest of them."""
    least = edges.groupBy("hi").agg(F.min("lo").alias("m"))
    moved = edges.join(least, "hi").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
    return _directed(moved.unionByName(least.select("hi", F.col("m").alias("lo"))))


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(hi, lo))"),
                           F.expr("bit_xor(xxhash64(lo, hi, 1))")).first())


def components(edges: DataFrame, a: Column | str = "a", b: Column | str = "b") -> DataFrame:
    """(node, root) for every node that has an edge to another node; root is
    the smallest node of the component and has no row of its own.

    Loops, repeated edges and null ends are ignored; no edges: no rows.
    """
    now = stored(_directed(edges.select(F.col(a).alias("hi"), F.col(b).alias("lo"))
                           if isinstance(a, str) else edges.select(a.alias("hi"), b.alias("lo"))))
    state = _state(now)
    while state[0]:
        after = stored(_small_star(_large_star(now)))
        discard(now)
        now, before, state = after, state, _state(after)
        if state == before:
            break
    return now.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
