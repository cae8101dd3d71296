"""Connected components of an undirected edge table, for links far too many
for one machine: alternating large-star and small-star rounds, each a
combined minimum per node and a join, with the edges written to the shared
folder between rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import materialize


def _minima(pairs: DataFrame) -> DataFrame:
    """Smallest of a node and its neighbours. Written out: the join that
    follows then reads both sides freshly, so a hub's rows can be split."""
    m = pairs.groupBy("u").agg(F.min("v").alias("m"))
    return materialize(m.select("u", F.least("u", "m").alias("m")), "star-minima")


def _settled(e: DataFrame) -> bool:
    """Whether the edges (u, v < u) are stars: every u points to one v, and
    no v points on."""
    torn = e.groupBy("u").agg(F.min("v").alias("lo"), F.max("v").alias("hi")).filter("lo <> hi")
    if not torn.isEmpty():
        return False
    return e.join(e.select(F.col("v").alias("u")).distinct(), "u", "left_semi").isEmpty()


def components(edges: DataFrame, rounds: int = 30) -> DataFrame:
    """(node, component) for every node of ``edges`` (u, v): the smallest
    node reachable. Ends when every node points to its component's smallest;
    raises if ``rounds`` are not enough (their number grows with the
    logarithm of the size)."""
    e = edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    e = materialize(e, "star-edges")
    for _ in range(rounds):
        if _settled(e):
            break
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (both.join(_minima(both), "u").filter(F.col("v") > F.col("u"))
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v"))
        large = materialize(large, "star-large")
        down = _minima(large)
        small = large.join(down, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(down.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()
        e = materialize(small, "star-edges")
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
