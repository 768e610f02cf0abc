"""Connected components by alternating large and small stars, as DataFrame jobs.

Every round is two aggregations and two joins over the links; each ends in a
stored table, so lineage stays short and a lost executor costs a re-read. The
number of rounds grows with the logarithm of the longest chain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import stored


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b: long): root is the smallest node that it reaches.

    Loops, repeated links and both directions are the same link; no links give
    no rows; links with a null end are none.
    """
    edges = _edges(links.where("a is not null and b is not null"), "a", "b")
    before = None
    while (now := _digest(edges)) != before:
        before = now
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _minima(both)
        edges = _edges(both.join(large, "u").where("v > u"), "v", "m")
        small = _minima(edges)
        starred = edges.join(small, "u")
        edges = _edges(starred.select("v", "m").unionByName(small.select(F.col("u").alias("v"), "m")), "v", "m")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _edges(df: DataFrame, a: str, b: str) -> DataFrame:
    """Distinct links, larger end first."""
    return stored(df.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct(), "edges")


def _minima(edges: DataFrame) -> DataFrame:
    """The smallest of each u and its neighbours; stored, so that the join back sees its size and may split hot nodes."""
    return stored(edges.groupBy("u").agg(F.min("v").alias("v")).select("u", F.least("u", "v").alias("m")), "minima")


def _digest(edges: DataFrame):
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())
