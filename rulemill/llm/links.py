"""Connected components of a link table, by rounds of star contraction.

A round is two equi-joins (Kiveris et al., "Connected Components in MapReduce
and Beyond", 2014): every node's larger neighbours are linked to its smallest
neighbour, then its smaller ones. Links and minima are written between rounds,
so lineage stays short, lost executors cost one round, and a node with any
number of links is a plain skewed join that adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..staging import stage


def _to_minimum(links: DataFrame) -> DataFrame:
    """(u, v) -> (u, v, m): m the smallest of u and its neighbours v."""
    links = stage(links, "links")
    lowest = stage(
        links.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("_u"), F.least("u", "m").alias("m")), "lowest"
    )
    return links.join(lowest, F.col("u") == F.col("_u")).drop("_u")


def _summary(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """(a, b) -> (node, root) for every node with a link; root is the smallest reachable."""
    edges = stage(
        links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links"
    )
    before = _summary(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _to_minimum(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small = _to_minimum(large)
        edges = stage(
            small.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(small.select("u", F.col("m").alias("v"))).distinct(),
            "links",
        )
        now = _summary(edges)
        if now == before:
            break
        before = now
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return stars.unionByName(stars.select(F.col("root").alias("node"), "root").distinct())
