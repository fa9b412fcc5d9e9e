"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import shared_table


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
    return row["n"], row["x"]


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``label`` (the smallest node reached) for every node that has a link.

    In a large star every larger neighbour moves to the smallest neighbour; in a small star every
    smaller one does. The minimum of a node's neighbours combines before the shuffle, so a node
    with very many links is no hot spot of the aggregation, and no neighbour list is ever gathered.
    """
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u != v").distinct()
    edges = shared_table(edges, "stars")
    state = _state(edges)
    while True:
        both = edges.union(edges.select(F.col("v"), F.col("u")))
        smallest = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u"), F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(smallest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u != v").distinct()
        smallest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(smallest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = shared_table(small.union(smallest.select("u", F.col("m").alias("v"))).filter("u != v").distinct(), "stars")
        before, state = state, _state(edges)
        if state == before:
            break
    # Each node now has one link, to the smallest of its component.
    labels = edges.select(F.col("u").alias("node"), F.col("v").alias("label"))
    return labels.union(edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
