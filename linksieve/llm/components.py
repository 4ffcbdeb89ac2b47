"""Connected components of a table of links, in rounds of star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linksieve.session import checkpointed


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component`` for every node of ``links``; the component is its smallest node.

    Each round links every larger neighbour of a node to the node's smallest neighbour, then
    every smaller one. A component of n nodes takes about log n rounds, and a round moves as many
    rows as there are links, whatever the degrees. Links that lack an end are left out. No links
    give no rows.
    """
    edges = checkpointed(
        links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") != F.col("v")))
        .distinct()
    )
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        larger = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = larger.filter("u != v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        smaller = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v")
        edges = checkpointed(smaller.unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == before:
            break
        before = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
