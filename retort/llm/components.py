"""Connected components of a link table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retort.llm.common import materialize


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) of every node of ``links`` (two long columns); component is the smallest node.

    Each round points every node at the least of its neighbourhood, first for larger neighbours and then
    for smaller ones, until the links are stars around the components' least nodes. Minima are aggregated
    before they are shuffled and the joins are plain equi-joins, so a node with very many links is split
    like any skewed key. Every round is written to the shared folder. Self-links, repeated links and
    nulls change nothing; no links give no rows."""
    a, b = links.columns[:2]
    hi, lo = F.greatest(a, b).alias("a"), F.least(a, b).alias("b")
    edges = materialize(links.where(F.col(a) != F.col(b)).select(hi, lo).distinct(), "links")
    state = None
    while True:
        now = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if state == (now.n, now.h) or not now.n:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
                edges.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()
        state = (now.n, now.h)
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        large = materialize(large, "large-star")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        small = small.select("a", F.col("m").alias("b")).union(small.where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b")))
        edges = materialize(small.distinct(), "small-star")
