"""Connected components of a table of links, by rounds of large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from assetweave.llm.scratch import land


def components(links: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """(node, component) for each node of a link; the component is its smallest node.

    A round hangs the neighbours of each node below the smallest of them, first the larger ones, then the smaller ones,
    so the depth halves and stars come out; it ends when a round changes nothing. A node's neighbours are never
    collected: their smallest one comes from an aggregate and is joined back, which adaptive execution can split.
    Every round is landed, so a lost executor costs a read.
    """
    pairs = links.select(F.col(left).alias("u"), F.col(right).alias("v")).where("u <> v")
    rows = links.count()
    edges, before = land(pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links", rows), None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = large.where("u <> v")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        edges = land(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "links", rows)
        now = tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("u", "v") % 1000003)).first())
        if now == before:
            break
        before = now
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return land(edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots), "components", 2 * rows)
