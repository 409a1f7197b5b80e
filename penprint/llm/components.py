"""Connected components of a graph given by its links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from penprint.session import staged


def components(links: DataFrame) -> DataFrame:
    """Columns ``node`` and ``root``, the smallest node that can be reached from it.

    ``links``: two long columns ``a`` and ``b``; links to oneself and repeated ones do
    no harm. Nodes without a link are not in the result. Alternates two steps until
    nothing changes: every node points its larger neighbours to its smallest neighbour,
    then all its smaller ones. Both keep the number of links from growing, and the
    rounds needed grow with the logarithm of the size. Each step is written, so neither
    the plan nor what a lost executor costs grows with the rounds.
    """
    edges = staged(
        links.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
        "links",
    )
    before = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = staged(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "star")
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = staged(large, "star")
        least = staged(large.groupBy("u").agg(F.min("v").alias("m")), "star")
        small = (
            large.join(least, "u")
            .where("v != m")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(least.select("u", F.col("m").alias("v")))
            .where("u != v")
            .distinct()
        )
        edges = staged(small, "star")
        after = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if after == before:
            break
        before = after
    # at the end each node has one link, to its root
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    out = edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
    return out
