"""Connected components of a link table, by alternating star contraction.

Each round links every node to the smallest node it knows, so trees flatten in a number of
rounds that grows with the logarithm of their depth. Every round is written to shared
storage, which cuts lineage and survives lost executors. Minimums are combined before the
shuffle; the joins leave a hot node's links to Spark's skew handling.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.sources.staging import stage


def _fingerprint(edges: DataFrame) -> tuple:
    return tuple(
        edges.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
    )


def connected(links: DataFrame) -> DataFrame:
    """(node, component) for each node of ``links`` (columns a, b; both long): the component
    is the smallest node reachable. Null ends and self links are ignored."""
    edges = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = links.sparkSession.createDataFrame([], "a long, b long").union(
        edges.where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
    )
    edges = stage(edges.distinct(), "links")
    seen = _fingerprint(edges)
    while True:
        # Every larger neighbour of a node is linked to the node's smallest neighbour.
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = large.where("a <> b").distinct()
        # A node and its smaller neighbours are linked to the smallest of them.
        least = edges.groupBy("a").agg(F.min("b").alias("m"))
        small = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = stage(small.union(least).where("a <> b").distinct(), "links")
        now = _fingerprint(edges)
        if now == seen:
            break
        seen = now
    members = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return members.union(roots)
