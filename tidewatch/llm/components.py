"""Connected components of a graph given by its links, without a driver-side step."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.session import pin, unpin


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())


def components(links: DataFrame) -> DataFrame:
    """Each linked node with the smallest node of its component: (node, root).

    ``links`` has two bigint columns (a, b); direction, loops, nulls and repeats
    do not matter. Alternates two steps on edges a > b until nothing changes:
    every node hands its larger neighbours, then its smaller ones, to the
    smallest it knows. Each round is written to the shared folder. A node is in
    the result if it has a link to another one.
    """
    edges = pin(
        links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    before = _state(edges)
    while before[0]:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        larger = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.least("a", "m").alias("b"))
        larger = larger.distinct()
        lowest = larger.groupBy("a").agg(F.min("b").alias("m"))
        smaller = larger.join(lowest, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        older, edges = edges, pin(smaller.union(lowest.select("a", F.col("m").alias("b"))).distinct())
        unpin(older)
        after = _state(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
