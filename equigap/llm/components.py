"""Connected components of an edge list, by alternating large-star and
small-star rounds until nothing changes.

Every round is a minimum per node (combined map-side) and a join with these
minima.  The minima are written tables: broadcast while their size allows it,
else joined by a shuffle that adaptive execution splits where a node is hot.
Rounds are written to the shared folder; the number of rounds grows with the
logarithm of the largest component.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .util import Scratch, small


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """``edges``: columns a, b of one orderable type.  Returns (node, root) for
    every node but the roots themselves, root being the component's least node."""

    def write(df: DataFrame, name: str) -> tuple[DataFrame, tuple]:
        """The written edges, and their number and checksum."""
        told = scratch.write(df, name)
        return told, tuple(told.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    ordered = edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    now, done = write(ordered.distinct(), "cc-0")
    k = 0
    while done[0]:
        # Large star: every larger neighbour of a node points to the least of its neighbourhood.
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = scratch.write(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), F.least("a", "m").alias("m")), f"cc-l-{k}")
        large = both.where("b > a").join(small(least, 32), F.expr("a = n")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = scratch.write(large.where("a > b"), f"cc-large-{k}")
        # Small star: a node and its smaller neighbours point to the least of them.
        least = scratch.write(large.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "n"), f"cc-s-{k}")
        lower = large.join(small(least, 32), F.expr("a = n")).where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now, after = write(lower.union(least.select(F.col("n").alias("a"), F.col("m").alias("b"))).distinct(), f"cc-{k + 1}")
        scratch.drop(f"cc-{k}", f"cc-l-{k}", f"cc-large-{k}", f"cc-s-{k}")
        if after == done:
            break
        done, k = after, k + 1
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
