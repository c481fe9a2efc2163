"""Connected components of a graph given as edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakewarden.session import checkpoint


def connected_components(edges: DataFrame, left: str, right: str) -> DataFrame:
    """`(node, component)`; a component is named by its least node. Nodes are strings.

    Large and small stars by turns: every node hands its neighbours the least node it knows, first
    those above it, then those below it. The number of rounds grows with the logarithm of the
    longest path. A node with very many neighbours is met by a minimum, combined per task.
    """
    links = edges.select(F.col(left).alias("a"), F.col(right).alias("b"))
    # every node points at itself, so single nodes stay and least nodes name themselves
    own = links.select(F.explode(F.array("a", "b")).alias("a")).distinct().withColumn("b", F.col("a"))
    links = checkpoint(_downward(links.where("a <> b")))
    seal = _seal(links)
    while True:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy(F.col("a").alias("n")).agg(F.least("n", F.min("b")).alias("least"))
        large = both.join(least, F.col("a") == F.col("n")).where("b > a")
        starred = _downward(large.select(F.col("b").alias("a"), F.col("least").alias("b")))
        # now to the least of the nodes below
        lowest = starred.groupBy(F.col("a").alias("n")).agg(F.min("b").alias("least"))
        small = starred.join(lowest, F.col("a") == F.col("n"))
        lifted = small.select(F.explode(F.array("a", "b")).alias("a"), F.col("least").alias("b"))
        after = checkpoint(_downward(lifted.where("a <> b")))
        before, seal = seal, _seal(after)
        links = after
        if seal == before:
            break
    named = links.unionByName(own)
    return named.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component"))


def _downward(links: DataFrame) -> DataFrame:
    """Distinct links from the greater to the lesser node."""
    return links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _seal(links: DataFrame) -> tuple:
    """Number and two sums of hashes of distinct links; equal ones mean that a round changed nothing."""
    sums = [F.sum(F.xxhash64(F.lit(salt), "a", "b").cast("decimal(38,0)")) for salt in (1, 2)]
    return tuple(links.agg(F.count(F.lit(1)), *sums).first())
