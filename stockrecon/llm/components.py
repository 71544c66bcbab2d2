"""Connected components by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockrecon.sources.scratch import Shelf


def _checksum(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))
    ).collect()[0]
    return tuple(row)


def connected(edges: DataFrame, shelf: Shelf) -> DataFrame:
    """``(node, root)`` for every node with a link, ``root`` the smallest node reachable.

    ``edges`` has two long columns; order and repeats do not matter, loops count
    for nothing. Each half step takes the least neighbour of every node (summed
    before the shuffle) and joins it to the edges as a written table, so Spark can
    split the edges of a node with very many of them. The number of rounds grows
    with the logarithm of the longest chain.
    """
    a, b = edges.columns
    now = shelf.put(
        edges.where(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .distinct()
    )
    before, here = None, _checksum(now)
    while here != before and here[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = shelf.put(
            both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        )
        large = shelf.put(
            both.join(low, "u")
            .where((F.col("v") > F.col("u")) & (F.col("v") != F.col("m")))
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .distinct()
        )
        low = shelf.put(large.groupBy("u").agg(F.min("v").alias("m")))
        met = large.join(low, "u").where(F.col("v") != F.col("m"))
        small = met.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            low.select("u", F.col("m").alias("v"))
        )
        now = shelf.put(small.distinct())
        before, here = here, _checksum(now)
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
