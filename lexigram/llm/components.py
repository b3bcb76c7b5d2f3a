"""Connected components by alternating star contraction, each round written to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexigram.session import stored


def _nearest(links: DataFrame) -> DataFrame:
    """``(node, low)``: the smallest neighbour, or the node itself."""
    return links.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least")).select(
        "node", F.least("node", "least").alias("low")
    )


def _both_ways(links: DataFrame) -> DataFrame:
    return links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(links: DataFrame) -> DataFrame:
    """Larger neighbours of every node move to its smallest neighbour."""
    around = _both_ways(links)
    moved = around.where("b > a").join(_nearest(around).withColumnRenamed("node", "a"), "a")
    return moved.select(F.col("b").alias("a"), F.col("low").alias("b")).where("a != b").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """The node and its smaller neighbours move to the smallest of them; links point to the smaller end already."""
    low = _nearest(links).withColumnRenamed("node", "a")
    moved = links.join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return moved.unionByName(low.select("a", F.col("low").alias("b"))).where("a != b").distinct()


def _state(links: DataFrame) -> tuple:
    mark = F.xxhash64("a", "b")
    row = links.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(mark).alias("x"), F.sum(mark % 1_000_003).alias("s")).first()
    return tuple(row)


def components(links: DataFrame) -> DataFrame:
    """``(node, component)`` of every node in ``links`` (a, b: bigint); the component is its smallest node.

    Rounds grow with the logarithm of the longest path. Repeated links, links to oneself and an empty table are fine; links
    with a null end are left out.
    """
    kept = links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    kept = stored(kept, "links")
    before = _state(kept)
    while before[0]:
        kept = stored(_small_star(_large_star(kept)), "links")
        after = _state(kept)
        if after == before:
            break
        before = after
    roots = kept.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return kept.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
