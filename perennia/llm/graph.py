"""Connected components of links, by joins and aggregates that never gather a component in a task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perennia.llm.common import cut


def components(links: DataFrame) -> DataFrame:
    """(node, component): for each node of `links` (a, b) the smallest node it can reach.

    Large-star and small-star steps in turn: every node's larger neighbours, then its smaller ones
    and itself, are tied to its smallest neighbour, until nothing changes; the number of rounds
    grows with the logarithm of the longest chain. Loops, repeats and nulls may occur in `links`.
    """
    edges = cut(
        links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    )
    print_ = _fingerprint(edges)
    while True:
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = cut(small.unionAll(least.select("u", F.col("m").alias("v"))).distinct())
        last, print_ = print_, _fingerprint(edges)
        if last == print_:
            break
    roots = edges.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(roots)


def _fingerprint(edges: DataFrame) -> tuple:
    digest = F.xxhash64("u", "v")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(digest.cast("decimal(20,0)")), F.bit_xor(digest)).first())
