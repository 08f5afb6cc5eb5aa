"""Connected components of a large graph by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.staged import shared_folder, stage


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) of every node that has a link; the root is the smallest node.

    Each round hangs the larger neighbours of a node on its smallest one, then the
    smaller ones too, until every component is a star. Minima are combined before
    they are shuffled and the joins are on a node, so adaptive execution can split
    a node with many links. The links of a round are staged, which ends the lineage.

    NULL ends and links of a node to itself are left out; repeated links count
    once; an empty table gives an empty result.
    """
    folder = shared_folder(links.sparkSession, "components")
    edges = (
        links.select(F.col(a).alias("a"), F.col(b).alias("b"))
        .filter("a IS NOT NULL AND b IS NOT NULL AND a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    step, edges = 0, stage(edges, f"{folder}/0")
    before = None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % (1 << 31))).first()
        if state == before or not state[0]:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                edges.select("b", "b").distinct()
            )
        before, step = state, step + 1
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        least = least.select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
        large = (
            both.filter("b > a").join(least, F.col("a") == F.col("u"))
            .filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        )
        large = stage(large, f"{folder}/{step}-large")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least.withColumnRenamed("a", "u"), F.col("a") == F.col("u"))
        small = small.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = stage(small.union(least.select("a", "m")).distinct(), f"{folder}/{step}")
