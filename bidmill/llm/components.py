"""Connected components by alternating large-star and small-star.

Each round hangs every node's larger neighbours on its smallest neighbour (large-star), then its
smaller ones (small-star), until nothing changes: then each node hangs on the smallest node of its
component. Smallest neighbours come from a grouped minimum with partial sums, and are joined back,
so a node with very many neighbours is split like any skewed join. Each round is written out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bidmill.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for edges (a, b): the smallest node that can be reached.

    Edges with a null end and loops are left out; nodes without other edges are not listed. No
    edges give no rows.
    """
    spark = edges.sparkSession
    links = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    links = stored(spark, links, "links")
    before = None
    while (now := _state(links)) != before:
        before = now
        both = links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = stored(spark, large, "links")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        met = large.join(least, "a")
        small = met.select("a", F.col("m").alias("b")).unionAll(met.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")))
        links = stored(spark, small.distinct(), "links")
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(
        links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("b", "a").cast("decimal(38,0)"))).first())
