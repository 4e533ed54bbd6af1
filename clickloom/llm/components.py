"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.tables import stored

EDGES = "a long, b long"


def _both(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").union(edges.select("b", "a"))


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node that has an edge; the label is the smallest node of its component.

    Large-star and small-star steps alternate until the edges are stars around the smallest nodes. Every round is a few
    grouped minima and joins of narrow rows; the driver sees a count and a checksum.
    """
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = stored(edges.where("a > b").distinct(), "edges")
    last = None
    while True:
        check = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if check == last:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("label")).union(
                edges.select("b", "b").distinct()
            )
        last = check
        both = _both(edges)
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a > b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        small = small.select(F.col("b").alias("x"), "m").union(small.select("a", "m"))
        small = small.select(F.col("x").alias("a"), F.col("m").alias("b")).where("a > b").distinct()
        edges = stored(small, "edges")
