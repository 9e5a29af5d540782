"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradepulse.llm.common import written


def _summary(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return row[0], int(row[1] or 0)


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its smallest node) of every node that ``edges`` (a, b) links.

    Each round links a node's larger neighbours to the smallest one it knows, then its
    smaller ones. Minima are aggregated before they meet the edges, so a node with very many
    links is not gathered anywhere. Rounds grow with the logarithm of the longest chain and
    are written, so that none depends on earlier ones.
    """
    links = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
    links = written(links, "links")
    state = _summary(links)
    while True:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        links = written(small.select("e.a", "e.b").filter("a <> b").distinct(), "links")
        before, state = state, _summary(links)
        if state == before:
            break
    stars = links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    centres = links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return stars.unionByName(centres)
