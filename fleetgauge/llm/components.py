"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import hand_off


def components(links: DataFrame) -> DataFrame:
    """(id, label): the smallest id connected to each id of the links (a, b).

    Each round hangs the larger neighbours of every id on its smallest neighbour, then the smaller ones; edges never
    grow in number beyond one per link end, and the work stops when a round changes nothing. All
    steps are joins and aggregations with map-side combine, so an id with very many links is no hot spot.
    """
    edges = hand_off(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    before = None
    while True:
        state = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("sum")).first()
        if state == before:
            return edges.select(F.col("u").alias("id"), F.col("v").alias("label")).unionByName(
                edges.select(F.col("v").alias("id"), F.col("v").alias("label")).distinct()
            )
        before = state
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = hand_off(small.unionByName(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct(), "edges")
