"""Connected components of a table of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinistar.llm.common import discard, staged


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for each node of ``links`` (``a, b``): the smallest node
    of its component.

    Large-star and small-star steps hang every node under a smaller one until
    nothing moves, in about log(nodes) rounds. Minima are partial aggregations
    and rows go back to their minimum by a join, so a node with very many
    links is never gathered in one place. Each round is a written table.
    """
    above = F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")
    edges = staged(links.where("a <> b").select(*above).distinct(), "links")
    seen = None
    while True:
        last = edges
        both = edges.select("v", "u").union(edges.select("u", "v"))
        low = both.groupBy("v").agg(F.least(F.min("u"), F.first("v")).alias("low")).withColumnRenamed("v", "of")
        large = both.join(low, both["v"] == low["of"]).where("u > v").select(F.col("u").alias("v"), F.col("low").alias("u")).where("v <> u").distinct()
        low = large.groupBy("v").agg(F.min("u").alias("low")).withColumnRenamed("v", "of")
        small = large.join(low, large["v"] == low["of"])
        small = small.select(F.col("u").alias("v"), F.col("low").alias("u")).union(low.select(F.col("of").alias("v"), F.col("low").alias("u")))
        edges = staged(small.where("v <> u").distinct(), "links")
        state = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("v", "u"))).first()
        discard(links.sparkSession, last)
        if state == seen:
            break
        seen = state
    stars = edges.select(F.col("v").alias("node"), F.col("u").alias("root"))
    return stars.union(stars.select(F.col("root").alias("node"), "root").distinct())
