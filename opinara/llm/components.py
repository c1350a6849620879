"""Connected components of a graph given as links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from opinara.session import cut_lineage


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``links`` (``a``, ``b``): the smallest node it reaches.

    Alternates two steps: every node passes its larger neighbours, then its smaller ones, on
    to the smallest node it knows. Both are a minimum per node and a join; the number of links
    never grows and the rounds are logarithmic in the longest path.
    """
    links = cut_lineage(links.filter("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())

    def mark(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    state = mark(links)
    while state[0]:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        larger = both.join(least, "a").filter("b > a").select(
            F.col("b").alias("a"), F.least("a", "m").alias("b")).distinct()
        least = larger.groupBy("a").agg(F.min("b").alias("m"))
        smaller = larger.join(least, "a")
        links = cut_lineage(smaller.filter("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                            .unionByName(smaller.select("a", F.col("m").alias("b"))).distinct())
        before, state = state, mark(links)
        if state == before:
            break
    roots = links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
