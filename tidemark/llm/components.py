"""Connected components of a link table, by rounds of Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import stage


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of `links` (columns a, b); component is its smallest node.

    Alternates large-star and small-star steps: every round shortens all paths, so the number of
    rounds grows with the logarithm of the longest path. Each round is a written table, which cuts
    the lineage; only the number of links and a checksum reach the driver. Links of a node with
    itself and repeated links change nothing; no links give no rows.
    """
    def mark(df):
        row = df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        return tuple(row)

    def star(df, both):
        pairs = df.select("a", "b")
        if both:
            pairs = pairs.union(df.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = pairs.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        met = pairs.join(least, "a")
        if both:
            out = met.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        else:
            out = met.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
        return out.where("a <> b").distinct()

    current = stage(
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "links"
    )
    before = mark(current)
    while True:
        current = stage(star(star(current, True), False), "links")
        now = mark(current)
        if now == before:
            break
        before = now
    child = current.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return child.union(current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
