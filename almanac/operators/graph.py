"""Bounded crawls and connected components over edge tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from almanac.operators.lineage import checkpoint


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for each node of the edges (a, b); the label is the smallest node reachable.

    Minimum labels spread along the edges and are shortened by following each
    label's own label, so long chains take few rounds. Every round sums by key
    before its shuffle and is checkpointed; nothing but whether a label changed
    comes to the driver. The table of followed labels has one row a label: labels
    that many nodes share meet one row of it, in a join whose skew AQE splits.
    """
    both = checkpoint(edges.select("a", "b").union(edges.select("b", "a")).distinct())
    labels = checkpoint(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("label")))
    while True:
        low = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("label").alias("m"))
        step = labels.join(low, labels["node"] == low["a"]).select("node", F.col("label").alias("old"), F.least("label", "m").alias("label"))
        jump = labels.select(F.col("node").alias("via"), F.col("label").alias("further")).where("via != further")
        step = step.join(jump, step["label"] == jump["via"], "left").select("node", "old", F.least("label", F.coalesce("further", "label")).alias("label"))
        step = checkpoint(step)
        labels = step.select("node", "label")
        if step.where("old != label").isEmpty():
            return labels


def crawl(seeds: DataFrame, edges: DataFrame, max_depth: int = 2, max_pages: int = 80) -> DataFrame:
    """(source, url, depth, seq): pages in breadth-first order, so many a source at most.

    seeds: (source, url, seq); edges: (url, target, seq), in document order. A
    level is a join of the frontier less what was seen, and is cut to what a
    source may still visit before the next one is joined. Equal targets of one
    page count once; a source whose pages are all visited has no further rows.
    """
    first = Window.partitionBy("source", "url").orderBy("path")
    order = Window.partitionBy("source").orderBy("path", "url")

    def visited(found: DataFrame, before: DataFrame | None) -> DataFrame:
        found = found.withColumn("rn", F.row_number().over(first)).where("rn = 1").drop("rn")
        start = F.lit(0).cast("long")
        if before is not None:
            counts = before.groupBy("source").agg(F.count("*").alias("had"))
            found = found.join(before.select("source", "url"), ["source", "url"], "left_anti").join(counts, "source", "left")
            start = F.coalesce("had", F.lit(0).cast("long"))
        found = found.withColumn("seq", start + F.row_number().over(order)).where(F.col("seq") <= max_pages)
        return checkpoint(found.select("source", "url", "depth", "seq", "path"))

    level = visited(seeds.select("source", "url", F.lit(0).alias("depth"), F.array(F.col("seq").cast("long")).alias("path")), None)
    seen = level
    for depth in range(1, max_depth + 1):
        # a page's place among all, then the link's place on it
        found = level.join(edges.withColumnRenamed("seq", "link"), "url").select("source", F.col("target").alias("url"), F.lit(depth).alias("depth"), F.array(F.col("seq"), F.col("link").cast("long")).alias("path"))
        level = visited(found, seen)
        seen = seen.unionByName(level)
    return seen.select("source", "url", "depth", F.col("seq").cast("int").alias("seq"))
