"""Caps, running totals and early stops as windows over ordered rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def cap(df: DataFrame, by: list[str], order: list, most: int) -> DataFrame:
    """The first rows of each group."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("_n") <= most).drop("_n")


def _before(by: list[str], order: list) -> Window:
    return Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)


def stop_at_total(df: DataFrame, by: list[str], order: list, count: Column, most: int) -> DataFrame:
    """Rows up to and with the one that brings the running total to ``most``."""
    return df.withColumn("_t", F.coalesce(F.sum(count).over(_before(by, order)), F.lit(0))).where(F.col("_t") < most).drop("_t")


def stop_at_streak(df: DataFrame, by: list[str], order: list, bad: Column, good: Column, most: int = 3) -> DataFrame:
    """Rows up to and with the one that makes ``most`` bad ones since the last good one."""
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    df = df.withColumn("_seg", F.sum(F.when(good, 1).otherwise(0)).over(w)).withColumn("_bad", bad)
    inner = Window.partitionBy(*by, "_seg").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    df = df.withColumn("_s", F.sum(F.when(F.col("_bad"), 1).otherwise(0)).over(inner))
    hit = F.col("_bad") & (F.col("_s") >= most)
    df = df.withColumn("_stop", F.coalesce(F.max(F.when(hit, 1).otherwise(0)).over(_before(by, order)), F.lit(0)))
    return df.where("_stop = 0").drop("_seg", "_bad", "_s", "_stop")


def spider_budget(found: Column, links: int = 15, total: int = 40) -> Column:
    """Detail pages that may still be visited."""
    return F.greatest(F.least(F.lit(links), total - found), F.lit(0))


def round_robin(seed: Column, attempt: Column, n: int) -> Column:
    """The turn of an attempt among n, from a seed on."""
    return F.pmod(seed + attempt, F.lit(n)).cast("long")


def listings_first(visits: DataFrame) -> DataFrame:
    """Visits (source, listing, n) without the fallback pages of sources whose listings had events."""
    had = F.max(F.when(F.col("listing"), F.col("n")).otherwise(0)).over(Window.partitionBy("source"))
    return visits.withColumn("_had", had).where((F.col("_had") == 0) | F.col("listing")).drop("_had")
