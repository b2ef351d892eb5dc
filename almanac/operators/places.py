"""Places of rows: in a global order, and on the cores, without one task that holds all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from almanac.operators.lineage import checkpoint


def placed(df: DataFrame, order: list[Column], name: str = "place") -> DataFrame:
    """The rows with their place from 1 in the order, which should leave no ties.

    Rows are dealt into ranges and sorted there; a row's place is its place in the
    range and the sizes of the ranges before it. Only one number a range is summed in one task.
    """
    sorted_ = df.repartitionByRange(*order).sortWithinPartitions(*order)
    # an id is the partition in the high bits and the row's number in the low 33
    ranged = checkpoint(sorted_.withColumn("_at", F.monotonically_increasing_id()))
    ranged = ranged.withColumns({"_range": F.shiftright("_at", 33), "_n": F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))})
    sizes = ranged.groupBy("_range").agg(F.count("*").alias("_size"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_range", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    return ranged.join(F.broadcast(starts), "_range").withColumn(name, F.col("_start") + F.col("_n") + 1).drop("_at", "_range", "_n", "_start")


def spread(df: DataFrame) -> DataFrame:
    """The rows dealt over all cores: for short rows that become long ones.

    A file of a few megabytes is read in one task or two, however much is then made of its rows.
    """
    spark = df.sparkSession
    tasks = max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")), df.rdd.getNumPartitions())
    return df.repartition(tasks)
