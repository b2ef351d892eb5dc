"""Where lineage ends: files in a folder that all executors share."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

#: Whether the shuffle files of a query go when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir, set as Spark's own.

    Where that is unset, as in tests, a session on this machine gets a folder here; on a cluster that is an error.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        at = spark.conf.get("spark.checkpoint.dir", None)
        if at is None and not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(at or tempfile.mkdtemp(prefix="checkpoint-"))
    return sc.getCheckpointDir()


def checkpoint(df: DataFrame) -> DataFrame:
    """The frame, written to the shared folder; its lineage ends there.

    The shuffle files that it was made from go with the job that has written it, and not when the driver
    happens to collect its garbage. The setting counts for frames made under it: for a new one of the same rows.
    """
    spark = df.sparkSession
    shared_folder(spark)
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        return df.select("*").checkpoint(eager=True)
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)
