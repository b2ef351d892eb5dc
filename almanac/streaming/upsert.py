"""The streaming twin of the event upsert: each micro-batch is merged into the catalog table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from almanac.operators import merge
from almanac.sources import sinks


def start_upsert(incoming: DataFrame, catalog: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Merges a stream of event rows into the Parquet catalog, micro-batch by micro-batch.

    A row that is late, even past, is accepted; nothing is dropped by a
    watermark. Merging a batch again changes nothing, so a replay is safe.
    """

    def apply(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        if batch.isEmpty():
            return
        active = spark.read.parquet(catalog) if sinks.recover(spark, catalog) else batch.limit(0)
        merged = merge.upsert_events(active, batch)
        from pyspark.sql import Window
        from pyspark.sql import functions as F

        rows = merged.withColumn("pos", F.row_number().over(Window.partitionBy("date").orderBy("at")).cast("long"))
        sinks.overwrite_with_snapshot(rows.select(*batch.columns), catalog, f"batch-{number}")

    writer = incoming.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
