"""Reliable storage between steps: lineage is cut only by files that all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from almanac.operators.lineage import checkpoint, shared_folder

__all__ = ["checkpoint", "rewritten"]


def rewritten(df: DataFrame, name: str) -> DataFrame:
    """The frame, written as Parquet under a new name in the shared folder and read again."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
