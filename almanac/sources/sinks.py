"""Artifacts of a run: partitioned tables, snapshots, archives, YAML and Markdown."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from almanac.operators import merge


def _path(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _path(spark, path)
    return fs.exists(p)


def write_stage(df: DataFrame, path: str, run_id: str, by: str | None = None) -> None:
    """The rows of a run (and source) in folders of their own; a rerun replaces only these."""
    out = df.withColumn("run_id", F.lit(run_id)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    out.partitionBy("run_id", *([by] if by else [])).parquet(path)


_UPDATED = "_last_updated"


def recover(spark: SparkSession, path: str) -> bool:
    """Whether there is a catalog, after what a crash between two renames left is put right.

    A complete new catalog takes its place; else the last snapshot comes back.
    """
    p, fs = _path(spark, path)
    if fs.exists(p):
        return True
    new, _ = _path(spark, f"{path}.new")
    if fs.exists(_path(spark, f"{path}.new/_SUCCESS")[0]):
        return fs.rename(new, p)
    kept, _ = _path(spark, f"{path}.snapshot")
    if fs.exists(kept):
        last = max(fs.listStatus(kept), key=lambda f: f.getModificationTime(), default=None)
        if last is not None:
            return fs.rename(last.getPath(), p)
    return False


def overwrite_with_snapshot(df: DataFrame, path: str, run_id: str, updated: str | None = None) -> None:
    """Replaces a catalog: the old one is kept under snapshot/run_id=..., the new one is complete before it takes its place.

    ``updated`` goes with the catalog, for ``last_updated``. A run that is
    repeated leaves the snapshot that its first try made.
    """
    spark = df.sparkSession
    recover(spark, path)
    new, old = f"{path}.new", f"{path}.snapshot/run_id={run_id}"
    df.write.mode("overwrite").parquet(new)
    p, fs = _path(spark, path)
    if updated is not None:
        out = fs.create(_path(spark, f"{new}/{_UPDATED}")[0], True)
        out.write(bytearray(updated.encode()))
        out.close()
    if fs.exists(p):
        kept, _ = _path(spark, old)
        if fs.exists(kept):
            fs.delete(p, True)
        else:
            fs.mkdirs(kept.getParent())
            fs.rename(p, kept)
    fs.rename(_path(spark, new)[0], p)


def last_updated(spark: SparkSession, path: str) -> str | None:
    """What the catalog's last overwrite said of its date."""
    p, fs = _path(spark, f"{path}/{_UPDATED}")
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_reports(lines: DataFrame, path: str) -> None:
    """Reports of lines (report, place, line) as one text file each, under report=..., written by the executors."""
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "line"))), lambda x: x["line"]), "\n")
    lines.groupBy("report").agg(text.alias("value")).write.mode("overwrite").partitionBy("report").text(path)


def append_archive(past: DataFrame, path: str) -> None:
    """Past rows into their months' folders; a row whose key is there is not written again."""
    spark = past.sparkSession
    there = spark.read.parquet(path).withColumn("month", F.col("month").cast("string")) if exists(spark, path) else past.limit(0)
    merge.new_in_archive(past, there).write.mode("append").partitionBy("month").parquet(path)


def to_yaml(df: DataFrame, envelope: dict, field: str, order: list[str], most: int = 100_000) -> str:
    """A catalog as one YAML document, in block style, for people and small tools.

    It is made on the driver, so ``most`` rows bound it; larger catalogs stay tables.
    """
    import yaml

    rows = df.orderBy(*order).limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} rows: use the tables")
    doc = envelope | {field: [r.asDict(recursive=True) for r in rows]}
    return yaml.safe_dump(doc, explicit_start=True, sort_keys=False, allow_unicode=True, default_flow_style=False)
