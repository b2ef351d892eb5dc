"""YAML document scans, typed with coercion, and run folders."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _rows(it: Iterator[pa.RecordBatch], field: str) -> Iterator[pa.RecordBatch]:
    import yaml

    for batch in it:
        out: list[tuple] = []
        for path, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            try:
                doc = yaml.safe_load(text or "")
            except yaml.YAMLError:
                doc = None
            rows = doc.get(field) if isinstance(doc, dict) else None
            rows = rows if isinstance(rows, list) else list(rows.items()) if isinstance(rows, dict) else []
            out += [(path, i, json.dumps(r, default=str, ensure_ascii=False)) for i, r in enumerate(rows)]
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate((pa.string(), pa.int64(), pa.string()))], names=["path", "pos", "raw"])


def read_yaml(spark: SparkSession, path: str, field: str) -> DataFrame:
    """(path, pos, raw): the rows of a list (or the pairs of a map) of each document, as JSON text.

    Files are read by Spark, whole, one after another in a task; a document that
    is no YAML, or lacks the field, has no rows.
    """
    files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")
    return files.mapInArrow(lambda it: _rows(it, field), "path string, pos long, raw string")


def text_of(raw: Column, name: str) -> Column:
    """A field as text, stripped; null if absent."""
    return F.trim(F.get_json_object(raw, f"$.{name}"))


def bool_of(raw: Column, name: str) -> Column:
    """True for true and for a text that says so, in any case."""
    return F.coalesce(F.lower(text_of(raw, name)) == "true", F.lit(False))


def literal_of(raw: Column, name: str) -> Column:
    """A scalar field as JSON has it: texts keep their quotes, so ``"true"`` is not ``true``."""
    value = F.get_json_object(raw, f"$.{name}")
    kind = F.schema_of_variant(F.try_variant_get(F.try_parse_json(raw), f"$.{name}", "variant"))
    return F.when(kind == "STRING", F.concat(F.lit('"'), value, F.lit('"'))).otherwise(value)


def list_of(raw: Column, name: str) -> Column:
    """A list field; a scalar is a list of one, null and absent an empty one."""
    value = F.get_json_object(raw, f"$.{name}")
    listed = F.from_json(value, "array<string>")
    none = F.array().cast("array<string>")
    return F.when(value.isNull(), none).when(F.json_array_length(value).isNotNull(), F.coalesce(F.array_compact(listed), none)).otherwise(F.array(value))


def typed_sources(raw: DataFrame) -> DataFrame:
    """Source rows with their columns, polymorphic ones made lists."""
    r = F.col("raw")
    return raw.select(
        "pos",
        *[text_of(r, c).alias(c) for c in ("id", "name", "homepage_url", "source_type", "access_type", "crawl_frequency", "confidence")],
        *[list_of(r, c).alias(c) for c in ("event_listing_urls", "event_focus", "languages", "genre_tags")],
        F.coalesce(F.get_json_object(r, "$.geo_coverage.primary_city"), F.array_join(list_of(r, "geo_coverage"), ",")).alias("geo_coverage"),
        literal_of(r, "active").alias("active"),
        F.get_json_object(r, "$.robots_txt_checked").alias("robots_txt_checked"),
    )


def taxonomy_ids(raw: DataFrame) -> DataFrame:
    """(id), each once: the keys of a mapping's rows as ``read_yaml`` gives them, or the ids of a list's rows."""
    pair = F.json_array_length("raw").isNotNull()
    ident = F.when(pair, F.get_json_object("raw", "$[0]")).otherwise(F.get_json_object("raw", "$.id"))
    return raw.select(ident.alias("id")).where("id IS NOT NULL").distinct()


def name_map(sources: DataFrame | None, spark: SparkSession) -> DataFrame:
    """(id, name) of a catalog's sources, the last of equal ids; empty without a catalog."""
    if sources is None:
        return spark.createDataFrame([], "id string, name string")
    return sources.where(F.col("id").isNotNull()).groupBy("id").agg(F.max_by("name", "pos").alias("name"))


def latest_run(spark: SparkSession, glob: str, without: str) -> str | None:
    """The most recently written file of other runs."""
    files = spark.read.format("binaryFile").load(glob).select("path", "modificationTime")
    row = files.where(~F.contains("path", F.lit(f"/{without}/"))).agg(F.max_by("path", F.struct("modificationTime", "path")).alias("path")).first()
    return row["path"]


def carry_forward(events: DataFrame, start: Column, days: int = 90) -> DataFrame:
    """Events of an earlier run whose date exists and lies in the window, upcoming again."""
    day = F.try_to_date("date", "yyyy-MM-dd")
    return events.where(day.between(start, F.date_add(start, days))).withColumn("status", F.lit("upcoming"))
