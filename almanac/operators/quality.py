"""Data-quality rules on raw JSON rows, where an absent key differs from a null."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from almanac.functions import fixed


def present(raw: Column) -> Column:
    """Keys of a JSON object; empty if it is none."""
    return F.coalesce(F.json_object_keys(raw), F.array().cast("array<string>"))


def _length(raw: Column, name: str) -> Column:
    return F.coalesce(F.json_array_length(F.get_json_object(raw, f"$.{name}")), F.lit(0))


def event_errors(raw: Column) -> Column:
    """Messages about one event row, in the order of the rules."""
    missing = F.array_except(F.array(*[F.lit(f) for f in fixed.EVENT_FIELDS]), present(raw))
    status, confidence, date = (F.get_json_object(raw, f"$.{f}") for f in ("status", "confidence", "date"))
    rules = [
        F.when(F.json_object_keys(raw).isNull(), "not a mapping"),
        F.when(F.size(missing) > 0, F.concat(F.lit("missing: "), F.array_join(missing, ","))),
        F.when(~F.coalesce(status.isin(fixed.EVENT_STATES), F.lit(False)), "invalid status"),
        F.when(~F.coalesce(confidence.isin(fixed.CONFIDENCES), F.lit(False)), "invalid confidence"),
        F.when(~F.coalesce(date.rlike(r"\A\d{4}-\d{2}-\d{2}\z"), F.lit(False)), "invalid date"),
        F.when(_length(raw, "categories") == 0, "no categories"),
        F.when(_length(raw, "source_urls") == 0, "no source_urls"),
    ]
    found = F.array_compact(F.array(*rules))
    return F.when(F.json_object_keys(raw).isNull(), F.array(F.lit("not a mapping"))).otherwise(found)


def missing_fields(raw: Column, required: Column, fallback: list[str]) -> Column:
    """Required keys that a row lacks; the contract's list, or else the fallback."""
    wanted = F.coalesce(F.when(F.size(required) > 0, required), F.array(*[F.lit(f) for f in fallback]))
    return F.array_except(wanted, present(raw))


def envelope_errors(df: DataFrame) -> DataFrame:
    """Messages about documents (raw, stage, run_date): mapping, stage, date, list of rows."""
    raw = F.col("raw")
    rules = [
        F.when(F.json_object_keys(raw).isNull(), "root is not a mapping"),
        F.when(F.coalesce(F.get_json_object(raw, "$.pipeline_stage"), F.lit("")) != F.col("stage"), "wrong stage"),
        F.when(F.coalesce(F.get_json_object(raw, "$.run_date"), F.lit("")) != F.col("run_date"), "wrong run_date"),
        F.when(F.json_array_length(F.get_json_object(raw, "$.events")).isNull(), "events is not a list"),
    ]
    return df.withColumn("errors", F.array_compact(F.array(*rules)))


def report(events: DataFrame, envelope: DataFrame) -> DataFrame:
    """(pos, id, error): each message about a document's rows (pos, raw) and its envelope (errors); pos is null for the latter.

    A row without an id is named by its place, from 1.
    """
    named = F.coalesce(F.get_json_object("raw", "$.id"), F.concat(F.lit("index_"), (F.col("pos") + 1).cast("string")))
    rows = events.select("pos", named.alias("id"), F.explode(event_errors(F.col("raw"))).alias("error"))
    whole = envelope.select(F.lit(None).cast("long").alias("pos"), F.lit(None).cast("string").alias("id"), F.explode("errors").alias("error"))
    return whole.unionByName(rows)


def verdict(found: DataFrame, n_events: Column) -> DataFrame:
    """(verdict, n, exit_status) of such messages: VALID with the number of rows and 0, or INVALID with that of messages and 1."""
    out = found.agg(F.count("*").alias("errors"))
    bad = F.col("errors") > 0
    return out.select(F.when(bad, "INVALID").otherwise("VALID").alias("verdict"), F.when(bad, F.col("errors")).otherwise(n_events).alias("n"), bad.cast("int").alias("exit_status"))
