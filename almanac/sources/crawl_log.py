"""The crawl log: lines are written from visits and read back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from almanac.functions import fixed
from almanac.operators import report

# The five kinds of lines.
_START = r"^SOURCE_START index=(\d+)/(\d+) remaining=(\d+) id=(\S+) name=\"(.*)\" urls=(\d+)$"
_URL = r"^SOURCE_URL .*status=(\S+)(?: .*|)$"
_AT = r"index=(\d+)/(\d+)"
_DONE = r"^SOURCE_DONE index=(\d+)/(\d+) remaining=(\d+) success=(true|false) blocked=(true|false) source_events=(\d+) running_new_events=(\d+) id=(\S+)$"
_TOTALS = r"^attempted=(\d+) successful=(\d+) blocked=(\d+) no_upcoming=(\d+)$"
_EVENTS = r"^events=(\d+) \(existing=(\d+), new=(\d+)\)$"


def start_line(index: Column, total: Column, ident: Column, name: Column, n_urls: Column) -> Column:
    return F.format_string('SOURCE_START index=%d/%d remaining=%d id=%s name="%s" urls=%d', index, total, total - index, ident, name, n_urls)


def url_line(index: Column, total: Column, at: Column, n: Column, status: Column, url: Column) -> Column:
    return F.format_string("SOURCE_URL index=%d/%d url_index=%d/%d status=%s url=%s", index, total, at, n, status, url)


def done_line(index: Column, total: Column, success: Column, blocked: Column, events: Column, running: Column, ident: Column) -> Column:
    return F.format_string("SOURCE_DONE index=%d/%d remaining=%d success=%s blocked=%s source_events=%d running_new_events=%d id=%s", index, total, total - index, success.cast("string"), blocked.cast("string"), events, running, ident)


def totals_line(attempted: Column, successful: Column, blocked: Column, no_upcoming: Column) -> Column:
    return F.format_string("attempted=%d successful=%d blocked=%d no_upcoming=%d", attempted, successful, blocked, no_upcoming)


def events_line(existing: Column, new: Column) -> Column:
    return F.format_string("events=%d (existing=%d, new=%d)", existing + new, existing, new)


def _int(line: Column, pattern: str, group: int) -> Column:
    return F.regexp_extract(line, pattern, group).try_cast("long")


def numbered(log: DataFrame) -> DataFrame:
    """The log's lines, stripped, with the column n in their order: their own, or else that of the scan."""
    n = F.col("n") if "n" in log.columns else F.monotonically_increasing_id()
    return log.select(n.alias("n"), F.btrim("value").alias("value"))


def starts(log: DataFrame) -> DataFrame:
    v = F.col("value")
    rows = numbered(log).where(v.rlike(_START))
    return rows.select("n", _int(v, _START, 1).alias("index"), _int(v, _START, 2).alias("total"), F.regexp_extract(v, _START, 4).alias("id"), F.regexp_extract(v, _START, 5).alias("name"), _int(v, _START, 6).alias("n_urls"))


def visits(log: DataFrame) -> DataFrame:
    v = F.col("value")
    return numbered(log).where(v.rlike(_URL)).select("n", _int(v, _AT, 1).alias("index"), _int(v, _AT, 2).alias("total"), F.regexp_extract(v, _URL, 1).alias("status"), F.contains(v, F.lit("blocked=true")).alias("blocked"))


def outcomes(log: DataFrame) -> DataFrame:
    v = F.col("value")
    return numbered(log).where(v.rlike(_DONE)).select("n", _int(v, _DONE, 1).alias("index"), F.regexp_extract(v, _DONE, 8).alias("id"), (F.regexp_extract(v, _DONE, 4) == "true").alias("success"), (F.regexp_extract(v, _DONE, 5) == "true").alias("blocked"), _int(v, _DONE, 6).alias("events"))


def totals(log: DataFrame) -> DataFrame:
    """One row: attempted, successful, blocked, no_upcoming, events, existing, new; of several lines the last, null without one."""
    v = F.col("value")

    def last(pattern: str, names: list[str]) -> list[Column]:
        return [F.max_by(_int(v, pattern, k + 1), F.when(v.rlike(pattern), F.col("n"))).alias(name) for k, name in enumerate(names)]

    return numbered(log).where(v.rlike(_TOTALS) | v.rlike(_EVENTS)).agg(*last(_TOTALS, ["attempted", "successful", "blocked", "no_upcoming"]), *last(_EVENTS, ["events", "existing", "new"]))


def visits_by_source(log: DataFrame) -> DataFrame:
    """Visits with their source's id: that of the first start of their (index, total); those of an unknown source are dropped."""
    first = starts(log).groupBy("index", "total").agg(F.min_by("id", "n").alias("id"))
    return visits(log).join(first, ["index", "total"])


def sources(log: DataFrame) -> DataFrame:
    """One row a source: index, total, id, name, success, blocked, events, statuses (each once, in order), blocked_hits, category.

    Of repeated start or done lines the last counts. A source without a done line has no
    success; its category, like that of one that succeeded, is null. A source that only a
    done line names has no index.
    """
    started = starts(log).groupBy("id").agg(*[F.max_by(c, "n").alias(c) for c in ("index", "total", "name")])
    done = outcomes(log).groupBy("id").agg(*[F.max_by(c, "n").alias(c) for c in ("success", "blocked", "events")])
    status = F.col("status")
    seen = F.array_sort(F.collect_list(F.struct("at", "status")))
    each = visits_by_source(log).groupBy("id", "status").agg(F.min("n").alias("at"), F.count("*").alias("times"), F.count_if("blocked").alias("hits"))
    hit = each.groupBy("id").agg(
        F.transform(seen, lambda x: x["status"]).alias("statuses"),
        F.sum("hits").alias("blocked_hits"),
        report.failure_class(F.bool_or(status == "error"), F.bool_or(status.isin([str(c) for c in fixed.BLOCKED_CODES])), F.sum("hits"), F.sum(F.when(status == "404", F.col("times")).otherwise(0)) / F.sum("times")).alias("category"),
    )
    out = started.join(done, "id", "full").join(hit, "id", "left")
    none = F.array().cast("array<string>")
    return out.select(
        "index", "total", "id", "name", "success", "blocked", F.coalesce("events", F.lit(0)).alias("events"), F.coalesce("statuses", none).alias("statuses"), F.coalesce("blocked_hits", F.lit(0)).alias("blocked_hits"),
        F.when(~F.col("success"), F.coalesce("category", F.lit("unknown_unreachable"))).alias("category"),
    )
