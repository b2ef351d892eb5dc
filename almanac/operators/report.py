"""Metrics, failure classes and Markdown reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from almanac.functions import fixed
from almanac.functions import text as tx

# What the failure categories mean.
EXPLANATIONS = {
    "network_or_fetch_errors": "Requests failed before a valid HTTP response was received (connection, DNS, TLS, timeout, or similar transport-level failures).",
    "access_blocked_or_rate_limited": "Source blocked automated access or required interactive/browser execution (HTTP 401/403/429/503, or blocked-body signals such as anti-bot/captcha pages).",
    "missing_or_invalid_listing_paths": "Configured listing/fallback URLs mostly returned not found (404), indicating stale paths, moved pages, or incompatible URL structure.",
    "unknown_unreachable": "Source was unsuccessful but did not match the known failure signatures above; requires manual inspection.",
    "FETCH_ERROR": "HTTP error or network-level failure when fetching a URL (e.g. connection refused, 4xx/5xx response)",
    "ACCESS_DENIED": "Server returned 401/403 or presented a CAPTCHA/login wall",
    "PARSE_ERROR": "HTML could not be parsed or had an unexpected MIME type (e.g. PDF, binary response)",
    "INVALID_SOURCE": "The source URL or configuration is malformed and cannot be processed (e.g. bad URI)",
    "TIMEOUT": "Request exceeded the configured timeout before a response was received",
    "UNKNOWN": "Unexpected exception not matched by any known category — check the message for details",
}


def explanation(category: Column) -> Column:
    """The meaning of a category; empty if it is not known."""
    table = F.create_map(*[F.lit(x) for pair in EXPLANATIONS.items() for x in pair])
    return F.coalesce(F.try_element_at(table, category), F.lit(""))


def failure_class(has_error: Column, has_blocked_code: Column, blocked_hits: Column, share_404: Column) -> Column:
    """Class of an unsuccessful source; the first rule that fits."""
    return (
        F.when(has_error, "network_or_fetch_errors")
        .when(has_blocked_code | (blocked_hits > 0), "access_blocked_or_rate_limited")
        .when(share_404 >= 0.8, "missing_or_invalid_listing_paths")
        .otherwise("unknown_unreachable")
    )


def classify_sources(visits: DataFrame) -> DataFrame:
    """(source_id, category) from rows (source_id, status as text, blocked)."""
    status = F.col("status")
    return visits.groupBy("source_id").agg(
        failure_class(F.bool_or(status == "error"), F.bool_or(status.isin([str(c) for c in fixed.BLOCKED_CODES])), F.count_if("blocked"), F.avg((status == "404").cast("int"))).alias("category")
    )


def failure_counts(failures: DataFrame) -> DataFrame:
    """Failures by category, most first."""
    return failures.groupBy("category").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "category")


def failure_matrix(failures: DataFrame) -> DataFrame:
    """Failures by source and category; nothing where there are none."""
    return failures.groupBy("source_id", "category").agg(F.count("*").alias("n"))


def failure_map(failures: DataFrame) -> DataFrame:
    """(source_id, counts): per source a map from category to failures, its entries in order of the categories."""
    entries = F.array_sort(F.collect_list(F.struct("category", "n")))
    return failure_matrix(failures).groupBy("source_id").agg(F.map_from_entries(entries).alias("counts"))


def with_total(rows: DataFrame, by: str, total: str = "TOTAL") -> DataFrame:
    """(by as text, n, is_total): rows counted by a column, and a row of all; a null of the column stays null."""
    out = rows.rollup(by).agg(F.count("*").alias("n"), (F.grouping_id() == 1).alias("is_total"))
    return out.select(F.when(F.col("is_total"), total).otherwise(F.col(by).cast("string")).alias(by), "n", "is_total")


def source_outcomes(visits: DataFrame) -> DataFrame:
    """Per source: success, blocked (and no success), event found."""
    out = visits.groupBy("source_id").agg(F.bool_or("ok").alias("success"), F.bool_or("blocked").alias("hit"), F.bool_or("has_event").alias("has_event"))
    return out.select("source_id", "success", (F.col("hit") & ~F.col("success")).alias("blocked"), "has_event")


def source_metrics(visits: DataFrame, events: DataFrame) -> DataFrame:
    """(source_id, unique_events, visited_pages, failures, duration_ms) of visits (source_id, failed, started, ended) and events (source_id, id).

    A source lasts from its first start to its last end; one without events has none.
    """
    seen = visits.groupBy("source_id").agg(
        F.count("*").alias("visited_pages"), F.count_if("failed").alias("failures"), (F.unix_millis(F.max("ended").cast("timestamp")) - F.unix_millis(F.min("started").cast("timestamp"))).alias("duration_ms")
    )
    found = events.groupBy("source_id").agg(F.count_distinct("id").alias("unique_events"))
    return seen.join(found, "source_id", "left").select("source_id", F.coalesce("unique_events", F.lit(0)).alias("unique_events"), "visited_pages", "failures", "duration_ms")


def unsuccessful(sources: DataFrame) -> DataFrame:
    """Sources that did not succeed; of those whose success is unknown none."""
    return sources.where(~F.col("success"))


def cell(c: Column) -> Column:
    """A value as a table's cell: empty for null, pipes escaped."""
    return tx.escape_pipes(F.coalesce(c.cast("string"), F.lit("")))


def table_row(*cells: Column) -> Column:
    return F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |"))


def lines(df: DataFrame, section: int, line: Column, order: list[Column] = (), report: Column | None = None) -> DataFrame:
    """(report, place, line) of each row of a section; order: a number, then texts that break ties."""
    number, text = (order[0] if order else F.lit(0)), (order[1:] or [F.lit("")])
    place = F.struct(F.lit(section).alias("section"), F.coalesce(number.cast("long"), F.lit(999_999).cast("long")).alias("n"), F.concat_ws("\x01", *text).alias("text"))
    return df.select((F.lit("run") if report is None else report).alias("report"), place.alias("place"), line.alias("line"))


def _texts(df: DataFrame, section: int, texts: list, report: Column | None = None) -> DataFrame:
    """Lines that stand once in each row's report."""
    told = F.array(*[t if isinstance(t, Column) else F.lit(t) for t in texts])
    kept = df.select((F.lit("run") if report is None else report).alias("_report"), F.posexplode(told).alias("_n", "_line"))
    return lines(kept, section, F.col("_line"), [F.col("_n")], F.col("_report"))


def _labelled(label: str, value: Column) -> Column:
    return F.concat(F.lit(label), F.coalesce(value.cast("string"), F.lit("")))


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def stage1_lines(sources: DataFrame, totals: DataFrame, run_id: str, generated_at: str) -> DataFrame:
    """Lines of the report on a crawl log's sources and totals (see sources.crawl_log)."""
    bad = unsuccessful(sources)
    whole = totals.join(F.broadcast(bad.agg(F.count("*").alias("n_bad"))))
    categories = failure_counts(bad)
    at = [F.col("index"), F.col("id")]
    head = [
        "# Stage 1 Source Performance Report", "", f"Run: {run_id}", f"Generated at: {generated_at}", "", "## Totals", "",
        _labelled("- Attempted sources: ", F.col("attempted")), _labelled("- Successful sources: ", F.col("successful")), _labelled("- Unsuccessful sources: ", F.col("n_bad")),
        _labelled("- Blocked sources: ", F.col("blocked")), _labelled("- Successful with no upcoming events: ", F.col("no_upcoming")), _labelled("- Stage 1 events total: ", F.col("events")),
        _labelled("- Seeded events: ", F.col("existing")), _labelled("- New events: ", F.col("new")), "",
        "## Number of Events per Source", "", "| # | Source ID | Source Name | Events Found | Success |", "|---:|---|---|---:|---|",
    ]
    return _union(
        [
            _texts(whole, 0, head),
            lines(sources, 1, table_row(*[cell(F.col(c)) for c in ("index", "id", "name", "events", "success")]), at),
            _texts(whole, 2, ["", F.concat(F.lit("## Unsuccessful Sources ("), F.col("n_bad").cast("string"), F.lit(")")), "", "| # | Source ID | Source Name | Failure Category | Statuses Seen |", "|---:|---|---|---|---|"]),
            lines(bad, 3, table_row(*[cell(F.col(c)) for c in ("index", "id", "name", "category")], cell(F.array_join("statuses", ", "))), at),
            _texts(whole, 4, ["", "## Failure Categories", "", "| Category | Sources |", "|---|---:|"]),
            lines(categories, 5, table_row(cell(F.col("category")), cell(F.col("n"))), [-F.col("n"), F.col("category")]),
            _texts(whole, 6, ["", "## Failure Category Explanations", ""]),
            lines(categories, 7, F.concat(F.lit("- "), F.col("category"), F.lit(": "), explanation(F.col("category"))), [-F.col("n"), F.col("category")]),
        ]
    )


def run_lines(metrics: DataFrame, failures: DataFrame, run_id: str, run_date: str, generated_at: str) -> DataFrame:
    """Lines of the report on a run: metrics (source_id, source_name, pos, ...), failures (source_id, category, url, message, pos)."""
    total = metrics.agg(F.coalesce(F.sum("unique_events"), F.lit(0)).alias("e"), F.coalesce(F.sum("failures"), F.lit(0)).alias("f"))
    whole = total.join(F.broadcast(failures.agg(F.count("*").alias("n_bad"))))
    some, none = whole.where("n_bad > 0"), whole.where("n_bad = 0")
    bold = lambda c: F.concat(F.lit("**"), F.col(c).cast("string"), F.lit("**"))
    by_source = failure_matrix(failures)
    head = [f"# Run Summary: {run_id}", "", f"**Run date:** {run_date}  ", f"**Generated at:** {generated_at}", "", "## Source Metrics", "", "| Source | Events | Pages visited | Failures | Duration (ms) |", "|--------|-------:|-------------:|---------:|--------------:|"]
    return _union(
        [
            _texts(whole, 0, head),
            lines(metrics, 1, table_row(*[cell(F.col(c)) for c in ("source_name", "unique_events", "visited_pages", "failures", "duration_ms")]), [F.col("pos"), F.col("source_id")]),
            _texts(whole, 2, [F.concat(F.lit("| **TOTAL** | "), bold("e"), F.lit(" | | "), bold("f"), F.lit(" | |")), "", "## Failures", ""]),
            _texts(none, 3, ["No failures recorded."]),
            _texts(some, 3, ["### By Category", "", "| Category | Count | Description |", "|----------|------:|-------------|"]),
            lines(failure_counts(failures), 4, table_row(cell(F.col("category")), cell(F.col("n")), explanation(F.col("category"))), [F.lit(0), F.col("category")]),
            _texts(some, 5, ["", "### By Source", "", "| Source | Category | Count |", "|--------|----------|------:|"]),
            lines(by_source, 6, table_row(*[cell(F.col(c)) for c in ("source_id", "category", "n")]), [F.lit(0), F.col("source_id"), F.col("category")]),
            _texts(some, 7, ["", "### Failure Details", "", "| Source | Category | URL | Message |", "|--------|----------|-----|---------|"]),
            lines(failures, 8, table_row(*[cell(F.col(c)) for c in ("source_id", "category", "url", "message")]), [F.col("pos"), F.col("source_id")]),
            _texts(some, 9, [""]),
        ]
    )


def source_lines(metrics: DataFrame, failures: DataFrame, run_id: str, run_date: str) -> DataFrame:
    """Lines of one report a source, named by its id; failures of sources without metrics are in none."""
    ident = F.col("source_id")
    failures = failures.join(metrics.select("source_id"), "source_id", "left_semi")
    counts = failure_matrix(failures)
    bad = failures.select("source_id").distinct()
    some, none = metrics.join(bad, "source_id", "left_semi"), metrics.join(bad, "source_id", "left_anti")
    head = [
        _labelled("# Source Report: ", F.col("source_name")), "", F.concat(_labelled("**Source ID:** ", ident), F.lit("  ")), F.concat(_labelled("**Source type:** ", F.col("source_type")), F.lit("  ")), f"**Run ID:** {run_id}  ", f"**Run date:** {run_date}", "",
        "## Stats", "", _labelled("- **Unique events found:** ", F.col("unique_events")), _labelled("- **Pages visited:** ", F.col("visited_pages")), F.concat(_labelled("- **Duration:** ", F.col("duration_ms")), F.lit(" ms")), "", "## Failures", "",
    ]
    return _union(
        [
            _texts(metrics, 0, head, ident),
            _texts(none, 1, ["No failures."], ident),
            _texts(some, 1, ["| Category | Count | Description |", "|----------|------:|-------------|"], ident),
            lines(counts, 2, table_row(cell(F.col("category")), cell(F.col("n")), explanation(F.col("category"))), [F.lit(0), F.col("category")], ident),
            _texts(some, 3, ["", "### Failure Details", "", "| Category | URL | Message |", "|----------|-----|---------|"], ident),
            lines(failures, 4, table_row(*[cell(F.col(c)) for c in ("category", "url", "message")]), [F.col("pos")], ident),
            _texts(some, 5, [""], ident),
        ]
    )
