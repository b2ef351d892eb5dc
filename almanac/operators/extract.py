"""Whole extractors: from pages to events and to the links worth a visit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from almanac.functions import dates as dt
from almanac.functions import fixed, html, urls
from almanac.functions import text as tx
from almanac.operators import predicates, windows

MOST_CHUNKS, MOST_HITS, MOST_LINKS = 4000, 15, 15


def text_events(pages: DataFrame, start: Column, days: int = fixed.WINDOW_DAYS, year: int = 2026) -> DataFrame:
    """Events of pages (source_id, source_name, url, html) from their running text, with url and seq.

    A page's text is cut into sentences, the first MOST_CHUNKS of them; each date of the window
    in one that may hold a date is an event, MOST_HITS a page at most. Rows of one
    (source_id, url) are one page each only if they differ in nothing else; repeated pages share the cap.
    """
    chunks = F.slice(tx.sentences(tx.clean_html(F.coalesce("html", F.lit("")))), 1, MOST_CHUNKS)
    c = pages.select("source_id", "source_name", "url", F.posexplode(chunks).alias("chunk_at", "chunk")).where(predicates.hopeful_chunk(F.col("chunk"), year))
    d = c.select("*", F.posexplode(dt.candidates_v1(F.col("chunk"), year)).alias("date_at", "day")).where(dt.in_window(F.col("day"), start, days))
    hits = windows.cap(d, ["source_id", "url"], ["chunk_at", "date_at"], MOST_HITS)
    return hits.select("source_id", "url", F.struct("chunk_at", "date_at").alias("seq"), *predicates.event_v1(F.col("day"), F.col("source_name"), F.col("source_id"), F.col("url"), F.col("chunk")))


def candidates(page_html: Column, url: Column, start: Column) -> Column:
    """Links of a page that look like events and are of its origin, each once, in order."""
    parts = F.struct(urls.base_parts(url).alias("base"), urls.origin(url).alias("origin"))

    def wanted(a: Column, page: Column) -> Column:
        return F.coalesce(F.startswith(a["link"], page["origin"]) & predicates.link_candidate(a["inner"], a["link"], start), F.lit(False))

    def of(page: Column) -> Column:
        found = F.transform(html.links(page_html), lambda a: F.struct(urls.resolve_by(a["href"], page["base"]).alias("link"), a["inner"].alias("inner")))
        return F.array_distinct(F.transform(F.filter(found, lambda a: wanted(a, page)), lambda a: a["link"]))

    # what the page alone decides is made once for all its links
    return tx.let(parts, of)


def event_links(page_html: Column, url: Column, start: Column, most: int = MOST_LINKS) -> Column:
    """The first candidates of a page, without the page itself."""
    return F.slice(F.filter(candidates(page_html, url, start), lambda x: x != url), 1, most)
