"""Filters and projections of sources, pages and events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from almanac.functions import dates as dt
from almanac.functions import fixed, urls
from almanac.functions import text as tx


def active_strict(sources: DataFrame) -> DataFrame:
    """active is the boolean true (a text that says so has its quotes)."""
    return sources.where(F.col("active") == "true")


def active_lenient(sources: DataFrame) -> DataFrame:
    """active is true, or a text that says so."""
    bare = F.regexp_replace(F.col("active").cast("string"), '^"|"$', "")
    return sources.where(F.lower(tx.strip(bare)) == "true")


def is_social(kind: Column, homepage: Column, listings: Column) -> Column:
    """The type names a social network or forum, or a URL's host holds one's name."""
    kind = F.lower(F.coalesce(kind, F.lit("")))
    all_urls = F.array_compact(F.concat(F.coalesce(listings, F.array().cast("array<string>")), F.array(homepage)))
    on_host = F.exists(F.transform(all_urls, urls.host), lambda h: F.coalesce(tx.has_any(h, fixed.SOCIAL_HOSTS), F.lit(False)))
    return F.contains(kind, F.lit("social")) | F.contains(kind, F.lit("forum")) | on_host


def is_social_type(kind: Column) -> Column:
    return F.contains(F.lower(F.coalesce(kind, F.lit(""))), F.lit("social"))


def well_formed(sources: DataFrame) -> DataFrame:
    """With an id, a name and a URL at least."""
    has_url = ~tx.is_blank(F.col("homepage_url")) | (F.size(F.coalesce("event_listing_urls", F.array().cast("array<string>"))) > 0)
    return sources.where(~tx.is_blank(F.col("id")) & ~tx.is_blank(F.col("name")) & has_url)


def listed(sources: DataFrame, wanted: DataFrame) -> DataFrame:
    """Sources whose id is wanted."""
    return sources.join(wanted.select("id"), "id", "left_semi")


def blocked_body(body: Column, tokens: list[str]) -> Column:
    """Empty, or with a sign of a blocked page."""
    body = F.coalesce(body, F.lit(""))
    return (body == "") | tx.has_token(body, tokens)


def blocked_status(status: Column) -> Column:
    return status.isin(fixed.BLOCKED_CODES)


def succeeded(status: Column) -> Column:
    return status.between(200, 399)


def failure_category(status: Column, error: Column) -> Column:
    """Category of a fetch: by exception first, then by status; null if it went well."""
    by_error = (
        F.when(error == "IllegalArgumentException", "INVALID_SOURCE")
        .when(error.isin("HttpTimeoutException", "HttpConnectTimeoutException", "InterruptedException"), "TIMEOUT")
        .when(error.isin("IOException", "ConnectException"), "FETCH_ERROR")
        .when(error.isin("UnsupportedMimeTypeException", "UncheckedIOException"), "PARSE_ERROR")
        .when(error.isNotNull(), "UNKNOWN")
    )
    return F.coalesce(by_error, F.when(status == 403, "ACCESS_DENIED").when(status >= 400, "FETCH_ERROR"))


def link_candidate(inner: Column, href: Column, start: Column) -> Column:
    """No veto word anywhere, and a hint word or a date of the window.

    What the words are sought in is the link's text, markup and target. A word of the text stands in the markup
    too, as cleaning puts only spaces and quotes in; so the text is made for links that a date must decide.
    """

    def told(joined: Column) -> Column:
        dated = tx.once(tx.clean_html(inner), lambda x: dt.first_v15(x, start).isNotNull())
        return ~tx.has_any(joined, fixed.LINK_VETOES) & (tx.has_any(joined, fixed.LINK_HINTS) | dated)

    return tx.once(F.lower(F.concat_ws(" ", inner, href)), told)


def hopeful_chunk(chunk: Column, year: int = 2026) -> Column:
    """Long enough, and with the year or something like a date."""
    return (F.length(chunk) >= 8) & chunk.rlike(rf"({year}|\d{{1,2}}\.\d{{1,2}}\.?)")


def seed_urls_v1(homepage: Column, listings: Column) -> Column:
    """Listings, then the fallback paths of the homepage's host; each once."""
    paths = F.array(*[F.lit(p) for p in fixed.FALLBACK_PATHS])
    fallback = F.when(urls.is_http(homepage), F.transform(paths, lambda p: F.concat(urls.origin(homepage), p)))
    none = F.array().cast("array<string>")
    return F.array_union(F.array_compact(F.coalesce(listings, none)), F.coalesce(fallback, none))


def seed_urls_v15(homepage: Column, listings: Column) -> Column:
    """Listings, then the homepage; each once."""
    return F.array_distinct(F.array_compact(F.concat(F.coalesce(listings, F.array().cast("array<string>")), F.array(homepage))))


def seed_urls_v2(homepage: Column, listings: Column) -> Column:
    """Listings, or the homepage if there are none."""
    listings = F.coalesce(listings, F.array().cast("array<string>"))
    return F.when(F.size(listings) == 0, F.array(homepage)).otherwise(listings)


def categories_of(tags: Column, known: Column) -> Column:
    """A source's tags that are known categories, in their order; else ``mixed``."""
    mapped = F.array_intersect(F.coalesce(tags, F.array().cast("array<string>")), known)
    return F.when(F.size(mapped) == 0, F.array(F.lit("mixed"))).otherwise(mapped)


def event_id(day: Column, venue_slug: Column, title_slug: Column) -> Column:
    return F.concat(F.lit("evt_"), F.date_format(day, "yyyyMMdd"), F.lit("_"), venue_slug, F.lit("_"), title_slug)


def event_v1(day: Column, source_name: Column, source_id: Column, url: Column, line: Column) -> list[Column]:
    """Event of a line of text."""
    title = F.coalesce(F.nullif(tx.cut(tx.strip(tx.squeeze(line)), 140), F.lit("")), F.concat(source_name, F.lit(" event")))
    note = F.concat(F.lit("Candidate event extracted from source "), source_id, F.lit("; date/title may require verification."))
    return _event(event_id(day, tx.slug(source_name), tx.slug(title)), title, day, source_name, F.array(F.lit("mixed")), url, F.lit("low"), note)


def event_v15(day: Column, source_name: Column, url: Column, title: Column, venue: Column, categories: Column, description: Column, confidence: Column) -> list[Column]:
    """Event of a block or an embedded object; slugs come from the uncut texts."""
    title, venue = tx.default(tx.squeeze(title), source_name), tx.default(venue, source_name)
    note = tx.cut(tx.strip(F.coalesce(description, F.lit(""))), 280)
    return _event(event_id(day, tx.slug(venue), tx.slug(title)), tx.cut(title, 180), day, tx.cut(venue, 120), categories, url, confidence, note)


def event_v2(day: Column, source_id: Column, source_name: Column, url: Column, title: Column) -> list[Column]:
    """Event of an element; its id holds the source's id."""
    note = F.lit("Auto-extracted from page content without URL/path assumptions")
    return _event(event_id(day, tx.slug_plain(source_id), tx.slug_plain(title)), title, day, source_name, F.array(F.lit("mixed")), url, F.lit("low"), note)


def _event(ident: Column, title: Column, day: Column, venue: Column, categories: Column, url: Column, confidence: Column, note: Column) -> list[Column]:
    return [
        ident.alias("id"), title.alias("title"), F.date_format(day, "yyyy-MM-dd").alias("date"), venue.alias("venue_name"), F.lit(fixed.CITY).alias("venue_city"),
        categories.alias("categories"), F.array(url).alias("source_urls"), F.lit("upcoming").alias("status"), confidence.alias("confidence"), note.alias("description"),
    ]
