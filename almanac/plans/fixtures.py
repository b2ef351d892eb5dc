"""Queries on rows written out here, each with the rows it must give.

They show edge cases; ``tables`` and ``derived`` have the operators over whole
tables. The SQL of such a query is its expected result, which DuckDB repeats.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from almanac.functions import dates as dt
from almanac.functions import fixed, html, jsonld, rank, urls
from almanac.functions import text as tx
from almanac.operators import graph, merge, predicates, quality, report, windows
from almanac.sources import documents

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def _literal(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "true" if v else "false"
    return str(v) if isinstance(v, (int, float)) else "'" + v.replace("'", "''") + "'"


def table(spark: SparkSession, columns: str, rows: list[tuple]) -> DataFrame:
    """Rows as a frame; columns are ``name type, ...``."""
    return spark.createDataFrame(rows, columns)


def fixture(columns: str, rows: list[tuple], gives: str, expected: list[tuple] | None):
    """Registers f(frame) under its name; ``gives`` names the columns of the expected rows with DuckDB's types."""

    def put(f):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(table(spark, columns, rows))

        run.__doc__, run.__name__ = f.__doc__, f.__name__
        QUERIES[f.__name__] = run
        if expected is not None:
            cols = [c.split() for c in gives.split(", ")]
            values = ", ".join("(" + ", ".join(map(_literal, r)) + ")" for r in expected)
            ORACLE_SQL[f.__name__] = f"SELECT {', '.join(f'CAST({n} AS {t}) AS {n}' for n, t in cols)} FROM (VALUES {values}) AS t({', '.join(n for n, _ in cols)})"
        return f

    return put


def _list(name: str):
    """A column of ``|``-separated text as an array; empty text is an empty one."""
    return F.when(F.col(name) == "", F.array().cast("array<string>")).otherwise(F.split(name, r"\|"))


def _join(c):
    return F.array_join(c, "|")


def _days(c):
    return F.array_join(F.transform(c, lambda d: F.date_format(d, "yyyy-MM-dd")), "|")


_TEXTS = [
    (1, "Start 2026-03-20, end 2026/4/2."),
    (2, "Am 5.4.2026 und 6.4. sowie 2026-05-01"),
    (3, "31.2. und 31.2.2026 gibt es nicht"),
    (4, "12 marec o 19:00, 3 may 2026"),
    (5, "20 máj 2026"),
    (6, "15.3.x aber 15.3.7"),
    (7, "2025-12-31 2026-03-15 2026-06-13 2026-06-14"),
    (8, "7 juli 2026"),
    (9, "nothing here"),
]
_START = "2026-03-15"


@fixture("id long, text string", _TEXTS, "id BIGINT, days VARCHAR", [
    (1, "2026-03-20|2026-04-02"), (2, "2026-05-01|2026-04-05|2026-04-06"), (3, ""), (4, "2026-05-03"), (5, ""), (6, "2026-03-15"), (7, "2026-03-15|2026-06-13"), (8, ""), (9, ""),
])
def date_candidates_fixture(t):
    """All patterns in the window of 90 days from 2026-03-15."""
    return t.select("id", _days(dt.candidates_v15(F.col("text"), F.lit(_START).cast("date"))).alias("days"))


@fixture("id long, text string", _TEXTS, "id BIGINT, days VARCHAR", [
    (1, "2026-03-20|2026-04-02"), (2, "2026-05-01|2026-04-05|2026-04-06"), (3, ""), (4, "2026-05-03"), (5, ""), (6, "2026-03-15"), (7, "2026-03-15|2026-06-13|2026-06-14"), (8, "2026-07-07"), (9, ""),
])
def date_candidates_v1(t):
    """The first extractor's patterns of its one year."""
    return t.select("id", _days(dt.candidates_v1(F.col("text"))).alias("days"))


@fixture("id long, name string", [(1, "MAREC"), (2, "Januára"), (3, "oktobra"), (4, "juli"), (5, "máj"), (6, "x")], "id BIGINT, v1 INTEGER, v15 INTEGER", [
    (1, 3, 3), (2, None, None), (3, 10, 10), (4, 7, None), (5, None, None), (6, None, None),
])
def month_names(t):
    return t.select("id", dt.month_number(F.col("name"), fixed.MONTHS_V1).alias("v1"), dt.month_number(F.col("name"), fixed.MONTHS_V15).alias("v15"))


@fixture("id long, start string, text string", [(1, "2026-11-20", "5.1. a 30.11."), (2, "2026-03-15", "5.1."), (3, "2026-11-20", "3 januar und 4 januar 2026"), (4, "2026-12-01", "29.2.")], "id BIGINT, days VARCHAR", [
    (1, "2027-01-05|2026-11-30"), (2, ""), (3, "2027-01-03"), (4, ""),
])
def year_rollover(t):
    """A date without a year falls into the next one only if the window crosses New Year."""
    return t.select("id", _days(dt.candidates_v15(F.col("text"), F.to_date("start"))).alias("days"))


@fixture("id long, text string", [(1, "am 31.2.2026"), (2, "2026-02-30"), (3, "30.4.2026 und 1.5.2026"), (4, "31.4.2026"), (5, "32.1.2026"), (6, "1.13.2026"), (7, "x")], "id BIGINT, day VARCHAR", [
    (1, "2026-02-28"), (2, None), (3, "2026-04-30"), (4, "2026-04-30"), (5, None), (6, None), (7, None),
])
def date_smart_clamp(t):
    return t.select("id", F.date_format(dt.lenient(dt.first_token(F.col("text"))), "yyyy-MM-dd").alias("day"))


@fixture("id long, text string", [(1, "Jazz 1.5.2026  Nacht 1.5.2026"), (2, "ab 1.5.2026"), (3, "abcd 2026-05-01"), (4, "kein Datum"), (5, "Rock 2026-02-30")], "id BIGINT, title VARCHAR, day VARCHAR", [
    (1, "Jazz Nacht", "2026-05-01"), (3, "abcd", "2026-05-01"),
])
def date_removed_title(t):
    """Events of texts: the first date, and the text without it, of four characters or more."""
    tok = dt.first_token(F.col("text"))
    title = F.trim(tx.squeeze(F.replace("text", tok, F.lit(""))))
    rows = t.select("id", title.alias("title"), F.date_format(dt.lenient(tok), "yyyy-MM-dd").alias("day"))
    return rows.where("day IS NOT NULL AND length(title) >= 4")


@fixture("id long, text string", [(1, "2026-01-31"), (2, "2026-02-30"), (3, ""), (4, None), (5, "x")], "id BIGINT, past BOOLEAN", [(1, True), (2, False), (3, False), (4, False), (5, False)])
def lenient_date(t):
    """A date that cannot be read is not past."""
    return t.select("id", F.coalesce(dt.parse_or_null(F.col("text")) < F.lit("2026-03-01").cast("date"), F.lit(False)).alias("past"))


@fixture("id long, run string", [(1, "2026-03-15_210847"), (2, "2026-03-15"), (3, "rapid5")], "id BIGINT, day VARCHAR", [(1, "2026-03-15"), (2, "2026-03-15"), (3, None)])
def run_date_from_id(t):
    return t.select("id", F.date_format(dt.run_date(F.col("run")), "yyyy-MM-dd").alias("day"))


@fixture("id long, a string, b string", [(1, "2026-03-15 10:00:00", "2026-03-15 10:00:01.5"), (2, "2026-03-15 23:59:59", "2026-03-16 00:00:00")], "id BIGINT, ms BIGINT", [(1, 1500), (2, 1000)])
def elapsed_ms(t):
    return t.select("id", (F.unix_millis(F.to_timestamp("b")) - F.unix_millis(F.to_timestamp("a"))).alias("ms"))


_URLS = [
    (1, "HTTP://WWW.Example.com:80/Path/?q=1#x"), (2, "https://example.com/"), (3, "example.com/A?b"), (4, " https://e.com/a//  "), (5, None), (6, "  "), (7, "https://e.com/ä/"), (8, "mailto:a@b.c"), (9, "http://u:p@e.com/x"),
]


@fixture("id long, url string", _URLS, "id BIGINT, norm VARCHAR", [
    (1, "http://www.example.com/Path"), (2, "https://example.com"), (3, "example.com/a"), (4, "https://e.com/a"), (5, None), (6, None), (7, "https://e.com/ä"), (8, "mailto:a@b.c"), (9, "http://e.com/x"),
])
def url_identity(t):
    return t.select("id", urls.identity(F.col("url")).alias("norm"))


@fixture("id long, href string, base string", [(1, "/a", "http://h/x/y"), (2, "b", "http://h/x/y"), (3, "//k/z", "https://h/x"), (4, "?q=1", "http://h/x/y"), (5, "http://o/", "http://h/"), (6, "../c", "http://h/x/y/z"), (7, None, "http://h/")], "id BIGINT, url VARCHAR", [
    (1, "http://h/a"), (2, "http://h/x/b"), (3, "https://k/z"), (4, "http://h/x/y?q=1"), (5, "http://o/"), (6, "http://h/x/c"), (7, None),
])
def url_resolve(t):
    return t.select("id", urls.resolve("href", "base").alias("url"))


_SOURCES = [
    # id, name, homepage, listings, type, active
    ("s1", "One", "https://one.sk/", "https://one.sk/events|https://one.sk/program", "venue", "true"),
    ("s2", "Two", "https://facebook.com/two", "", "venue", "true"),
    ("s3", "Three", "https://three.sk", "", "Social media", "true"),
    ("s4", "Four", "https://four.sk", "https://netflix.com/x", "portal", "true"),
    ("s5", "Five", "https://five.sk", "", "forum", '"TRUE"'),
    ("s6", "Six", "https://six.sk", "", "venue", "false"),
    ("s7", "", "https://seven.sk", "", "venue", "true"),
    ("s8", "Eight", None, "", "venue", "true"),
    ("s9", "Nine", "not a url", "", "venue", None),
]
_SOURCE_COLUMNS = "id string, name string, homepage_url string, listings string, source_type string, active string"


def _sources(t: DataFrame) -> DataFrame:
    return t.withColumn("event_listing_urls", _list("listings"))


@fixture(_SOURCE_COLUMNS, _SOURCES, "id VARCHAR", [(x,) for x in ("s1", "s2", "s3", "s4", "s7", "s8")])
def source_filters_v1(t):
    return predicates.active_strict(t).select("id")


@fixture(_SOURCE_COLUMNS, _SOURCES, "id VARCHAR", [(x,) for x in ("s1", "s7", "s8")])
def source_filters_v15(t):
    """A host is social if it holds a network's name anywhere, as netflix.com does."""
    s = predicates.active_strict(_sources(t))
    return s.where(~predicates.is_social(F.col("source_type"), F.col("homepage_url"), F.col("event_listing_urls"))).select("id")


@fixture(_SOURCE_COLUMNS, _SOURCES, "id VARCHAR", [(x,) for x in ("s1", "s2", "s4", "s5")])
def source_filters_v2(t):
    s = predicates.well_formed(predicates.active_lenient(_sources(t)))
    return s.where(~predicates.is_social_type(F.col("source_type"))).select("id")


@fixture(_SOURCE_COLUMNS, _SOURCES, "id VARCHAR", [("s2",), ("s9",)])
def source_allowlist(t):
    wanted = t.select("id").where(F.col("id").isin("s2", "s9", "zz"))
    return t.join(wanted, "id", "left_semi").select("id")


@fixture(_SOURCE_COLUMNS, _SOURCES, "id VARCHAR, n BIGINT, first_url VARCHAR", [
    ("s1", 14, "https://one.sk/events"), ("s2", 14, "https://facebook.com/events"), ("s3", 14, "https://three.sk/events"), ("s4", 15, "https://netflix.com/x"), ("s5", 14, "https://five.sk/events"),
    ("s6", 14, "https://six.sk/events"), ("s7", 14, "https://seven.sk/events"), ("s8", 0, None), ("s9", 0, None),
])
def seed_urls_v1(t):
    """Listings and fallback paths, each once: s1's listings are among its paths."""
    u = predicates.seed_urls_v1(F.col("homepage_url"), F.col("event_listing_urls"))
    return _sources(t).select("id", F.size(u).cast("long").alias("n"), F.get(u, F.lit(0)).alias("first_url"))


@fixture(_SOURCE_COLUMNS, _SOURCES[:3] + _SOURCES[7:8], "id VARCHAR, u15 VARCHAR, u2 VARCHAR", [
    ("s1", "https://one.sk/events|https://one.sk/program|https://one.sk/", "https://one.sk/events|https://one.sk/program"), ("s2", "https://facebook.com/two", "https://facebook.com/two"),
    ("s3", "https://three.sk", "https://three.sk"), ("s8", "", ""),
])
def seed_urls_v15(t):
    s, h, u = _sources(t), F.col("homepage_url"), F.col("event_listing_urls")
    return s.select("id", _join(predicates.seed_urls_v15(h, u)).alias("u15"), _join(predicates.seed_urls_v2(h, u)).alias("u2"))


@fixture("id long, tags string", [(1, "rock|jazz|rock|scene"), (2, "scene"), (3, ""), (4, "jazz")], "id BIGINT, categories VARCHAR", [(1, "rock|jazz"), (2, "mixed"), (3, "mixed"), (4, "jazz")])
def tag_intersect_default(t):
    known = F.array(F.lit("jazz"), F.lit("rock"), F.lit("mixed"))
    return t.select("id", _join(predicates.categories_of(_list("tags"), known)).alias("categories"))


@fixture("id long, a string, b string", [(1, "x|y", "y|z|x|w"), (2, "", "q|q"), (3, "p|p", "")], "id BIGINT, u VARCHAR", [(1, "x|y|z|w"), (2, "q"), (3, "p")])
def array_union_order(t):
    return t.select("id", _join(F.array_union(_list("a"), _list("b"))).alias("u"))


@fixture("id long, raw string", [(1, '{"f": "a"}'), (2, '{"f": ["a", null, "b"]}'), (3, '{"f": null}'), (4, "{}"), (5, '{"f": []}'), (6, '{"f": 7}')], "id BIGINT, l VARCHAR, n BIGINT", [
    (1, "a", 1), (2, "a|b", 2), (3, "", 0), (4, "", 0), (5, "", 0), (6, "7", 1),
])
def array_coerce(t):
    v = documents.list_of(F.col("raw"), "f")
    return t.select("id", _join(v).alias("l"), F.size(v).cast("long").alias("n"))


_EVENTS_RAW = [
    (1, '{"id":"a","title":"t","date":"2026-03-20","venue_name":"v","venue_city":"c","categories":["x"],"source_urls":["u"],"status":"upcoming","confidence":"low"}'),
    (2, '{"id":"a","title":null,"date":"2026-3-20","venue_name":"v","venue_city":"c","categories":[],"source_urls":"u","status":"done","confidence":"low"}'),
    (3, '{"id":"a"}'),
    (4, '[1]'),
]


@fixture("id long, raw string", _EVENTS_RAW, "id BIGINT, errors VARCHAR", [
    (1, ""), (2, "invalid status|invalid date|no categories|no source_urls"),
    (3, "missing: title,date,venue_name,venue_city,categories,source_urls,status,confidence|invalid status|invalid confidence|invalid date|no categories|no source_urls"), (4, "not a mapping"),
])
def dq_events(t):
    """A null title is present; an absent one is not."""
    return t.select("id", _join(quality.event_errors(F.col("raw"))).alias("errors"))


@fixture("id long, raw string, required string", [(1, '{"a":1,"b":null}', "a|b|c"), (2, '{"a":1}', ""), (3, '{"id":1,"name":2}', "")], "id BIGINT, missing VARCHAR", [(1, "c"), (2, "id|name"), (3, "")])
def dq_required_dynamic(t):
    return t.select("id", _join(quality.missing_fields(F.col("raw"), _list("required"), ["id", "name"])).alias("missing"))


@fixture("id long, raw string, stage string, run_date string", [(1, '{"pipeline_stage":2,"run_date":"2026-03-15","events":[]}', "2", "2026-03-15"), (2, '{"pipeline_stage":1,"run_date":"x"}', "2", "2026-03-15"), (3, "[]", "2", "x")], "id BIGINT, errors VARCHAR", [
    (1, ""), (2, "wrong stage|wrong run_date|events is not a list"), (3, "root is not a mapping|wrong stage|wrong run_date|events is not a list"),
])
def dq_envelope(t):
    return quality.envelope_errors(t).select("id", _join("errors").alias("errors"))


_LD = [
    (1, '<script type="application/ld+json">{"@type":"Event","name":"A","startDate":"2026-04-01","location":{"name":"Hall"},"url":"http://x/a"}</script>'),
    (2, "<script type='application/ld+json'>{\"@graph\":[{\"@type\":[\"Thing\",\"EVENT\"],\"name\":\"B\",\"startDate\":\"2026-04-02\",\"location\":\"Street\"}],\"x\":{\"@type\":\"Event\",\"name\":\"no\"}}</script>"),
    (3, '<script type="application/ld+json">{"@type":"MusicEvent","name":"C","startDate":"2026-04-03"}</script>'),
    (4, '<script type="application/ld+json">{bad json</script><script type="application/ld+json">[{"sub":{"@type":"event","name":"D","startDate":"2026-04-04"}}]</script>'),
    (5, '<script type="application/ld+json">{"@type":"Event","name":" ","startDate":"2026-04-05"}</script>'),
]


@fixture("id long, html string", _LD, "id BIGINT, n BIGINT", [(1, 1), (2, 1), (3, 1), (4, 2), (5, 1)])
def jsonld_blobs(t):
    return t.select("id", F.size(html.json_ld_blobs(F.col("html"))).cast("long").alias("n"))


def _ld_events(t: DataFrame) -> DataFrame:
    blobs = t.select("id", F.explode(html.json_ld_blobs(F.col("html"))).alias("blob")).select("id", F.explode(jsonld.events("blob")).alias("e"))
    day = F.get(dt.candidates_v15(F.col("e.start"), F.lit(_START).cast("date")), F.lit(0))
    return blobs.where(~tx.is_blank(F.col("e.name"))).select("id", "e", day.alias("day")).where("day IS NOT NULL")


@fixture("id long, html string", _LD, "id BIGINT, event VARCHAR, venue VARCHAR, url VARCHAR", [
    (1, "evt_20260401_hall_a", "Hall", "http://x/a"), (2, "evt_20260402_src_b", "Src", "http://page"), (4, "evt_20260404_src_d", "Src", "http://page"),
])
def jsonld_events(t):
    rows = _ld_events(t)
    cols = predicates.event_v15(F.col("day"), F.lit("Src"), F.coalesce(F.nullif("e.url", F.lit("")), F.lit("http://page")), F.col("e.name"), F.coalesce("e.place", F.lit("")), F.array(F.lit("mixed")), F.col("e.description"), F.lit("high"))
    e = rows.select("id", F.struct(*cols).alias("x"))
    return e.select("id", F.col("x.id").alias("event"), F.col("x.venue_name").alias("venue"), F.element_at("x.source_urls", 1).alias("url"))


_BLOCKS = [
    (1, "<article><h2>A</h2>1.4.2026</article><article><h3>B</h3></article><article><b>x</b><a href='/c'>C</a> 2026-04-03</article>"),
    (2, "<article><h2>A</h2>1.4.2026</article><li class='item'><strong>L</strong> 2.4.2026</li><li class='nav'>n</li><section class=\"event\"><h1> </h1><h2>S</h2> 3.4.2026</section>"),
    (3, "<div class='x card'>D 4.4.2026</div>"),
    (4, "<p>nothing</p>"),
    (5, "".join(f"<article><h2>T{i}</h2> 1.4.2026</article>" for i in range(35))),
    (6, "".join(f"<li class='card'>{i}</li>" for i in range(70))),
]


@fixture("id long, html string", _BLOCKS, "id BIGINT, n BIGINT", [(1, 3), (2, 3), (3, 1), (4, 0), (5, 35), (6, 60)])
def event_blocks(t):
    return t.select("id", F.size(html.blocks("html")).cast("long").alias("n"))


def _block_events(t: DataFrame) -> DataFrame:
    b = t.select("id", F.posexplode(html.blocks("html")).alias("pos", "block"))
    day = F.get(dt.candidates_v15(F.col("block"), F.lit(_START).cast("date")), F.lit(0))
    return b.select("id", "pos", html.heading(F.col("block")).alias("title"), day.alias("day")).where("day IS NOT NULL AND title IS NOT NULL")


@fixture("id long, html string", _BLOCKS[:4], "id BIGINT, title VARCHAR, day VARCHAR", [(1, "A", "2026-04-01"), (1, "C", "2026-04-03"), (2, "A", "2026-04-01"), (2, "S", "2026-04-02"), (2, "S", "2026-04-03")])
def block_events(t):
    """A list item's block runs on into the section, whose heading ranks higher."""
    return _block_events(t).select("id", "title", F.date_format("day", "yyyy-MM-dd").alias("day"))


@fixture("id long, html string", _BLOCKS, "id BIGINT, n BIGINT", [(1, 2), (2, 3), (5, 30)])
def block_cap(t):
    return windows.cap(_block_events(t), ["id"], ["pos"], html.MOST_EVENTS).groupBy("id").agg(F.count("*").alias("n"))


_CARDS = [
    (1, "<div class='big event'>Jazz 1.5.2026</div><div class='eventful'>no 2.5.2026</div><div itemtype='http://schema.org/MusicEvent'>Rock <b>x</b> 3.5.2026</div>"),
    (2, "<article>no date</article><p>Pop 4.5.2026</p><li>abc</li><h2>Folk 2026-05-05</h2><div>Skip 6.5.2026</div>"),
    (3, "<p>ok 1.5.2026</p>"),
]


def _v2_texts(t: DataFrame, picked) -> DataFrame:
    c = t.select("id", F.posexplode(picked).alias("pos", "text"))
    tok = dt.first_token(F.col("text"))
    title = F.trim(tx.squeeze(F.replace("text", tok, F.lit(""))))
    return c.select("id", "pos", title.alias("title"), dt.lenient(tok).alias("day")).where("day IS NOT NULL AND length(title) >= 4")


@fixture("id long, html string", _CARDS, "id BIGINT, title VARCHAR", [(1, "Jazz"), (1, "Rock x")])
def v2_cards(t):
    return _v2_texts(t, html.cards("html")).select("id", "title")


@fixture("id long, html string", _CARDS, "id BIGINT, title VARCHAR", [(1, "Jazz"), (1, "Rock x"), (2, "Folk")])
def v2_fallback(t):
    """Other elements count only on pages without an event in a card; a title has four characters."""
    first = _v2_texts(t, html.cards("html"))
    rest = _v2_texts(t, html.text_blocks("html")).join(first.select("id").distinct(), "id", "left_anti")
    return first.select("id", "title").unionByName(rest.select("id", "title"))


@fixture("id long, url string, home string", [(1, "http://a/x", "http://a/"), (2, "http://A/y", "http://a/"), (3, "http://b/", "http://a/"), (4, "mailto:x@y", "bad"), (5, "mailto:x@y", "http://a/")], "id BIGINT", [(1,), (2,), (4,)])
def v2_links(t):
    """Links of the homepage's host; two unknown hosts are the same."""
    return t.where(urls.host(F.col("url")).eqNullSafe(urls.host(F.col("home")))).select("id")


_SRC = "pos long, id string, name string, homepage_url string, listings string, genres string, confidence string, active string"
_KNOWN = [(0, "a", "A", "https://a.sk", "https://a.sk/e", "rock", "low", "true"), (1, "b", "", "https://b.sk", "", "", "high", None), (2, "c", "C", "https://shared.sk", "https://a.sk", "", "medium", "false")]
_NEW = [
    (0, "n0", "N", "https://new.sk", "https://a.sk/e/", "jazz", "high", "false"),
    (1, "n1", "B2", "https://b.sk/", "", "", "low", "true"),
    (2, "a", "Fresh", "https://fresh.sk", "https://fresh.sk/l", "", "low", "true"),
    (3, "n3", "Chain", "https://x.sk", "https://fresh.sk/l", "", "high", "true"),
    (4, "n4", "Late", "https://new.sk", "", "", "low", "true"),
    (5, "a", "Again", "https://again.sk", "", "", "low", "true"),
    (6, "c", "C2", "https://c2.sk", "", "", "low", "true"),
]


def _source_rows(spark, rows: list[tuple]) -> DataFrame:
    t = table(spark, _SRC, rows)
    none = F.lit(None).cast("string")
    t = t.withColumns({"event_listing_urls": _list("listings"), "genre_tags": _list("genres"), "source_type": none, "event_focus": none, "geo_coverage": none, "languages": F.array().cast("array<string>"), "access_type": none, "crawl_frequency": none, "robots_txt_checked": none})
    return t.drop("listings", "genres")


@fixture(_SRC, _NEW, "pos BIGINT, match BIGINT", [(0, 0), (1, 1)])
def source_match_urls(t):
    """Matches with known sources, before any of the new ones is known."""
    return merge.match_sources(_source_rows(t.sparkSession, _KNOWN), _source_rows(t.sparkSession, _NEW))


@fixture(_SRC, _NEW, "id VARCHAR, name VARCHAR, is_new BOOLEAN, listings VARCHAR, confidence VARCHAR, changes BIGINT", [
    ("a", "A", False, "https://a.sk/e|https://a.sk/e/", "high", 1), ("b", "B2", False, "", "high", 1), ("c", "C", False, "https://a.sk", "medium", 0),
    ("a_new", "Fresh", True, "https://fresh.sk/l", "high", 1), ("n4", "Late", True, "", "low", 0), ("a_new2", "Again", True, "", "low", 0), ("c_new", "C2", True, "", "low", 0),
])
def source_merge_urls(t):
    """A matched source does not lend its homepage, so its new URLs stay unknown unless listed."""
    m = merge.merge_sources(_source_rows(t.sparkSession, _KNOWN), _source_rows(t.sparkSession, _NEW))
    return m.select("id", "name", "is_new", _join("event_listing_urls").alias("listings"), "confidence", F.size("changes").cast("long").alias("changes"))


@fixture("pos long, id string, is_new boolean", [(0, "a", False), (1, "a_new", False), (2, "a", True), (3, "a", True), (4, "b", True), (5, "b", True)], "pos BIGINT, id VARCHAR", [(0, "a"), (1, "a_new"), (2, "a_new2"), (3, "a_new3"), (4, "b"), (5, "b_new")])
def id_collision_suffix(t):
    return merge.resolve_ids(t).select("pos", "id")


@fixture("id long, name string", [(1, "x"), (2, None)], "id BIGINT, name VARCHAR, n_urls BIGINT, active VARCHAR", [(1, "x", 0, None), (2, None, 0, None)])
def field_completion(t):
    full = merge.complete_fields(t, {"id": "long", "name": "string", "event_listing_urls": "array<string>", "active": "string"})
    return full.select("id", "name", F.size("event_listing_urls").cast("long").alias("n_urls"), "active")


@fixture("code string", [("FETCH_ERROR",), ("unknown_unreachable",), ("nope",)], "code VARCHAR, text VARCHAR", [("FETCH_ERROR", report.EXPLANATIONS["FETCH_ERROR"]), ("unknown_unreachable", report.EXPLANATIONS["unknown_unreachable"]), ("nope", "")])
def category_text_lookup(t):
    return t.select("code", report.explanation(F.col("code")).alias("text"))


@fixture("category_id string, grp string, label string", [("rock", "music", "Rock"), ("jazz", "music", "Jazz"), ("talk", "other", "Talk")], "grp VARCHAR, n BIGINT", [("music", 2), ("other", 1)])
def taxonomy_scan(t):
    return t.groupBy("grp").agg(F.count("*").alias("n"))


@fixture("id long, status int, error string, message string", [(1, 200, None, None), (2, 399, None, None), (3, 403, None, None), (4, 401, None, None), (5, 503, None, None), (6, None, "HttpTimeoutException", " "), (7, None, "IllegalArgumentException", "bad"), (8, None, "IOException", "x"), (9, None, "RuntimeException", None)], "id BIGINT, ok BOOLEAN, blocked BOOLEAN, category VARCHAR, text VARCHAR", [
    (1, True, False, None, None), (2, True, False, None, None), (3, False, True, "ACCESS_DENIED", None), (4, False, True, "FETCH_ERROR", None), (5, False, True, "FETCH_ERROR", None),
    (6, None, None, "TIMEOUT", "HttpTimeoutException: no message"), (7, None, None, "INVALID_SOURCE", "IllegalArgumentException: bad"), (8, None, None, "FETCH_ERROR", "IOException: x"), (9, None, None, "UNKNOWN", "RuntimeException: no message"),
])
def http_status_class(t):
    s, e = F.col("status"), F.col("error")
    text = F.when(e.isNotNull(), tx.error_text(e, F.col("message")))
    return t.select("id", predicates.succeeded(s).alias("ok"), predicates.blocked_status(s).alias("blocked"), predicates.failure_category(s, e).alias("category"), text.alias("text"))


@fixture("source_id string, status string, blocked boolean", [("a", "404", False), ("a", "error", False), ("b", "429", False), ("c", "404", True), ("d", "404", False), ("d", "404", False), ("d", "404", False), ("d", "404", False), ("d", "200", False), ("e", "404", False), ("e", "200", False)], "source_id VARCHAR, category VARCHAR", [
    ("a", "network_or_fetch_errors"), ("b", "access_blocked_or_rate_limited"), ("c", "access_blocked_or_rate_limited"), ("d", "missing_or_invalid_listing_paths"), ("e", "unknown_unreachable"),
])
def failure_classes(t):
    return report.classify_sources(t)


@fixture("id long, found long", [(1, 0), (2, 30), (3, 40), (4, 44)], "id BIGINT, budget BIGINT", [(1, 15), (2, 10), (3, 0), (4, 0)])
def spider_budget(t):
    return t.select("id", windows.spider_budget(F.col("found")).cast("long").alias("budget"))


@fixture("source string, page string, seq long, n long", [("s", "p1", 1, 20), ("s", "p2", 2, 19), ("s", "p3", 3, 5), ("s", "p4", 4, 1)], "page VARCHAR", [("p1",), ("p2",), ("p3",)])
def spider_two_level(t):
    """Detail pages are visited until forty events are found; the page that brings them counts."""
    return windows.stop_at_total(t, ["source"], ["seq"], F.col("n"), 40).select("page")


@fixture("source string, seq long, listing boolean, n long", [("a", 1, True, 0), ("a", 2, True, 3), ("a", 3, False, 9), ("b", 1, True, 0), ("b", 2, False, 4), ("c", 1, False, 1)], "source VARCHAR, seq BIGINT", [("a", 1), ("a", 2), ("b", 1), ("b", 2), ("c", 1)])
def listing_short_circuit(t):
    """Fallback pages are left out where the listings had events."""
    from pyspark.sql import Window

    had = F.max(F.when(F.col("listing"), F.col("n")).otherwise(0)).over(Window.partitionBy("source"))
    return t.withColumn("had", had).where((F.col("had") == 0) | F.col("listing")).select("source", "seq")


@fixture("url string, target string, seq long", [("h", "a", 1), ("h", "b", 2), ("a", "h", 1), ("a", "c", 2), ("b", "c", 1), ("c", "d", 1)], "url VARCHAR, depth BIGINT, seq BIGINT", [("h", 0, 1), ("a", 1, 2), ("b", 1, 3), ("c", 2, 4)])
def bfs_levels(t):
    """Pages of one source to a depth of two; what was seen is not seen again."""
    seeds = table(t.sparkSession, "source string, url string, seq long", [("s", "h", 0)])
    out = graph.crawl(seeds, t)
    return out.select("url", F.col("depth").cast("long").alias("depth"), F.col("seq").cast("long").alias("seq"))


@fixture("id long, text string", [(1, "a|b"), (2, "x")], "id BIGINT, escaped VARCHAR", [(1, "a\\|b"), (2, "x")])
def md_escape(t):
    return t.select("id", tx.escape_pipes(F.col("text")).alias("escaped"))


@fixture("id long, raw binary", [(1, bytearray(b"ok")), (2, bytearray(b"a\xffb")), (3, bytearray("é".encode()))], "id BIGINT, text VARCHAR", [(1, "ok"), (2, "a b"), (3, "é")])
def utf8_scrub(t):
    return t.select("id", tx.scrub(F.col("raw")).alias("text"))


@fixture("id long, a string, b string", [(1, "abc", "abcde"), (2, "abc", "abcdef"), (3, "", "a"), (4, "xyz", "abcde"), (5, "abcde", "abc")], "id BIGINT, near BOOLEAN", [(1, True), (2, False), (3, False), (4, False), (5, True)])
def ratio_thresholds(t):
    return t.select("id", tx.contains_similar(F.col("a"), F.col("b")).alias("near"))


@fixture("id long, text string", [(1, "\t x \n"), (2, " "), (3, ""), (4, None), (5, "a  b")], "id BIGINT, blank BOOLEAN", [(1, False), (2, False), (3, True), (4, True), (5, False)])
def blank_test(t):
    return t.select("id", tx.is_blank(F.col("text")).alias("blank"))


_DATED = [(1, "  Big   Show  ", "Club Ž"), (2, "", "Hall"), (3, "Čaj & Káva", "")]


@fixture("id long, title string, venue string", _DATED, "id BIGINT, event VARCHAR, title VARCHAR, note VARCHAR", [
    (1, "evt_20260401_club_z_big_show", "Big Show", "Candidate event extracted from source s; date/title may require verification."),
    (2, "evt_20260401_hall_hall_event", "Hall event", "Candidate event extracted from source s; date/title may require verification."),
    (3, "evt_20260401_x_caj_kava", "Čaj & Káva", "Candidate event extracted from source s; date/title may require verification."),
])
def event_projection_v1(t):
    e = t.select("id", F.struct(*predicates.event_v1(F.lit("2026-04-01").cast("date"), F.col("venue"), F.lit("s"), F.lit("u"), F.col("title"))).alias("x"))
    return e.select("id", F.col("x.id").alias("event"), F.col("x.title").alias("title"), F.col("x.description").alias("note"))


@fixture("id long, title string, venue string", _DATED, "id BIGINT, event VARCHAR, title VARCHAR, venue VARCHAR", [
    (1, "evt_20260401_club_z_big_show", "Big Show", "Club Ž"), (2, "evt_20260401_hall_src", "Src", "Hall"), (3, "evt_20260401_src_caj_kava", "Čaj & Káva", "Src"),
])
def event_projection_v15(t):
    e = t.select("id", F.struct(*predicates.event_v15(F.lit("2026-04-01").cast("date"), F.lit("Src"), F.lit("u"), F.col("title"), F.col("venue"), F.array(F.lit("mixed")), F.lit(" d "), F.lit("high"))).alias("x"))
    return e.select("id", F.col("x.id").alias("event"), F.col("x.title").alias("title"), F.col("x.venue_name").alias("venue"))


@fixture("id long, title string, venue string", _DATED[2:], "id BIGINT, event VARCHAR, confidence VARCHAR", [(3, "evt_20260401_src_1_aj_k_va", "low")])
def event_projection_v2(t):
    e = t.select("id", F.struct(*predicates.event_v2(F.lit("2026-04-01").cast("date"), F.lit("Src 1"), F.lit("Src"), F.lit("u"), F.col("title"))).alias("x"))
    return e.select("id", F.col("x.id").alias("event"), F.col("x.confidence").alias("confidence"))


@fixture("id long, n int", [(1, 1), (2, 2), (3, 12)], "id BIGINT, name VARCHAR", [(1, "a_new"), (2, "a_new2"), (3, "a_new12")])
def suffix_names(t):
    return t.select("id", tx.with_suffix(F.lit("a"), F.col("n")).alias("name"))


@fixture("id long, c string", [(1, "low"), (2, "medium"), (3, "high"), (4, "?"), (5, None)], "id BIGINT, e INTEGER, s INTEGER, clamped INTEGER", [(1, 1, 0, 1), (2, 2, 1, 2), (3, 3, 2, 2), (4, 0, -1, 1), (5, 0, -1, 1)])
def rank_table(t):
    e = rank.event_confidence(F.col("c"))
    return t.select("id", e.alias("e"), rank.source_confidence(F.col("c")).alias("s"), rank.clamp(e, 1, 2).alias("clamped"))
