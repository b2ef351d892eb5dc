"""Queries on rows made of the tables' columns, each with SQL that computes the same.

The tables hold no sources, embedded metadata or event pages, so these are built
from customers, orders and events; every table row takes part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from almanac.functions import dates as dt
from almanac.functions import fixed, html, jsonld, rank, urls
from almanac.functions import text as tx
from almanac.operators import merge, places, predicates, quality, report, windows
from almanac.sources import documents

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str):
    """Registers a function of (table reader) under its name, with its SQL."""

    def put(f):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet"))

        run.__doc__, run.__name__ = f.__doc__, f.__name__
        QUERIES[f.__name__], ORACLE_SQL[f.__name__] = run, sql
        return f

    return put


def _k() -> Column:
    return F.col("c_custkey")


def _text(c: Column) -> Column:
    return c.cast("string")


def _cases(column: Column, values: dict[int, Column | str | None], other) -> Column:
    """A value by remainder."""
    out = None
    for k, v in values.items():
        v = F.lit(v) if v is None or isinstance(v, str) else v
        out = F.when(column == k, v) if out is None else out.when(column == k, v)
    return out.otherwise(other)


# sources


def _sources(t) -> DataFrame:
    """One source a customer: some inactive, social, or without name or URL."""
    site = F.concat(F.lit("https://s"), _text(_k()), F.lit(".example.org"))
    home = _cases(_k() % 9, {3: None, 4: F.concat(F.lit("https://www.facebook.com/"), _text(_k()))}, F.concat(site, F.lit("/")))
    listing = F.when(_k() % 4 == 0, F.array(F.concat(site, F.lit("/events")), F.concat(site, F.lit("/x")))).when(_k() % 4 == 1, F.array(F.lit("https://t.me/x"))).otherwise(F.array().cast("array<string>"))
    kind = _cases(_k() % 7, {2: "Social network", 5: "forum"}, F.lit("venue"))
    active = _cases(_k() % 5, {0: "false", 1: '"TRUE"', 2: None}, F.lit("true"))
    return t("customer").select(_k().alias("k"), F.concat(F.lit("s"), _text(_k())).alias("id"), F.when(_k() % 11 != 0, F.col("c_name")).alias("name"), home.alias("homepage_url"), listing.alias("event_listing_urls"), kind.alias("source_type"), active.alias("active"))


_SRC = """SELECT c_custkey AS k, 's' || c_custkey AS id, c_custkey % 5 IN (3, 4) AS strict, c_custkey % 5 IN (1, 3, 4) AS lenient, c_custkey % 7 = 2 AS social, c_custkey % 7 = 5 AS forum,
  c_custkey % 9 = 4 OR c_custkey % 4 = 1 AS host, c_custkey % 11 <> 0 AND (c_custkey % 9 <> 3 OR c_custkey % 4 IN (0, 1)) AS formed, 'https://s' || c_custkey || '.example.org' AS site,
  CASE c_custkey % 9 WHEN 3 THEN NULL WHEN 4 THEN 'https://www.facebook.com/' || c_custkey ELSE 'https://s' || c_custkey || '.example.org/' END AS home FROM customer"""


@query(f"SELECT id, 'v1' AS step FROM ({_SRC}) WHERE strict UNION ALL SELECT id, 'v15' FROM ({_SRC}) WHERE strict AND NOT (social OR forum OR host) UNION ALL SELECT id, 'v2' FROM ({_SRC}) WHERE lenient AND formed AND NOT social UNION ALL SELECT id, 'listed' FROM ({_SRC}) WHERE k % 10 = 0")
def source_steps(t):
    """What the filters of each extractor, and a list of ids, leave of the sources."""
    s = _sources(t)
    v1 = predicates.active_strict(s)
    v15 = v1.where(~predicates.is_social(F.col("source_type"), F.col("homepage_url"), F.col("event_listing_urls")))
    v2 = predicates.well_formed(predicates.active_lenient(s)).where(~predicates.is_social_type(F.col("source_type")))
    listed = predicates.listed(s, s.where("k % 10 = 0").select("id"))
    out = None
    for step, rows in (("v1", v1), ("v15", v15), ("v2", v2), ("listed", listed)):
        rows = rows.select("id", F.lit(step).alias("step"))
        out = rows if out is None else out.union(rows)
    return out


_OWN = "CASE k % 4 WHEN 0 THEN [site || '/events', site || '/x'] WHEN 1 THEN ['https://t.me/x'] ELSE [] END"
_PATHS = "[" + ", ".join(f"'{p}'" for p in fixed.FALLBACK_PATHS) + "]"


@query(
    f"""SELECT id, array_to_string(list_concat(l, CASE WHEN home IS NULL THEN [] ELSE list_filter(list_transform({_PATHS}, lambda p: regexp_extract(home, '^https://[^/]+') || p), lambda u: NOT list_contains(l, u)) END), ' ') AS v1,
  array_to_string(CASE WHEN home IS NULL THEN l ELSE list_append(l, home) END, ' ') AS v15, CASE WHEN len(l) > 0 THEN array_to_string(l, ' ') ELSE coalesce(home, '') END AS v2 FROM (SELECT *, {_OWN} AS l FROM ({_SRC}))"""
)
def seed_urls(t):
    """URLs that each extractor begins with, in order."""
    h, u = F.col("homepage_url"), F.col("event_listing_urls")
    seeds = {"v1": predicates.seed_urls_v1(h, u), "v15": predicates.seed_urls_v15(h, u), "v2": predicates.seed_urls_v2(h, u)}
    return _sources(t).select("id", *[F.array_join(c, " ").alias(n) for n, c in seeds.items()])


def _known(t) -> DataFrame:
    """Suppliers as known sources; none of their URLs is another's."""
    k, none = F.col("s_suppkey"), F.lit(None).cast("string")
    site = F.concat(F.lit("https://k"), _text(k), F.lit(".sk"))
    return t("supplier").select(
        k.cast("long").alias("pos"), F.concat(F.lit("k"), _text(k)).alias("id"), F.when(k % 3 > 0, F.col("s_name")).alias("name"), site.alias("homepage_url"), F.lit("true").alias("active"), _cases(k % 3, {0: "low", 1: "medium"}, F.lit("high")).alias("confidence"),
        F.array(F.concat(site, F.lit("/e"))).alias("event_listing_urls"), F.array(F.lit("rock")).alias("genre_tags"), *[none.alias(c) for c in ("source_type", "event_focus", "geo_coverage", "access_type", "crawl_frequency", "robots_txt_checked")], F.array().cast("array<string>").alias("languages"),
    )


def _incoming(t) -> DataFrame:
    """As many sources again: a third each known by homepage, known by listing, and new under a known id."""
    k = F.col("pos")
    site = F.concat(F.lit("https://k"), _text(k), F.lit(".sk"))
    own = F.concat(F.lit("https://n"), _text(k), F.lit(".sk"))
    return _known(t).withColumns({
        "homepage_url": F.when(k % 3 == 0, F.concat(F.lit("HTTPS://K"), _text(k), F.lit(".SK/"))).otherwise(own), "event_listing_urls": F.when(k % 3 == 1, F.array(F.concat(site, F.lit("/e/?q=1")))).otherwise(F.array().cast("array<string>")),
        "genre_tags": F.array(F.lit("jazz"), F.lit("rock")), "confidence": F.lit("medium"), "name": F.lit("new"), "source_type": F.lit("venue"),
    })


@query("SELECT s_suppkey AS pos, s_suppkey AS match FROM supplier WHERE s_suppkey % 3 < 2")
def source_matches(t):
    """Known sources by URL, whatever the case of a host and the rest behind a path."""
    m = merge.match_sources(_known(t), _incoming(t))
    return m.select("pos", F.col("match").cast("long").alias("match"))


@query(
    """SELECT 'k' || s_suppkey AS id, CASE WHEN s_suppkey % 3 > 0 THEN s_name ELSE 'new' END AS name, CASE s_suppkey % 3 WHEN 0 THEN 'medium' WHEN 1 THEN 'medium' ELSE 'high' END AS confidence, CASE WHEN s_suppkey % 3 < 2 THEN 'rock jazz' ELSE 'rock' END AS tags,
  CASE s_suppkey % 3 WHEN 0 THEN 'confidence,genre_tags,languages,name,source_type' WHEN 1 THEN 'event_listing_urls,genre_tags,languages,source_type' ELSE '' END AS changes FROM supplier
  UNION ALL SELECT 'k' || s_suppkey || '_new', 'new', 'medium', 'jazz rock', '' FROM supplier WHERE s_suppkey % 3 = 2"""
)
def source_merges(t):
    """Known sources with what the incoming ones add; new ones get spare ids."""
    m = merge.merge_sources(_known(t), _incoming(t))
    return m.select("id", "name", "confidence", F.array_join("genre_tags", " ").alias("tags"), F.array_join("changes", ";").alias("changes"))


# codes, texts and arrays

_CODE = "200 + (event_id * 7) % 320"
_ERRORS = ["IllegalArgumentException", "HttpTimeoutException", "IOException", "UncheckedIOException", "RuntimeException"]


@query(
    f"""SELECT event_id, code BETWEEN 200 AND 399 AS ok, code IN (401, 403, 429, 503) AS blocked, CASE WHEN e = 0 THEN 'INVALID_SOURCE' WHEN e = 1 THEN 'TIMEOUT' WHEN e = 2 THEN 'FETCH_ERROR' WHEN e = 3 THEN 'PARSE_ERROR' WHEN e = 4 THEN 'UNKNOWN' WHEN code = 403 THEN 'ACCESS_DENIED' WHEN code >= 400 THEN 'FETCH_ERROR' END AS category,
  CASE WHEN e < 5 THEN [{", ".join(f"'{e}'" for e in _ERRORS)}][e + 1] || ': ' || CASE WHEN event_id % 2 = 0 THEN event_type ELSE 'no message' END END AS text FROM (SELECT event_id, event_type, {_CODE} AS code, event_id % 30 AS e FROM events)"""
)
def status_classes(t):
    i = F.col("event_id")
    code = (200 + (i * 7) % 320).cast("int")
    error = _cases(i % 30, dict(enumerate(_ERRORS)), F.lit(None).cast("string"))
    message = F.when(i % 2 == 0, F.col("event_type")).otherwise("  ")
    text = F.when(error.isNotNull(), tx.error_text(error, message))
    return t("events").select("event_id", predicates.succeeded(code).alias("ok"), predicates.blocked_status(code).alias("blocked"), predicates.failure_category(code, error).alias("category"), text.alias("text"))


@query("""SELECT c_custkey, CASE WHEN c_custkey % 4 = 3 THEN 'mixed' WHEN c_mktsegment = 'BUILDING' THEN 'FURNITURE BUILDING' ELSE 'FURNITURE' END AS tags,
  array_to_string(CASE WHEN c_mktsegment = 'FURNITURE' THEN ['FURNITURE', 'z'] ELSE ['FURNITURE', c_mktsegment, 'z'] END, ' ') AS united FROM customer""")
def tags_and_unions(t):
    """A source's tags that are known, and two lists in order, each value once."""
    known = F.array(F.lit("BUILDING"), F.lit("FURNITURE"))
    own = F.when(_k() % 4 == 3, F.array(F.lit("x"), F.lit("y"))).otherwise(F.array(F.lit("FURNITURE"), F.col("c_mktsegment"), F.lit("FURNITURE")))
    united = F.array_union(F.array(F.lit("FURNITURE"), F.col("c_mktsegment")), F.array(F.lit("FURNITURE"), F.lit("z")))
    return t("customer").select("c_custkey", F.array_join(predicates.categories_of(own, known), " ").alias("tags"), F.array_join(united, " ").alias("united"))


@query("SELECT c_custkey, CASE c_custkey % 6 WHEN 0 THEN c_mktsegment WHEN 1 THEN 'a|' || c_mktsegment WHEN 2 THEN CAST(c_custkey AS VARCHAR) ELSE '' END AS l, CASE c_custkey % 6 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 1 ELSE 0 END AS n, c_custkey % 6 = 5 AS active FROM customer")
def coerced_fields(t):
    """A list of a list, a scalar, a null, an empty list or nothing; a boolean of a text."""
    seg = F.concat(F.lit('"'), F.col("c_mktsegment"), F.lit('"'))
    raw = _cases(_k() % 6, {0: F.concat(F.lit('{"f": '), seg, F.lit("}")), 1: F.concat(F.lit('{"f": ["a", null, '), seg, F.lit("]}")), 2: F.concat(F.lit('{"f": '), _text(_k()), F.lit("}")), 3: '{"f": null}', 4: '{"f": []}'}, F.lit('{"active": " True "}'))
    v = documents.list_of(F.col("raw"), "f")
    return t("customer").select("c_custkey", raw.alias("raw")).select("c_custkey", F.array_join(v, "|").alias("l"), F.size(v).cast("long").alias("n"), documents.bool_of(F.col("raw"), "active").alias("active"))


@query("""SELECT doc_id, regexp_full_match(coalesce(p, ''), '[\\x00\\x09-\\x0D ]*') AS blank, contains(l, s) AND s <> '' AND length(s) / greatest(length(l), 1) >= 0.6 AS near, left(text, 5) || ' ' || substr(text, 6) AS scrubbed FROM
  (SELECT doc_id, text, CASE doc_id % 4 WHEN 0 THEN NULL WHEN 1 THEN chr(9) || ' ' || chr(10) WHEN 2 THEN ' ' || chr(13) || left(text, 1) ELSE left(text, 3) END AS p, substr(text, 2, CAST(doc_id % 50 AS INT)) AS s, left(text, 50) AS l FROM documents WHERE text IS NOT NULL)""")
def text_tests(t):
    """Blank texts, texts that nearly contain each other, and bytes that are no text."""
    d, i, x = t("documents").where("text IS NOT NULL"), F.col("doc_id"), F.col("text")
    p = _cases(i % 4, {0: None, 1: "\t \n", 2: F.concat(F.lit(" \r"), F.left(x, F.lit(1)))}, F.left(x, F.lit(3)))
    cut = F.substr(x, F.lit(2), (i % 50).cast("int"))
    raw = F.concat(F.left(x, F.lit(5)).cast("binary"), F.unhex(F.lit("FF")), F.substr(x, F.lit(6)).cast("binary"))
    return d.select("doc_id", tx.is_blank(p).alias("blank"), tx.contains_similar(cut, F.left(x, F.lit(50))).alias("near"), tx.scrub(raw).alias("scrubbed"))


@query("SELECT c_custkey, c_name || '_new' || CASE WHEN c_custkey % 9 > 0 THEN CAST(c_custkey % 9 + 1 AS VARCHAR) ELSE '' END AS name, CASE c_custkey % 4 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 3 ELSE 0 END AS e, CASE c_custkey % 4 WHEN 0 THEN 0 WHEN 1 THEN 1 WHEN 2 THEN 2 ELSE -1 END AS s, greatest(least(15, 40 - c_custkey % 50), 0) AS budget, 0 AS n_languages, CAST(NULL AS VARCHAR) AS event_focus FROM customer")
def names_ranks_budgets(t):
    """Spare names, both confidence scales, a spider's budget, and fields that a row lacks."""
    c = _cases(_k() % 4, {0: "low", 1: "medium", 2: "high"}, F.lit("?"))
    full = merge.complete_fields(t("customer"), {"c_custkey": "long", "languages": "array<string>", "event_focus": "string"})
    return full.select("c_custkey", tx.with_suffix(F.col("c_name"), _k() % 9 + 1).alias("name"), rank.event_confidence(c).alias("e"), rank.source_confidence(c).alias("s"), windows.spider_budget(_k() % 50).cast("long").alias("budget"), F.size("languages").cast("long").alias("n_languages"), "event_focus")


@query("SELECT event_id FROM (SELECT *, max(CASE WHEN event_type = 'purchase' THEN CASE WHEN value > 100 THEN 1 ELSE 0 END ELSE 0 END) OVER (PARTITION BY user_id, CAST(ts AS DATE)) AS had FROM events) WHERE had = 0 OR event_type = 'purchase'")
def listings_before_fallbacks(t):
    """Purchases as listings, the others as fallback pages that are visited only on days without a large one."""
    e = t("events").select("event_id", F.concat_ws("/", "user_id", F.to_date("ts")).alias("source"), (F.col("event_type") == "purchase").alias("listing"), (F.col("value") > 100).cast("int").alias("n"))
    return windows.listings_first(e).select("event_id")


# dates

_NAMES = ["january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december"]
_ORDER_TEXT = "'Od ' || strftime(d, '%-d.%-m.%Y') || ' do ' || strftime(d + INTERVAL 10 DAY, '%Y-%m-%d') || ', opat ' || strftime(d + INTERVAL 20 DAY, '%-d.%-m.') || ' a ' || strftime(d + INTERVAL 30 DAY, '%-d') || ' ' || lower(strftime(d + INTERVAL 30 DAY, '%B')) || ' ' || year(d + INTERVAL 30 DAY)"
_NEAR = "CASE WHEN strftime(e, '%m-%d') < '11-20' THEN TRY_CAST('1997-' || strftime(e, '%m-%d') AS DATE) ELSE TRY_CAST('1996-' || strftime(e, '%m-%d') AS DATE) END"


@query(
    f"""SELECT o_orderkey, array_to_string(list_transform(list_filter(l, lambda x, i: x BETWEEN DATE '1996-11-20' AND DATE '1997-02-18' AND list_position(l, x) = i), lambda x: strftime(x, '%Y-%m-%d')), ' ') AS days FROM
  (SELECT o_orderkey, [CAST(d + INTERVAL 10 DAY AS DATE), d, {_NEAR}, CAST(d + INTERVAL 30 DAY AS DATE)] AS l FROM (SELECT o_orderkey, d, CAST(d + INTERVAL 20 DAY AS DATE) AS e FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)))"""
)
def dates_in_window(t):
    """All four kinds of dates of a text in a window over New Year, in order of the kinds."""
    return t("orders").select("o_orderkey", F.array_join(F.transform(dt.candidates_v15(_notice(F.to_date("o_orderdate")), F.lit("1996-11-20").cast("date")), lambda x: F.date_format(x, "yyyy-MM-dd")), " ").alias("days"))


def _notice(d: Column) -> Column:
    later = F.date_add(d, 30)
    month = F.element_at(F.array(*[F.lit(n) for n in _NAMES]), F.month(later))
    return F.concat(F.lit("Od "), F.date_format(d, "d.M.yyyy"), F.lit(" do "), F.date_format(F.date_add(d, 10), "yyyy-MM-dd"), F.lit(", opat "), F.date_format(F.date_add(d, 20), "d.M."), F.lit(" a "), _text(F.dayofmonth(later)), F.lit(" "), month, F.lit(" "), _text(F.year(later)))


@query(
    """SELECT o_orderkey, array_to_string(list_transform(list_filter(l, lambda x, i: x IS NOT NULL AND list_position(l, x) = i), lambda x: strftime(x, '%Y-%m-%d')), ' ') AS days, CASE WHEN o_orderkey % 3 > 0 THEN strftime(d, '%Y-%m-%d') END AS run FROM
  (SELECT o_orderkey, d, [CASE WHEN year(a) = 1996 THEN a END, CASE WHEN year(d) = 1996 THEN d END, make_date(1996, month(e), day(e)), CASE WHEN year(f) = 1996 THEN f END] AS l FROM
  (SELECT o_orderkey, d, CAST(d + INTERVAL 10 DAY AS DATE) AS a, CAST(d + INTERVAL 20 DAY AS DATE) AS e, CAST(d + INTERVAL 30 DAY AS DATE) AS f FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)))"""
)
def dates_of_a_year(t):
    """The first extractor's dates of its one year, and the date of a run's id."""
    d = F.to_date("o_orderdate")
    run = _cases(F.col("o_orderkey") % 3, {0: "label", 1: F.date_format(d, "yyyy-MM-dd")}, F.date_format(d, "yyyy-MM-dd_HHmmss"))
    return t("orders").select("o_orderkey", F.array_join(F.transform(dt.candidates_v1(_notice(d), 1996), lambda x: F.date_format(x, "yyyy-MM-dd")), " ").alias("days"), F.date_format(dt.run_date(run), "yyyy-MM-dd").alias("run"))


# pages with events


@query(
    """SELECT c_custkey, CASE c_custkey % 5 WHEN 3 THEN 2 ELSE 1 END AS n_blobs, CASE WHEN c_custkey % 5 IN (0, 1, 3) AND c_custkey % 200 <= 90 THEN 'evt_' || strftime(d, '%Y%m%d') || '_' || CASE WHEN c_custkey % 5 = 0 THEN 'hall' ELSE 'src' END || '_gig_' || c_custkey END AS event FROM (SELECT c_custkey, DATE '2024-01-01' + CAST(c_custkey % 200 AS INT) AS d FROM customer)"""
)
def embedded_events(t):
    """Embedded objects: plain, in a graph, of another type, one that is broken and one nested, one without a name."""
    day = F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), (_k() % 200).cast("int")), "yyyy-MM-dd")
    gig = F.concat(F.lit('"name":"Gig '), _text(_k()), F.lit('","startDate":"'), day, F.lit('"'))
    blob = lambda c: F.concat(F.lit('<script type="application/ld+json">'), c, F.lit("</script>"))
    page = _cases(
        _k() % 5,
        {
            0: blob(F.concat(F.lit('{"@type":"Event",'), gig, F.lit(',"location":{"name":"Hall"}}'))),
            1: blob(F.concat(F.lit('{"@graph":[{"@type":["Thing","EVENT"],'), gig, F.lit(',"location":"Street"}],"x":{"@type":"Event","name":"no"}}'))),
            2: blob(F.concat(F.lit('{"@type":"MusicEvent",'), gig, F.lit("}"))),
            3: F.concat(blob(F.lit("{broken")), blob(F.concat(F.lit('[{"sub":{"@type":"event",'), gig, F.lit("}}]")))),
        },
        blob(F.concat(F.lit('{"@type":"Event","name":" ","startDate":"'), day, F.lit('"}'))),
    )
    p = t("customer").select("c_custkey", page.alias("html"))
    b = p.select("c_custkey", html.json_ld_blobs(F.col("html")).alias("blobs")).select("c_custkey", F.size("blobs").cast("long").alias("n_blobs"), F.flatten(F.transform("blobs", lambda x: F.array(x))).alias("blobs"))
    e = b.select("c_custkey", "n_blobs", F.explode("blobs").alias("blob")).select("c_custkey", "n_blobs", F.explode_outer(jsonld.events("blob")).alias("e"))
    when = F.get(dt.candidates_v15(F.col("e.start"), F.lit("2024-01-01").cast("date")), F.lit(0))
    cols = predicates.event_v15(when, F.lit("Src"), F.lit("u"), F.col("e.name"), F.coalesce("e.place", F.lit("")), F.array(F.lit("mixed")), F.col("e.description"), F.lit("high"))
    rows = e.select("c_custkey", "n_blobs", F.when(~tx.is_blank(F.col("e.name")) & when.isNotNull(), F.struct(*cols)).alias("x"))
    return rows.groupBy("c_custkey", "n_blobs").agg(F.max("x.id").alias("event"))


_TAGS = "SELECT c_custkey AS k, c_custkey % 5 AS a, c_custkey % 4 AS l, c_custkey % 3 AS s, (c_custkey % 7) * 12 AS b FROM customer"


def _marked(t) -> DataFrame:
    """Pages of articles, list items, sections and boxes, so many of each by remainder."""

    def times(n: Column, piece: Column) -> Column:
        return F.repeat(piece, n.cast("int"))

    dated = lambda tag, cls: F.concat(F.lit(f"<{tag}{cls}><h3>T "), _text(_k()), F.lit(f"</h3> 5.2.2024</{tag}>"))
    page = F.concat(times(_k() % 5, dated("article", "")), times(_k() % 4, dated("li", " class='x item'")), times(_k() % 3, dated("section", ' class="event"')), times((_k() % 7) * 12, dated("div", " class='card'")), F.lit("<li class='nav'>n</li>"))
    return places.spread(t("customer").select("c_custkey")).select(_k().alias("k"), page.alias("html"))


@query(f"SELECT k, n, least(n, 30) AS events, CASE WHEN n > 0 THEN 'T ' || k END AS title FROM (SELECT k, CASE WHEN a >= 3 THEN a WHEN a + l >= 3 THEN a + l WHEN a + l + s >= 3 THEN a + l + s ELSE least(a + l + s + b, 60) END AS n FROM ({_TAGS}))")
def marked_blocks(t):
    """Blocks of each page, and its events: the first thirty blocks with a heading and a date."""
    titled = F.filter(F.transform("blocks", lambda x: F.struct(x.alias("block"), html.heading(x).alias("title"))), lambda x: x["title"].isNotNull())
    dated = F.filter(titled, lambda x: dt.first_v15(x["block"], F.lit("2024-01-01").cast("date")).isNotNull())
    events = F.transform(F.slice(dated, 1, html.MOST_EVENTS), lambda x: x["title"])
    b = _marked(t).select("k", html.blocks(F.col("html")).alias("blocks")).select("k", F.size("blocks").cast("long").alias("n"), events.alias("titles"))
    return b.select("k", "n", F.size("titles").cast("long").alias("events"), F.array_max("titles").alias("title"))


@query(
    """SELECT k, kind, 'evt_20240205_s_1_' || lower(kind) || '_' || k AS event FROM (SELECT c_custkey AS k, unnest(CASE c_custkey % 4 WHEN 0 THEN ['Card'] WHEN 1 THEN ['Card', 'Item'] WHEN 2 THEN ['Para', 'Head'] ELSE [] END) AS kind FROM customer)"""
)
def element_events(t):
    """Events of cards; of headings, paragraphs and list items only on pages without an event in a card."""
    kind = lambda name: F.concat(F.lit(f"{name} "), _text(_k()), F.lit(" 5.2.2024"))
    page = _cases(
        _k() % 4,
        {
            0: F.concat(F.lit("<div class='big event'>"), kind("Card"), F.lit("</div><p>"), kind("Lost"), F.lit("</p>")),
            1: F.concat(F.lit("<article>"), kind("Card"), F.lit("</article><div itemtype='http://schema.org/MusicEvent'>"), kind("Item"), F.lit("</div>")),
            2: F.concat(F.lit("<article>no date</article><p>"), kind("Para"), F.lit("</p><h2>"), kind("Head"), F.lit("</h2><div>"), kind("Skip"), F.lit("</div>")),
        },
        F.lit("<p>abc 5.2.2024</p>"),
    )
    p = t("customer").select(_k().alias("k"), page.alias("html"))

    def events(picked: Column) -> DataFrame:
        e = p.select("k", F.explode(picked).alias("text"))
        tok = dt.first_token(F.col("text"))
        e = e.select("k", F.trim(tx.squeeze(F.replace("text", tok, F.lit("")))).alias("title"), dt.lenient(tok).alias("day")).where("day IS NOT NULL AND length(title) >= 4")
        return e.select("k", F.split("title", " ")[0].alias("kind"), F.struct(*predicates.event_v2(F.col("day"), F.lit("S 1"), F.lit("Src"), F.lit("u"), F.col("title"))).alias("x")).select("k", "kind", F.col("x.id").alias("event"))

    first = events(html.cards("html"))
    return first.union(events(html.text_blocks("html")).join(first.select("k").distinct(), "k", "left_anti"))


@query(
    """SELECT c_custkey, 'evt_20240205_' || v || '_' || CASE WHEN c_custkey % 4 > 0 THEN 'noc_' || c_custkey WHEN c_custkey % 3 = 0 THEN 'event' ELSE v || '_event' END AS event, CASE WHEN c_custkey % 4 = 0 THEN n || ' event' ELSE 'Noc ' || c_custkey || '!' END AS title FROM
  (SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'x' ELSE 'club_' || lower(c_mktsegment) END AS v, CASE WHEN c_custkey % 3 = 0 THEN '?!' ELSE 'Club ' || c_mktsegment END AS n FROM customer)"""
)
def line_events(t):
    """Events of lines of text: the source's name stands in for an empty line, and a mark for an empty slug."""
    venue = F.when(_k() % 3 == 0, F.lit("?!")).otherwise(F.concat(F.lit("Club "), F.col("c_mktsegment")))
    line = F.when(_k() % 4 == 0, F.lit("  ")).otherwise(F.concat(F.lit(" Noc   "), _text(_k()), F.lit("! ")))
    e = t("customer").select("c_custkey", F.struct(*predicates.event_v1(F.lit("2024-02-05").cast("date"), venue, F.lit("s"), F.lit("u"), line)).alias("x"))
    return e.select("c_custkey", F.col("x.id").alias("event"), F.col("x.title").alias("title"))


@query("SELECT c_custkey, array_to_string(list_filter(['name', CASE WHEN c_custkey % 2 = 0 THEN 'id' END, CASE WHEN c_custkey % 3 = 0 THEN 'c_acctbal' END], lambda x: x IS NOT NULL), ',') AS missing FROM customer")
def required_fields(t):
    """Required keys that a row lacks, of a list of its own or the usual one."""
    raw = F.when(_k() % 2 == 0, F.lit('{"url": null}')).otherwise(F.lit('{"url": null, "id": 1}'))
    required = F.when(_k() % 3 == 0, F.array(F.lit("name"), F.lit("id"), F.lit("url"), F.lit("c_acctbal")))
    return t("customer").select("c_custkey", F.array_join(quality.missing_fields(raw, required, ["name", "id", "url"]), ",").alias("missing"))


@query("SELECT source, CASE WHEN k % 5 = 0 THEN 'network_or_fetch_errors' WHEN k % 5 = 1 THEN 'access_blocked_or_rate_limited' WHEN k % 5 = 2 THEN 'access_blocked_or_rate_limited' WHEN k % 5 = 3 THEN 'missing_or_invalid_listing_paths' ELSE 'unknown_unreachable' END AS category FROM (SELECT 'c' || c_custkey AS source, c_custkey AS k FROM customer)")
def failure_rules(t):
    """Five visits a source: a network error, a refusal, a blocked page, four pages not found, or three."""
    v = t("customer").select(F.concat(F.lit("c"), _text(_k())).alias("source_id"), _k().alias("k"), F.explode(F.sequence(F.lit(1), F.lit(5))).alias("i"))
    k, i = F.col("k") % 5, F.col("i")
    status = F.when((k == 0) & (i == 2), "error").when((k == 1) & (i == 3), "429").when((k == 4) & (i > 3), "200").when(i == 5, "200").otherwise("404")
    return report.classify_sources(v.select("source_id", status.alias("status"), ((k == 2) & (i == 1)).alias("blocked"))).select(F.col("source_id").alias("source"), "category")
