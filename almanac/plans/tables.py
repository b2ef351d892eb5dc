"""Queries on the tables, each with its SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from almanac.functions import dates as dt
from almanac.functions import fixed, html, rank, urls
from almanac.functions import text as tx
from almanac.operators import dedup, extract, graph, merge, places, predicates, quality, report, windows
from almanac.sources import crawl_log, documents

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a function of (table reader) under its name, with its SQL."""

    def put(f):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet"))

        run.__doc__ = f.__doc__
        run.__name__ = f.__name__
        QUERIES[f.__name__] = run
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return put


# DuckDB twins of the text functions
_NORM = "trim(regexp_replace(regexp_replace(lower({c}), '[^\\p{{L}}\\p{{M}}\\p{{Nd}}\\s]', ' ', 'g'), '\\s+', ' ', 'g'))"
_CLEAN = "trim(" + "regexp_replace(" * 8 + "{c}" + "".join(f", '{p}', '{r}', '{o}')" for p, r, o in (("<script\\b.*?</script>", " ", "gis"), ("<style\\b.*?</style>", " ", "gis"), ("<[^>]+>", " ", "g"), ("&nbsp;", " ", "gi"), ("&amp;", "&", "gi"), ("&quot;", '"', "gi"), ("&#39;|&apos;", "''", "gi"), ("\\s+", " ", "g"))) + ")"
_SLUG = "coalesce(nullif(substring(regexp_replace(regexp_replace({c}, '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g'), 1, {n}), ''), '{d}')"


def _norm(c: str) -> str:
    return _NORM.format(c=c)


def _clean(c: str) -> str:
    return _CLEAN.replace("{c}", c)


_H1 = "regexp_extract(html, '<h1\\b[^>]*>(.*?)</h1>', 1, 'is')"
_HOST = "lower(regexp_extract(url, '^[a-zA-Z]+://([^/:?#]+)', 1))"


@query(f"SELECT {_HOST} AS host, count(DISTINCT {_norm(_clean(_H1))}) AS n_titles, count(*) AS n_pages FROM pages GROUP BY 1")
def catalog_from_pages(t):
    """Pages cleaned, keyed by heading, deduplicated, counted by host."""
    p = t("pages").select(urls.host(F.col("url")).alias("host"), tx.norm_key(tx.clean_html(F.regexp_extract("html", r"(?is)<h1\b[^>]*>(.*?)</h1>", 1))).alias("k"))
    per = p.groupBy("host", "k").agg(F.count("*").alias("n"))
    return per.groupBy("host").agg(F.count("k").alias("n_titles"), F.sum("n").alias("n_pages"))


@query(f"SELECT page_id, {_clean('html')} AS text FROM pages")
def clean_text_pages(t):
    return t("pages").select("page_id", tx.clean_html(F.col("html")).alias("text"))


@query(f"SELECT page_id, nullif({_clean(_H1)}, '') AS heading FROM pages")
def page_heading(t):
    return t("pages").select("page_id", html.heading(F.col("html")).alias("heading"))


@query(f"SELECT page_id, length(substring({_clean(_H1)}, 1, 180)) AS n FROM pages")
def page_title_len(t):
    return t("pages").select("page_id", F.length(tx.cut(html.heading(F.col("html")), 180)).cast("long").alias("n"))


_HREF = """regexp_extract_all(html, '<a\\b[^>]*\\bhref=["'']([^"''#][^"'']*)["''][^>]*>(.*?)</a>', {k}, 'is')"""
_LINKS = f"SELECT page_id, url, unnest({_HREF.format(k=1)}) AS href, unnest({_HREF.format(k=2)}) AS inner_html FROM pages"


@query(f"SELECT page_id, href, count(*) AS n FROM ({_LINKS}) GROUP BY ALL")
def page_links(t):
    links = t("pages").select("page_id", F.explode(html.hrefs(F.col("html"))).alias("href"))
    return links.groupBy("page_id", "href").agg(F.count("*").alias("n"))


_ORIGIN = "regexp_extract(url, '^[a-zA-Z]+://[^/:?#]+')"


@query(f"SELECT page_id, {_ORIGIN} || href AS link, count(*) AS n FROM ({_LINKS}) WHERE href LIKE '/%' GROUP BY ALL")
def same_host_links(t):
    p = t("pages").select("page_id", "url", F.explode(html.hrefs(F.col("html"))).alias("href"))
    p = p.select("page_id", "url", urls.resolve("href", "url").alias("link"))
    return p.where(urls.host(F.col("link")).eqNullSafe(urls.host(F.col("url")))).groupBy("page_id", "link").agg(F.count("*").alias("n"))


_ANY = "({})".format
_HINT = _ANY(" OR ".join(f"contains(joined, '{w}')" for w in fixed.LINK_HINTS))
_VETO = _ANY(" OR ".join(f"contains(joined, '{w}')" for w in fixed.LINK_VETOES))


def _listings(t) -> DataFrame:
    """All pages, and one listing a customer: 24 links each, some telling, some vetoed, some dated, one to itself, one elsewhere."""
    k = F.col("c_custkey")
    own = F.concat(F.lit("https://c"), k.cast("string"), F.lit(".example.org/program"))

    def link(x):
        path = F.when(x % 4 == 0, F.concat(F.lit("/event/"), x.cast("string"))).when(x % 4 == 1, F.concat(F.lit("p/"), (x % 7).cast("string"))).when(x == 22, F.lit("https://other.example.org/event")).when(x == 23, F.lit("/program")).otherwise(F.concat(F.lit("/about/event/"), x.cast("string")))
        text = F.when(x % 5 == 0, F.lit("Noc 12.1.2024")).otherwise("Noc")
        return F.concat(F.lit('<a href="'), path, F.lit('"><b>'), text, F.lit("</b></a>"))

    made = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(23)), link), "\n")
    return t("pages").select("page_id", "url", "html").union(places.spread(t("customer").select("c_custkey")).select(k + 1000000, own, made))


_MADE = f"""SELECT page_id, url, unnest({_HREF.format(k=1)}) AS href, unnest({_HREF.format(k=2)}) AS inner_html, unnest(range(len({_HREF.format(k=1)}))) AS x FROM (SELECT page_id, url, html FROM pages
  UNION ALL SELECT c_custkey + 1000000, 'https://c' || c_custkey || '.example.org/program', array_to_string(list_transform(range(24), lambda x: '<a href="' || CASE WHEN x % 4 = 0 THEN '/event/' || x WHEN x % 4 = 1 THEN 'p/' || (x % 7)
  WHEN x = 22 THEN 'https://other.example.org/event' WHEN x = 23 THEN '/program' ELSE '/about/event/' || x END || '"><b>' || CASE WHEN x % 5 = 0 THEN 'Noc 12.1.2024' ELSE 'Noc' END || '</b></a>'), chr(10)) FROM customer)"""
_ABSOLUTE = f"CASE WHEN href LIKE 'http%' THEN href WHEN href LIKE '/%' THEN {_ORIGIN} || href ELSE {_ORIGIN} || '/' || href END"
_WANTED = f"""SELECT * FROM (SELECT page_id, url, x, {_ABSOLUTE} AS link, lower({_clean('inner_html')} || ' ' || inner_html || ' ' || {_ABSOLUTE}) AS joined, {_ORIGIN} AS origin FROM ({_MADE}))
  WHERE starts_with(link, origin) AND ({_HINT} OR contains(joined, '12.1.2024')) AND NOT {_VETO}"""


@query(f"SELECT DISTINCT page_id, link FROM ({_WANTED})")
def link_candidates(t):
    found = extract.candidates(F.col("html"), F.col("url"), F.lit("2024-01-01").cast("date"))
    return _listings(t).select("page_id", F.explode(found).alias("link"))


@query(f"SELECT page_id, place, link FROM (SELECT page_id, link, row_number() OVER (PARTITION BY page_id ORDER BY min(x)) AS place FROM ({_WANTED}) WHERE link <> url GROUP BY page_id, link) WHERE place <= 5")
def event_links(t):
    """The first five candidates of each page, without the page itself."""
    found = extract.event_links(F.col("html"), F.col("url"), F.lit("2024-01-01").cast("date"), most=5)
    return _listings(t).select("page_id", F.posexplode(found).alias("place", "link")).select("page_id", (F.col("place") + 1).cast("long").alias("place"), "link")


@query(f"""SELECT page_id, rn, link FROM (SELECT page_id, link, row_number() OVER (PARTITION BY page_id ORDER BY p) AS rn FROM
  (SELECT page_id, {_ORIGIN} || href AS link, min(p) AS p FROM (SELECT page_id, url, unnest(h) AS href, unnest(range(len(h))) AS p FROM (SELECT page_id, url, {_HREF.format(k=1)} AS h FROM pages)) GROUP BY ALL)) WHERE rn <= 3""")
def first_n_links(t):
    p = t("pages").select("page_id", "url", F.posexplode(html.hrefs(F.col("html"))).alias("p", "href")).select("page_id", "p", urls.resolve("href", "url").alias("link"))
    p = p.groupBy("page_id", "link").agg(F.min("p").alias("p"))
    return p.withColumn("rn", F.row_number().over(Window.partitionBy("page_id").orderBy("p")).cast("long")).where("rn <= 3").select("page_id", "rn", "link")


@query(f"SELECT page_id, {_HOST} AS host, lower(regexp_extract(url, '^([a-zA-Z]+)://', 1)) || '://' || {_HOST} || regexp_replace(regexp_extract(url, '^[a-zA-Z]+://[^/?#]+([^?#]*)', 1), '/+$', '') AS norm FROM pages")
def url_normalize_pages(t):
    return t("pages").select("page_id", urls.host(F.col("url")).alias("host"), urls.identity(F.col("url")).alias("norm"))


@query(f"SELECT {_HOST} AS host, count(*) AS n FROM pages GROUP BY 1")
def pages_per_host(t):
    return t("pages").groupBy(urls.host(F.col("url")).alias("host")).agg(F.count("*").alias("n"))


@query("SELECT page_id, regexp_replace(trim(url), '/$', '') AS trimmed, starts_with(lower(url), 'http://') OR starts_with(lower(url), 'https://') AS is_http FROM pages")
def url_trim_slash(t):
    return t("pages").select("page_id", urls.trim_slash(F.col("url")).alias("trimmed"), urls.is_http(F.col("url")).alias("is_http"))


def _tokens(c: str, words: list[str]) -> str:
    return "(" + " OR ".join(f"contains(lower({c}), '{w}')" for w in words) + ")"


@query(f"SELECT page_id, {_tokens('html', fixed.BLOCKED_BODY_V1)} AS v1, {_tokens('html', fixed.BLOCKED_BODY_V15)} AS v15 FROM pages")
def blocked_pages(t):
    h = F.col("html")
    return t("pages").select("page_id", predicates.blocked_body(h, fixed.BLOCKED_BODY_V1).alias("v1"), predicates.blocked_body(h, fixed.BLOCKED_BODY_V15).alias("v15"))


@query(f"SELECT doc_id, {_norm('text')} AS k FROM documents")
def doc_norm_key(t):
    return t("documents").select("doc_id", tx.norm_key(F.col("text")).alias("k"))


_TR = f"translate(lower(text), '{fixed.SLUG_FROM}', '{fixed.SLUG_TO}')"


@query(f"SELECT doc_id, {_SLUG.format(c=_TR, n=80, d='x')} AS slug, {_SLUG.format(c='lower(text)', n=60, d='event')} AS slug_plain FROM documents")
def doc_slug(t):
    return t("documents").select("doc_id", tx.slug(F.col("text")).alias("slug"), tx.slug_plain(F.col("text")).alias("slug_plain"))


@query(f"SELECT doc_id, k_size FROM (SELECT doc_id, row_number() OVER (PARTITION BY {_norm('text')} ORDER BY doc_id) AS rn, count(*) OVER (PARTITION BY {_norm('text')}) AS k_size FROM documents) WHERE rn = 1")
def doc_dedup_first_wins(t):
    return t("documents").groupBy(tx.norm_key(F.col("text")).alias("k")).agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("k_size")).select("doc_id", "k_size")


def _doc_events(t) -> DataFrame:
    """Documents as event rows: text as title, language as venue, labels as confidence."""
    labels = t("labels").groupBy("doc_id").agg(F.max("quality").alias("q"), F.max("toxic").alias("x"))
    d = t("documents").join(labels, "doc_id", "left")
    confidence = F.when(F.col("x") == 1, "high").when(F.col("q") == 1, "medium").when(F.col("q") == 0, "low")
    none = F.lit(None).cast("string")
    return d.select(
        F.col("doc_id").cast("string").alias("id"), F.col("text").alias("title"), F.lit("2024-01-01").alias("date"), F.lit("lib").alias("venue_name"), F.lit("x").alias("venue_city"),
        F.lit("upcoming").alias("status"), confidence.alias("confidence"), F.array("lang").alias("categories"), F.array("source").alias("source_urls"),
        none.alias("time_start"), none.alias("time_end"), none.alias("ticket_url"), F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("p"), F.col("doc_id"))).alias("price"),
        F.col("text").alias("description"), F.col("doc_id").alias("pos"),
    )


_EVENTS = f"""SELECT d.doc_id AS pos, {_norm('text')} AS k, source, text, CASE WHEN x = 1 THEN 3 WHEN q = 1 THEN 2 WHEN q = 0 THEN 1 ELSE 0 END AS r,
  CASE WHEN d.doc_id % 3 = 0 THEN 'p' || d.doc_id END AS price FROM documents d LEFT JOIN (SELECT doc_id, max(quality) AS q, max(toxic) AS x FROM labels GROUP BY 1) l ON d.doc_id = l.doc_id"""
_PREC = f"""SELECT *, CASE WHEN r > coalesce(max(r) OVER (PARTITION BY k ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), -1) THEN 0 ELSE 1 END AS c FROM ({_EVENTS})"""
_ORDERED = f"SELECT *, row_number() OVER (PARTITION BY k ORDER BY c, CASE WHEN c = 0 THEN -pos ELSE pos END) AS o FROM ({_PREC})"


@query(f"""SELECT b.pos AS id, b.r AS rank, p.price, u.urls, u.n FROM ({_ORDERED}) b
  JOIN (SELECT k, string_agg(source, ',' ORDER BY o) AS urls, sum(n) AS n FROM (SELECT k, source, min(o) AS o, count(*) AS n FROM ({_ORDERED}) GROUP BY k, source) GROUP BY k) u ON b.k = u.k
  LEFT JOIN (SELECT k, arg_min(price, o) AS price FROM ({_ORDERED}) WHERE price IS NOT NULL GROUP BY k) p ON b.k = p.k WHERE b.o = 1""")
def doc_dedup_merge(t):
    d = dedup.dedup_merge(_doc_events(t))
    return d.select(F.col("id").cast("long").alias("id"), rank.event_confidence(F.coalesce("confidence", F.lit(""))).alias("rank"), "price", F.array_join("source_urls", ",").alias("urls"), F.col("n_merged").cast("long").alias("n"))


@query(f"SELECT min(pos) AS id, max(r) AS rank, count(*) AS n FROM ({_EVENTS}) GROUP BY k")
def doc_dedup_keep_first(t):
    d = dedup.dedup_first(_doc_events(t))
    return d.select(F.col("id").cast("long").alias("id"), rank.event_confidence(F.coalesce("confidence", F.lit(""))).alias("rank"), F.col("n_merged").cast("long").alias("n"))


@query(f"SELECT count(*) AS n_in, count(DISTINCT k) AS n_out, count(*) - count(DISTINCT k) AS merged FROM ({_EVENTS})")
def merged_count(t):
    d = _doc_events(t).groupBy(tx.norm_key(F.col("title")).alias("k")).agg(F.count("*").alias("n"))
    return d.agg(F.sum("n").alias("n_in"), F.count("*").alias("n_out"), (F.sum("n") - F.count("*")).alias("merged"))


_BASES = f"SELECT *, max(CASE WHEN c = 0 THEN pos END) OVER (PARTITION BY k ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS was FROM ({_PREC})"


@query(f"""SELECT kept_id, string_agg(m, ',' ORDER BY m) AS merged_from FROM (SELECT DISTINCT CASE WHEN c = 0 THEN pos ELSE was END AS kept_id,
  CAST(CASE WHEN c = 0 THEN was ELSE pos END AS VARCHAR) AS m FROM ({_BASES}) WHERE was IS NOT NULL) GROUP BY kept_id""")
def merge_log_by_kept(t):
    return dedup.merge_log(_doc_events(t)).select(F.col("kept_id").cast("long").alias("kept_id"), F.array_join("merged_from", ",").alias("merged_from"))


def _blocked_docs(t) -> DataFrame:
    """Documents to be paired: text as title, language as date, source as venue."""
    return t("documents").where("lang IS NOT NULL AND source IS NOT NULL").select(F.col("text").alias("title"), F.col("lang").alias("date"), F.col("source").alias("venue_name"), F.col("doc_id").alias("pos"))


_SHORT = f"SELECT doc_id AS pos, lang, {_norm('source')} AS v, {_norm('text')} AS k FROM documents"
_SIMILAR = "s <> '' AND contains(l, s) AND length(s) / length(l) >= 0.6"
_PAIRS = f"""SELECT p, q FROM (SELECT a.pos AS p, b.pos AS q, CASE WHEN length(a.k) <= length(b.k) THEN a.k ELSE b.k END AS s, CASE WHEN length(a.k) <= length(b.k) THEN b.k ELSE a.k END AS l
  FROM ({_SHORT}) a JOIN ({_SHORT}) b ON a.lang = b.lang AND a.v = b.v AND a.pos < b.pos) WHERE {_SIMILAR}"""


@query(f"SELECT p AS left_id, q AS right_id FROM ({_PAIRS})")
def keyed_pairs(t):
    return dedup.near_pairs(_blocked_docs(t)).select(F.col("left").alias("left_id"), F.col("right").alias("right_id"))


@query(f"SELECT pos AS doc_id, CASE WHEN pos IN (SELECT p FROM ({_PAIRS}) UNION SELECT q FROM ({_PAIRS})) THEN 1 ELSE r END AS rank FROM ({_EVENTS})")
def doc_near_dup_flag(t):
    return dedup.flag_near_dups(_doc_events(t), _blocked_docs(t)).select(F.col("pos").alias("doc_id"), rank.event_confidence(F.coalesce("confidence", F.lit(""))).alias("rank"))


@query("SELECT source, count(*) AS n, min(pos) AS first_id FROM (SELECT source, min(doc_id) AS pos FROM documents GROUP BY source, regexp_replace(lower(trim(text, ' ' || chr(9) || chr(10) || chr(13))), '\\s+', ' ', 'g')) GROUP BY source")
def v2_signature_dedup(t):
    d = t("documents").select(F.col("source").alias("source_id"), F.col("text").alias("title"), F.lit("d").alias("date"), F.lit("v").alias("venue_name"), F.array("source").alias("source_urls"), F.col("doc_id").alias("pos"))
    return dedup.dedup_by_signature(d).groupBy(F.col("source_id").alias("source")).agg(F.count("*").alias("n"), F.min("pos").alias("first_id"))


_TOLD = """SELECT doc_id, text FROM documents UNION ALL SELECT o_orderkey + 10000000, 'Order ' || o_orderkey || ' of ' || CASE o_orderkey % 4 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN strftime(o_orderdate, '%-d.%-m.%Y') || ' not 1.1.1999'
  WHEN 2 THEN '31.' || strftime(o_orderdate, '%m.%Y') ELSE strftime(o_orderdate, '%Y-%m') || '-31' END FROM orders"""


@query(
    f"""SELECT doc_id, strftime(d, '%Y-%m-%d') AS first_date FROM (SELECT doc_id, CASE WHEN tok LIKE '____-%' THEN TRY_CAST(tok AS DATE)
  WHEN tok <> '' THEN least(m + CAST(CAST(split_part(tok, '.', 1) AS INT) - 1 AS INT), last_day(m)) END AS d FROM
  (SELECT *, TRY_CAST(split_part(tok, '.', 3) || '-' || split_part(tok, '.', 2) || '-01' AS DATE) AS m FROM (SELECT doc_id, regexp_extract(text, '(\\d{{4}}-\\d{{2}}-\\d{{2}}|\\d{{1,2}}\\.\\d{{1,2}}\\.\\d{{4}})', 1) AS tok FROM ({_TOLD})))) WHERE d IS NOT NULL"""
)
def doc_dates(t):
    """The first date of documents, and of notes on orders; a day that a month lacks becomes its last, in dotted dates only."""
    o = t("orders")
    k, d = F.col("o_orderkey"), F.col("o_orderdate")
    told = (
        F.when(k % 4 == 0, F.date_format(d, "yyyy-MM-dd"))
        .when(k % 4 == 1, F.concat(F.date_format(d, "d.M.yyyy"), F.lit(" not 1.1.1999")))
        .when(k % 4 == 2, F.concat(F.lit("31."), F.date_format(d, "MM.yyyy")))
        .otherwise(F.concat(F.date_format(d, "yyyy-MM"), F.lit("-31")))
    )
    notes = t("documents").select("doc_id", "text").union(o.select(k + 10000000, F.concat(F.lit("Order "), k.cast("string"), F.lit(" of "), told)))
    return notes.select("doc_id", F.date_format(dt.lenient(dt.first_token(F.col("text"))), "yyyy-MM-dd").alias("first_date")).where("first_date IS NOT NULL")


_PIECES = "list_filter(list_transform(string_split(regexp_replace(regexp_replace(text, '\\s+', ' ', 'g'), '([.!?])\\s+', '\\1' || chr(1), 'g'), chr(1)), lambda x: trim(x)), lambda x: x <> '')"


@query(f"SELECT doc_id, n, chunk FROM (SELECT doc_id, unnest(range(len(p))) AS n, unnest(p) AS chunk FROM (SELECT doc_id, {_PIECES} AS p FROM documents)) WHERE length(chunk) >= 8 AND regexp_matches(chunk, '(2026|\\d{{1,2}}\\.\\d{{1,2}}\\.?)')")
def sentence_chunks(t):
    """Sentence pieces that may hold a date."""
    c = t("documents").select("doc_id", F.posexplode(tx.sentences(tx.squeeze(F.col("text")))).alias("n", "chunk"))
    return c.where(predicates.hopeful_chunk(F.col("chunk"))).select("doc_id", F.col("n").cast("long").alias("n"), "chunk")


@query("SELECT doc_id, CASE WHEN x = '' THEN 0 ELSE len(regexp_extract_all(x, '[.!?] ')) + 1 END AS n FROM (SELECT doc_id, trim(regexp_replace(coalesce(text, ''), '\\s+', ' ', 'g')) AS x FROM documents)")
def sentence_counts(t):
    """Sentences of each document; none in a null or blank one."""
    return t("documents").select("doc_id", F.size(tx.sentences(tx.squeeze(F.coalesce("text", F.lit(""))))).cast("long").alias("n"))


@query(
    f"""SELECT page, day, count(*) AS n FROM (SELECT o_custkey AS page, strftime(d, '%Y-%m-%d') AS day, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey, k) AS nth FROM
  (SELECT o_custkey, o_orderkey, k, CAST(o_orderdate AS DATE) + INTERVAL 25 YEAR + (3 * k) * INTERVAL 1 DAY AS d FROM orders, (SELECT unnest([0, 1]) AS k)) WHERE d BETWEEN DATE '2022-01-01' AND DATE '2022-04-01' AND year(d) = 2022) WHERE nth <= 15 GROUP BY ALL"""
)
def text_chunk_events(t):
    """Events of running text: one page a customer with a note an order, dates moved into the window's years."""
    day = F.to_date(F.add_months("o_orderdate", 300))
    note = F.concat(F.lit("Koncert "), F.col("o_orderkey").cast("string"), F.lit(" bude "), F.date_format(day, "d.M.yyyy"), F.lit(". Klub hlasi program! A dalsi "), F.date_format(F.date_add(day, 3), "yyyy-MM-dd"), F.lit("."))
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("o_orderkey", note.alias("note")))), lambda x: F.concat(F.lit("<p>"), x["note"], F.lit("</p>"))), "\n")
    pages = t("orders").groupBy("o_custkey").agg(body.alias("html")).select(F.col("o_custkey").cast("string").alias("source_id"), F.lit("Klub").alias("source_name"), F.col("o_custkey").cast("string").alias("url"), "html")
    e = extract.text_events(pages, F.lit("2022-01-01").cast("date"), year=2022)
    return e.groupBy(F.col("url").cast("long").alias("page"), F.col("date").alias("day")).agg(F.count("*").alias("n"))


@query(f"SELECT item_id, count(*) AS n FROM (SELECT item_id, {_norm('text')} AS s FROM benchmark) JOIN (SELECT {_norm('text')} AS l FROM documents) ON s <> '' AND contains(' ' || l || ' ', ' ' || s || ' ') GROUP BY item_id")
def benchmark_containment(t):
    """Documents that hold an item's words in a row: met by its first three words, then verified in the same row.

    The items are the small side; of a document's runs of words only those that begin an item leave its row.
    """
    b = t("benchmark").select("item_id", tx.norm_key(F.col("text")).alias("s")).where("s != ''")
    w = F.split("s", " ")
    size = F.least(F.lit(3), F.size(w))
    key = F.when(size == 3, F.xxhash64(w[0], w[1], w[2])).when(size == 2, F.xxhash64(w[0], w[1])).otherwise(F.xxhash64(w[0]))
    b = b.select("item_id", "s", size.alias("size"), key.alias("k"))
    known = b.select("size", "k").distinct().collect()

    def begun(words: Column, n: int) -> Column:
        """Those of a document's runs of n words that begin an item; runs over its end have fewer words, and are verified like all."""
        wanted = [r["k"] for r in known if r["size"] == n]
        shifted = F.arrays_zip(*[F.slice(words, j + 1, 2**30).alias(f"w{j}") for j in range(n)])
        return F.filter(F.transform(shifted, lambda x: F.xxhash64(*[x[f"w{j}"] for j in range(n)])), lambda k: k.isin(wanted))

    found = [begun(F.split("l", " "), n) for n in sorted({r["size"] for r in known})]
    hits = F.array_distinct(F.concat(F.array().cast("array<bigint>"), *found))
    near = t("documents").select(tx.norm_key(F.col("text")).alias("l")).select("l", F.explode(hits).alias("k")).join(F.broadcast(b), "k")
    padded = [F.concat(F.lit(" "), c, F.lit(" ")) for c in ("l", "s")]
    return near.where(F.contains(*padded)).groupBy("item_id").agg(F.count("*").alias("n"))


@query(f"SELECT doc_id, {_tokens('text', fixed.LINK_HINTS)} AS hint, {_tokens('text', fixed.LINK_VETOES)} AS veto FROM documents")
def token_hits(t):
    return t("documents").select("doc_id", tx.has_token(F.col("text"), fixed.LINK_HINTS).alias("hint"), tx.has_token(F.col("text"), fixed.LINK_VETOES).alias("veto"))


@query("SELECT n, doc_id FROM (SELECT doc_id, row_number() OVER (ORDER BY lang, lower(text), doc_id) AS n FROM documents) WHERE n <= 50")
def sort_top_titles(t):
    d = t("documents").select("doc_id", "lang", F.lower("text").alias("k")).orderBy("lang", "k", "doc_id").limit(50)
    return d.select(F.row_number().over(Window.orderBy("lang", "k", "doc_id")).cast("long").alias("n"), "doc_id")


@query("SELECT c_custkey, row_number() OVER (ORDER BY CAST(o_orderdate AS DATE), encode(c_name || o_orderpriority), o_orderkey) AS place FROM orders JOIN customer ON o_custkey = c_custkey")
def order_date_title(t):
    """Places by date and title; letters of a case differ, and bytes decide."""
    e = t("orders").join(t("customer"), F.col("o_custkey") == F.col("c_custkey")).select("c_custkey", "o_orderkey", F.to_date("o_orderdate").alias("date"), F.concat("c_name", "o_orderpriority").alias("title"))
    return places.placed(e, [F.col("date"), F.col("title"), F.col("o_orderkey")]).select("c_custkey", F.col("place").cast("long").alias("place"))


@query("SELECT doc_id, 'a' AS origin FROM documents WHERE contains(lower(text), 'the') UNION ALL SELECT doc_id, 'b' FROM documents WHERE contains(lower(text), 'der')")
def two_extractors_union(t):
    d = t("documents")
    a = d.where(F.contains(F.lower("text"), F.lit("the"))).select("doc_id", F.lit("a").alias("origin"))
    return a.unionByName(d.where(F.contains(F.lower("text"), F.lit("der"))).select("doc_id", F.lit("b").alias("origin")))


# catalogs


def _customer_events(t, part: int) -> DataFrame:
    """Customers of one parity as catalog rows; keys overlap, as names are cut."""
    c = t("customer").where(F.col("c_custkey") % 2 == part)
    none = F.lit(None).cast("string")
    confidence = F.when(F.col("c_acctbal") > 6000, "high").when(F.col("c_acctbal") > 2000, "medium").otherwise("low")
    return c.select(
        F.col("c_custkey").cast("string").alias("id"), F.format_string("n %d", F.floor(F.col("c_custkey") / 3)).alias("title"), F.lit("2024-05-01").alias("date"), F.lit("v").alias("venue_name"), F.lit("x").alias("venue_city"),
        F.when(F.col("c_custkey") % 7 == 0, "cancelled").otherwise("upcoming").alias("status"), confidence.alias("confidence"), F.array("c_mktsegment").alias("categories"), F.array("c_name").alias("source_urls"),
        none.alias("time_start"), none.alias("time_end"), none.alias("ticket_url"), F.when(F.col("c_custkey") % 5 == 0, F.col("c_name")).alias("price"), none.alias("description"), F.col("c_custkey").alias("pos"),
    )


_CUST = """SELECT c_custkey AS pos, c_custkey % 2 AS side, CAST(floor(c_custkey / 3) AS BIGINT) AS k, CASE WHEN c_acctbal > 6000 THEN 3 WHEN c_acctbal > 2000 THEN 2 ELSE 1 END AS r,
  c_custkey % 7 = 0 AS cancelled, c_mktsegment AS seg, CASE WHEN c_custkey % 5 = 0 THEN c_name END AS price FROM customer"""
_SIDE = f"SELECT *, CASE WHEN side = 0 THEN row_number() OVER (PARTITION BY k, side ORDER BY pos DESC) ELSE 1 END AS rn FROM ({_CUST})"
_FOLD = f"""SELECT k, arg_min(pos, side * 1000000000 + pos) AS id, max(r) AS rank, bool_or(cancelled) AS cancelled, count(DISTINCT seg) AS n_cat, count(*) AS n, min(side) = 1 AS added,
  arg_min(price, CASE WHEN price IS NULL THEN 4000000000 ELSE side * 1000000000 + pos END) AS price,
  arg_min(r, side * 1000000000 + pos) AS r0, arg_min(cancelled, side * 1000000000 + pos) AS c0 FROM ({_SIDE}) WHERE rn = 1 GROUP BY k"""


@query(f"SELECT id, rank, cancelled, n_cat, price FROM ({_FOLD}) UNION ALL SELECT pos, r, cancelled, 1, price FROM ({_SIDE}) WHERE rn > 1")
def catalog_upsert(t):
    out = merge.upsert_events(_customer_events(t, 0), _customer_events(t, 1))
    return out.select(F.col("id").cast("long").alias("id"), rank.event_confidence(F.col("confidence")).alias("rank"), (F.col("status") == "cancelled").alias("cancelled"), F.size("categories").cast("long").alias("n_cat"), "price")


@query(f"SELECT count(*) FILTER (added) AS added, count(*) FILTER (NOT added AND n > 1) AS updated, count(*) - count(*) FILTER (added) - count(*) FILTER (NOT added AND n > 1) + (SELECT count(*) FROM ({_SIDE}) WHERE rn > 1) AS unchanged FROM ({_FOLD})")
def upsert_counters(t):
    """Every merge changes a row here, as each customer brings a name of its own."""
    return merge.upsert_counters(merge.upsert_events(_customer_events(t, 0), _customer_events(t, 1)))


def _order_events(t) -> DataFrame:
    """Orders as catalog rows: a customer's orders of one day and priority are one event."""
    return t("orders").select(F.col("o_orderkey").alias("pos"), F.concat(F.lit("c "), F.col("o_custkey").cast("string")).alias("title"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"), F.col("o_orderstatus").alias("venue_name"))


@query("SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS n FROM orders WHERE CAST(o_orderdate AS DATE) < DATE '1996-06-15' GROUP BY 1")
def archive_past(t):
    return merge.split_past(_order_events(t), "1996-06-15")[1].groupBy("month").agg(F.count("*").alias("n"))


@query("""WITH p AS (SELECT strftime(o_orderdate, '%Y-%m') AS month, CAST(o_orderdate AS DATE) AS d, o_custkey AS c, lower(o_orderstatus) AS s, o_orderkey FROM orders WHERE CAST(o_orderdate AS DATE) < DATE '1996-06-15')
  SELECT month, count(DISTINCT (d, c, s)) AS n FROM p WHERE (month, d, c, s) NOT IN (SELECT (month, d, c, s) FROM p WHERE o_orderkey % 3 = 0) GROUP BY month""")
def archive_idempotent(t):
    """Past rows whose key the archive, here that of every third row, lacks."""
    past = merge.split_past(_order_events(t), "1996-06-15")[1]
    return merge.new_in_archive(past, past.where("pos % 3 = 0")).groupBy("month").agg(F.count("*").alias("n"))


@query("SELECT o_orderkey FROM orders WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1995-03-01' AND DATE '1995-03-01' + INTERVAL 90 DAY")
def window_90d(t):
    return t("orders").where(dt.in_window(F.to_date("o_orderdate"), F.lit("1995-03-01").cast("date"))).select("o_orderkey")


@query("SELECT o_orderkey, 'upcoming' AS status FROM orders WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1996-01-01' + INTERVAL 90 DAY UNION ALL SELECT o_orderkey, 'new' FROM orders WHERE o_orderstatus = 'P'")
def seed_carry_forward(t):
    o = t("orders")
    rows = o.select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"), F.lit("past").alias("status"))
    seeded = documents.carry_forward(rows, F.lit("1996-01-01").cast("date")).select("o_orderkey", "status")
    return seeded.unionByName(o.where("o_orderstatus = 'P'").select("o_orderkey", F.lit("new").alias("status")))


# reports over the event stream


def _failures(t) -> DataFrame:
    return t("events").where("event_type IN ('error', 'view')").select(F.col("user_id").alias("source_id"), F.col("event_type").alias("category"))


_FAIL = "SELECT user_id AS source_id, event_type AS category FROM events WHERE event_type IN ('error', 'view')"


@query(f"SELECT category, count(*) AS n FROM ({_FAIL}) GROUP BY 1")
def status_by_source(t):
    return report.failure_counts(_failures(t))


@query(f"SELECT source_id, category, count(*) AS n FROM ({_FAIL}) GROUP BY ALL")
def failure_matrix(t):
    return report.failure_matrix(_failures(t))


@query(f"SELECT source_id, '{{' || string_agg('\"' || category || '\":' || n, ',' ORDER BY category) || '}}' AS counts FROM (SELECT source_id, category, count(*) AS n FROM ({_FAIL}) GROUP BY ALL) GROUP BY source_id")
def failure_map(t):
    """Categories in order within each source's map."""
    return report.failure_map(_failures(t)).select("source_id", F.to_json("counts").alias("counts"))


_SOME = "SELECT CASE WHEN source_id % 10 > 0 THEN source_id END AS source_id FROM ({})".format


@query(f"SELECT CAST(source_id AS VARCHAR) AS source_id, count(*) AS n, false AS is_total FROM ({_SOME(_FAIL)}) GROUP BY 1 UNION ALL SELECT 'TOTAL', count(*), true FROM ({_FAIL})")
def failure_total(t):
    """Failures of no known source are a row of their own, not the total."""
    return report.with_total(_failures(t).select(F.when(F.col("source_id") % 10 > 0, F.col("source_id")).alias("source_id")), "source_id")


@query("""SELECT user_id AS source_id, count(DISTINCT CASE WHEN event_type = 'purchase' THEN props END) AS unique_events, count(*) AS visited_pages, count(*) FILTER (event_type = 'error') AS failures,
  epoch_us(max(ts) + INTERVAL 2 SECOND) // 1000 - epoch_us(min(ts)) // 1000 AS duration_ms FROM events GROUP BY user_id""")
def source_rollup(t):
    e = t("events")
    visits = e.select(F.col("user_id").alias("source_id"), (F.col("event_type") == "error").alias("failed"), F.col("ts").alias("started"), (F.col("ts") + F.expr("INTERVAL 2 SECONDS")).alias("ended"))
    found = e.where("event_type = 'purchase'").select(F.col("user_id").alias("source_id"), F.col("props").alias("id"))
    return report.source_metrics(visits, found)


@query("SELECT user_id, success, hit AND NOT success AS blocked, found FROM (SELECT user_id, bool_or(event_type = 'view') AS success, bool_or(event_type = 'error') AS hit, bool_or(event_type = 'purchase') AS found FROM events GROUP BY user_id)")
def source_outcomes(t):
    e = F.col("event_type")
    v = t("events").select(F.col("user_id").alias("source_id"), (e == "view").alias("ok"), (e == "error").alias("blocked"), (e == "purchase").alias("has_event"))
    return report.source_outcomes(v).select(F.col("source_id").alias("user_id"), "success", "blocked", F.col("has_event").alias("found"))


@query("SELECT user_id, CASE WHEN share >= 0.8 THEN 'missing_or_invalid_listing_paths' ELSE 'unknown_unreachable' END AS category FROM (SELECT user_id, avg(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS share FROM events GROUP BY user_id)")
def error_share_class(t):
    v = t("events").select(F.col("user_id").alias("source_id"), F.when(F.col("event_type") == "error", "404").otherwise("200").alias("status"), F.lit(False).alias("blocked"))
    return report.classify_sources(v).select(F.col("source_id").alias("user_id"), "category")


@query("SELECT user_id, string_agg(event_type, ',' ORDER BY ts, event_id) AS kinds FROM (SELECT user_id, event_type, arg_min(ts, (ts, event_id)) AS ts, arg_min(event_id, (ts, event_id)) AS event_id FROM events GROUP BY ALL) GROUP BY user_id")
def distinct_types_ordered(t):
    rows = F.array_sort(F.collect_list(F.struct("ts", "event_id", "event_type")))
    return t("events").groupBy("user_id").agg(F.array_join(F.array_distinct(F.transform(rows, lambda r: r["event_type"])), ",").alias("kinds"))


_RN = "row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id)"


@query(f"SELECT event_id FROM (SELECT event_id, {_RN} AS n FROM events) WHERE n <= 15")
def cap_per_source(t):
    return windows.cap(t("events"), ["user_id"], ["ts", "event_id"], 15).select("event_id")


@query("SELECT event_id FROM (SELECT event_id, coalesce(sum(CAST(floor(value) AS BIGINT)) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s FROM events) WHERE s < 100")
def running_total_stop(t):
    return windows.stop_at_total(t("events"), ["user_id"], ["ts", "event_id"], F.floor("value"), 100).select("event_id")


@query(
    f"""WITH a AS (SELECT *, {_RN} AS n, sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS seg FROM events),
  b AS (SELECT *, sum(CASE WHEN event_type IN ('error', 'view') THEN 1 ELSE 0 END) OVER (PARTITION BY user_id, seg ORDER BY n ROWS UNBOUNDED PRECEDING) AS s FROM a),
  c AS (SELECT user_id, min(n) AS stop FROM b WHERE s >= 3 AND event_type IN ('error', 'view') GROUP BY 1)
  SELECT b.event_id FROM b LEFT JOIN c ON b.user_id = c.user_id WHERE c.stop IS NULL OR b.n <= c.stop"""
)
def streak_stop(t):
    e = F.col("event_type")
    return windows.stop_at_streak(t("events"), ["user_id"], ["ts", "event_id"], e.isin("error", "view"), e == "purchase").select("event_id")


@query("SELECT s_suppkey, CAST((s_suppkey + 2) % 3 AS BIGINT) AS agent FROM supplier")
def round_robin_agent(t):
    return t("supplier").select("s_suppkey", windows.round_robin(F.col("s_suppkey"), F.lit(2), 3).alias("agent"))


@query("SELECT strftime(ts, '%Y-%m-%d') AS run, max(ts) AS at, arg_max(event_id, (ts, event_id)) AS event_id FROM events GROUP BY 1")
def latest_run(t):
    return t("events").groupBy(F.date_format("ts", "yyyy-MM-dd").alias("run")).agg(F.max("ts").alias("at"), F.max_by("event_id", F.struct("ts", "event_id")).alias("event_id"))


@query("SELECT s_suppkey, coalesce(n_name, '') AS name FROM supplier LEFT JOIN (SELECT n_nationkey, n_name FROM nation) ON s_nationkey = n_nationkey")
def name_lookup(t):
    """A source's name by its id, where the catalog has one."""
    names = documents.name_map(t("nation").select(F.col("n_nationkey").cast("string").alias("id"), F.col("n_name").alias("name"), F.col("n_nationkey").alias("pos")), t("nation").sparkSession)
    return t("supplier").join(names, F.col("s_nationkey").cast("string") == F.col("id"), "left").select("s_suppkey", F.coalesce("name", F.lit("")).alias("name"))


_DAYS = "SELECT user_id || '/' || strftime(ts, '%d') AS source, count(*) AS n, bool_or(event_type = 'purchase') AS success FROM events GROUP BY 1"


@query(f"SELECT source, n FROM ({_DAYS}) WHERE NOT success")
def unsuccessful_sources(t):
    """Sources, one for each user and day here, without a success."""
    source = F.concat(F.col("user_id").cast("string"), F.lit("/"), F.date_format("ts", "dd"))
    return report.unsuccessful(t("events").groupBy(source.alias("source")).agg(F.count("*").alias("n"), F.bool_or(F.col("event_type") == "purchase").alias("success"))).select("source", "n")


@query("""SELECT user_id, '| ' || user_id || ' | ' || name || ' | ' || n || ' | ' || CASE WHEN ok THEN 'true' ELSE 'false' END || ' |' AS line FROM (SELECT user_id, count(*) AS n, bool_or(event_type = 'purchase') AS ok,
  replace(min(event_type || '|' || event_type), '|', '\\|') AS name FROM events GROUP BY user_id)""")
def report_rows(t):
    e = F.col("event_type")
    rows = t("events").groupBy("user_id").agg(F.count("*").alias("n"), F.bool_or(e == "purchase").alias("ok"), F.min(F.concat(e, F.lit("|"), e)).alias("name"))
    return rows.select("user_id", report.table_row(*[report.cell(F.col(c)) for c in ("user_id", "name", "n", "ok")]).alias("line"))


def _ordered(name: str, sql_order: str, order: list[str]):
    """A report's order as places, since a result has none."""

    def f(t):
        e = t("events").groupBy("user_id").agg(F.count("*").alias("n"), F.max(F.when(F.col("event_type") == "purchase", F.col("event_id"))).alias("last"))
        return places.placed(e, [F.expr(o) for o in order]).select("user_id", F.col("place").cast("long").alias("place"))

    f.__name__ = name
    query(f"SELECT user_id, row_number() OVER (ORDER BY {sql_order}) AS place FROM (SELECT user_id, count(*) AS n, max(CASE WHEN event_type = 'purchase' THEN event_id END) AS last FROM events GROUP BY 1)")(f)


_ordered("order_by_id", "user_id", ["user_id"])
_ordered("order_index_nulls", "coalesce(last, 999999), user_id", ["coalesce(last, 999999)", "user_id"])
_ordered("order_count_desc", "n DESC, user_id", ["-n", "user_id"])
_ordered("order_key", "CAST(user_id AS STRING)", ["CAST(user_id AS STRING)"])


def _log(t) -> DataFrame:
    """A crawl log (n, value) with one source a user and one URL line an event; every seventh user has no start line."""
    e = t("events").withColumn("at", F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id")))
    total, u, kind = F.lit(100_000), F.col("user_id"), F.col("event_type")
    status = F.when(kind == "error", "404").when(kind == "signup", "403").otherwise("200")
    ident = F.concat(F.lit("src_"), u.cast("string"))
    visits = e.select((u * 100_000 + 10 + F.col("at")).alias("n"), F.concat(crawl_log.url_line(u, total, F.col("at"), F.lit(99), status, F.concat(F.lit("http://x/"), F.col("event_id"))), F.when(kind == "click", " blocked=true").otherwise("")).alias("value"))
    users = e.groupBy("user_id").agg(F.count("*").alias("v"), F.count_if(kind == "purchase").alias("found"))
    known = users.where("user_id % 7 != 0")
    name = F.concat(F.lit('a "b" '), u.cast("string"))
    start = known.select((u * 100_000).alias("n"), crawl_log.start_line(u, total, ident, name, F.col("v")).alias("value"))
    # a later start of the same place under another id takes no visits
    again = known.where("user_id % 5 = 0").select((u * 100_000 + 5).alias("n"), crawl_log.start_line(u, total, F.concat(ident, F.lit("_b")), F.lit("late"), F.lit(0)).alias("value"))
    ok = F.col("found") > 2
    done = known.where("user_id % 11 != 0").select((u * 100_000 + 99_999).alias("n"), crawl_log.done_line(u, total, ok, ~ok, F.col("found"), F.col("found"), ident).alias("value"))
    end = users.agg(F.count("*").alias("u"), F.sum("found").alias("f"), F.max("user_id").alias("m"))
    last = (F.col("m") + 1) * 100_000
    tail = end.select(last.alias("n"), crawl_log.totals_line(F.col("u"), F.col("u") - 1, F.lit(1), F.lit(0)).alias("value")).union(end.select(last + 1, crawl_log.events_line(F.lit(7), F.col("f"))))
    return visits.union(start).union(again).union(done).union(tail)


_STATUS = "CASE event_type WHEN 'error' THEN '404' WHEN 'signup' THEN '403' ELSE '200' END"


@query(f"SELECT 'src_' || user_id AS id, {_STATUS} AS status, count(*) AS n, count(*) FILTER (event_type = 'click') AS hits FROM events WHERE user_id % 7 <> 0 GROUP BY ALL")
def log_roundtrip(t):
    """Visits of sources that the log never started are dropped; of two starts of one place the first has them."""
    return crawl_log.visits_by_source(_log(t)).groupBy("id", "status").agg(F.count("*").alias("n"), F.count_if("blocked").alias("hits"))


_LOGGED = f"""WITH e AS (SELECT user_id AS u, event_type AS k, {_STATUS} AS s, {_RN} AS nth FROM events),
  st AS (SELECT u, string_agg(s, ', ' ORDER BY nth) AS statuses FROM (SELECT u, s, min(nth) AS nth FROM e GROUP BY ALL) GROUP BY u),
  a AS (SELECT u, count(*) FILTER (k = 'purchase') AS found, count(*) FILTER (k = 'click') AS hits, bool_or(s = '403') AS denied, avg(CASE WHEN s = '404' THEN 1.0 ELSE 0 END) AS share FROM e GROUP BY u),
  src AS (SELECT a.u AS "index", 'src_' || a.u AS id, 'a "b" ' || a.u AS name, CASE WHEN a.u % 11 <> 0 THEN found > 2 END AS success, CASE WHEN a.u % 11 <> 0 THEN found ELSE 0 END AS events, statuses, hits AS blocked_hits,
    CASE WHEN a.u % 11 <> 0 AND found <= 2 THEN CASE WHEN denied OR hits > 0 THEN 'access_blocked_or_rate_limited' WHEN share >= 0.8 THEN 'missing_or_invalid_listing_paths' ELSE 'unknown_unreachable' END END AS category
    FROM a JOIN st ON a.u = st.u WHERE a.u % 7 <> 0
    UNION ALL SELECT DISTINCT u, 'src_' || u || '_b', 'late', NULL, 0, '', 0, NULL FROM a WHERE u % 7 <> 0 AND u % 5 = 0)"""


@query(f"{_LOGGED} SELECT * FROM src")
def log_sources(t):
    """A log's sources, with what its start, URL and done lines say of each."""
    return crawl_log.sources(_log(t)).select("index", "id", "name", "success", "events", F.array_join("statuses", ", ").alias("statuses"), "blocked_hits", "category")


@query("SELECT count(DISTINCT user_id) AS attempted, count(DISTINCT user_id) - 1 AS successful, 1 AS blocked, 0 AS no_upcoming, count(*) FILTER (event_type = 'purchase') + 7 AS events, 7 AS existing, count(*) FILTER (event_type = 'purchase') AS new FROM events")
def log_totals(t):
    return crawl_log.totals(_log(t))


_MEANING = "CASE category " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in report.EXPLANATIONS.items()) + " ELSE '' END"


@query(
    f"""{_LOGGED}, bad AS (SELECT * FROM src WHERE NOT success), cat AS (SELECT category, count(*) AS n FROM bad GROUP BY 1)
  SELECT 1 AS section, '| ' || "index" || ' | ' || id || ' | ' || name || ' | ' || events || ' | ' || CASE WHEN success THEN 'true' WHEN NOT success THEN 'false' ELSE '' END || ' |' AS line FROM src
  UNION ALL SELECT 2, '## Unsuccessful Sources (' || count(*) || ')' FROM bad
  UNION ALL SELECT 3, '| ' || "index" || ' | ' || id || ' | ' || name || ' | ' || category || ' | ' || statuses || ' |' FROM bad
  UNION ALL SELECT 5, '| ' || category || ' | ' || n || ' |' FROM cat
  UNION ALL SELECT 7, '- ' || category || ': ' || {_MEANING} FROM cat"""
)
def stage1_report(t):
    """The report's lines that depend on its log, by section."""
    out = report.stage1_lines(crawl_log.sources(_log(t)), crawl_log.totals(_log(t)), "2024-01-01", "2024-01-02T00:00:00Z")
    return out.where("place.section IN (1, 3, 5, 7) OR line LIKE '## Uns%'").select(F.col("place.section").alias("section"), "line")


def _run(t) -> tuple[DataFrame, DataFrame]:
    """A run's metrics and failures: a source a user, a failure an error or view."""
    e = t("events")
    kind = F.when(F.col("event_type") == "error", "FETCH_ERROR").otherwise("TIMEOUT")
    failures = e.where("event_type IN ('error', 'view')").select(F.col("user_id").cast("string").alias("source_id"), kind.alias("category"), F.concat(F.lit("http://x/"), "event_id").alias("url"), F.concat(F.col("event_type"), F.lit("|x")).alias("message"), F.col("event_id").alias("pos"))
    failures = failures.where("source_id NOT LIKE '%3'")
    rows = e.groupBy("user_id").agg(F.count_if(F.col("event_type") == "purchase").alias("unique_events"), F.count("*").alias("visited_pages"), F.count_if(F.col("event_type").isin("error", "view")).alias("failures"))
    return rows.select(F.col("user_id").cast("string").alias("source_id"), F.concat(F.lit("S "), F.col("user_id")).alias("source_name"), F.lit("venue").alias("source_type"), "unique_events", "visited_pages", "failures", (F.col("visited_pages") * 10).alias("duration_ms"), F.col("user_id").alias("pos")), failures


_BAD = "SELECT CAST(user_id AS VARCHAR) AS source_id, CASE event_type WHEN 'error' THEN 'FETCH_ERROR' ELSE 'TIMEOUT' END AS category, 'http://x/' || event_id AS url, event_type || '\\|x' AS message FROM events WHERE event_type IN ('error', 'view') AND CAST(user_id AS VARCHAR) NOT LIKE '%3'"
_METRICS = "SELECT user_id, count(*) FILTER (event_type = 'purchase') AS e, count(*) AS v, count(*) FILTER (event_type IN ('error', 'view')) AS f FROM events GROUP BY user_id"


@query(
    f"""WITH bad AS ({_BAD}), m AS ({_METRICS}) SELECT 1 AS section, '| S ' || user_id || ' | ' || e || ' | ' || v || ' | ' || f || ' | ' || v * 10 || ' |' AS line FROM m
  UNION ALL SELECT 2, '| **TOTAL** | **' || sum(e) || '** | | **' || sum(f) || '** | |' FROM m
  UNION ALL SELECT 4, '| ' || category || ' | ' || count(*) || ' | ' || {_MEANING} || ' |' FROM bad GROUP BY category
  UNION ALL SELECT 6, '| ' || source_id || ' | ' || category || ' | ' || count(*) || ' |' FROM bad GROUP BY source_id, category
  UNION ALL SELECT 8, '| ' || source_id || ' | ' || category || ' | ' || url || ' | ' || message || ' |' FROM bad"""
)
def run_report(t):
    out = report.run_lines(*_run(t), "r", "2024-01-01", "now")
    return out.where("place.section IN (1, 4, 6, 8) OR line LIKE '%TOTAL%'").select(F.col("place.section").alias("section"), "line")


@query(
    f"""WITH bad AS ({_BAD}), m AS ({_METRICS}), s AS (SELECT CAST(user_id AS VARCHAR) AS report, * FROM m)
  SELECT report, unnest(['# Source Report: S ' || user_id, '**Source ID:** ' || user_id || '  ', '- **Unique events found:** ' || e, '- **Pages visited:** ' || v, '- **Duration:** ' || v * 10 || ' ms']) AS line FROM s
  UNION ALL SELECT report, 'No failures.' FROM s WHERE report NOT IN (SELECT source_id FROM bad)
  UNION ALL SELECT source_id, '| ' || category || ' | ' || count(*) || ' | ' || {_MEANING} || ' |' FROM bad GROUP BY source_id, category
  UNION ALL SELECT source_id, '| ' || category || ' | ' || url || ' | ' || message || ' |' FROM bad"""
)
def source_reports(t):
    """One report a source: its figures, failures by category, and each failure."""
    out = report.source_lines(*_run(t), "r", "2024-01-01")
    told = F.col("line").rlike(r"^(# Source|\*\*Source ID|- |No failures)") | F.col("place.section").isin(2, 4)
    return out.where(told).select("report", "line")


@query("SELECT conv_id, min(turn) AS first_turn, max(turn) AS last_turn, arg_min(role, turn) AS first_role, arg_max(role, turn) AS last_role FROM conversations GROUP BY conv_id")
def conv_turn_first(t):
    return t("conversations").groupBy("conv_id").agg(F.min("turn").alias("first_turn"), F.max("turn").alias("last_turn"), F.min_by("role", "turn").alias("first_role"), F.max_by("role", "turn").alias("last_role"))


@query("SELECT c_custkey, concat_ws(',', CASE WHEN c_acctbal < 0 THEN 'acctbal' END, CASE WHEN c_mktsegment = 'BUILDING' THEN 'mktsegment' END, CASE WHEN c_nationkey % 5 = 0 THEN 'nationkey' END) AS changed FROM customer")
def fields_changed(t):
    """What differs between a customer's row and a new one: balances below zero become null, a segment and some nations change."""
    c = F.col
    before = {"acctbal": c("c_acctbal"), "mktsegment": c("c_mktsegment"), "nationkey": c("c_nationkey"), "name": F.nullif(c("c_name"), c("c_name"))}
    after = {
        "acctbal": F.when(c("c_acctbal") >= 0, c("c_acctbal")), "mktsegment": F.when(c("c_mktsegment") == "BUILDING", "HOUSE").otherwise(c("c_mktsegment")),
        "nationkey": F.when(c("c_nationkey") % 5 == 0, -1).otherwise(c("c_nationkey")), "name": F.lit(None).cast("string"),
    }
    return t("customer").select("c_custkey", F.array_join(merge.changed_fields(before, after), ",").alias("changed"))


@query("""WITH e AS (SELECT 'c' || c_custkey AS url, 'n' || c_nationkey AS target FROM customer UNION ALL SELECT 'n' || n_nationkey, 'r' || n_regionkey FROM nation)
  SELECT depth, url, count(*) AS n FROM (SELECT c_custkey AS source, 0 AS depth, 'c' || c_custkey AS url FROM customer
  UNION ALL SELECT c_custkey, 1, 'n' || c_nationkey FROM customer
  UNION ALL SELECT c_custkey, 2, 'r' || n_regionkey FROM customer JOIN nation ON c_nationkey = n_nationkey) GROUP BY ALL""")
def bfs_crawl(t):
    c, n = t("customer"), t("nation")
    edges = c.select(F.concat(F.lit("c"), "c_custkey").alias("url"), F.concat(F.lit("n"), "c_nationkey").alias("target"), F.lit(0).alias("seq"))
    edges = edges.union(n.select(F.concat(F.lit("n"), "n_nationkey"), F.concat(F.lit("r"), "n_regionkey"), F.lit(0)))
    seeds = c.select(F.col("c_custkey").alias("source"), F.concat(F.lit("c"), "c_custkey").alias("url"), F.lit(0).alias("seq"))
    return graph.crawl(seeds, edges).groupBy("depth", "url").agg(F.count("*").alias("n"))


@query("SELECT doc_id, CASE quality WHEN 1 THEN 3 ELSE 1 END AS event_rank, CASE quality WHEN 1 THEN 2 ELSE 0 END AS source_rank FROM labels")
def rank_scales(t):
    c = F.when(F.col("quality") == 1, "high").otherwise("low")
    return t("labels").select("doc_id", rank.event_confidence(c).alias("event_rank"), rank.source_confidence(c).alias("source_rank"))


_PAGES80 = "SELECT nation, seq, 'c' || c AS url FROM (SELECT c_nationkey AS nation, c_custkey AS c, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) + 1 AS seq FROM customer)"


@query(f"SELECT * FROM ({_PAGES80}) WHERE seq <= 4 UNION ALL SELECT n_nationkey, 1, 'n' || n_nationkey FROM nation")
def bfs_page_cap(t):
    """A crawl of each nation's customers that ends after four pages."""
    c, n = t("customer"), t("nation")
    edges = c.select(F.concat(F.lit("n"), "c_nationkey").alias("url"), F.concat(F.lit("c"), "c_custkey").alias("target"), F.col("c_custkey").alias("seq"))
    edges = edges.union(c.select(F.concat(F.lit("c"), "c_custkey"), F.concat(F.lit("x"), "c_custkey"), F.lit(0)))
    seeds = n.select(F.col("n_nationkey").alias("source"), F.concat(F.lit("n"), "n_nationkey").alias("url"), F.lit(0).alias("seq"))
    out = graph.crawl(seeds, edges, max_pages=4).where("url NOT LIKE 'x%'")
    return out.select(F.col("source").alias("nation"), F.col("seq").cast("long").alias("seq"), "url")


def _raw(t) -> DataFrame:
    """Customers as event rows in JSON, with one fault or another."""
    k = F.col("c_custkey")
    event = F.struct(
        F.when(k % 6 != 0, k.cast("string")).alias("id"), F.lit("t").alias("title"), F.when(k % 5 == 0, "1.5.2026").otherwise("2026-05-01").alias("date"), F.lit("v").alias("venue_name"), F.lit("c").alias("venue_city"),
        F.when(k % 4 == 0, F.array().cast("array<string>")).otherwise(F.array("c_mktsegment")).alias("categories"), F.array("c_name").alias("source_urls"), F.when(k % 3 == 0, "done").otherwise("past").alias("status"), F.lit("low").alias("confidence"),
    )
    return t("customer").select(k.alias("pos"), F.when(k % 7 == 0, "[1]").otherwise(F.to_json(event)).alias("raw"))


_FAULTS = """SELECT pos, id, unnest(list_filter([CASE WHEN k % 7 = 0 THEN 'not a mapping' END, CASE WHEN k % 7 <> 0 AND k % 6 = 0 THEN 'missing: id' END, CASE WHEN k % 7 <> 0 AND k % 3 = 0 THEN 'invalid status' END,
  CASE WHEN k % 7 <> 0 AND k % 5 = 0 THEN 'invalid date' END, CASE WHEN k % 7 <> 0 AND k % 4 = 0 THEN 'no categories' END], lambda x: x IS NOT NULL)) AS error
  FROM (SELECT c_custkey AS pos, c_custkey AS k, CASE WHEN c_custkey % 7 = 0 OR c_custkey % 6 = 0 THEN 'index_' || (c_custkey + 1) ELSE CAST(c_custkey AS VARCHAR) END AS id FROM customer)
  UNION ALL SELECT NULL, NULL, 'wrong stage'"""


@query(_FAULTS)
def dq_report(t):
    """All messages about a document's rows and its envelope."""
    whole = t("region").limit(1).select(F.array(F.lit("wrong stage")).alias("errors"))
    return quality.report(_raw(t), whole)


@query(f"SELECT 'INVALID' AS verdict, count(*) AS n, 1 AS exit_status FROM ({_FAULTS}) UNION ALL SELECT 'VALID', (SELECT count(*) FROM customer WHERE gcd(c_custkey, 420) = 1), 0")
def dq_verdict(t):
    """The verdict on all rows, and on those without a fault."""
    whole = t("region").limit(1).select(F.array(F.lit("wrong stage")).alias("errors"))
    good = _raw(t).where(" AND ".join(f"pos % {k} != 0" for k in (3, 4, 5, 6, 7, 2)))
    n = good.count()
    return quality.verdict(quality.report(_raw(t), whole), F.lit(0)).union(quality.verdict(quality.report(good, whole.where("false")), F.lit(n).cast("long")))
