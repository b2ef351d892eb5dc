"""Scans, sinks, settings and the stream, on files of our own."""

import os
import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from almanac.functions import jsonld, urls
from almanac.operators import predicates, report
from almanac.sources import config, crawl_log, documents, fetch, sinks
from almanac.streaming import upsert
from tests.test_dedup import COLUMNS, events


def test_yaml_scan(spark, tmp_path):
    (tmp_path / "a.yaml").write_text("contract: x\nsources:\n- id: s1\n  active: 'true'\n  event_focus: rock\n- id: s2\n  active: true\n  event_focus: [a, b]\n  geo_coverage: {primary_city: B}\n")
    (tmp_path / "bad.yaml").write_text("{: [")
    rows = documents.typed_sources(documents.read_yaml(spark, str(tmp_path / "*.yaml"), "sources")).orderBy("pos").collect()
    assert [(r["id"], r["event_focus"], r["active"], r["geo_coverage"]) for r in rows] == [("s1", ["rock"], '"true"', ""), ("s2", ["a", "b"], "true", "B")]
    typed = documents.typed_sources(documents.read_yaml(spark, str(tmp_path / "*.yaml"), "sources"))
    assert [r["id"] for r in predicates.active_strict(typed).collect()] == ["s2"]
    assert sorted(r["id"] for r in predicates.active_lenient(typed).collect()) == ["s1", "s2"]


def test_snapshot_and_stage(spark, tmp_path):
    path = str(tmp_path / "catalog")
    for n in (1, 2):
        sinks.overwrite_with_snapshot(spark.range(n), path, f"run{n}")
    assert spark.read.parquet(path).count() == 2
    assert spark.read.parquet(f"{path}.snapshot/run_id=run2").count() == 1
    for run in ("r1", "r2", "r1"):
        sinks.write_stage(spark.range(3), str(tmp_path / "stage"), run)
    assert spark.read.parquet(str(tmp_path / "stage")).count() == 6


def test_yaml_dump(spark):
    text = sinks.to_yaml(spark.range(2), {"contract": "c"}, "events", ["id"])
    assert text == "---\ncontract: c\nevents:\n- id: 0\n- id: 1\n"
    with pytest.raises(ValueError):
        sinks.to_yaml(spark.range(3), {}, "events", ["id"], most=2)


def test_settings():
    assert config.check_run_id("2026-03-15_210847")
    with pytest.raises(ValueError):
        config.check_run_id("15.3.2026")
    assert config.labelled_run_id("a", datetime(2026, 3, 15, 1, 2, 3)) == "a_2026-03-15_010203"
    with pytest.raises(ValueError):
        config.CrawlConfig("x", max_pages=0)


class Answer:
    def __init__(self, status, body=b"", to=None):
        self.status, self.body, self.headers = status, body, {"Location": to} if to else {}

    def read(self):
        return self.body

    def __enter__(self):
        return self

    def __exit__(self, *args):
        return False


def web(pages, asked):
    def get(request, timeout):
        asked.append((request.full_url, request.get_header("User-agent"), timeout))
        page = pages[request.full_url]
        if isinstance(page, list):
            page = page.pop(0)
        if isinstance(page, Exception):
            raise page
        return page

    return get


def test_fetch_failures():
    calls, waits = [], []

    def broken(*a, **k):
        calls.append(1)
        raise OSError

    assert fetch.fetch_one("ftp://x", fetch.POLICIES["v1"])[1] == "bad_uri"
    assert fetch.fetch_one("http://x", fetch.POLICIES["v15"], broken, waits.append)[1] == "error"
    assert len(calls) == 3 and [w for w in waits if w] == pytest.approx([0.2, 0.4, 0.6])
    assert fetch.fetch_one("http://x", fetch.POLICIES["v1"], broken, waits.append)[1] == "error" and len(calls) == 4


def test_fetch_agents_and_redirects():
    asked = []
    pages = {"http://a/": Answer(302, to="/b"), "http://a/b": [OSError(), Answer(200, b"ok\xff")], "https://s/": Answer(301, to="http://s/"), "http://s/": Answer(200, b"plain"), "http://loop/": Answer(301, to="http://loop/")}
    body, status, url = fetch.fetch_one("http://a/", fetch.POLICIES["v15"], web(pages, asked), lambda s: None, seed=1)
    assert (body, status, url) == ("ok ", "200", "http://a/b")
    # agents go round; the new place has attempts of its own, from the next agent on
    assert [a for _, a, _ in asked] == [fetch.AGENTS[1], fetch.AGENTS[2], fetch.AGENTS[0]]
    pages["http://a/b"] = [OSError(), OSError(), Answer(200)]
    assert fetch.fetch_one("http://a/", fetch.POLICIES["v15"], web(pages, asked), lambda s: None)[1] == "error"
    assert fetch.fetch_one("https://s/", fetch.POLICIES["v1"], web(pages, asked), lambda s: None)[0] == "plain"
    assert fetch.fetch_one("https://s/", fetch.POLICIES["v2"], web(pages, asked), lambda s: None)[1] == "301"
    asked.clear()
    assert fetch.fetch_one("http://loop/", fetch.POLICIES["v2"], web(pages, asked), lambda s: None)[1] == "301" and len(asked) == 6


def test_delays_are_drawn_evenly():
    draw = random.Random(1)
    waits = [fetch.delay(fetch.POLICIES["v2"], draw) for _ in range(500)]
    assert 0.8 <= min(waits) < 0.85 and 2.15 < max(waits) <= 2.2 and abs(sum(waits) / 500 - 1.5) < 0.1
    assert {fetch.agent(fetch.POLICIES["v2"], 0, draw) for _ in range(50)} == set(fetch.AGENTS)
    assert fetch.delay(fetch.POLICIES["v1"], draw) == 0


def test_options():
    now = datetime(2026, 3, 15, 1, 2, 3)
    c = config.parse_options(["--maxDepth=1", "--sourceIds= a, ,b", "--maxDepth=7", "--runDate=2026-04-01", "--requestTimeoutSeconds=5"], now)
    assert (c.run_id, c.run_date, c.max_depth, c.source_ids, c.timeout_s, c.max_pages, c.min_delay_ms, c.max_delay_ms) == ("2026-03-15_010203", "2026-04-01", 1, ("a", "b"), 5, 80, 800, 2200)
    assert config.parse_options([], now).run_date == "2026-03-15"
    for bad in (["--nope=1"], ["maxDepth=1"], ["--maxDepth=x"], ["--minDelayMs=9000"]):
        with pytest.raises(ValueError):
            config.parse_options(bad, now)


def test_report_files(spark, tmp_path):
    metrics = spark.createDataFrame([("s1", "S|1", "venue", 3, 2, 1, 10, 0), ("s2", "S2", None, 0, 1, 0, 5, 1)], "source_id string, source_name string, source_type string, unique_events long, visited_pages long, failures long, duration_ms long, pos long")
    failures = spark.createDataFrame([("s1", "TIMEOUT", "http://x", "a|b", 0)], "source_id string, category string, url string, message string, pos long")
    path = str(tmp_path / "reports")
    sinks.write_reports(report.run_lines(metrics, failures, "r1", "2026-03-15", "now").unionByName(report.source_lines(metrics, failures, "r1", "2026-03-15")), path)
    texts = {r["report"]: r["value"] for r in spark.read.text(path, wholetext=True).select("report", "value").collect()}
    assert set(texts) == {"run", "s1", "s2"}
    assert texts["run"].startswith("# Run Summary: r1\n\n**Run date:** 2026-03-15  \n") and "| S\\|1 | 3 | 2 | 1 | 10 |\n| S2 | 0 | 1 | 0 | 5 |\n| **TOTAL** | **3** | | **1** | |\n\n## Failures" in texts["run"]
    assert "| s1 | TIMEOUT | http://x | a\\|b |" in texts["run"] and texts["s2"].rstrip().endswith("## Failures\n\nNo failures.")
    none = report.run_lines(metrics.limit(0), failures.limit(0), "r", "d", "now").where("line LIKE 'No fail%' OR line LIKE '%TOTAL%'").collect()
    assert sorted(r["line"] for r in none) == ["No failures recorded.", "| **TOTAL** | **0** | | **0** | |"]


def test_log_of_odd_lines(spark):
    lines = ['SOURCE_START index=1/2 remaining=1 id=a name="A" urls=1', 'SOURCE_START index=1/2 remaining=1 id=b name="B" urls=1', "SOURCE_URL index=1/2 url_index=1/1 status=200 x", "  SOURCE_DONE index=1/2 remaining=1 success=true blocked=false source_events=4 running_new_events=4 id=a  ",
             "SOURCE_DONE index=2/2 remaining=0 success=maybe blocked=false source_events=4 running_new_events=4 id=c", "attempted=2 successful=1 blocked=0 no_upcoming=1 and more", "events=5 (existing=1, new=4)"]
    log = spark.createDataFrame(list(enumerate(lines)), "n long, value string")
    assert [(r["id"], r["status"]) for r in crawl_log.visits_by_source(log).collect()] == [("a", "200")]
    got = {r["id"]: (r["index"], r["success"], r["events"], r["statuses"]) for r in crawl_log.sources(log).collect()}
    assert got == {"a": (1, True, 4, ["200"]), "b": (1, None, 0, [])}
    assert crawl_log.totals(log).first().asDict() == {"attempted": None, "successful": None, "blocked": None, "no_upcoming": None, "events": 5, "existing": 1, "new": 4}
    assert crawl_log.totals(log.limit(0)).count() == 1 and crawl_log.sources(log.limit(0)).count() == 0


def test_taxonomy_names_and_runs(spark, tmp_path):
    (tmp_path / "t.yaml").write_text("categories:\n  jazz: {label: Jazz}\n  rock: x\n")
    (tmp_path / "l.yaml").write_text("categories:\n- id: pop\n- id: pop\n- name: none\n")
    ids = [sorted(r["id"] for r in documents.taxonomy_ids(documents.read_yaml(spark, str(tmp_path / f), "categories")).collect()) for f in ("t.yaml", "l.yaml")]
    assert ids == [["jazz", "rock"], ["pop"]]
    assert documents.name_map(None, spark).count() == 0
    for k, run in enumerate(("r1", "r2", "r3")):
        (tmp_path / run).mkdir()
        (tmp_path / run / "stage.yaml").write_text("x")
        os.utime(tmp_path / run / "stage.yaml", (1000 + k, 1000 + k))
    assert documents.latest_run(spark, str(tmp_path / "r*" / "stage.yaml"), "r3").endswith("r2/stage.yaml")


def test_catalog_survives_a_crash(spark, tmp_path):
    path = str(tmp_path / "catalog")
    sinks.overwrite_with_snapshot(spark.range(1), path, "run1", "2026-03-15")
    assert sinks.last_updated(spark, path) == "2026-03-15" and spark.read.parquet(path).count() == 1
    spark.range(2).write.parquet(f"{path}.new")
    os.makedirs(f"{path}.snapshot")
    os.rename(path, f"{path}.snapshot/run_id=run2")  # stopped between the renames
    assert sinks.recover(spark, path) and spark.read.parquet(path).count() == 2
    sinks.overwrite_with_snapshot(spark.range(3), path, "run2")  # run again: its snapshot is still that of before
    assert spark.read.parquet(path).count() == 3 and spark.read.parquet(f"{path}.snapshot/run_id=run2").count() == 1
    os.rename(path, f"{path}.lost")
    assert sinks.recover(spark, path) and spark.read.parquet(path).count() == 1
    assert not sinks.recover(spark, str(tmp_path / "none")) and sinks.last_updated(spark, str(tmp_path / "none")) is None


def test_deep_json_is_no_event(spark):
    deep = "[" * 200_000 + "]" * 200_000
    t = spark.createDataFrame([(1, deep), (2, '{"@type":"Event","name":"A"}')], "id long, blob string")
    assert [(r["id"], r["n"]) for r in t.select("id", F.size(jsonld.events("blob")).alias("n")).orderBy("id").collect()] == [(1, 0), (2, 1)]


def test_resolved_urls(spark):
    from urllib.parse import urljoin

    bases = ["http://h/x/y", "https://h:8080/a/b/c?q#f", "http://h", "http://h/a/"]
    hrefs = ["/a", "b", "//k/z", "?q=1", "http://o/", "../c", "../../../c", "./d/./e/..", "#f", "mailto:a@b.c", " x ", "a/../b", "", ".", "..", "g;x=1/../y", "/../up"]
    t = spark.createDataFrame([(h, b) for h in hrefs for b in bases], "h string, b string")
    for r in t.withColumn("u", urls.resolve("h", "b")).collect():
        assert r["u"] == urljoin(r["b"], r["h"].strip()), r


def test_archive_append(spark, tmp_path):
    past = spark.createDataFrame(events([("Jazz", "2026-03-01", "low", [], None, None)]), COLUMNS).withColumn("month", F.lit("2026-03"))
    for _ in range(2):
        sinks.append_archive(past, str(tmp_path / "archive"))
    assert spark.read.parquet(str(tmp_path / "archive")).count() == 1


def test_stream(spark, tmp_path):
    src, catalog = str(tmp_path / "in"), str(tmp_path / "catalog")
    for batch in ([("Jazz", "2026-04-01", "low", ["a"], None, None)], [("jazz", "2026-04-01", "high", ["b"], None, None), ("Rock", "2020-01-01", "low", ["c"], None, None)]):
        spark.createDataFrame(events(batch), COLUMNS).write.mode("append").parquet(src)
        stream = spark.readStream.schema(COLUMNS).parquet(src)
        upsert.start_upsert(stream, catalog, str(tmp_path / "ck")).awaitTermination()
    got = {r["title"]: (r["confidence"], r["source_urls"]) for r in spark.read.parquet(catalog).collect()}
    assert got == {"Jazz": ("high", ["a", "b"]), "Rock": ("low", ["c"])}
