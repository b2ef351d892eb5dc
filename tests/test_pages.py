"""Pages built of short rows: dealt over the cores, and each value made once."""

import duckdb
import pytest
from pyspark.sql import functions as F

from almanac.functions import dates as dt
from almanac.functions import urls
from almanac.plans import derived, tables

SF = "/root/testdata/sf0.01"


@pytest.fixture
def reader(spark):
    return lambda name: spark.read.parquet(f"{SF}/{name}.parquet")


def same_as_sql(spark, module, name):
    con = duckdb.connect()
    for t in ("customer", "supplier", "pages", "documents", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got = sorted(map(tuple, module.QUERIES[name](spark, SF).collect()), key=repr)
    return got == sorted(con.execute(module.ORACLE_SQL[name]).fetchall(), key=repr)


def test_marked_pages_are_spread(spark, reader):
    """One file of customers is one task's; their pages are not, and no block is sorted or shuffled."""
    assert reader("customer").rdd.getNumPartitions() == 1
    assert derived._marked(reader).rdd.getNumPartitions() >= 4 * spark.sparkContext.defaultParallelism
    assert "Window" not in derived.QUERIES["marked_blocks"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert same_as_sql(spark, derived, "marked_blocks")


def test_first_date_is_first_of_all(spark):
    texts = ["", None, "none 12", "5.2.2024 and 2024-02-07", "1.1.2023, 3.2. or 4.3.2024", "12 januara, 9.9.2025", "7 marca 2024 30.2.2024", "1.1.2024 1.1.2024 2024/03/01"]
    t, start = spark.createDataFrame([(x,) for x in texts], "x string"), F.lit("2024-01-01").cast("date")
    for r in t.select(dt.first_v15(F.col("x"), start).alias("a"), F.get(dt.candidates_v15(F.col("x"), start), F.lit(0)).alias("b"), F.size(dt.candidates_v15(F.col("x"), start)).alias("n"), "x").collect():
        assert r["a"] == r["b"], r["x"]
    assert t.select(dt.candidates_v15(F.col("x"), start).alias("c")).where("c IS NULL").count() == 1


def test_listings_are_spread(spark, reader):
    made = tables._listings(reader)
    assert made.rdd.getNumPartitions() >= 4 * spark.sparkContext.defaultParallelism
    assert same_as_sql(spark, tables, "event_links") and same_as_sql(spark, tables, "link_candidates")


def test_references_by_parts_of_their_base(spark):
    """As the standard library has it, over bases with and without a path, and references of all kinds."""
    from urllib.parse import urljoin

    bases = ["https://a.b/c/d?q=1", "https://a.b", "https://a.b/", "https://a.b/c/../d/"]
    hrefs = ["x", "/x", "./x", "../x", "../../x/.", "/x/../y/./z", "x/..", "//h/p", "?k=2", "x?y=/../z", "http://o.p/./q", "x:y", "/x?u=a:b"]
    t = spark.createDataFrame([(b, h) for b in bases for h in hrefs], "b string, h string")
    for r in t.withColumn("u", urls.resolve("h", "b")).collect():
        assert r["u"] == urljoin(r["b"], r["h"]), r
    assert spark.createDataFrame([(None, "x"), ("https://a.b", None)], "b string, h string").where(urls.resolve("h", "b").isNotNull()).count() == 0
