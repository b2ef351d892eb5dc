"""The closed form of the merge against a fold in input order."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from almanac.operators import dedup, merge, places

COLUMNS = "id string, title string, date string, venue_name string, venue_city string, status string, confidence string, categories array<string>, source_urls array<string>, time_start string, time_end string, ticket_url string, price string, description string, pos long"
RANK = {"low": 1, "medium": 2, "high": 3}

row = st.tuples(
    st.sampled_from(["Jazz!", "jazz", "Rock"]), st.sampled_from(["2026-04-01", "2026-04-02"]), st.sampled_from(["low", "medium", "high", "?", None]),
    st.lists(st.sampled_from("abc"), max_size=2, unique=True), st.sampled_from([None, "", " ", "€7", "€9"]), st.sampled_from([None, "", "x", "longer", "other!"]),
)


def events(rows):
    return [(f"e{i}", t, d, "Hall", "B", "upcoming", c, u, u, None, None, None, p, x, i) for i, (t, d, c, u, p, x) in enumerate(rows)]


def blank(v):
    return v is None or not v.strip()


def absorb(base, new):
    if RANK.get(new["confidence"], 0) > RANK.get(base["confidence"], 0):
        base["confidence"] = new["confidence"]
    for f in ("categories", "source_urls"):
        base[f] = list(dict.fromkeys(base[f] + new[f]))
    if blank(base["price"]) and not blank(new["price"]):
        base["price"] = new["price"]
    a, b = (base["description"] or "").strip(), (new["description"] or "").strip()
    if b and len(b) > len(a):
        base["description"] = new["description"]


def fold(rows, switch):
    kept = {}
    for r in rows:
        r = dict(zip([c.split()[0] for c in COLUMNS.split(", ")], r, strict=True))
        key = (r["title"].lower().strip("!"), r["date"])
        if key not in kept:
            kept[key] = r
        elif switch and RANK.get(r["confidence"], 0) > RANK.get(kept[key]["confidence"], 0):
            absorb(r, kept[key])
            kept[key] = r
        else:
            absorb(kept[key], r)
    return sorted((r["id"], r["confidence"], r["categories"], r["source_urls"], r["price"], r["description"]) for r in kept.values())


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(row, max_size=14))
def test_merge_equals_fold(spark, rows):
    df = spark.createDataFrame(events(rows), COLUMNS)
    got = dedup.dedup_merge(df).select("id", "confidence", "categories", "source_urls", "price", "description").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(fold(events(rows), True), key=repr)


def test_first_stays_base(spark):
    rows = events([("Jazz", "2026-04-01", "low", ["a"], None, None), ("jazz!", "2026-04-01", "high", ["b"], "€7", "x")])
    r = dedup.dedup_first(spark.createDataFrame(rows, COLUMNS)).first()
    assert (r["id"], r["confidence"], r["source_urls"], r["price"], r["description"]) == ("e0", "high", ["a", "b"], None, "x")


def test_upsert_twice_adds_nothing(spark):
    a = spark.createDataFrame(events([("Jazz", "2026-04-01", "low", ["a"], None, None), ("JAZZ", "2026-04-01", "low", ["z"], None, None)]), COLUMNS)
    b = spark.createDataFrame(events([("jazz", "2026-04-01", "high", ["b"], "€7", "x"), ("Rock", "2026-04-02", "low", ["c"], None, None)]), COLUMNS)
    out = merge.upsert_events(a, b)
    assert merge.upsert_counters(out).first().asDict() == {"added": 1, "updated": 1, "unchanged": 1}
    # the last of rows that share a key takes part
    assert sorted(r["id"] for r in out.where("changed").collect()) == ["e1"]
    again = merge.upsert_events(out.withColumn("pos", F.col("at.p")).select(*a.columns), b)
    assert merge.upsert_counters(again).first()["added"] == 0


def test_archive_once(spark):
    a = spark.createDataFrame(events([("Jazz", "2026-03-01", "low", [], None, None), ("Rock", "2026-04-02", "low", [], None, None), ("Pop", "bad", "low", [], None, None)]), COLUMNS)
    active, past = merge.split_past(a, "2026-03-15")
    assert sorted(r["title"] for r in active.collect()) == ["Pop", "Rock"]
    assert merge.new_in_archive(past, past).count() == 0
    assert merge.new_in_archive(past, past.limit(0)).count() == 1


def similar(a, b):
    s, t = sorted((a, b), key=len)
    return s != "" and s in t and len(s) / len(t) >= 0.6


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.text("ab ", max_size=22), st.sampled_from("xy")), max_size=16))
def test_near_pairs_equal_all_pairs(spark, rows):
    rows = [*rows, ("the long night of jazz", "x"), ("long night of jazz", "x"), ("ong night of jaz", "x"), ("night of", "x"), ("abcdefg", "y"), ("abcdefgh", "y"), ("abcdefghijkl", "y")]
    df = spark.createDataFrame([(t, d, "v", i, "high") for i, (t, d) in enumerate(rows)], "title string, date string, venue_name string, pos long, confidence string")
    norm = [" ".join(t.split()) for t, _ in rows]
    want = {(i, j) for i in range(len(rows)) for j in range(i + 1, len(rows)) if rows[i][1] == rows[j][1] and similar(norm[i], norm[j])}
    assert sorted(map(tuple, dedup.near_pairs(df).collect())) == sorted(want)
    low = {r["pos"] for r in dedup.flag_near_dups(df).where("confidence = 'low'").collect()}
    assert low == {x for p in want for x in p}


def test_places(spark):
    df = spark.range(1000).selectExpr("id", "pmod(xxhash64(id), 50) AS k")
    got = places.placed(df, [F.desc("k"), F.col("id")]).collect()
    order = sorted(got, key=lambda r: (-r["k"], r["id"]))
    assert [r["place"] for r in order] == list(range(1, 1001))
    assert places.placed(df.limit(0), [F.col("id")]).count() == 0


def test_empty(spark):
    none = spark.createDataFrame([], COLUMNS)
    assert dedup.dedup_merge(none).count() == 0
    assert dedup.flag_near_dups(none).count() == 0
    assert merge.upsert_events(none, none).count() == 0
