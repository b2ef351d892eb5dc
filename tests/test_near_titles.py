"""Near titles: rows that share ids, titles that share passages, and the keys that they meet under."""

import random

import numpy as np
import pyarrow as pa

from almanac.functions import grams
from almanac.operators import dedup

COLUMNS = "title string, date string, venue_name string, pos long, confidence string"


def test_rows_that_share_an_id(spark):
    """Titles are told apart by their names; an id that two titles share pairs none of them with the other's rows."""
    rows = [("aaa", 1), ("zzz", 1), ("aaa", 2), ("long night of jazz", 3), ("the long night of jazz", 3), ("solo", 4), ("solo", 4)]
    df = spark.createDataFrame([(t, "d", "v", p, "high") for t, p in rows], COLUMNS)
    assert [tuple(r) for r in dedup.near_pairs(df).collect()] == [(1, 2)]
    assert {r["pos"] for r in dedup.flag_near_dups(df).where("confidence = 'low'").collect()} == {1, 2}


def test_no_title_in_what_names_are_met_by(spark):
    df = spark.createDataFrame([("night " * 500, "d", "v", k, "high") for k in range(3)], COLUMNS)
    kept = dedup._title_rows(df, 60)
    assert "title_norm" not in kept.columns
    assert kept.rdd.map(lambda r: len(str(r.asDict()))).max() < 1000


def test_parts_have_keys_of_their_whole():
    r = random.Random(5)
    for _ in range(400):
        n = r.choice([1, 2, 7, 8, 9, 31, 33, 50, 60, 200])
        whole = "".join(r.choice("ab é") for _ in range(n))
        size = r.randint(-(-60 * n // 100), n)
        at = r.randint(0, n - size)
        own, _, marks, _ = grams.keys_of(whole[at : at + size], 60)
        _, parts, _, seen = grams.keys_of(whole, 60)
        assert own in parts and set(marks) <= set(seen)


def test_strangers_with_a_common_passage_seldom_meet():
    """A third of each text is the same; of the pairs few have a key in common."""
    r = np.random.RandomState(3)
    word = lambda: "".join(r.choice(list("abcdefghijklmnop"), 7))
    common = " ".join(word() for _ in range(40))
    keys = [grams.keys_of(" ".join(word() for _ in range(40)) + " " + common + " " + " ".join(word() for _ in range(40)), 60) for _ in range(120)]
    met = sum(a is not b and a[0] in b[1] and set(a[2]) <= set(b[3]) for a in keys for b in keys)
    one = sum(a is not b and bool(set(a[2][:1]) & set(b[3])) for a in keys for b in keys)
    assert met < one / 4


def test_keys_are_made_in_arrow():
    out = grams.containment_keys(60).func(pa.array(["some long night", None, "", "x"]))
    assert isinstance(out, pa.StructArray) and out.field("own").null_count == 2 and len(out) == 4
