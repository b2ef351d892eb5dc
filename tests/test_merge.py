"""Sources folded as a stream against a plain fold of all rows, one after another."""

import random

from almanac.functions import urls
from almanac.operators import merge
from pyspark.sql import functions as F

COLUMNS = "pos long, id string, name string, homepage_url string, active string, confidence string, event_listing_urls array<string>, genre_tags array<string>, source_type string, languages array<string>"
NAMES = [c.split()[0] for c in COLUMNS.split(", ")]
RANK = {"low": 0, "medium": 1, "high": 2}


def sources(r, side, n):
    def url():
        return r.choice([None, "", f"https://H{r.randint(0, 14)}.sk/", f"https://h{r.randint(0, 14)}.sk", f"https://h{r.randint(0, 14)}.sk/e?x={side}"])

    def some(values):
        return r.choice([None, [r.choice(values) for _ in range(r.randint(0, 3))]])

    return [
        (k, f"{side}-{k}", r.choice([None, "", f"n{k}"]), url(), None, r.choice([None, "low", "medium", "high"]), some([url() for _ in range(3)]), some(["rock", "jazz", None]), r.choice([None, "venue"]), some(["sk"]))
        for k in range(n)
    ]


def plain(known, incoming, norm):
    """Every row looks at all URLs of all rows before it."""
    out, holders = [], {}
    for side, rows in ((0, known), (1, incoming)):
        for row in rows:
            row = dict(zip(NAMES, row, strict=True))
            own = [norm[u] for u in [row["homepage_url"], *(row["event_listing_urls"] or [])] if norm.get(u) is not None]
            at = next((holders[u] for u in own if u in holders), None) if side else None
            if at is None:
                at = len(out)
                out.append(row | {"changes": []})
            else:
                base, changes = out[at], set()
                if RANK.get(row["confidence"], -1) > RANK.get(base["confidence"], -1):
                    base["confidence"] = row["confidence"]
                    changes.add("confidence")
                for f in ("event_listing_urls", "genre_tags"):
                    union = list(dict.fromkeys(x for x in (base[f] or []) + (row[f] or []) if x is not None))
                    if len(union) > len(base[f] or []):
                        base[f] = union
                        changes.add(f)
                if not (base["homepage_url"] or "").strip() and (row["homepage_url"] or "").strip():
                    base["homepage_url"] = row["homepage_url"]
                    changes.add("homepage_url")
                for f in ("name", "source_type", "languages", "active"):
                    if row[f] is not None and not base[f]:
                        base[f] = row[f]
                        changes.add(f)
                if changes:
                    base["changes"] = [*base["changes"], ",".join(sorted(changes))]
            for u in (out[at]["homepage_url"], *(out[at]["event_listing_urls"] or [])):
                if norm.get(u) is not None:
                    holders.setdefault(norm[u], at)
    return sorted((x["id"], *(x[c] for c in NAMES[2:]), x["changes"]) for x in out)


def test_stream_equals_plain_fold(spark):
    """Links of all kinds, among them sources without a list of listings, which stopped the fold before."""
    for seed in range(4):
        r = random.Random(seed)
        known, incoming = sources(r, "k", 12), sources(r, "i", 25)
        every = {u for row in known + incoming for u in [row[3], *(row[6] or [])]}
        norm = {x["u"]: x["n"] for x in spark.createDataFrame([(u,) for u in every], "u string").select("u", urls.identity(F.col("u")).alias("n")).collect()}
        got = merge.merge_sources(spark.createDataFrame(known, COLUMNS), spark.createDataFrame(incoming, COLUMNS))
        got = sorted(((*x,) for x in got.select(*NAMES[1:], "changes").collect()), key=repr)
        assert got == sorted(plain(known, incoming, norm), key=repr), seed
