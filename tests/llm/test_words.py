"""Operators on words and lines against brute force."""

import hashlib
import re
from collections import Counter

import pytest

from almanac.llm import decontaminate, license_scan, line_dedup, near_dup, substring_dedup
from tests.llm.conftest import frame

ALNUM = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
NONSPACE = re.compile("[^\x20\x09-\x0d]+")


def low(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def sha(t):
    return hashlib.sha256(t.encode()).hexdigest()


def test_license_scan(spark, docs, none, rows):
    notes = [
        (200, "Licensed under CC BY-NC 4.0."), (201, "x cc by cc by y"), (202, "This work is licensed under the GNU General Public License, version 3."), (203, "All Rights\nReserved"),
        (204, "released the license"), (205, "word " * 70 + "Released under the MIT License. " + "word " * 70), (200, None), (None, "all rights reserved"), (206, "licensed under apache license version 2 0"),
        (207, " * Redistribution and use in source and binary forms, with or without\n * modification, are permitted provided"), (208, "# Subject to the terms of the Mozilla\n# Public License, v. 2.0."), (209, "w " * 33 + "Released under\nthe MIT\n\nLicense"),
    ]
    everything = rows + notes
    got = license_scan.license_scan(frame(spark, everything)).collect()
    want = []
    for i, t in everything:
        w, places, base, more, best = ALNUM.findall(low(t)), [], set(), set(), 0.0
        for phrase, label in license_scan.PHRASES.items():
            p = phrase.split()
            at = [k for k in range(len(w)) if w[k : k + len(p)] == p]
            places += at
            base |= {label} if at else set()
        for b in [w[k : k + 40] for k in range(0, max(len(w) - 20, 1), 20)]:
            for label, words in license_scan.TEMPLATES:
                s = set(words.split())
                if 10 * len(s & set(b)) >= 8 * len(s):
                    more.add(label)
                    best = max(best, len(s & set(b)) / len(s))
        want.append((i, len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)), ",".join(sorted(base | more)), 1.0 if base else best))
    assert Counter(map(tuple, got)) == Counter(want)
    assert {i: x[6] for x in want if (i := x[0]) in (205, 207, 208, 209)} == {205: "mit", 207: "bsd", 208: "mpl", 209: "mit"}
    assert license_scan.license_scan(none).count() == 0


def test_license_scan_is_native(docs):
    plan = license_scan.license_scan(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_decontaminate(spark, docs, none, rows):
    passage = next(t for i, t in rows if t and len(t.split()) > 80)
    items = [(1, " ".join(passage.split()[5:30])), (2, "la la la"), (3, ""), (4, None), (None, "ab"), (5, " ".join(passage.split()[20:29])), (6, "AB!"), (1, "zu zu")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    windows = {}
    for n, t in items:
        w = ALNUM.findall(low(t))
        if w and n is not None:
            k = min(8, len(w))
            for a in range(len(w) - k + 1):
                windows.setdefault(tuple(w[a : a + k]), set()).add(str(n))
    want = []
    for i, t in rows:
        w = ALNUM.findall(low(t))
        hit, found = [False] * len(w), set()
        for k in {len(x) for x in windows}:
            for a in range(len(w) - k + 1):
                if names := windows.get(tuple(w[a : a + k])):
                    found |= names
                    hit[a : a + k] = [True] * k
        want.append((i, len(w), sum(hit), tuple(sorted(found))))
    for block in (decontaminate.BLOCK_WORDS, 12):
        old, decontaminate.BLOCK_WORDS = decontaminate.BLOCK_WORDS, block
        got = decontaminate.scan(docs, bench).collect()
        decontaminate.BLOCK_WORDS = old
        assert Counter((r["doc_id"], r["n_words"], sum(s["last"] - s["first"] + 1 for s in r["hit_spans"]), tuple(r["hit_items"])) for r in got) == Counter(want)
    assert decontaminate.scan(none, bench).count() == 0
    out = decontaminate.decontaminate(docs, bench, max_items=99, max_coverage=1.0)
    assert out.columns == docs.columns
    texts = {r["doc_id"]: r for r in out.collect()}
    for i, n, h, _ in want:
        assert len(ALNUM.findall(low(texts[i]["text"]))) == n - h
        assert (texts[i]["n_chars"] or 0) == len(texts[i]["text"] or "")
    assert Counter(r["text"] for r in decontaminate.decontaminate(docs, bench.limit(0)).collect()) == Counter(t for _, t in rows)


@pytest.mark.parametrize("window", [13, 10])
def test_substring_dedup(docs, none, rows, window):
    smallest = {}
    for i, t in rows:
        w = NONSPACE.findall(t or "")
        for a in range(len(w) - window + 1):
            k = tuple(w[a : a + window])
            smallest[k] = min(i, smallest.get(k, i))
    want = []
    for i, t in rows:
        w = NONSPACE.findall(t or "")
        gone = [False] * len(w)
        for a in range(len(w) - window + 1):
            if smallest[tuple(w[a : a + window])] < i:
                gone[a : a + window] = [True] * window
        want.append((i, len(w), sum(gone), sha(" ".join(x for x, g in zip(w, gone, strict=True) if not g))))
    got = substring_dedup.substring_dedup(docs, window).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
    assert Counter(map(tuple, got)) == Counter(want)
    assert sum(x[2] for x in want) > 100
    assert substring_dedup.substring_dedup(none).count() == 0


def test_high_symbols():
    """Equal passages have equal symbols inside, and these alone settle long repeats."""
    import random

    import numpy as np
    import pyarrow as pa
    import zstandard

    r = random.Random(1)
    passage = [f"p{r.randint(0, 300)}" for _ in range(400)]
    texts = [[f"{k}{r.randint(0, 300)}" for _ in range(30 + k)] + passage + [f"{k}end{j}" for j in range(25)] for k in range(3)]
    words = {w: k for k, w in enumerate(sorted({w for t in texts for w in t}))}
    symbols = []
    for t in texts:
        w = substring_dedup.tn.mix(np.array([words[x] for x in t], np.uint64) + np.uint64(1))
        name, start, end = substring_dedup.high_symbols(w, np.array([0, len(w)]), substring_dedup.LEVELS)
        assert start[0] == 0 and end[-1] == len(w) and (start[1:] == end[:-1]).all()
        symbols.append({(int(n), tuple(t[a:b])) for n, a, b in zip(name, start, end, strict=True) if b - a > 3})
    shared = symbols[0] & symbols[1] & symbols[2]
    assert sum(len(x) for _, x in shared) > 200
    raw = [" ".join(t).encode() for t in texts]
    off = np.cumsum([0] + [len(x) for x in raw])
    batch = pa.table({"batch": [0], "ids": [[0, 1, 2]], "sizes": [np.diff(off).tobytes()], "texts": [zstandard.compress(b"".join(raw))], "notes": [b""]})
    _, _, _, _, first, w = substring_dedup._words(batch)
    pairs = np.unique(substring_dedup._pairs(w, first)[0])  # as if every pair were shared
    held = substring_dedup._Held(batch, 13, pa.table({"batch": [0], "names": [substring_dedup.ex.encode(pairs)]}))
    held.settle(pa.table({"batch": pa.array([], pa.int64()), "names": pa.array([], pa.binary())}))
    of = Counter((np.searchsorted(first, held.settled, side="right") - 1).tolist())
    assert set(of) == {1, 2} and all(200 < n <= 388 for n in of.values())
    assert not set(held.settled.tolist()) & set(held.at.tolist())


def shingles(t, n):
    w = NONSPACE.findall(low(t))
    return frozenset(tuple(w[a : a + n]) for a in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])


def brute_components(rows, n):
    sets = {i: shingles(t, n) for i, t in rows}
    label = {i: i for i in sets}
    ids = sorted(sets)
    links = [(a, b) for a in ids for b in ids if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    while True:
        changed = False
        for a, b in links:
            m = min(label[a], label[b])
            changed |= label[a] != m or label[b] != m
            label[a] = label[b] = m
        if not changed:
            return sets, label


@pytest.mark.parametrize("n", [4, 5])
def test_near_dup(spark, none, n):
    import random

    r = random.Random(n)
    base = [[f"w{r.randint(0, 400)}" for _ in range(120)] for _ in range(6)]
    rows = []
    for i in range(150):
        w = list(r.choice(base))
        for _ in range(r.choice([0, 0, 1, 2, 3, 5, 9])):
            w[r.randrange(len(w))] = f"e{r.randint(0, 9999)}"
        rows.append((1000 - i, " ".join(w)))
    rows += [(1, None), (2, ""), (3, "a b"), (4, "A  b"), (5, "a b c"), (6, " \t"), (7, "one two three four five six"), (8, "ONE two three four five six")]
    sets, label = brute_components(rows, n)
    want = sorted((i, len(sets[i]), label[i], label[i] == i) for i, _ in rows)
    assert sorted(map(tuple, near_dup.near_dup(frame(spark, rows), n).collect())) == want
    kept = near_dup.near_dedup(frame(spark, rows), n)
    assert kept.columns == frame(spark, []).columns
    assert sorted(x["doc_id"] for x in kept.collect()) == sorted({label[i] for i, _ in rows})
    if n == 4:
        assert near_dup.near_dup(none).count() == 0
        odd = near_dup.near_dup(frame(spark, [(None, "x y z q r"), (9, "x y z q r"), (9, "x y z q r")])).collect()
        assert sorted((x["doc_id"], x["kept"]) for x in odd if x["doc_id"]) == [(9, True), (9, True)] and len(odd) == 3


def test_long_lists_are_divided(spark, monkeypatch):
    """Lists of more than a few members are divided by a second coordinate, and blocks split what is left: the links are the same."""
    import random

    monkeypatch.setattr(near_dup, "BLOCK", 3)
    r = random.Random(8)
    base = [[f"w{r.randint(0, 60)}" for _ in range(60)] for _ in range(2)]
    rows = []
    for i in range(70):
        w = list(base[i % 2])
        for _ in range(r.choice([0, 1, 2, 3, 4, 6])):
            w[r.randrange(len(w))] = f"e{r.randint(0, 9999)}"
        rows.append((i, " ".join(w)))
    sets, label = brute_components(rows, 4)
    got = near_dup.near_dup(frame(spark, rows), 4).collect()
    assert sorted((x["doc_id"], x["component_id"]) for x in got) == sorted((i, label[i]) for i, _ in rows)
    assert 3 < len(set(label.values())) < 60


def test_prefixes_skip_long_lists():
    """A class is posted in its rarest lists of several members, and two classes with enough matches meet in one."""
    import numpy as np
    import pyarrow as pa

    r, k = np.random.RandomState(3), near_dup.COORDINATES
    least = near_dup.least_matches(80)
    a = r.randint(0, 1 << 31, k).astype(np.uint32)
    b = a.copy()
    b[: k - least] = r.randint(0, 1 << 31, k - least)
    chunk = pa.table({"batch": [0], "reps": [np.array([1, 2], np.int64).tobytes()], "sigs": [np.concatenate((a, b)).tobytes()]})
    keys = near_dup._keys(np.stack((a, b)))
    names = near_dup.tn.mix(keys)
    both = np.flatnonzero(keys[0] == keys[1])
    count = {int(names[0][c]): 2 if j < 5 else 1000 + j for j, c in enumerate(both.tolist())}
    listed = np.array(sorted(count), np.uint64)
    got = pa.table({"batch": [0], "names": [near_dup.ex.encode(listed, np.array([count[int(x)] for x in listed], np.uint64))]})
    posts = near_dup._post(least)(chunk, got).to_pydict()
    lists = {rep: {key for key, x in zip(posts["key"], posts["rep"], strict=True) if x == rep} for rep in (1, 2)}
    # the coordinates that differ are the rarest and have no other member; one place is left, for the shortest list that both are in
    assert lists[1] == lists[2] and len(lists[1]) == 1 and lists[1] < {int(keys[0][c]) for c in both[:5].tolist()}


def test_checkpoints_leave_no_shuffle_files(spark):
    """What op6 has written to the shared folder needs no shuffle files, and they go at once."""
    import time
    from pathlib import Path

    from almanac.operators import lineage

    top = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    left = lambda: {str(f) for d in top for f in Path(d).rglob("shuffle_*.data")}
    before, setting = left(), spark.conf.get(lineage.CLEANUP)
    rows = spark.range(5000).selectExpr("id % 700 AS k", "id").groupBy("k").count()
    both = rows.join(spark.range(700).withColumnRenamed("id", "k").hint("merge"), "k")
    made = near_dup.checkpoint(both)
    until = time.time() + 20
    while left() - before and time.time() < until:
        time.sleep(0.2)
    assert not left() - before
    assert spark.conf.get(lineage.CLEANUP) == setting
    # the frame and the one that it was made from are whole, also when they are read again
    assert sorted(made.collect()) == sorted(both.collect()) and made.count() == 700


def test_near_dup_repeated_ids(spark):
    """Different texts under one doc_id are judged each for itself, and of equal ones one stays."""
    a = [f"a{k}" for k in range(60)]
    near, far, other = " ".join([*a[:-1], "end"]), " ".join(f"z{k}" for k in range(40)), " ".join(f"y{k}" for k in range(40))
    a = " ".join(a)
    rows = [(3, a), (5, near), (5, far), (7, other), (7, other), (8, far + " more"), (9, ""), (9, ""), (None, other)]
    got = near_dup.near_dup(frame(spark, rows)).where("doc_id < 9").select("doc_id", "component_id", "kept").collect()
    assert sorted(map(tuple, got)) == [(3, 3, True), (5, 3, False), (5, 5, True), (7, 7, True), (7, 7, True), (8, 5, False)]
    kept = near_dup.near_dedup(frame(spark, rows)).select("doc_id", "text").collect()
    assert Counter(map(tuple, kept)) == Counter([(3, a), (5, far), (7, other), (9, ""), (9, ""), (None, other)])
    # two near texts under one doc_id are one component
    assert near_dup.near_dedup(frame(spark, [(4, a), (4, near)])).count() == 1


def chunk_brute(rows):
    """The same boundaries by the module's line hashes, removal by plain comparison."""
    import numpy as np
    import pyarrow as pa

    from almanac.llm import textnp as tn

    parts = []
    for i, t in rows:
        buf, off = tn.flatten(pa.array([t], pa.string()))
        a, b, _, (s, e, _) = line_dedup.chunks(buf, off)
        raw = buf.tobytes()
        parts.append([raw[s[x] : e[y]].decode() for x, y in zip(np.asarray(a), np.asarray(b), strict=True)])
    owner, seen = {}, Counter()
    for (i, _), p in zip(rows, parts, strict=True):
        for c in p:
            if "\n" in c and c.strip() and i is not None:
                owner[c] = min(i, owner.get(c, i))
                seen[c] += 1
    out = []
    for (i, t), p in zip(rows, parts, strict=True):
        kept, had, lost = [], set(), 0
        for c in p:
            if i is not None and "\n" in c and seen[c] > 1 and (owner[c] < i or c in had):
                lost += c.count("\n") + 1
            else:
                kept.append(c)
            had.add(c)
        out.append((i, sum(c.count("\n") + 1 for c in p), lost, t if not lost else "\n".join(kept)))
    return out


def test_line_dedup(spark, docs, none, rows):
    block = "\n".join(f"line {k} of a block" for k in range(60))
    more = rows + [(300, block), (301, "intro\n" + block + "\noutro"), (302, block + "\n" + block), (None, block), (303, "\n\n\n"), (304, "\n\n\n")]
    got = line_dedup.mark(frame(spark, more)).collect()
    want = chunk_brute(more)
    assert Counter((r["doc_id"], r["n_lines"], r["n_removed"], r["text"]) for r in got) == Counter(want)
    # a line before the block moves only the boundaries next to it
    assert next(x[2] for x in want if x[0] == 301) > 40
    kept = line_dedup.line_dedup(frame(spark, more))
    assert kept.columns == docs.columns and kept.where("n_chars != length(text)").count() == 0
    assert line_dedup.mark(none).count() == 0


def runs_brute(rows):
    """A line goes if it is one of two neighbours, not both blank, that stand earlier without overlap; or in a blank stretch that does with its neighbour."""
    places = {}
    parts = [(i, (t or "").split("\n") if t else []) for i, t in rows]
    found = []
    for k, (i, p) in enumerate(parts):
        own = {(x, x + 2) for x in range(len(p) - 1) if p[x].strip() or p[x + 1].strip()}
        x = 0
        while x < len(p):
            y = x
            while y < len(p) and not p[y].strip():
                y += 1
            if y - x > 1:
                own |= ({(x - 1, y)} if x else set()) | ({(x, y + 1)} if y < len(p) else set())
            x = y + 1
        found.append(sorted(own))
        if i is not None:
            for x, y in sorted(own):
                places.setdefault(tuple(p[x:y]), []).append((i, x, y, k))
    out = []
    for k, (i, p) in enumerate(parts):
        gone = set()
        for x, y in found[k] if i is not None else []:
            at = places[tuple(p[x:y])]
            if min(at)[0] < i or min(o[2] for o in at if o[3] == k) <= x:
                gone |= set(range(x, y))
        out.append((i, len(p), len(gone), rows[k][1] if not gone else "\n".join(w for j, w in enumerate(p) if j not in gone)))
    return out


@pytest.mark.parametrize("size", range(2, 9))
def test_line_runs_planted(spark, size):
    """Passages between different lines go whole from all documents but the first, and nothing else goes."""
    rows, want = [], []
    for k in range(40):
        passage = [f"passage {k} of {size}, line {j}" for j in range(size)]
        for c in range(3):
            before, behind = ([f"{side} {k} {c} {j}" for j in range((k + c) % 3 + 1)] for side in ("before", "behind"))
            rows.append((3 * k + c, "\n".join(before + passage + behind)))
            want.append((3 * k + c, size if c else 0, rows[-1][1] if not c else "\n".join(before + behind)))
    got = line_dedup.runs(frame(spark, rows)).select("doc_id", "n_removed", "text").collect()
    assert sorted(map(tuple, got)) == want
    left = line_dedup.line_dedup(frame(spark, rows)).select("doc_id", "text").collect()
    assert sorted(map(tuple, left)) == [(i, t) for i, _, t in want]


def test_line_runs(spark, none, rows):
    block = "\n".join(f"line {k} of a block" for k in range(60))
    more = rows + [
        (300, block), (301, "intro\n" + block + "\noutro"), (302, block + "\n" + block), (None, block), (303, "\n\n\n"), (304, "\n\n\n"), (305, "a\na\na\na"), (306, "b\na\na\nb"), (307, "c\n\n \n\nd"),
        (308, "e\nc\n\n \n\nd\nf\n\n\n"), (309, "f\n\n\n"), (310, "x\ny\nx\ny\nx"), (311, "c\n\n\n"), (312, "line 8 of a block\nline 9 of a block\n"), (312, "u\nv"), (312, "u\nv"), (313, "u\nv\r\nw"),
    ]
    want = Counter(runs_brute(more))
    assert sum(x[2] for x in want) > 250

    def found():
        return Counter((r["doc_id"], r["n_lines"], r["n_removed"], r["text"]) for r in line_dedup.runs(frame(spark, more)).collect())

    assert found() == want
    assert line_dedup.runs(none).count() == 0 and line_dedup.line_dedup(none).count() == 0
    # texts go through one exchange
    plan = line_dedup.runs(frame(spark, more))
    plan.collect()
    assert "ReusedExchange" in plan._jdf.queryExecution().executedPlan().toString()
