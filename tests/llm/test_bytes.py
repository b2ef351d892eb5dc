"""Operators on bytes, tokens and characters against brute force and round trips."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from almanac.llm import exchange, fingerprint, near_dup, packing, substring_dedup, suffix_dedup
from tests.llm.conftest import frame


def repeated(rows, length):
    """Of each text, which bytes lie in a string of so many that starts anywhere else."""
    count = Counter()
    for _, t in rows:
        b = (t or "").encode()
        count.update(b[k : k + length] for k in range(len(b) - length + 1))
    for _, t in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - length + 1):
            if count[b[k : k + length]] > 1:
                gone[k : k + length] = True
        yield b, gone


@pytest.mark.parametrize(("length", "early"), [(400, 256), (37, 20), (300, 37), (50, 50)])
def test_suffix_dedup(docs, none, rows, length, early):
    want = []
    for (i, _), (b, gone), (_, again) in zip(rows, repeated(rows, length), repeated(rows, early), strict=True):
        spans = int((gone & ~np.concatenate(([False], gone[:-1]))).sum()) if len(b) else 0
        want.append((i, len(b), int(gone.sum()), spans, hashlib.sha256(np.frombuffer(b, np.uint8)[~gone].tobytes()).hexdigest(), int(again.sum())))
    got = suffix_dedup.suffix_dedup(docs, length, early).drop("kept").collect()
    assert Counter(map(tuple, got)) == Counter(want)
    assert sum(x[2] for x in want) > 500
    assert suffix_dedup.suffix_dedup(none, length, early).count() == 0


def test_ranks_decide_what_is_repeated(docs, monkeypatch):
    """Places leave by their rank: with every rank unique only settled stretches are found."""
    found = suffix_dedup.suffix_dedup(docs, 37, 20).agg({"n_removed": "sum"}).first()[0]
    monkeypatch.setattr(suffix_dedup, "_ranked", lambda sent, to: sent.select("batch", "names").limit(0))
    assert suffix_dedup.suffix_dedup(docs, 37, 20).agg({"n_removed": "sum"}).first()[0] < found


@pytest.mark.parametrize("hop", [2, 3])
def test_buckets_in_two_steps(docs, monkeypatch, hop):
    """Names that go to ranges of buckets first come to the same verdicts, and a batch has no more rows than ranges."""
    to = exchange.Buckets(8 + hop, hop)
    assert not to.direct and to.groups == 4
    want = [sorted(map(tuple, f(docs).drop("kept", "text").collect()), key=repr) for f in (suffix_dedup.suffix_dedup, substring_dedup.substring_dedup, near_dup.near_dup)]
    monkeypatch.setattr(exchange, "buckets", lambda d: to)
    got = [sorted(map(tuple, f(docs).drop("kept", "text").collect()), key=repr) for f in (suffix_dedup.suffix_dedup, substring_dedup.substring_dedup, near_dup.near_dup)]
    assert got == want
    sent = exchange.each(exchange.pack(docs, suffix_dedup._notes(20, 37), 4000), suffix_dedup._reveal(to), exchange.SENT)
    assert sent.groupBy("batch").count().agg({"count": "max"}).first()[0] <= 1 << hop


def test_packing(spark, docs, none, rows):
    from tokenizers import Tokenizer

    path = packing.tokenizer_path()
    odd = [(400, "It's they'LL don't ''s"), (401, "<|startoftext|> <|endoftext|>x"), (402, "Ünïcödé ÀÉÎ ß × ÷ İ Σς ⅷ 漢字 é"), (403, "a b c\x1cd\x00e"), (404, "12 3.14 ###!!! x1y2"), (405, "word " * 30_000)]
    t = Tokenizer.from_file(path)
    everything = rows + odd
    ids = [(i, t.encode(x or "", add_special_tokens=False).ids + [2]) for i, x in everything]
    got = packing.pack(frame(spark, everything), path).collect()
    pieces = Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in got)
    rest = Counter()
    for i, x in ids:
        own = np.array(x, np.uint32)
        starts = sorted({r["start"] for r in got if r["doc_id"] == i and r["doc_tokens"] == len(x)})
        for a, b in zip(starts, [*starts[1:], len(x)], strict=True):
            rest[(i, a, b - a, zlib.crc32(own[a:b]), len(x))] += 1
    assert pieces == rest
    by = {}
    for r in got:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by.values():
        parts.sort()
        assert [o for o, _ in parts] == [sum(n for _, n in parts[:k]) for k in range(len(parts))]
        assert sum(n for _, n in parts) <= packing.CAPACITY
    assert packing.pack(none, path).count() == 0


def test_differencing():
    r = random.Random(1)
    for parts, n in ((1, 5), (3, 20), (7, 100), (4, 3)):
        sizes = [r.randint(1, 900) for _ in range(n)]
        of = packing.difference(sizes, parts)
        sums = np.bincount(of, sizes, parts)
        assert sums.sum() == sum(sizes)
        if n > 3 * parts:
            assert sums.max() - sums.min() < 60
    sizes = [r.randint(1, 4000) for _ in range(500)]
    of = packing.windows(sizes)
    assert np.bincount(of, sizes).max() <= packing.CAPACITY
    assert len(set(of.tolist())) <= 1.06 * sum(sizes) / packing.CAPACITY + 1


def test_edited(spark, none, rows):
    for parts in ("1", "4"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        got = fingerprint.edited(frame(spark, rows)).collect()
        ordered = sorted((i, t or "") for i, t in rows)
        want = []
        for k, (i, t) in enumerate(ordered):
            nxt = ordered[(k + 1) % len(ordered)][1]
            e = t[: len(t) - len(t) // 2] + nxt[: len(t) // 2]
            want.append((i, len(t), hashlib.sha256(e.encode()).hexdigest()))
        assert Counter((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in got) == Counter(want)
        for r in got:
            assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
            assert fingerprint.compare(r["fingerprint"], r["edited_fingerprint"]) == r["near_edited"]
        same = {}
        for r in got:
            same.setdefault((r["n_chars"], dict(ordered)[r["doc_id"]]), set()).add(r["fingerprint"])
        assert all(len(x) == 1 for x in same.values())
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert fingerprint.edited(none).count() == 0
    assert fingerprint.edited(frame(spark, [(None, "abc"), (None, "abd")])).count() == 2
    assert fingerprint.fingerprint(frame(spark, rows)).select("fingerprint").distinct().count() == len({t or "" for _, t in rows})


def test_padding_does_not_follow_the_partitioning(spark):
    r = random.Random(5)
    rows = [(i, " ".join(r.choice("alpha beta gamma delta epsilon".split()) for _ in range(r.choice([20, 200, 900])))) for i in range(900)]
    for parts in (1, 64):
        got = packing.pack(frame(spark, rows).repartition(parts), packing.tokenizer_path()).collect()
        by = Counter()
        for x in got:
            by[x["sequence_id"]] += x["length"]
        assert sum(by.values()) > 60 * packing.CAPACITY and max(by.values()) <= packing.CAPACITY
        assert 1 - sum(by.values()) / (len(by) * packing.CAPACITY) < 0.03, parts


def test_a_million_empty_texts_in_little_memory():
    import tracemalloc

    packer, one, placed = packing._Packer(0, packing.CAPACITY), np.array([2], np.uint32), 0
    tracemalloc.start()
    for k in range(1_000_000):
        packer.add(k, one)
        if packer.rows:
            placed += packer.out().num_rows
    packer.flush()
    placed += packer.out().num_rows
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert placed == 1_000_000 and peak < 200e6


def test_differencing():
    r = random.Random(2)
    for parts, sizes in ((2, [8, 7, 6, 5, 4]), (3, [5, 5, 5, 4, 4, 3, 3, 1]), (7, [r.randint(1, 900) for _ in range(200)]), (5, [1, 2]), (4, []), (3, [9])):
        of = packing.difference(sizes, parts)
        sums = np.bincount(of, sizes, parts) if sizes else np.zeros(parts)
        assert len(of) == len(sizes) and (not sizes or (of.max() < parts and sums.sum() == sum(sizes)))
        if len(sizes) > 20:
            assert sums.max() - sums.min() <= 2
    # differences, not a greedy fill: 16 and 14, where each next item to the smaller part gives 17 and 13
    assert sorted(np.bincount(packing.difference([8, 7, 6, 5, 4], 2), [8, 7, 6, 5, 4]).tolist()) == [14, 16]


def test_common_extensions_of_edited_texts(spark, rows):
    r"""Bytes that a text and its edited text share at both ends, by plain comparison."""
    unique = list({i: (i, t) for i, t in rows}.values())
    ordered = sorted((i, t or "") for i, t in unique)
    got = {x["doc_id"]: (x["same_head"], x["same_tail"]) for x in fingerprint.edited(frame(spark, unique)).collect()}
    for k, (i, t) in enumerate(ordered):
        nxt = ordered[(k + 1) % len(ordered)][1]
        a, b = t.encode(), (t[: len(t) - len(t) // 2] + nxt[: len(t) // 2]).encode()
        least = min(len(a), len(b))
        head = next((j for j in range(least) if a[j] != b[j]), least)
        tail = next((j for j in range(least) if a[-1 - j] != b[-1 - j]), least)
        assert got[i] == (head, tail)


def plain_fingerprint(text):
    """The same minima by whole polynomial sums of plain integers, one span after another."""
    primes, bases = (2147483647, 2147483629), (48271, 1389796)

    def value(raw):
        x = [sum((c + 1) * pow(b, k, p) for k, c in enumerate(raw)) % p for b, p in zip(bases, primes, strict=True)]
        return x[0] << 31 | x[1]

    def mixed(v):
        return int(fingerprint.tn.mix(np.array([v], np.uint64))[0])

    raw, n = text.encode(), fingerprint.SPAN
    spans = [text[k : k + n].encode() for k in range(len(text) - n + 1)] or ([raw] if text else [])
    low = {}
    for x in spans:
        h = mixed(value(x))
        low[h >> 58] = min(h & (1 << 58) - 1, low.get(h >> 58, 1 << 60))
    bits = [(mixed(low[k]) >> 48) | 1 if k in low else 0 for k in range(fingerprint.BINS)]
    return f"{mixed(value(raw) ^ (len(raw) << 40) % 2**64):016x}" + "".join(f"{b:04x}" for b in bits)


def test_fingerprints_by_plain_sums(spark):
    r = random.Random(6)
    texts = ["", "a", "é" * 15, "é" * 16, "x" * 40] + ["".join(r.choice("abcñ 漢") for _ in range(r.randint(17, 90))) for _ in range(6)]
    got = {x["doc_id"]: x["fingerprint"] for x in fingerprint.fingerprint(frame(spark, list(enumerate(texts)))).collect()}
    assert [got[k] for k in range(len(texts))] == [plain_fingerprint(t) for t in texts]
    edited = fingerprint.edited(frame(spark, list(enumerate(texts)))).collect()
    for x in edited:
        own, nxt = got[x["doc_id"]], got[(x["doc_id"] + 1) % len(texts)]
        a, b = ([int(f[16 + 4 * k : 20 + 4 * k], 16) for k in range(fingerprint.BINS)] for f in (own, nxt))
        j = sum(p == q > 0 for p, q in zip(a, b, strict=True)) / max(sum(p > 0 or q > 0 for p, q in zip(a, b, strict=True)), 1)
        assert x["near_next"] == pytest.approx(1.0 if own[:16] == nxt[:16] else 2 * j / (1 + j), abs=1e-6)


def test_prefix_hashes():
    r = np.random.RandomState(0)
    buf = r.randint(97, 99, 400).astype(np.uint8)
    p = fingerprint.Prefixes(buf)
    a, b = r.randint(0, 390, 200), r.randint(0, 390, 200)
    raw = buf.tobytes()
    for x, y, n in zip(a.tolist(), b.tolist(), p.common_extension(a, b).tolist(), strict=True):
        k = 0
        while max(x, y) + k < 400 and raw[x + k] == raw[y + k]:
            k += 1
        assert n == k
