"""Suffix-array dedup of byte strings by prefix doubling.

A string of ``length`` bytes that starts in two places is found as a suffix
array would find it: places are sorted by pairs of the rank of their first bytes
and the rank a step further on, get a new rank, and leave as soon as it is
unique. Short prefixes are named within a task, by doubling, since equal bytes
have equal names everywhere; Spark moves places only at lengths where many of
them leave:

1. ``EARLY // 2`` bytes, at one anchor a window of ``EARLY`` bytes: the smallest name
   in the window's first half, the last one of equals. A window recurs only
   with its anchor, so windows of unique anchors leave.
2. Whole stretches: all bytes that the windows of one anchor cover, of either
   length. Where these recur as a whole, all these windows do: they are settled.
   One stretch of each kind stays as witness.
3. ``EARLY`` bytes, for the places that are left: pairs of the names of both halves
   are sorted over ranges of names, and ranked.
4. ``length`` bytes, for the places whose rank is shared: pairs of this rank and the
   name of the last ``EARLY`` bytes are sorted and ranked again.

Each byte of a window of ``length`` bytes that starts anywhere else too is
removed, overlaps included; ``n_repeated`` counts the bytes in such strings of
``EARLY`` bytes, which shorter repeated passages have too. Texts are UTF-8 bytes,
nulls are empty, shorter texts lose nothing; rows are judged each for itself,
whatever their doc_id, which may be null; matches never cross documents. An
empty table gives no rows. Other columns do not matter here. A batch holds one
text at least, so a very long text takes some forty bytes of memory for each of its bytes.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from almanac.llm import exchange as ex
from almanac.llm import textnp as tn

LENGTH, EARLY = 400, 256
OUT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, n_repeated long, kept binary"
_PLACE = np.uint64((1 << 24) - 1)
_TOP48, _TOP32 = np.uint64(0xFFFFFFFFFFFF0000), np.uint64(0xFFFFFFFF00000000)


def names(buf: np.ndarray, length: int) -> np.ndarray:
    """Name of the ``length`` bytes from each place (it may cross documents), by doubling."""
    h, n = tn.BYTE_VALUE[buf], 1
    while n < length:
        step = min(n, length - n)  # the last step overlaps itself
        if len(h) <= step:
            return h[:0]
        nxt = h[:-step] * np.uint64(0x9FB21C651E98DF25 + 2 * n)
        nxt ^= nxt >> np.uint64(31)
        nxt += h[step:]
        h, n = nxt, n + step
    return tn.mix(h)


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    n = 1
    while n < width:
        step = min(n, width - n)
        x, n = np.minimum(x[:-step], x[step:]), n + step
    return x


def anchors(buf: np.ndarray, off: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows with one anchor: first and last window, anchor, and its name."""
    half = length // 2
    z = np.zeros(0, np.int64)
    if len(buf) < length:
        return z, z, z, z.astype(np.uint64)
    h = names(buf, half)
    order = (h & ~_PLACE) | (_PLACE - (np.arange(len(h), dtype=np.uint64) & _PLACE))
    low = _sliding_min(order, length - half + 1)
    n = len(buf) - length + 1  # windows of the batch; those that cross documents are dropped
    edge = np.zeros(len(buf) + 1, np.int8)
    np.add.at(edge, np.maximum(off[1:] - length + 1, off[:-1]), 1)
    np.add.at(edge, off[1:], -1)
    ok = np.cumsum(edge[:n], dtype=np.int8) == 0
    same = (low[1:n] == low[: n - 1]) & ok[1:] & ok[:-1]
    first = np.flatnonzero(ok & ~np.concatenate(([False], same)))
    last = np.flatnonzero(ok & ~np.concatenate((same, [False])))
    place = (_PLACE - (low[first] & _PLACE)).astype(np.int64)
    at = first + ((place - first) & int(_PLACE))
    return first, last, at, h[at]


def _ends(off: np.ndarray, last: np.ndarray, length: int) -> np.ndarray:
    """Ends of stretches: all that windows of either length cover, in their document."""
    return np.minimum(last + length, off[np.searchsorted(off, last, side="right")])


def _notes(early: int, length: int):
    """Of each run: first window, length, and the names of its anchor and of its stretch."""

    def run(buf: np.ndarray, off: np.ndarray) -> bytes:
        first, last, at, name = anchors(buf, off, early)
        whole = tn.span_hash(buf, first, _ends(off, last, length)) if len(first) else name
        whole = tn.mix(whole * np.uint64(3) + (at - first).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        return ex.encode(first.astype(np.uint64), last - first, name & _TOP48, whole & _TOP48)

    return run


def _runs(batch: pa.Table) -> tuple[np.ndarray, ...]:
    """First and last window of each run, and its two names, as noted when the batch was packed."""
    first, more, name, whole = ex.decode(batch.column("notes")[0].as_py())
    return first.astype(np.int64), (first + more).astype(np.int64), name, whole


def _reveal(to: ex.Buckets):
    def run(batch: pa.Table) -> pa.Table:
        name = np.sort(_runs(batch)[2])
        begin = np.flatnonzero(ex.starts(name))
        multi = (np.diff(np.append(begin, len(name))) > 1).astype(np.uint64)
        return ex.send(batch.column("batch")[0].as_py(), to, name[begin], multi)

    return run


def _context(to: ex.Buckets):
    def run(batch: pa.Table, got: pa.Table) -> pa.Table:
        z = np.zeros(0, np.uint64)
        if not batch.num_rows or not got.num_rows:
            return ex.send(0, to, z, z, z)
        _, _, name, whole = _runs(batch)
        keep = ex.found(name, ex.received(got)[0])
        name, whole = name[keep], whole[keep]
        order = np.lexsort((whole, name))
        name, whole = name[order], whole[order]
        begin = np.flatnonzero(ex.starts(name, whole))
        multi = (np.diff(np.append(begin, len(name))) > 1).astype(np.uint64)
        return ex.send(batch.column("batch")[0].as_py(), to, name[begin], whole[begin], multi)

    return run


def _settle(sent: DataFrame, to: ex.Buckets) -> DataFrame:
    """Verdict on each anchor and context: 1 settled, 2 to send its windows (one batch for each context)."""

    def run(table: pa.Table) -> pa.Table:
        key, (whole, multi), of = ex.gather(table)
        order = np.lexsort((of, whole, key))
        key, whole, multi, of = key[order], whole[order], multi[order], of[order]
        new = ex.starts(key, whole)
        begin = np.flatnonzero(new)
        count = np.diff(np.append(begin, len(key)))
        settled = np.repeat((count > 1) | (np.add.reduceat(multi, begin) > 0), count)
        top = np.flatnonzero(ex.starts(key))
        kinds = np.add.reduceat(new.astype(np.int64), top)
        several = np.repeat(kinds > 1, np.diff(np.append(top, len(key))))
        flag = settled.astype(np.uint64) + (several & new).astype(np.uint64) * np.uint64(2)
        return ex.reply(table, to, of, flag > 0, key, whole, flag)

    return ex.per_bucket(sent, to, run)


def _flags(name: np.ndarray, whole: np.ndarray, got: pa.Table) -> np.ndarray:
    """The verdict on each run."""
    k, w, f = ex.received(got, 3)
    order = np.lexsort((w, k))
    k, w, f = k[order], w[order], f[order]
    out = np.zeros(len(name), np.uint64)
    lo, hi = np.searchsorted(k, name), np.searchsorted(k, name, side="right")
    for step in range(int((hi - lo).max(initial=0))):
        ok = np.flatnonzero(lo + step < hi)
        ok = ok[w[lo[ok] + step] == whole[ok]]
        out[ok] = f[lo[ok] + step]
    return out


def _left(batch: pa.Table, got: pa.Table) -> tuple[np.ndarray, ...]:
    """Runs with their verdicts, and the places that are left to compare."""
    first, last, name, whole = _runs(batch)
    flag = _flags(name, whole, got)
    own = np.flatnonzero(flag >= 2)
    # of several equal stretches in the batch one is enough
    own = own[np.unique(np.stack((name[own], whole[own])), axis=1, return_index=True)[1]] if len(own) else own
    size = last[own] - first[own] + 1
    return first, last, flag, np.repeat(first[own] - (np.cumsum(size) - size), size) + np.arange(size.sum())


def _halves(buf: np.ndarray, at: np.ndarray, early: int) -> tuple[np.ndarray, np.ndarray]:
    """Names of both halves of the ``early`` bytes from each place."""
    if not len(at):
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    h = names(buf, early // 2)
    return h[at], h[at + early - early // 2] & _TOP32


def _pairs(batch: int, to: ex.Buckets, a: np.ndarray, b: np.ndarray) -> pa.Table:
    """The distinct pairs of a batch in order, each with whether it stands there repeatedly."""
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    begin = np.flatnonzero(ex.starts(a, b))
    multi = (np.diff(np.append(begin, len(a))) > 1).astype(np.uint64)
    return ex.send(batch, to, a[begin], b[begin], multi)


def _ranked(sent: DataFrame, to: ex.Buckets) -> DataFrame:
    """Back to each batch: its pairs that stand in several places, with their rank in the order of all pairs.

    A bucket holds a range of first members, so the buckets in turn are the whole order.
    """

    def run(table: pa.Table) -> pa.Table:
        a, (b, multi), of = ex.gather(table)
        order = np.lexsort((b, a))
        a, b, multi, of = a[order], b[order], multi[order], of[order]
        begin = np.flatnonzero(ex.starts(a, b))
        count = np.diff(np.append(begin, len(a)))
        many = np.repeat((count > 1) | (np.add.reduceat(multi, begin) > 0), count)
        rank = (np.uint64(ex.bucket_of(table)) << np.uint64(64 - to.bits)) + np.repeat(np.arange(len(begin), dtype=np.uint64), count)
        return ex.reply(table, to, of, many, a, b, rank)

    return ex.per_bucket(sent, to, run)


def _rank_of(a: np.ndarray, b: np.ndarray, got: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Of each pair whether it came back, and its rank."""
    ga, gb, rank = ex.received(got, 3)
    both, key = _both(ga, gb), _both(a, b)
    order = np.argsort(both)
    at = np.searchsorted(both[order], key)
    at[at == len(both)] = 0
    if not len(both):
        return np.zeros(len(a), bool), np.zeros(len(a), np.uint64)
    at = order[at]
    return (ga[at] == a) & (gb[at] == b), rank[at]


def _early(to: ex.Buckets, early: int):
    def run(batch: pa.Table, got: pa.Table) -> pa.Table:
        if not batch.num_rows or not got.num_rows:
            return ex.send(0, to, *[np.zeros(0, np.uint64)] * 3)
        *_, at = _left(batch, got)
        _, buf, _ = ex.unpack(batch)
        return _pairs(batch.column("batch")[0].as_py(), to, *_halves(buf, at, early))

    return run


def _late_pairs(buf: np.ndarray, off: np.ndarray, at: np.ndarray, rank: np.ndarray, early: int, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places that have ``length`` bytes, with their rank and the name of their last ``early`` bytes."""
    fits = at + length <= off[np.searchsorted(off, at, side="right")] if len(at) else np.zeros(0, bool)
    at, rank = at[fits], rank[fits]
    return at, rank, tn.span_hash(buf, at + length - early, at + length) & _TOP48 if len(at) else rank


def _late(to: ex.Buckets, early: int, length: int):
    def run(batch: pa.Table, got: pa.Table) -> pa.Table:
        if not batch.num_rows or not got.num_rows:
            return ex.send(0, to, *[np.zeros(0, np.uint64)] * 3)
        two, three = _kinds(got, 2, 3)
        *_, at = _left(batch, two)
        _, buf, off = ex.unpack(batch)
        there, rank = _rank_of(*_halves(buf, at, early), three)
        _, *pair = _late_pairs(buf, off, at[there], rank[there], early, length)
        return _pairs(batch.column("batch")[0].as_py(), to, *pair)

    return run


def _kinds(got: pa.Table, *kinds: int) -> list[pa.Table]:
    kind = got.column("kind").to_numpy() if got.num_rows else np.zeros(0)
    return [got.filter(pa.array(kind == k)) if got.num_rows else got for k in kinds]


def _covered(n: int, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    mark = np.zeros(n + 1, np.int32)
    np.add.at(mark, first, 1)
    np.add.at(mark, end, -1)
    return np.cumsum(mark[:-1]) > 0


def _finish(early: int, length: int):
    def run(batch: pa.Table, got: pa.Table) -> pa.Table:
        two, three, four = _kinds(got, 2, 3, 4)
        ids, buf, off = ex.unpack(batch)
        gone = again = np.zeros(len(buf), bool)
        if two.num_rows:
            first, last, flag, at = _left(batch, two)
            settled = (flag & np.uint64(1)) > 0
            first, last = first[settled], last[settled]
            there, rank = _rank_of(*_halves(buf, at, early), three)
            at = at[there]
            again = _covered(len(buf), np.concatenate((first, at)), np.concatenate((last, at)) + early)
            end = _ends(off, last, length)
            whole = end - first >= length
            at, *pair = _late_pairs(buf, off, at, rank[there], early, length)
            at = at[_rank_of(*pair, four)[0]]
            gone = _covered(len(buf), np.concatenate((first[whole], at)), np.concatenate((end[whole], at + length)))
        lost = np.concatenate(([0], np.cumsum(gone)))
        head = gone.copy()
        head[1:] &= ~gone[:-1]
        inner = off[:-1][np.diff(off) > 0]
        head[inner] = gone[inner]
        heads = np.concatenate(([0], np.cumsum(head)))
        kept = [buf[a:b][~gone[a:b]].tobytes() if lost[b] > lost[a] else buf[a:b].tobytes() for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True)]
        return pa.table(
            {
                "doc_id": pa.array(ids, pa.int64()),
                "n_bytes": pa.array(np.diff(off), pa.int64()),
                "n_removed": pa.array(np.diff(lost[off]), pa.int64()),
                "n_spans": pa.array(np.diff(heads[off]), pa.int64()),
                "kept_sha256": pa.array([hashlib.sha256(t).hexdigest() for t in kept], pa.string()),
                "n_repeated": pa.array(np.diff(np.concatenate(([0], np.cumsum(again)))[off]), pa.int64()),
                "kept": pa.array(kept, pa.binary()),
            }
        )

    return run


def _both(key: np.ndarray, check: np.ndarray) -> np.ndarray:
    return tn.mix(key * np.uint64(0x9E3779B97F4A7C15) + check)


def suffix_dedup(docs: DataFrame, length: int = LENGTH, early: int = EARLY) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, n_repeated and the kept bytes, per document.

    ``early`` is at most ``length``; n_repeated counts bytes in repeated strings of so many.
    """
    if not 2 <= early <= length:
        raise ValueError("two bytes at least, and early <= length")
    to = ex.buckets(docs)
    packed = ex.pack(docs, _notes(early, length)).repartition(ex.parts(docs), "batch")
    one = ex.shared(ex.each(packed, _reveal(to), ex.SENT), to)
    two = _settle(ex.per_batch(packed, one, _context(to), ex.SENT), to).withColumn("kind", F.lit(2))
    three = _ranked(ex.per_batch(packed, two, _early(to, early), ex.SENT), to).withColumn("kind", F.lit(3))
    four = _ranked(ex.per_batch(packed, two.union(three), _late(to, early, length), ex.SENT), to).withColumn("kind", F.lit(4))
    return ex.per_batch(packed, two.union(three).union(four), _finish(early, length), OUT)


def op5(spark, sf_dir: str) -> DataFrame:
    """Bytes of each document in 400-byte strings that stand anywhere else; n_repeated: the same of 256 bytes."""
    return suffix_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("kept")
