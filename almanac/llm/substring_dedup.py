"""Substring dedup of word windows by recompression.

A round of recompression gives every maximal run of one word a name, then every
pair of a left and a right symbol (a bit of the symbol's name tells which it
is). Names are hashes of what they stand for, so all tasks give the same name to
the same run or pair. Equal passages so have equal symbols but at their edges.

Three Spark rounds compare symbols over the whole corpus:

1. Of a window of 13 words, the symbols two words and more from its edges are the
   same wherever it stands (four words, if a word in it is doubled). A window can
   recur only where all pairs of neighbouring symbols inside that stretch are
   shared. The round finds the shared pairs (of the half of them whose name has an
   even bit). Windows with a word three times in a row always stay candidates.
2. ``LEVELS`` rounds of recompression of the texts in which many windows are left
   give symbols of some twenty words. Two neighbouring ones that stand in a
   document of smaller doc_id, too, verify all windows inside them: long
   repeats are settled, whole, by a few names.
3. The other windows, at the edges of long repeats or in short ones, are verified
   by 96-bit names of their own, which bring the smallest doc_id that holds each.

A word goes if a window that covers it also starts in a document of smaller
doc_id. Words are ``[^\\x20\\x09-\\x0D]+``; nulls and empty texts have none;
rows that share a doc_id never remove each other's words; a null doc_id removes
nothing and loses nothing. Other columns do not matter here.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from almanac.llm import exchange as ex
from almanac.llm import textnp as tn

WINDOW = 13
#: Rounds of the high symbols, and candidates that make a text worth them.
LEVELS, MANY = 11, 40
_TOP48 = np.uint64(0xFFFFFFFFFFFF0000)
OUT = "doc_id long, n_words long, n_removed long, kept_sha256 string, text string"


def recompress(w: np.ndarray, first: np.ndarray, level: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols after one round: names, first words, and ends (one past the last word)."""
    n = len(w)
    new = ex.starts(w)
    begins = first[:-1][np.diff(first) > 0]
    new[begins] = True
    at = np.flatnonzero(new)
    length = np.diff(np.append(at, n))
    sym = np.where(length > 1, tn.mix(w[at] * np.uint64(5) + length.astype(np.uint64)), w[at])
    left = (tn.mix(sym + np.uint64(0xA5A5 + 0x10001 * level)) & np.uint64(1)).astype(bool)
    opens = np.zeros(n, dtype=bool)
    opens[begins] = True
    join = left[:-1] & ~left[1:] & ~opens[at[1:]]
    head = np.ones(len(at), dtype=bool)
    head[1:] = ~join
    keep = np.flatnonzero(head)
    name = sym[keep].copy()
    pair = np.flatnonzero(np.append(join, False)[keep])
    name[pair] = tn.mix(sym[keep[pair]] * np.uint64(7) + sym[keep[pair] + 1] * np.uint64(11))
    start = at[keep]
    return name, start, np.append(start[1:], n)


def high_symbols(w: np.ndarray, first: np.ndarray, levels: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols after several rounds: names, first words and ends."""
    name, start, end = w, np.arange(len(w)), np.arange(1, len(w) + 1)
    for level in range(levels):
        if not len(name):
            break
        own = np.searchsorted(start, first)
        own[-1] = len(name)
        name, a, b = recompress(name, own, level)
        start, end = start[a], end[b - 1]
    return name, start, end


def _pairs(w: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Half of the pairs of neighbouring symbols: 48-bit names, first word, end."""
    if not len(w):
        z = np.zeros(0, np.int64)
        return z.astype(np.uint64), z, z
    name, start, end = recompress(w, first)
    doc = np.searchsorted(first, start, side="right")
    both = tn.mix(name[:-1] * np.uint64(13) + name[1:] * np.uint64(17))
    ok = (doc[1:] == doc[:-1]) & ((both & np.uint64(0x8000)) == 0)
    return both[ok] & _TOP48, start[:-1][ok], end[1:][ok]


def _words(batch: pa.Table) -> tuple[list, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    ids, buf, off = ex.unpack(batch)
    s, e, first = tn.spans(buf, off, tn.NONSPACE)
    return ids, buf, s, e, first, tn.span_hash(buf, s, e)


def _ranks(ids: list) -> tuple[np.ndarray, np.ndarray]:
    """doc_ids as ordered unsigned numbers, and which are null."""
    null = np.array([i is None for i in ids], dtype=bool)
    value = np.array([0 if i is None else i for i in ids], np.int64).view(np.uint64) ^ np.uint64(1 << 63)
    return value, null


def _reveal(to: ex.Buckets):
    def run(batch: pa.Table) -> pa.Table:
        ids, _, _, _, first, w = _words(batch)
        name, start, _ = _pairs(w, first)
        doc = np.searchsorted(first, start, side="right") - 1
        order = np.lexsort((doc, name))
        name, doc = name[order], doc[order]
        begin = np.flatnonzero(ex.starts(name))
        entries = ex.starts(name, doc).astype(np.uint64)
        multi = (np.add.reduceat(entries, begin) > 1).astype(np.uint64) if len(begin) else entries
        return ex.send(batch.column("batch")[0].as_py(), to, name[begin], multi)

    return run


def _candidates(w: np.ndarray, first: np.ndarray, names: np.ndarray, window: int) -> np.ndarray:
    """Starts of the windows that may recur, by the shared pairs."""
    n = len(w)
    ok = tn.inside(first, window, n)
    name, start, end = _pairs(w, first)
    lone = ~ex.found(name, names)
    p, q = start[lone], end[lone]

    def ruled_out(margin: int) -> np.ndarray:
        low, high = np.maximum(q - (window - margin), 0), p - margin
        fine = high >= low
        d = np.bincount(low[fine], minlength=n + 1)[: n + 1] - np.bincount(high[fine] + 1, minlength=n + 1)[: n + 1]
        return np.cumsum(d)[:n] > 0

    same = np.zeros(n + 1, np.int64)
    same[1:n] = w[1:] == w[:-1]  # word i equals the one before
    total = np.concatenate(([0], np.cumsum(same)))
    last = np.minimum(np.arange(n) + window, n)
    doubled = (total[last] - total[np.minimum(np.arange(n) + 1, n)]) > 0
    thrice = np.zeros(n + 1, np.int64)
    thrice[2:n] = same[2:n] & same[1 : n - 1]
    total = np.concatenate(([0], np.cumsum(thrice)))
    tripled = (total[last] - total[np.minimum(np.arange(n) + 2, n)]) > 0
    out = np.where(doubled, ruled_out(4), ruled_out(2)) & ~tripled
    return np.flatnonzero(ok & ~out)


def _names(w: np.ndarray, at: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    return tn.ngram_hash(w, window)[at], tn.ngram_hash(w * np.uint64(0xC2B2AE3D27D4EB4F), window, salt=9)[at] >> np.uint64(32)


def _long(w: np.ndarray, first: np.ndarray, at: np.ndarray, window: int, levels: int) -> tuple[np.ndarray, ...]:
    """Neighbouring high symbols all of whose windows are candidates: name, check, first word and end."""
    n = len(w)
    cand = np.zeros(n + 1, np.int64)
    cand[at + 1] = 1
    total = np.cumsum(cand)
    picked = np.flatnonzero(total[first[1:]] - total[first[:-1]] >= MANY)
    size = first[picked + 1] - first[picked]
    own = np.concatenate(([0], np.cumsum(size)))
    word = np.repeat(first[picked] - own[:-1], size) + np.arange(own[-1])
    name, start, end = high_symbols(w[word], own, levels)
    if len(name) < 2:
        z = np.zeros(0, np.int64)
        return z.astype(np.uint64), z.astype(np.uint64), z, z
    doc = np.searchsorted(own, start, side="right")
    p, q = start[:-1], end[1:]
    ok = (doc[1:] == doc[:-1]) & (q - p >= window)
    both = tn.mix(name[:-1] * np.uint64(19) + name[1:] * np.uint64(23))[ok]
    p, q = word[p[ok]], word[q[ok] - 1] + 1
    full = total[q - window + 1] - total[p] == q - window + 1 - p
    both, p, q = both[full], p[full], q[full]
    up, down = tn.POWERS.get(n + 1)
    pre = np.concatenate((np.zeros(1, np.uint64), np.cumsum(tn.mix(w) * up[:-1], dtype=np.uint64)))
    return both, tn.mix((pre[q] - pre[p]) * down[p] + (q - p).astype(np.uint64)) >> np.uint64(32), p, q


class _Held:
    """A batch's words, and what earlier rounds have told of them."""

    def __init__(self, batch: pa.Table, window: int, one: pa.Table) -> None:
        self.ids, self.buf, self.s, self.e, self.first, self.w = _words(batch)
        value, self.null = _ranks(self.ids)
        self.value, self.window = value, window
        at = _candidates(self.w, self.first, ex.received(one)[0], window)
        doc = np.searchsorted(self.first, at, side="right") - 1
        self.at = at[~self.null[doc]]

    def _value(self, at: np.ndarray) -> np.ndarray:
        return self.value[np.searchsorted(self.first, at, side="right") - 1]

    def long(self) -> tuple[np.ndarray, ...]:
        """Names and checks of long symbols, doc values, and first and last windows."""
        key, check, p, q = _long(self.w, self.first, self.at, self.window, LEVELS)
        return key, check, self._value(p), p, q - self.window

    def settle(self, got: pa.Table) -> None:
        """Windows inside long symbols that a smaller doc_id has, too, are done."""
        key, check, v, p, q = self.long()
        done = _least(key, check, v, got) < v
        mark = np.zeros(len(self.w) + 1, np.int64)
        np.add.at(mark, p[done], 1)
        np.add.at(mark, q[done] + 1, -1)
        inside = np.cumsum(mark) > 0
        self.settled = np.flatnonzero(inside)
        self.at = self.at[~inside[self.at]]

    def windows(self) -> tuple[np.ndarray, ...]:
        """Names, checks and doc values of the windows that are left."""
        return *_names(self.w, self.at, self.window), self._value(self.at)


def _groups(key: np.ndarray, check: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """An order by (key, check), where each pair begins, and its smallest value."""
    order = np.lexsort((check, key))
    begin = np.flatnonzero(ex.starts(key[order], check[order]))
    return order, begin, np.minimum.reduceat(v[order], begin) if len(begin) else v


def _least(key: np.ndarray, check: np.ndarray, v: np.ndarray, got: pa.Table) -> np.ndarray:
    """Of each (key, check) the smallest value, in the batch or, as ``got`` tells, elsewhere."""
    order, begin, low = _groups(key, check, v)
    gk, gc, gv = ex.received(got, 3)
    if len(gk) and len(begin):
        # both sides in order of (key, check); checks differ under one key all but never
        sort = np.lexsort((gc, gk))
        gk, gc, gv = gk[sort], gc[sort], gv[sort]
        k, c = key[order[begin]], check[order[begin]]
        lo, hi = np.searchsorted(gk, k), np.searchsorted(gk, k, side="right")
        for step in range(int((hi - lo).max(initial=0))):
            ok = np.flatnonzero(lo + step < hi)
            ok = ok[gc[lo[ok] + step] == c[ok]]
            low[ok] = np.minimum(low[ok], gv[lo[ok] + step])
    out = np.empty_like(v)
    out[order] = np.repeat(low, np.diff(np.append(begin, len(order))))
    return out


def _send(batch: pa.Table, to: ex.Buckets, key: np.ndarray, check: np.ndarray, v: np.ndarray) -> pa.Table:
    order, begin, low = _groups(key, check, v)
    # two checks under one key are two entries, in order
    return ex.send(batch.column("batch")[0].as_py(), to, key[order[begin]], check[order[begin]], low)


def _kinds(got: pa.Table, *kinds: int) -> list[pa.Table]:
    kind = got.column("kind").to_numpy() if got.num_rows else np.zeros(0)
    return [got.filter(pa.array(kind == k)) if got.num_rows else got for k in kinds]


def _none(to: ex.Buckets) -> pa.Table:
    return ex.send(0, to, *[np.zeros(0, np.uint64)] * 3)


def _settle(to: ex.Buckets, window: int):
    def run(batch: pa.Table, got: pa.Table) -> pa.Table:
        if not batch.num_rows:
            return _none(to)
        return _send(batch, to, *_Held(batch, window, got).long()[:3])

    return run


def _verify(to: ex.Buckets, window: int):
    def run(batch: pa.Table, got: pa.Table) -> pa.Table:
        if not batch.num_rows:
            return _none(to)
        one, two = _kinds(got, 1, 2)
        held = _Held(batch, window, one)
        held.settle(two)
        return _send(batch, to, *held.windows())

    return run


def _finish(window: int):
    def run(batch: pa.Table, got: pa.Table) -> pa.Table:
        one, two, three = _kinds(got, 1, 2, 3)
        held = _Held(batch, window, one)
        held.settle(two)
        *names, v = held.windows()
        gone = held.at[_least(*names, v, three) < v]
        ids, s, e, first = held.ids, held.s, held.e, held.first
        removed = tn.cover(np.sort(np.concatenate((gone, held.settled))), window, len(s))
        raw, cs, ce = held.buf.tobytes(), s.tolist(), e.tolist()
        texts = []
        for d in range(len(ids)):
            a, b = int(first[d]), int(first[d + 1])
            keep = (np.flatnonzero(~removed[a:b]) + a).tolist()
            texts.append(b" ".join([raw[cs[i] : ce[i]] for i in keep]))
        lost = np.concatenate(([0], np.cumsum(removed)))
        n = len(ids)
        return pa.table(
            {
                "doc_id": pa.array(ids, pa.int64()),
                "n_words": pa.array(np.diff(first), pa.int64()),
                "n_removed": pa.array(lost[first[1:]] - lost[first[:-1]], pa.int64()) if n else pa.array([], pa.int64()),
                "kept_sha256": pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string()),
                "text": pa.array([t.decode() for t in texts], pa.string()),
            }
        )

    return run


def substring_dedup(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and the kept words joined by a space, per document."""
    if window < 10:
        raise ValueError("windows of fewer than ten words have no stable pair of symbols")
    to = ex.buckets(docs)
    packed = ex.pack(docs).repartition(ex.parts(docs), "batch")
    one = ex.shared(ex.each(packed, _reveal(to), ex.SENT), to).withColumn("kind", F.lit(1))
    two = ex.smallest(ex.per_batch(packed, one, _settle(to, window), ex.SENT), to).withColumn("kind", F.lit(2))
    three = ex.smallest(ex.per_batch(packed, one.union(two), _verify(to, window), ex.SENT), to).withColumn("kind", F.lit(3))
    return ex.per_batch(packed, one.union(two).union(three), _finish(window), OUT)


def op4(spark, sf_dir: str) -> DataFrame:
    """Words of each document in windows that an earlier document holds."""
    return substring_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("text")
