"""Document fingerprints from prefix polynomial hashes.

Arrays of polynomial hashes of all prefixes, modulo two primes, answer whether
any two spans are equal in constant time, and find the longest common extension
of two places by binary search: ``same_head`` and ``same_tail`` are the bytes that
a text and its edited text share from their starts and up to their ends. A fingerprint is the hash of the whole text and,
of the hashes of all its spans of ``SPAN`` characters, the smallest in each of
``BINS`` classes. Equal texts have equal fingerprints; the likeness of two is
1 if they are equal, else the estimated share of spans in common (Dice).

Shorter texts are one span; null texts are empty, and empty texts are alike.
``edited`` goes by ascending doc_id, nulls first, equal ids by their text; the
last document is followed by the first. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from almanac.llm import exchange as ex
from almanac.llm import textnp as tn
from almanac.llm.columns import adding, plus

SPAN, BINS = 16, 64
_PRIMES = (np.uint64(2147483647), np.uint64(2147483629))
_BASES = (48271, 1389796)
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


class _Tables:
    """Powers of a base and its inverse modulo a prime, grown by doubling."""

    def __init__(self, base: int, prime: np.uint64) -> None:
        self.prime, self.bases = prime, (base, pow(base, -1, int(prime)))
        self.tables = [np.ones(1, np.uint64), np.ones(1, np.uint64)]

    def get(self, n: int) -> list[np.ndarray]:
        while len(self.tables[0]) < n:
            m = len(self.tables[0])
            self.tables = [np.concatenate((t, t * np.uint64(pow(b, m, int(self.prime))) % self.prime)) for t, b in zip(self.tables, self.bases, strict=True)]
        return [t[:n] for t in self.tables]


_TABLES = [_Tables(b, p) for b, p in zip(_BASES, _PRIMES, strict=True)]


class Prefixes:
    """Prefix hashes of one byte buffer; spans are given by vectors of places."""

    def __init__(self, buf: np.ndarray) -> None:
        self.n = len(buf)
        self.sums, self.inverse = [], []
        data = buf.astype(np.uint64) + np.uint64(1)
        for t in _TABLES:
            up, down = t.get(self.n + 1)
            s = np.zeros(self.n + 1, np.uint64)
            np.cumsum(data * up[:-1] % t.prime, out=s[1:])
            self.sums.append(s % t.prime)
            self.inverse.append(down)

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """62-bit hash of each span, the same wherever it stands."""
        out = []
        for s, down, p in zip(self.sums, self.inverse, _PRIMES, strict=True):
            out.append((s[end] + p - s[start]) % p * down[start] % p)
        return (out[0] << np.uint64(31)) | out[1]

    def equal(self, a: np.ndarray, b: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Whether the ``n`` bytes from each ``a`` are those from each ``b``."""
        return self.hash(a, a + n) == self.hash(b, b + n)

    def common_extension(self, a: np.ndarray, b: np.ndarray, most: np.ndarray | None = None, back: bool = False) -> np.ndarray:
        """Length of the longest common extension from places a and b, ``most`` at most; with ``back`` of what ends there."""
        if most is None:
            most = np.minimum(a, b) if back else self.n - np.maximum(a, b)
        low, high = np.zeros(len(a), np.int64), most.copy()
        while (low < high).any():
            mid = (low + high + 1) // 2
            same = self.equal(a - mid, b - mid, mid) if back else self.equal(a, b, mid)
            low, high = np.where(same, mid, low), np.where(same, high, mid - 1)
        return low


def _characters(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places where characters start, and the first one of each document."""
    at = np.flatnonzero((buf & 0xC0) != 0x80)
    return at, np.searchsorted(at, off)


def sketches(pre: Prefixes, buf: np.ndarray, off: np.ndarray, at: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each whole text, and its smallest span hashes by class."""
    docs = len(off) - 1
    whole = tn.mix(pre.hash(off[:-1], off[1:]) ^ (np.diff(off).astype(np.uint64) << np.uint64(40)))
    low = np.full(docs * BINS, _EMPTY, np.uint64)
    count = np.diff(first)
    doc = tn.doc_of(first)
    bound = np.append(at, len(buf))
    place = np.arange(len(at))
    full = place + SPAN <= first[1:][doc]
    start, end, of = at[full], bound[place[full] + SPAN], doc[full]
    short = np.flatnonzero((count > 0) & (count < SPAN))
    start, end, of = np.concatenate((start, off[short])), np.concatenate((end, off[short + 1])), np.concatenate((of, short))
    h = tn.mix(pre.hash(start, end))
    np.minimum.at(low, of * BINS + (h >> np.uint64(58)).astype(np.int64), h & np.uint64((1 << 58) - 1))
    return whole, low.reshape(docs, BINS)


def fingerprints(buf: np.ndarray, off: np.ndarray, pre: Prefixes | None = None) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Fingerprint of each document, with its parts for ``likeness``."""
    at, first = _characters(buf, off)
    whole, low = sketches(pre or Prefixes(buf), buf, off, at, first)
    # classes keep 16 bits of their smallest hash; 0 is a class without spans
    bits = np.where(low == _EMPTY, 0, (tn.mix(low) >> np.uint64(48)) | np.uint64(1)).astype(np.uint16)
    rows = np.concatenate((whole.astype(">u8").view(np.uint8).reshape(-1, 8), bits.astype(">u2").view(np.uint8).reshape(len(bits), 2 * BINS)), axis=1)
    return [r.tobytes().hex() for r in rows], whole, bits


def likeness(whole_a: np.ndarray, bits_a: np.ndarray, whole_b: np.ndarray, bits_b: np.ndarray) -> np.ndarray:
    """Likeness of fingerprints, row by row, from 0 to 1."""
    any_, same = (bits_a > 0) | (bits_b > 0), (bits_a == bits_b) & (bits_a > 0)
    j = same.sum(1) / np.maximum(any_.sum(1), 1)
    return np.where(whole_a == whole_b, 1.0, np.round(2 * j / (1 + j), 6))


def compare(a: str, b: str) -> float:
    """Likeness of two fingerprints as they were returned."""
    x, y = (np.frombuffer(bytes.fromhex(s), np.uint8) for s in (a, b))
    w = [v[:8].view(">u8").astype(np.uint64) for v in (x, y)]
    bits = [v[8:].view(">u2").astype(np.uint16)[None] for v in (x, y)]
    return float(likeness(w[0], bits[0], w[1], bits[1])[0])


def fingerprint(docs: DataFrame) -> DataFrame:
    """The documents with n_chars and their fingerprint (replaced if there are such). No shuffle."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, buf, off in tn.batches(it, 1 << 20):
            _, first = _characters(buf, off)
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(np.diff(first)), pa.array(fingerprints(buf, off)[0])], names=[*rows.schema.names, "n_chars", "fingerprint"])

    return adding(docs, ("n_chars", "fingerprint"), lambda own: own.mapInArrow(run, plus(own.schema, "n_chars long, fingerprint string")))


def _halves(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    buf = np.frombuffer(b"".join(texts), np.uint8)
    off = np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)
    return buf, off, *_characters(buf, off)


def _edited(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (at, id, text) in order of (at, id, text); odd ``at`` only follow."""
    # nulls are ids below all others; they come back as nulls
    held: tuple[int, int | None, bytes] | None = None
    done = -1

    def flush(pairs: list[tuple[int | None, bytes, bytes]]) -> pa.RecordBatch:
        buf, off, at, first = _halves([p[1] for p in pairs])
        nbuf, noff, nat, nfirst = _halves([p[2] for p in pairs])
        n = np.diff(first)
        keep, take = n - n // 2, np.minimum(n // 2, np.diff(nfirst))
        cut = np.append(at, len(buf))[first[:-1] + keep]
        cut = np.where(keep == n, off[1:], cut) - off[:-1]
        ncut = np.where(take == np.diff(nfirst), noff[1:], np.append(nat, len(nbuf))[np.minimum(nfirst[:-1] + take, len(nat))]) - noff[:-1]
        texts = [p[1][:a] + p[2][:b] for p, a, b in zip(pairs, cut.tolist(), ncut.tolist(), strict=True)]
        # one buffer and one set of prefix hashes for the texts, the edited ones and the next ones
        m = len(pairs)
        whole, ends, _, _ = _halves([p[1] for p in pairs] + texts + [p[2] for p in pairs])
        pre = Prefixes(whole)
        names, w, b = fingerprints(whole, ends, pre)
        own, new, nxt = slice(0, m), slice(m, 2 * m), slice(2 * m, 3 * m)
        least = np.minimum(np.diff(ends)[own], np.diff(ends)[new])
        head = pre.common_extension(ends[:-1][own], ends[:-1][new], least)
        tail = pre.common_extension(ends[1:][own], ends[1:][new], least, back=True)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([p[0] for p in pairs], pa.int64()), pa.array(n), pa.array([hashlib.sha256(t).hexdigest() for t in texts]),
                pa.array(names[own]), pa.array(names[new]), pa.array(likeness(w[own], b[own], w[new], b[new])), pa.array(likeness(w[own], b[own], w[nxt], b[nxt])),
                pa.array(head), pa.array(tail),
            ],
            names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "same_head", "same_tail"],
        )

    pairs: list[tuple[int | None, bytes, bytes]] = []
    size = 0
    for rows in it:
        for at, ident, text in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist(), rows.column(2).to_pylist(), strict=True):
            raw = text.encode()
            if held is not None and at // 2 == held[0] // 2 and done != at // 2:
                pairs.append((held[1], held[2], raw))
                size += len(raw) + len(held[2])
                if at % 2:
                    done = at // 2
                if size > 1 << 20:
                    yield flush(pairs)
                    pairs, size = [], 0
            held = (at, ident, raw)
    if pairs:
        yield flush(pairs)


def edited(docs: DataFrame) -> DataFrame:
    """Each document's fingerprint against that of its edited text and of the next document.

    The second half of a text's characters is replaced by the first as many of
    the next document. Documents are dealt into ranges of doc_id by percentiles;
    the first of each range also goes to the range before it. The driver holds
    two numbers a range.
    """
    parts = ex.parts(docs)
    # nulls sort before all ids
    own = docs.select(F.col("doc_id").alias("id"), F.coalesce("doc_id", F.lit(-(2**63))).alias("k"), F.coalesce("text", F.lit("")).alias("text"))
    share = [i / parts for i in range(1, parts)]
    cuts = np.array([] if not share else own.agg(F.percentile_approx("k", share, 100 * parts).alias("q")).first()["q"] or [], np.int64)
    cuts = np.unique(cuts)

    @F.pandas_udf("int")
    def part(k: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(cuts, k.to_numpy(), side="left").astype(np.int32))

    firsts = {r["p"]: r["k"] for r in own.select(part("k").alias("p"), "k").groupBy("p").agg(F.min("k").alias("k")).collect()}
    ranges = sorted(firsts)
    before = {p: ranges[i - 1] for i, p in enumerate(ranges)}

    @F.pandas_udf("array<int>")
    def places(k: pd.Series) -> pd.Series:
        own_part = np.searchsorted(cuts, k.to_numpy(), side="left")
        return pd.Series([[2 * p] if firsts[p] != x else [2 * p, 2 * before[p] + 1] for p, x in zip(own_part.tolist(), k.tolist(), strict=True)])

    dealt = own.select("id", "k", "text", F.explode(places("k")).alias("at"))
    dealt = dealt.repartition(parts, F.floor(F.col("at") / 2)).sortWithinPartitions("at", "k", "text").select("at", "id", "text")
    return dealt.mapInArrow(_edited, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, same_head long, same_tail long")


def op9(spark, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts."""
    return edited(spark.read.parquet(f"{sf_dir}/documents.parquet"))
