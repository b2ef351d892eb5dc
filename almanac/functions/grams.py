"""Character grams that two texts share if one holds the other."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

#: Characters of a gram: the most that a text has. Long ones are rare, so that few texts meet under one.
SIZES = (32, 8, 1)
_BY = np.uint64(0x9E3779B97F4A7C15)


def _grams(chars: np.ndarray, q: int) -> np.ndarray:
    n = len(chars) - q + 1
    h = np.full(n, q, np.uint64)
    for k in range(q):
        h = (h ^ chars[k : k + n]) * _BY
        h ^= h >> np.uint64(29)
    return h


def _smallest(h: np.ndarray, width: int) -> np.ndarray:
    """The different minima of all runs of so many values."""
    n = 1
    while n < width:
        step = min(n, width - n)
        h, n = np.minimum(h[:-step], h[step:]), n + step
    return np.unique(h)


def _mixed(h: np.ndarray, k: int) -> np.ndarray:
    """The k-th order of the grams."""
    if k == 0:
        return h
    h = (h ^ np.uint64(k)) * _BY
    return h ^ (h >> np.uint64(32))


def _paired(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One value for each value of the one with each of the other."""
    return ((a[:, None] * _BY) ^ b[None, :]).ravel().view(np.int64)


def _marks(smallest: list[np.ndarray]) -> np.ndarray:
    return (np.concatenate(smallest) >> np.uint64(32)).astype(np.uint32).view(np.int32)


def keys_of(text: str, percent: int) -> tuple[int | None, np.ndarray, np.ndarray, np.ndarray]:
    """The key of a text and those that a part of ``percent`` of it, or more, can have; its marks and those of such parts.

    A key is made of the smallest grams in two orders, marks of those in two more. A
    part of a text has that many grams in a row, so its smallest one is a minimum
    of a run of them; there are but a few such minima. Parts too short for the larger
    grams have smaller ones, so a text whose parts may be so short lists these as well.
    Texts that share a passage have one smallest gram in common now and then, and seldom all four.
    """
    chars = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    n = len(chars)
    if not n:
        return None, np.empty(0, np.int64), np.empty(0, np.int32), np.empty(0, np.int32)
    least, parts, seen, own, longer = -(-percent * n // 100), [], [], None, n + 1
    for q in SIZES:
        if q <= n and least < longer:
            grams = _grams(chars, q)
            orders = [_mixed(grams, k) for k in range(4)]
            if own is None:
                own = [h.min(keepdims=True) for h in orders]
            runs = [_smallest(h, max(least - q + 1, 1)) for h in orders]
            parts.append(_paired(runs[0], runs[1]))
            seen.append(_marks(runs[2:]))
        longer = q
    return int(_paired(own[0], own[1])[0]), np.concatenate(parts), _marks(own[2:]), np.concatenate(seen)


def containment_keys(percent: int):
    """A function of a text column: struct(own, parts, marks, seen) as ``keys_of`` says.

    Texts stay in their batch's Arrow buffer; one at a time is taken out of it.
    """

    def lists(values: list[np.ndarray], dtype: type) -> pa.ListArray:
        ends = np.cumsum([0, *map(len, values)])
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([np.empty(0, dtype), *values])))

    @F.arrow_udf("own long, parts array<long>, marks array<int>, seen array<int>")
    def run(text: pa.Array) -> pa.Array:
        own, parts, marks, seen = [], [], [], []
        for t in text:
            for out, v in zip((own, parts, marks, seen), keys_of(t.as_py() or "", percent), strict=True):
                out.append(v)
        columns = [pa.array(own, pa.int64()), lists(parts, np.int64), lists(marks, np.int32), lists(seen, np.int32)]
        return pa.StructArray.from_arrays(columns, ["own", "parts", "marks", "seen"])

    return run
