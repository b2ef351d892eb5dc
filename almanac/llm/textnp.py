"""Whole-batch text kernels on UTF-8 bytes with numpy.

A batch of texts is one byte buffer with document offsets; words, lines and
spans are found for all its documents at once, so the cost per word is a few
dozen nanoseconds and memory is bounded by the batch, not by the table.
Null texts count as empty. Nothing crosses a document's boundary.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Texts of one sub-batch; a single longer text is a sub-batch of its own.
BATCH_BYTES = 1 << 20

_RNG = np.random.RandomState(20240229)
#: Fixed random value of every byte, and the odd base of the prefix hash.
BYTE_VALUE = _RNG.randint(0, 1 << 62, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    """Lookup table that is True outside the given byte ranges."""
    table = np.ones(256, dtype=bool)
    for low, high in ranges:
        table[low : high + 1] = False
    return table


#: Word bytes of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` (after lower-casing A-Z).
ALNUM = byte_class((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))
#: Word bytes of ``[^\\x20\\x09-\\x0D]+``.
NONSPACE = byte_class((0x20, 0x20), (0x09, 0x0D))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(h: np.ndarray) -> np.ndarray:
    """Finalizer that spreads every bit of a 64-bit value."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


class _Powers:
    """Powers of the base and of its inverse, grown to the longest buffer seen."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 1 << 20)
            out = []
            for base in (BASE, BASE_INV):
                p = np.full(size, base, dtype=np.uint64)
                p[0] = 1
                out.append(np.cumprod(p, dtype=np.uint64))
            self.up, self.down = out
        return self.up[:n], self.down[:n]


POWERS = _Powers()


def flatten(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and int64 offsets of a string column; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if not pa.types.is_binary(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    kind = np.int64 if wide else np.int32
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, dtype=kind)[column.offset : column.offset + len(column) + 1].astype(np.int64) if len(column) else np.zeros(1, np.int64)
    buf = np.frombuffer(data, dtype=np.uint8)[off[0] : off[-1]] if data is not None and len(column) else np.zeros(0, np.uint8)
    return buf, off - off[0]


def slices(offsets: np.ndarray, most: int = BATCH_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of documents of at most ``most`` bytes (or one document)."""
    n, first = len(offsets) - 1, 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + most, side="right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last


def batches(it: Iterator[pa.RecordBatch], most: int = BATCH_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """(rows, bytes, offsets) of sub-batches; the columns are doc_id, text, ..."""
    for rows in it:
        if not rows.num_rows:
            continue
        buf, off = flatten(rows.column(rows.schema.get_field_index("text")))
        for a, b in slices(off, most):
            yield rows.slice(a, b - a), buf[off[a] : off[b]], off[a : b + 1] - off[a]


def spans(buf: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, and the first word of each document (n + 1)."""
    if not len(buf):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    word = table[buf]
    start = word.copy()
    start[1:] &= ~word[:-1]
    cut = offsets[(offsets > 0) & (offsets < len(buf))]
    start[cut] = word[cut]
    end = np.zeros(len(buf) + 1, dtype=bool)
    end[1:-1] = word[:-1] & ~word[1:]
    end[-1] = word[-1]
    end[cut] = word[cut - 1]
    s, e = np.flatnonzero(start), np.flatnonzero(end)
    return s, e, np.searchsorted(s, offsets)


def span_hash(buf: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    """64-bit hash of each span ``buf[s:e]``, by prefix polynomial sums."""
    up, down = POWERS.get(len(buf) + 1)
    pre = np.zeros(len(buf) + 1, dtype=np.uint64)
    np.cumsum(BYTE_VALUE[buf] * up[:-1], out=pre[1:])
    return mix((pre[e] - pre[s]) * down[s] + (e - s).astype(np.uint64))


def ngram_hash(words: np.ndarray, n: int, salt: int = 0) -> np.ndarray:
    """Hash of each run of ``n`` values; run i starts at value i."""
    m = len(words) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    by = np.uint64(0xD6E8FEB86659FD93 + 2 * salt)
    h = words[:m] * by
    for k in range(1, n):
        h += words[k : k + m]
        h *= by
    return mix(h)


def doc_of(first: np.ndarray) -> np.ndarray:
    """Document of each word, from the first words of the documents."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def inside(first: np.ndarray, n: int, total: int) -> np.ndarray:
    """Whether the run of ``n`` words from each start stays in its document."""
    last = np.repeat(first[1:], np.diff(first))
    return (np.arange(total) + n) <= last


def cover(starts: np.ndarray, n: int, total: int) -> np.ndarray:
    """Which of ``total`` places lie in a run of ``n`` from a marked start."""
    mark = np.zeros(total + 1, dtype=np.int32)
    at = np.flatnonzero(starts) if starts.dtype == bool else starts
    np.add.at(mark, at, 1)
    np.add.at(mark, np.minimum(at + n, total), -1)
    return np.cumsum(mark[:-1]) > 0
