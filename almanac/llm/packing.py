"""Sequence packing by Karmarkar-Karp multiway differencing.

Documents are turned into token ids and packed into windows of ``CAPACITY``
tokens. A document longer than a window gives whole windows first; what is left
of it, and every shorter document, goes to a group of about ``GROUP_WINDOWS``
windows' tokens (or ``GROUP_PIECES`` pieces). Within a group, partial partitions
with the widest spread are merged so that the largest part of one meets the
smallest of the other. The windows come out near-equal; if one exceeds the
capacity, their number rises by one and the group is packed anew. A partial
partition holds its parts that are not empty and no others, so memory follows the
pieces; pieces of a few tokens travel in bundles of ``BUNDLE``.

Groups are made from the rows of one input partition as they stream by. The last
group of a partition is not full: ``CARRY`` neighbouring partitions send the places
of their last pieces (not the tokens) to one task, which packs them together, so
padding does not follow the partitioning. Null and empty texts have the
end id alone; repeated rows are packed each; an empty table gives no rows; columns
other than doc_id and text are ignored, whatever their names.
"""

from __future__ import annotations

import heapq
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from almanac.llm import textnp as tn

CAPACITY = 4096
END_ID = 2
GROUP_WINDOWS, GROUP_PIECES, BUNDLE = 256, 1 << 17, 64
#: Input partitions whose last groups are packed together.
CARRY = 64
#: Distinct units whose ids a task remembers.
CACHE_WORDS = 500_000
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


#: Classes of bytes: white space, letters, digits, other ASCII, and the rest.
_SPACE, _LETTER, _DIGIT, _OTHER, _HARD = range(5)
_CLASS = np.full(256, _HARD, np.uint8)
_CLASS[0x21:0x7F] = _OTHER
_CLASS[[0x20, *range(0x09, 0x0E)]] = _SPACE
_CLASS[ord("a") : ord("z") + 1] = _LETTER
_CLASS[ord("0") : ord("9") + 1] = _DIGIT
_CLASS[ord("'")] = _HARD  # contractions
_CLASS[ord("<")] = _HARD  # special tokens


class WordTokens:
    """Ids of texts for a lower-case vocabulary whose words never hold white space.

    The tokenizer drops white space, and neither its normalizer nor its splitter
    looks across ASCII white space; nor does it join letters, single digits and
    other characters. So the ids of a text are those of such units, one after
    another, and each distinct unit is encoded once. Letters are a-z and those
    of U+00C0 to U+00FF; a word with an apostrophe, a ``<`` or anything else is
    one unit as it stands, and the tokenizer gets it alone.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        names = self.tokenizer.get_vocab(with_added_tokens=False)
        self._last = np.zeros(max(names.values()) + 1, dtype=bool)  # tokens that end a unit
        self._last[[i for name, i in names.items() if name.endswith("</w>")]] = True
        self._known = np.zeros(0, np.uint64)  # sorted hashes of units, where their ids begin, and how many
        self._begin = self._size = np.zeros(0, np.int64)
        self._ids = np.zeros(0, np.uint32)

    @staticmethod
    def _units(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Lower-cased bytes; starts and ends of units; the first of each document; which are hard."""
        low = tn.LOWER[buf]
        kind = _CLASS[low]
        lead = np.flatnonzero(low[:-1] == 0xC3) if len(low) else np.zeros(0, np.int64)
        tail = low[lead + 1]
        fine = (tail != 0x97) & (tail != 0xB7)  # signs, not letters
        lead, tail = lead[fine], tail[fine]
        kind[lead] = kind[lead + 1] = _LETTER
        low[lead + 1] = np.where(tail < 0x9F, tail + 0x20, tail)
        s, e, _ = tn.spans(buf, off, tn.NONSPACE)
        hard = np.flatnonzero(kind == _HARD)
        of = np.searchsorted(s, hard, side="right") - 1
        word = np.unique(of)
        new = np.ones(len(low) + 1, dtype=bool)
        new[1:-1] = (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)
        new[s] = True
        for a, b in zip(s[word].tolist(), e[word].tolist(), strict=True):
            new[a + 1 : b] = False
            low[a:b] = buf[a:b]
        us = np.flatnonzero(new[:-1] & (kind != _SPACE))
        nxt = np.flatnonzero(new)
        ue = nxt[np.searchsorted(nxt, us, side="right")]
        is_hard = np.zeros(len(us), dtype=bool)
        is_hard[np.searchsorted(us, s[word])] = True
        return low, us, ue, np.searchsorted(us, off), is_hard

    def _encode_units(self, units: list[bytes], hard: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the units, one after another, and the number of each one's ids."""
        easy = np.flatnonzero(~hard).tolist()
        texts = [b" ".join([units[i] for i in easy[a : a + 64]]).decode() for a in range(0, len(easy), 64)]
        flat = np.concatenate([np.zeros(0, np.uint32), *(np.array(x.ids, np.uint32) for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False))])
        size = np.zeros(len(units), np.int64)
        size[easy] = np.diff(np.flatnonzero(self._last[flat]), prepend=-1)
        own = {i: self.tokenizer.encode(units[i].decode(), add_special_tokens=False).ids for i in np.flatnonzero(hard).tolist()}
        for i, ids in own.items():
            size[i] = len(ids)
        at = np.concatenate(([0], np.cumsum(size)))
        out = np.zeros(at[-1], np.uint32)
        body = np.repeat(~hard, size)
        out[body] = flat
        for i, ids in own.items():
            out[at[i] : at[i + 1]] = ids
        return out, size

    def encode(self, buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all documents, each with the end id, and their offsets."""
        docs = len(off) - 1
        if not len(buf):
            return np.full(docs, END_ID, np.uint32), np.arange(docs + 1)
        buf, s, e, first, hard = self._units(buf, off)
        keys, at, of = np.unique(tn.span_hash(buf, s, e), return_index=True, return_inverse=True)
        place = np.searchsorted(self._known, keys)
        place[place == len(self._known)] = 0
        new = self._known[place] != keys if len(self._known) else np.ones(len(keys), dtype=bool)
        if len(self._known) + new.sum() > CACHE_WORDS:
            self._known, self._begin, self._size, self._ids = self._known[:0], self._begin[:0], self._size[:0], self._ids[:0]
            new[:] = True
        if new.any():
            raw = buf.tobytes()
            units = [raw[x:y] for x, y in zip(s[at[new]].tolist(), e[at[new]].tolist(), strict=True)]
            flat, size = self._encode_units(units, hard[at[new]])
            begin = len(self._ids) + np.cumsum(size) - size
            where = np.searchsorted(self._known, keys[new])
            self._known = np.insert(self._known, where, keys[new])
            self._begin, self._size = np.insert(self._begin, where, begin), np.insert(self._size, where, size)
            self._ids = np.concatenate((self._ids, flat))
        place = np.searchsorted(self._known, keys)
        n = self._size[place][of]
        to = np.concatenate(([0], np.cumsum(n)))
        where = np.repeat(self._begin[place][of] - to[:-1], n) + np.arange(to[-1])
        ends = to[first[1:]]
        out = np.full(to[-1] + docs, END_ID, np.uint32)
        body = np.ones(len(out), dtype=bool)
        last = ends + np.arange(docs)
        body[last] = False
        out[body] = self._ids[where]
        return out, np.concatenate(([0], last + 1))


def difference(sizes: list[int], parts: int) -> np.ndarray:
    """The part of each item, by multiway differencing; ties go by order.

    A partial partition is its sums in falling order, less the smallest where all
    parts are taken, with one item that stands for each part. Parts that are
    joined point to one another, so nothing is kept of the merges.
    """
    n = len(sizes)
    if parts == 1 or not n:
        return np.zeros(n, np.int64)
    up = np.arange(n)
    state = {i: (np.array([x], np.int64), np.array([i])) for i, x in enumerate(sizes)}
    heap = [(-x, i) for i, x in enumerate(sizes)]
    heapq.heapify(heap)
    while len(heap) > 1:
        (sa, pa_), (sb, pb) = (state.pop(heapq.heappop(heap)[1]) for _ in range(2))
        free = parts - len(sa)
        if len(sb) > free:  # the smallest parts of one meet the largest of the other's rest
            meet = parts - 1 - np.arange(free, len(sb))
            sa = sa.copy()
            sa[meet] += sb[free:]
            up[pb[free:]] = pa_[meet]
        sums, of = np.concatenate((sa, sb[:free])), np.concatenate((pa_, pb[:free]))
        order = np.argsort(-sums, kind="stable")
        sums = sums[order]
        if len(sums) == parts:
            sums -= sums[-1]
        state[n] = (sums, of[order])
        heapq.heappush(heap, (-int(sums[0]), n))
        n += 1
    while (up != up[up]).any():
        up = up[up]
    number = np.zeros(len(sizes), np.int64)
    last = state.popitem()[1][1]
    number[last] = np.arange(len(last))
    return number[up]


def windows(sizes: list[int], capacity: int = CAPACITY) -> np.ndarray:
    """The window of each item; the fewest that differencing can fill."""
    sizes_ = np.array(sizes, np.int64)
    parts = max(1, -(-int(sizes_.sum()) // capacity), int((2 * sizes_ > capacity).sum()))
    while True:
        of = difference(sizes, parts)
        if np.bincount(of, sizes_, parts).max(initial=0) <= capacity:
            return of
        parts += 1


def bundles(sizes: list[int], least: int = BUNDLE) -> np.ndarray:
    """The bundle of each piece: small pieces join until they have ``least`` tokens, others are alone."""
    out, held, n, own = np.zeros(len(sizes), np.int64), 0, 0, -1
    for i, x in enumerate(sizes):
        if x >= least:
            out[i], n = n, n + 1
            continue
        if own < 0:
            own, n = n, n + 1
        out[i], held = own, held + x
        if held >= least:
            own, held = -1, 0
    return out


class _Packer:
    """Places of pieces: those of whole windows and full groups at once, the others when flushed."""

    def __init__(self, first: int, capacity: int) -> None:
        self.capacity, self.next = capacity, first
        self.rows: list[tuple] = []
        self.rest: list[tuple] = []
        self.held = 0

    def add(self, doc: int | None, ids: np.ndarray) -> None:
        n = len(ids)
        at = 0
        while n - at >= self.capacity:
            self.rows.append((doc, at, self.capacity, zlib.crc32(ids[at : at + self.capacity]), n, self.next, 0))
            self.next += 1
            at += self.capacity
        if at < n:
            self.piece((doc, at, n - at, zlib.crc32(ids[at:]), n))

    def piece(self, piece: tuple) -> None:
        self.rest.append(piece)
        self.held += piece[2]
        if self.held >= GROUP_WINDOWS * self.capacity or len(self.rest) >= GROUP_PIECES:
            self.flush()

    def flush(self) -> None:
        if not self.rest:
            return
        fill: dict[int, int] = {}
        sizes = [r[2] for r in self.rest]
        tied = bundles(sizes, min(BUNDLE, self.capacity // 64 + 1))
        of = windows(np.bincount(tied, sizes).astype(np.int64).tolist(), self.capacity)[tied].tolist()
        number = {w: self.next + i for i, w in enumerate(sorted(set(of)))}
        for r, w in zip(self.rest, of, strict=True):
            self.rows.append((*r, number[w], fill.get(w, 0)))
            fill[w] = fill.get(w, 0) + r[2]
        self.next += len(number)
        self.rest, self.held = [], 0

    def out(self) -> pa.RecordBatch:
        """The rows that have a place, with a key that only spreads them."""
        columns = list(zip(*self.rows, strict=True))
        keys = [-1 - r[5] % 4099 for r in self.rows]
        self.rows = []
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (*columns, keys)], names=_NAMES)

    def left(self, key: int) -> pa.RecordBatch:
        """The pieces that wait for others, numbered, with the key of those they meet."""
        rows = [(*r, self.next + k, None, key) for k, r in enumerate(self.rest)]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names=_NAMES)


_NAMES = [x.split()[0] for x in SCHEMA.split(", ")] + ["meet"]
_TOKENS: dict[str, WordTokens] = {}


def _pack(it: Iterator[pa.RecordBatch], path: str, capacity: int) -> Iterator[pa.RecordBatch]:
    tokens = _TOKENS.setdefault(path, None) or WordTokens(path)
    _TOKENS[path] = tokens
    task = TaskContext.get().partitionId()
    packer = _Packer(task << 33, capacity)
    for rows, buf, off in tn.batches(it):
        ids, at = tokens.encode(buf, off)
        at = at.tolist()
        for k, doc in enumerate(rows.column(0).to_pylist()):
            packer.add(doc, ids[at[k] : at[k + 1]])
        if packer.rows:
            yield packer.out()
    if packer.rest:
        yield packer.left(task // CARRY)


def _carry(it: Iterator[pa.RecordBatch], capacity: int) -> Iterator[pa.RecordBatch]:
    """Rows that have a place, as they are; then those that wait, by their key."""
    waiting: dict[int, list[tuple]] = {}
    for rows in it:
        placed = pc.less(rows.column(7), 0)
        yield rows.filter(placed).select(_NAMES[:-1])
        left = rows.filter(pc.invert(placed))
        for r in zip(*(c.to_pylist() for c in left.columns), strict=True):
            waiting.setdefault(r[7], []).append((r[5], r[:5]))
    for key in sorted(waiting):
        packer = _Packer((1 << 62) + (key << 33), capacity)
        for _, piece in sorted(waiting.pop(key), key=lambda x: x[0]):
            packer.piece(piece)
        packer.flush()
        yield packer.out().select(_NAMES[:-1])


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of the documents' ids with their window and place in it.

    ``tokenizer`` is the path of a vocabulary file that every executor has. The
    shuffle moves a row of eight numbers a piece, no text and no token.
    """
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(lambda it: _pack(it, tokenizer, capacity), SCHEMA + ", meet long")
    return own.repartition("meet").mapInArrow(lambda it: _carry(it, capacity), SCHEMA)


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op2(spark, sf_dir: str) -> DataFrame:
    """Every document packed into sequences of at most 4096 tokens."""
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"), tokenizer_path())
