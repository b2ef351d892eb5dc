"""Benchmark decontamination with a generalised suffix automaton.

The normalised words of all test items make one automaton. Documents stream
past it; at each word it gives the longest run of words, ending there, that
some item holds. Runs of ``window`` words or more are hit (an item of fewer
words counts as one window of its own), and are cut from the text; a document
covered beyond ``max_coverage``, or with hits from ``max_items`` items, goes.

Words are those of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after A-Z became
a-z. Null and empty texts have no words and are never hit; items without
words, or with a null id, are ignored; repeated documents are judged each for
itself; an empty benchmark hits nothing. Other columns of the documents pass
through ``decontaminate`` untouched.

The items are the small side: they go to the tasks in blocks of at most
``BLOCK_WORDS`` words (or one item), one automaton and one pass over the documents
a block. A pass is written before the next one begins, so that the driver holds one
block and a task one automaton, however large the benchmark is. A bitmap of the
windows' hashes says where the automaton need not look; it errs to one side only,
and what is hit is decided by the automaton's matching lengths.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from almanac.llm import textnp as tn
from almanac.llm.columns import adding, keeping, plus
from almanac.llm.store import checkpoint

WINDOW = 8
#: Words of one automaton: about 1 kB each in a task's memory.
BLOCK_WORDS = 200_000
_FILTER_BITS = 23


class SuffixAutomaton:
    """Generalised suffix automaton over word hashes, with the items of each state."""

    def __init__(self, items: list[tuple[str, list[int]]], window: int = WINDOW) -> None:
        self.window = window
        self.next: list[dict[int, int]] = [{}]
        self.link, self.len = [-1], [0]
        ends: dict[int, set[str]] = {}
        whole: dict[int, set[str]] = {}
        for name, words in items:
            at = 0
            for w in words:
                at = self._extend(at, w)
                ends.setdefault(at, set()).add(name)
            if 0 < len(words) < window:
                whole.setdefault(at, set()).add(name)
        # items of the states whose strings include one of exactly `window` words
        self.items: dict[int, set[str]] = {}
        for s in sorted(ends, key=lambda s: -self.len[s]):
            t = self._at_window(s)
            if t:
                self.items.setdefault(t, set()).update(ends[s])
        # an end's suffixes are the states above it; states below may hold further items
        for s in sorted(range(1, len(self.len)), key=lambda s: -self.len[s]):
            t = self._at_window(s)
            if t and t != s and s in self.items:
                self.items.setdefault(t, set()).update(self.items[s])
        self.whole = whole
        #: The nearest state at or above each one that is a whole short item.
        self.short = [0] * len(self.len)
        for s in sorted(range(1, len(self.len)), key=lambda s: self.len[s]):
            self.short[s] = s if s in whole else self.short[self.link[s]]

    def _extend(self, last: int, w: int) -> int:
        nxt, link, length = self.next, self.link, self.len
        if w in nxt[last]:
            q = nxt[last][w]
            return q if length[q] == length[last] + 1 else self._clone(last, w, q)
        cur = len(length)
        nxt.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p != -1 and w not in nxt[p]:
            nxt[p][w] = cur
            p = link[p]
        if p != -1:
            q = nxt[p][w]
            link[cur] = q if length[q] == length[p] + 1 else self._clone(p, w, q)
        return cur

    def _clone(self, p: int, w: int, q: int) -> int:
        new = len(self.len)
        self.next.append(dict(self.next[q]))
        self.link.append(self.link[q])
        self.len.append(self.len[p] + 1)
        self.link[q] = new
        while p != -1 and self.next[p].get(w) == q:
            self.next[p][w] = new
            p = self.link[p]
        return new

    def _at_window(self, s: int) -> int:
        """The state of the last `window` words of a state's longest string; 0 if shorter."""
        if self.len[s] < self.window:
            return 0
        while self.len[self.link[s]] >= self.window:
            s = self.link[s]
        return s

    def stream(self, words: list[int], hit: np.ndarray, base: int, found: set[str]) -> None:
        """Marks in ``hit[base:]`` the words of long matches; adds their items."""
        nxt, link, length, window = self.next, self.link, self.len, self.window
        s = match = 0
        for i, w in enumerate(words):
            while s and w not in nxt[s]:
                s = link[s]
                match = length[s]
            if w not in nxt[s]:
                continue
            s, match = nxt[s][w], match + 1
            if match >= window:
                hit[base + i + 1 - match : base + i + 1] = True
                t = s
                while length[link[t]] >= window:
                    t = link[t]
                found |= self.items[t]
            # the state's own string may be longer than what matched here
            t = s
            while length[link[t]] >= match:
                t = link[t]
            t = self.short[t if length[t] <= match else link[t]]
            while t:
                hit[base + i + 1 - length[t] : base + i + 1] = True
                found |= self.whole[t]
                t = self.short[link[t]]


class Matcher:
    """An automaton behind a bitmap of the windows' hashes: stretches without any are skipped."""

    def __init__(self, items: list[tuple[str, bytes]], window: int) -> None:
        hashed = [(name, np.frombuffer(words, dtype=np.uint64)) for name, words in items]
        self.automaton = SuffixAutomaton([(n, w.tolist()) for n, w in hashed], window)
        self.screen: dict[int, np.ndarray] = {}
        for _, w in hashed:
            if len(w):
                n = min(window, len(w))
                self.screen.setdefault(n, np.zeros(1 << _FILTER_BITS, dtype=bool))[tn.ngram_hash(w, n) >> np.uint64(64 - _FILTER_BITS)] = True

    def match(self, words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, dict[int, set[str]]]:
        """Hit words, and the items found in each document that has any."""
        total = len(words)
        near = np.zeros(total, dtype=bool)
        for n, screen in self.screen.items():
            at = np.flatnonzero(screen[tn.ngram_hash(words, n) >> np.uint64(64 - _FILTER_BITS)])
            if len(at):
                near |= tn.cover(at, n, total)
        hit, found = np.zeros(total, dtype=bool), {}
        edge = np.flatnonzero(np.diff(np.concatenate(([False], near, [False])).astype(np.int8)))
        for a, b in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
            d = int(np.searchsorted(first, a, side="right")) - 1
            while a < b:  # a stretch can run over the end of a document
                stop = min(b, int(first[d + 1]))
                if stop > a:
                    got: set[str] = set()
                    self.automaton.stream(words[a:stop].tolist(), hit, a, got)
                    if got:
                        found.setdefault(d, set()).update(got)
                a, d = max(a, stop), d + 1
        return hit, found


def _blocks(benchmark: DataFrame) -> Iterator[list[tuple[str, bytes]]]:
    """Item names and word hashes in blocks, streamed through the driver one at a time; one empty block if there are none."""
    block: list[tuple[str, bytes]] = []
    size, any_ = 0, False
    rows = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text").where("item_id IS NOT NULL AND text IS NOT NULL")
    for row in rows.toLocalIterator():
        buf, off = tn.flatten(pa.array([row["text"]]))
        buf = tn.LOWER[buf]
        s, e, _ = tn.spans(buf, off, tn.ALNUM)
        if not len(s):
            continue
        if size and size + len(s) > BLOCK_WORDS:
            yield block
            block, size, any_ = [], 0, True
        size += len(s)
        block.append((row["item_id"], tn.span_hash(buf, s, e).tobytes()))
    if block or not any_:
        yield block


_MATCHERS: dict[int, Matcher] = {}


def _scan(it: Iterator[pa.RecordBatch], items: list[tuple[str, bytes]], window: int, key: int, cut: bool) -> Iterator[pa.RecordBatch]:
    if key not in _MATCHERS:
        _MATCHERS.clear()
        _MATCHERS[key] = Matcher(items, window)
    matcher = _MATCHERS[key]
    for rows, buf, off in tn.batches(it):
        buf = tn.LOWER[buf]
        s, e, first = tn.spans(buf, off, tn.ALNUM)
        hit, found = matcher.match(tn.span_hash(buf, s, e), first)
        names = [sorted(found.get(d, ())) for d in range(len(first) - 1)]
        runs = []
        for d in range(len(first) - 1):
            a, b = int(first[d]), int(first[d + 1])
            if d in found:
                edge = np.flatnonzero(np.diff(np.concatenate(([False], hit[a:b], [False])).astype(np.int8)))
                runs.append([{"first": int(x), "last": int(y) - 1, "start": int(s[a + x] - off[d]), "end": int(e[a + y - 1] - off[d])} for x, y in zip(edge[::2], edge[1::2], strict=True)])
            else:
                runs.append([])
        if "hit_items" in rows.schema.names:  # of an earlier block of items
            names = [sorted({*x, *y}) for x, y in zip(names, rows.column(rows.schema.get_field_index("hit_items")).to_pylist(), strict=True)]
            runs = [_merge(x, y) for x, y in zip(runs, rows.column(rows.schema.get_field_index("hit_spans")).to_pylist(), strict=True)]
        if cut and any(runs):
            at = rows.schema.get_field_index("text")
            texts = [_without(t, r) for t, r in zip(rows.column(at).to_pylist(), runs, strict=True)]
            rows = rows.set_column(at, rows.schema.field(at), pa.array(texts, rows.schema.field(at).type))
        columns = [rows.column(i) for i, n in enumerate(rows.schema.names) if n not in ("n_words", "hit_items", "hit_spans")]
        kept = [f for f in rows.schema if f.name not in ("n_words", "hit_items", "hit_spans")]
        schema = pa.schema([*kept, ("n_words", pa.int64()), ("hit_items", pa.list_(pa.string())), ("hit_spans", _SPANS)])
        yield pa.RecordBatch.from_arrays([*columns, pa.array(np.diff(first), pa.int64()), pa.array(names, pa.list_(pa.string())), pa.array(runs, _SPANS)], schema=schema)


_ADDED = ("n_words", "hit_items", "hit_spans")
_SPANS = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64()), ("start", pa.int64()), ("end", pa.int64())]))
_DDL = "n_words long, hit_items array<string>, hit_spans array<struct<first:long,last:long,start:long,end:long>>"


def _merge(x: list[dict], y: list[dict]) -> list[dict]:
    out: list[dict] = []
    for r in sorted([*x, *y], key=lambda r: (r["first"], r["last"])):
        if out and r["first"] <= out[-1]["last"] + 1:
            if r["last"] > out[-1]["last"]:
                out[-1] |= {"last": r["last"], "end": r["end"]}
        else:
            out.append(dict(r))
    return out


def _without(text: str | None, spans: list[dict]) -> str | None:
    """The text less its spans."""
    if not spans:
        return text
    raw, at, parts = text.encode(), 0, []
    for s in spans:
        parts.append(raw[at : s["start"]])
        at = s["end"]
    return b"".join([*parts, raw[at:]]).decode()


def scan(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, cut: bool = False) -> DataFrame:
    """The documents with n_words, hit_items (sorted ids) and hit_spans.

    A span has its first and last word and its byte range in the UTF-8 text.
    Columns of those three names in the input are replaced. With ``cut`` the text
    comes without its spans. No shuffle.
    """
    return adding(docs, _ADDED, lambda own: _scanned(own, benchmark, window, cut))


def _scanned(out: DataFrame, benchmark: DataFrame, window: int, cut: bool) -> DataFrame:
    blocks = _blocks(benchmark)
    block = next(blocks)
    while True:
        after = next(blocks, None)
        key = hash((window, tuple(block)))
        last = cut and after is None
        out = out.mapInArrow(lambda it, block=block, key=key, last=last: _scan(it, block, window, key, last), plus(out.drop(*_ADDED).schema, _DDL))
        if after is None:
            return out
        out, block = checkpoint(out), after


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, max_items: int = 2, max_coverage: float = 0.5) -> DataFrame:
    """The documents without what they share with the benchmark.

    Every hit span is cut. A document goes if its spans come from ``max_items``
    items or more, or cover more than ``max_coverage`` of its words. The columns
    are those of ``docs``; n_chars, where there is one, is counted anew.
    """

    def clean(own: DataFrame) -> DataFrame:
        marked = scan(own, benchmark, window, cut=True)
        hit = F.aggregate("hit_spans", F.lit(0).cast("long"), lambda a, s: a + s["last"] - s["first"] + 1)
        out = marked.where((F.size("hit_items") < max_items) & (hit <= F.lit(max_coverage) * F.col("n_words")))
        if "n_chars" not in docs.columns:
            return out
        length = F.length("text").cast(docs.schema["n_chars"].dataType)
        return out.withColumn("n_chars", F.when(F.size("hit_spans") > 0, length).otherwise(F.col("n_chars")))

    return keeping(docs, _ADDED, clean)


def op3(spark, sf_dir: str) -> DataFrame:
    """Each document's contamination by the benchmark, as digest columns."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    marked = scan(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    n_items = F.size("hit_items").cast("long")
    return marked.select(
        "doc_id",
        "n_words",
        F.aggregate("hit_spans", F.lit(0).cast("long"), lambda a, s: a + s["last"] - s["first"] + 1).alias("n_hit"),
        n_items.alias("n_items"),
        F.sha2(F.concat_ws(",", "hit_items"), 256).alias("items_sha256"),
        (n_items >= 2).alias("contaminated"),
    )
