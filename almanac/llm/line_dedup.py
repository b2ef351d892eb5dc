"""Line dedup by content-defined chunks of lines.

A hash rolls over the hashes of two neighbouring lines, and every window that it
sees, if not both lines are white space, is a chunk: a run of two lines holds
just one window, so any sparser rule loses some of the runs. A chunk that stands
in several places of the corpus stays at the first of them (by doc_id, then
place in the document), and a line goes if a chunk around it stays elsewhere.
Chunks overlap by a line, so a repeated run of any length goes from end to end,
whatever lines stand around it. Bytes are compared, not only hashes. Where in
one document a chunk overlaps its first place, it is no repeat. A stretch of two
or more blank lines is a chunk with the line before and with the line behind; of
stretches of different length only the lines next to the run go.

Lines end at ``\\n``. Null texts stay null; empty texts have no lines; rows
with a null doc_id are left alone and count as no occurrence; rows that share
a doc_id are judged alike. Other columns pass through.

Scale: chunks are summed by hash before the shuffle, so a chunk that a third of
all documents hold is one row a task; bytes are sent of chunks with a repeated
hash only, summed too, and come back to the documents only where two chunks
share a hash; texts are shuffled once and read twice.

``mark`` is the sparse form: a chunk ends where the low bits of the rolling hash
are zero, and only whole chunks of two or more lines go. The queries use ``runs``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from almanac.llm import textnp as tn
from almanac.llm.columns import adding, keeping, plus

#: A boundary stands behind a line in so many on average.
EVERY = 4
_REPEATS, _ADDED = "__line_repeats", ("n_lines", "n_removed")


def lines(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all lines, and the first line of each document (n + 1)."""
    full = np.flatnonzero(np.diff(off) > 0)
    breaks = np.flatnonzero(buf == 10)
    s = np.sort(np.concatenate((off[full], breaks + 1)))
    e = np.sort(np.concatenate((off[full + 1], breaks)))
    # a line of each document starts at its offset, so equal starts are an empty last line and the next document's
    first = np.zeros(len(off), np.int64)
    per = np.zeros(len(off) - 1, np.int64)
    per[full] = 1
    np.add.at(per, np.searchsorted(off, breaks, side="right") - 1, 1)
    first[1:] = np.cumsum(per)
    return s, e, first


def chunks(buf: np.ndarray, off: np.ndarray, every: int = EVERY) -> tuple[np.ndarray, np.ndarray, np.ndarray, tuple]:
    """First and last line and document of each chunk; and the lines."""
    s, e, first = lines(buf, off)
    n = len(s)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, z, (s, e, first)
    h = tn.span_hash(buf, s, e)
    end = np.zeros(n, dtype=bool)
    end[1:] = tn.ngram_hash(h, 2) % np.uint64(every) == 0
    starts = first[:-1][np.diff(first) > 0]
    end[starts] = False  # the hash would roll over two documents
    end[first[1:][np.diff(first) > 0] - 1] = True
    last = np.flatnonzero(end)
    begin = np.concatenate(([0], last[:-1] + 1))
    return begin, last, np.searchsorted(first, begin, side="right") - 1, (s, e, first)


def _blank(buf: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    solid = np.concatenate(([0], np.cumsum(tn.NONSPACE[buf])))
    return solid[e] == solid[s]


def _chunks(it: Iterator[pa.RecordBatch], every: int, with_bytes: bool) -> Iterator[pa.RecordBatch]:
    for rows, buf, off in tn.batches(it):
        a, b, doc, (s, e, _) = chunks(buf, off, every)
        several = (b > a) & ~_blank(buf, s[a], e[b]) if len(a) else np.zeros(0, bool)
        a, b, doc = a[several], b[several], doc[several]
        ids = rows.column(0).take(pa.array(doc))
        h = pa.array(tn.span_hash(buf, s[a], e[b]).view(np.int64))
        if with_bytes:
            raw = buf.tobytes()
            data = pa.array([raw[x:y] for x, y in zip(s[a].tolist(), e[b].tolist(), strict=True)], pa.binary())
            yield pa.RecordBatch.from_arrays([ids, h, data], names=["doc_id", "h", "bytes"])
        else:
            yield pa.RecordBatch.from_arrays([ids, h], names=["doc_id", "h"])


def _remove(it: Iterator[pa.RecordBatch], every: int) -> Iterator[pa.RecordBatch]:
    for rows, buf, off in tn.batches(it):
        names = rows.schema.names
        ids = rows.column(names.index("doc_id")).to_pylist()
        known = rows.column(names.index(_REPEATS)).to_pylist()
        texts = rows.column(names.index("text"))
        a, b, doc, (s, e, first) = chunks(buf, off, every)
        h = tn.span_hash(buf, s[a], e[b]).view(np.int64) if len(a) else np.zeros(0, np.int64)
        of = np.searchsorted(doc, np.arange(len(off)))
        raw = buf.tobytes()
        out, lost = {}, np.zeros(len(ids), np.int64)
        for d, repeats in enumerate(known):
            if not repeats:
                continue
            owner = {(r["h"], r["bytes"]): r["owner"] for r in repeats}
            hashes = {r["h"] for r in repeats}
            seen, gone = set(), []
            for c in range(of[d], of[d + 1]):
                if b[c] > a[c] and int(h[c]) in hashes:
                    key = (int(h[c]), raw[s[a[c]] : e[b[c]]])
                    if key in owner and (owner[key] < ids[d] or key in seen):
                        gone.append(c)
                    seen.add(key)
            if gone:
                keep = np.ones(first[d + 1] - first[d], bool)
                for c in gone:
                    keep[a[c] - first[d] : b[c] + 1 - first[d]] = False
                at = np.flatnonzero(keep) + first[d]
                out[d] = b"\n".join(raw[s[i] : e[i]] for i in at.tolist()).decode()
                lost[d] = len(keep) - len(at)
        if out:
            plain = texts.to_pylist()
            for d, t in out.items():
                plain[d] = t
            texts = pa.array(plain, pa.string())
        columns = [texts if n == "text" else rows.column(i) for i, n in enumerate(names) if n != _REPEATS]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(np.diff(first)), pa.array(lost)], names=[*(n for n in names if n != _REPEATS), "n_lines", "n_removed"])


def mark(docs: DataFrame, every: int = EVERY) -> DataFrame:
    """The documents with their text cleaned, n_lines and n_removed (lines)."""
    return adding(docs, _ADDED, lambda d: _mark(d, every), (_REPEATS,))


def _mark(docs: DataFrame, every: int) -> DataFrame:
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id IS NOT NULL")
    full = own.mapInArrow(lambda it: _chunks(it, every, True), "doc_id long, h long, bytes binary")
    repeated = full.groupBy("h", "bytes").agg(F.count("*").alias("n"), F.min("doc_id").alias("owner")).where("n > 1").drop("n")
    places = own.mapInArrow(lambda it: _chunks(it, every, False), "doc_id long, h long").distinct()
    known = places.join(repeated, "h").groupBy("doc_id").agg(F.collect_list(F.struct("h", "bytes", "owner")).alias(_REPEATS))
    held = docs.join(known, "doc_id", "left")
    return held.mapInArrow(lambda it: _remove(it, every), plus(held.drop(_REPEATS).schema, "n_lines long, n_removed long"))


def windows(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, tuple]:
    """First and last line and document of each chunk of ``runs``, in order; and the lines."""
    s, e, first = lines(buf, off)
    n = len(s)
    if n < 2:
        z = np.zeros(0, np.int64)
        return z, z, z, (s, e, first)
    doc, blank = tn.doc_of(first), _blank(buf, s, e)
    with_next = doc[1:] == doc[:-1]
    x = np.flatnonzero(with_next & ~(blank[1:] & blank[:-1]))
    # stretches of two or more blank lines, with the line before and the line behind
    on = with_next & blank[1:] & blank[:-1]
    begin = np.flatnonzero(on & ~np.concatenate(([False], on[:-1])))
    end = np.flatnonzero(on & ~np.concatenate((on[1:], [False]))) + 1
    before = begin > first[doc[begin]]
    behind = end + 1 < first[doc[end] + 1]
    a = np.concatenate((x, begin[before] - 1, begin[behind]))
    b = np.concatenate((x + 1, end[before], end[behind] + 1))
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    return a, b, doc[a], (s, e, first)


def _places(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashes of the chunks of each document, with their counts."""
    for rows, buf, off in tn.batches(it):
        a, b, doc, (s, e, _) = windows(buf, off)
        h = tn.span_hash(buf, s[a], e[b]).view(np.int64)
        order = np.lexsort((h, doc))
        h, doc = h[order], doc[order]
        new = np.flatnonzero(np.concatenate(([True], (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])))[: len(h)])
        count = np.diff(np.concatenate((new, [len(h)]))) if len(h) else new
        yield pa.RecordBatch.from_arrays([rows.column(0).take(pa.array(doc[new])), pa.array(h[new]), pa.array(count.astype(np.int64))], names=["doc_id", "h", "n"])


def _repeated(buf: np.ndarray, off: np.ndarray, hashes: list) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, tuple]:
    """``windows`` and their hashes, only those whose hash is among the document's given ones."""
    a, b, doc, found = windows(buf, off)
    h = tn.span_hash(buf, found[0][a], found[1][b]).view(np.int64)
    keep = np.zeros(len(a), bool)
    of = np.searchsorted(doc, np.arange(len(off)))
    for d, own in enumerate(hashes):
        if own:
            keep[of[d] : of[d + 1]] = np.isin(h[of[d] : of[d + 1]], np.array(own, np.int64))
    return a[keep], b[keep], doc[keep], h[keep], found


def _bytes(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bytes of the chunks whose hash is repeated, summed over a batch."""
    for rows, buf, off in tn.batches(it):
        names = rows.schema.names
        ids = rows.column(names.index("doc_id")).to_pylist()
        a, b, doc, h, (s, e, _) = _repeated(buf, off, rows.column(names.index(_REPEATS)).to_pylist())
        raw = buf.tobytes()
        sums: dict[tuple[int, bytes], list[int]] = {}
        for x, y, d, k in zip(s[a].tolist(), e[b].tolist(), doc.tolist(), h.tolist(), strict=True):
            own = sums.setdefault((k, raw[x:y]), [ids[d], 0])
            own[0] = min(own[0], ids[d])
            own[1] += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array([k for k, _ in sums], pa.int64()), pa.array([x for _, x in sums], pa.binary()), pa.array([x for x, _ in sums.values()], pa.int64()), pa.array([n for _, n in sums.values()], pa.int64())],
            names=["h", "bytes", "owner", "n"],
        )


def _clear(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, buf, off in tn.batches(it):
        names = rows.schema.names
        ids = rows.column(names.index("doc_id")).to_pylist()
        known = rows.column(names.index(_REPEATS)).to_pylist()
        texts = rows.column(names.index("text"))
        a, b, doc, h, (s, e, first) = _repeated(buf, off, [[r["h"] for r in x or ()] for x in known])
        of = np.searchsorted(doc, np.arange(len(off)))
        raw = buf.tobytes()
        out, lost = {}, np.zeros(len(ids), np.int64)
        for d, repeats in enumerate(known):
            if not repeats:
                continue
            owner = {(r["h"], r["bytes"]): r["owner"] for r in repeats}
            keep = np.ones(first[d + 1] - first[d], bool)
            ends: dict = {}
            for c in range(of[d], of[d + 1]):
                key = (int(h[c]), None)  # the only bytes with this hash
                if key not in owner:
                    key = (int(h[c]), raw[s[a[c]] : e[b[c]]])
                    if key not in owner:
                        continue
                if owner[key] < ids[d] or a[c] > ends.setdefault(key, b[c]):
                    keep[a[c] - first[d] : b[c] + 1 - first[d]] = False
            if not keep.all():
                at = np.flatnonzero(keep) + first[d]
                out[d] = b"\n".join(raw[s[i] : e[i]] for i in at.tolist()).decode()
                lost[d] = len(keep) - len(at)
        if out:
            plain = texts.to_pylist()
            for d, t in out.items():
                plain[d] = t
            texts = pa.array(plain, pa.string())
        columns = [texts if n == "text" else rows.column(i) for i, n in enumerate(names) if n != _REPEATS]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(np.diff(first)), pa.array(lost)], names=[*(n for n in names if n != _REPEATS), "n_lines", "n_removed"])


def runs(docs: DataFrame) -> DataFrame:
    """The documents without the runs of lines that stand earlier, n_lines and n_removed (lines)."""
    return adding(docs, _ADDED, _runs, (_REPEATS,))


def _runs(docs: DataFrame) -> DataFrame:
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id IS NOT NULL")
    places = own.mapInArrow(_places, "doc_id long, h long, n long")
    repeated = places.groupBy("h").agg(F.sum("n").alias("n")).where("n > 1").select("h")
    some = places.select("doc_id", "h").join(repeated, "h").groupBy("doc_id").agg(F.collect_list("h").alias(_REPEATS))
    # both joins with the texts keep all rows and columns, so that one exchange serves both
    sent = docs.join(some, "doc_id", "left").mapInArrow(_bytes, "h long, bytes binary, owner long, n long")
    equal = sent.groupBy("h", "bytes").agg(F.min("owner").alias("owner"), F.sum("n").alias("n"))
    equal = equal.groupBy("h").agg(F.collect_list(F.struct("bytes", "owner", "n")).alias("g"))
    equal = equal.select("h", F.size("g").alias("c"), F.explode(F.filter("g", lambda x: x["n"] > 1)).alias("x"))
    equal = equal.select("h", F.when(F.col("c") > 1, F.col("x.bytes")).alias("bytes"), F.col("x.owner").alias("owner"))
    known = places.select("doc_id", "h").join(equal, "h").groupBy("doc_id").agg(F.collect_list(F.struct("h", "bytes", "owner")).alias(_REPEATS))
    held = docs.join(known, "doc_id", "left")
    return held.mapInArrow(_clear, plus(held.drop(_REPEATS).schema, "n_lines long, n_removed long"))


def line_dedup(docs: DataFrame) -> DataFrame:
    """The documents without repeated runs of lines; a text that loses all its lines goes.

    The columns are those of ``docs``; n_chars, where there is one, is counted anew.
    """

    def clean(own: DataFrame) -> DataFrame:
        out = runs(own).where("n_removed = 0 OR n_removed < n_lines")
        if "n_chars" not in docs.columns:
            return out
        length = F.length("text").cast(docs.schema["n_chars"].dataType)
        return out.withColumn("n_chars", F.when(F.col("n_removed") > 0, length).otherwise(F.col("n_chars")))

    return keeping(docs, _ADDED, clean)


def op10(spark, sf_dir: str) -> DataFrame:
    """Lines of each document and what is left of it without repeated runs."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    text = F.coalesce("text", F.lit(""))
    return runs(docs).select("doc_id", "n_lines", "n_removed", F.length(text).cast("long").alias("kept_chars"), F.sha2(text, 256).alias("kept_sha256"))
