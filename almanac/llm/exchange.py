"""Which content stands in several places: names go out, verdicts come back.

Documents are packed into batches of a few megabytes, whose compressed texts are
shuffled once. A round has three steps. Each batch sends its names (64-bit
hashes, sorted, as differences, in a few large rows) to buckets by the names'
leading bits. A bucket finds the names that several batches sent. Each batch
gets back those of its own names.

A name that a third of all documents hold is one entry a batch, so no bucket or
batch is larger than its share. Names travel as packed bytes; a row is a
(batch, bucket) pair, not a name. Buckets grow in number with the input, so beyond
2**HOP_BITS of them a batch sends to as many ranges of buckets instead; the rows of a
range and of a group of batches meet, and are dealt on to the range's buckets,
whose verdicts come back the same way. So a batch never has more than 2**HOP_BITS
rows, and a row many names, however large the input is.

Batches are numbered by partition and place. The documents should come from files
or a checkpoint, whose partitions hold the same rows in the same order when a lost
task runs again; rows straight from a shuffle may not.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from almanac.llm import textnp as tn

#: Bytes of names that a bucket gathers, about; it sets the number of buckets.
BUCKET_BYTES = 8 << 20
#: Bytes of the input that a partition gets at most, about.
PART_BYTES = 128 << 20
#: Leading bits of a name up to which batches send to buckets directly; bits of buckets that a task deals on at once.
HOP_BITS, TASK_BITS = 10, 6
#: Bytes of text of a packed batch, about.
PACKED_BYTES = 4 << 20
SENT = "bucket int, grp int, batch long, names binary"
_DEALT = "bucket int, grp int, fine int, names binary"
_BACK = "bucket int, grp int, names binary"
GOT = "batch long, names binary"
PACKED = "batch long, ids array<long>, sizes binary, texts binary, notes binary"


def encode(keys: np.ndarray, *more: np.ndarray) -> bytes:
    """Sorted keys and what goes with them, as byte planes of differences."""
    n = len(keys)
    planes = [np.ascontiguousarray(np.diff(keys, prepend=np.uint64(0)).view(np.uint8).reshape(n, 8).T)]
    planes += [np.ascontiguousarray(x.astype(np.uint64).view(np.uint8).reshape(n, 8).T) for x in more]
    return struct.pack("<QB", n, len(planes)) + zstandard.ZstdCompressor(level=1).compress(b"".join(p.tobytes() for p in planes))


def decode(blob: bytes) -> list[np.ndarray]:
    n, count = struct.unpack_from("<QB", blob)
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob[9:], max_output_size=8 * n * count), np.uint8).reshape(count, 8, n)
    out = [np.ascontiguousarray(p.T).reshape(-1).view(np.uint64) for p in raw]
    out[0] = np.cumsum(out[0], dtype=np.uint64)
    return out


@dataclass(frozen=True)
class Buckets:
    """How names are dealt: the leading bits that choose a bucket, and those that a batch sends by."""

    bits: int
    hop: int = HOP_BITS

    @property
    def direct(self) -> bool:
        return self.bits <= self.hop

    @property
    def coarse(self) -> int:
        return min(self.bits, self.hop)

    @property
    def groups(self) -> int:
        """Groups of batches: a task gets so many buckets' names of a range."""
        return 1 << max(0, self.bits - self.hop - TASK_BITS)

    def group(self, batch: np.ndarray) -> np.ndarray:
        return (tn.mix(np.asarray(batch, np.int64).view(np.uint64)) & np.uint64(self.groups - 1)).astype(np.int32)


def _size(docs: DataFrame) -> int | None:
    """The optimizer's size of the input; None where it has none, as for rows that come from an RDD."""
    size = int(str(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return size if size < 1 << 58 else None


def buckets(docs: DataFrame) -> Buckets:
    """Buckets for the documents' names, from the size of the input; without one, texts are measured."""
    size = _size(docs)
    if size is None:
        size = docs.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    return Buckets(max(6, min(20, (size // BUCKET_BYTES).bit_length())), HOP_BITS)


def parts(docs: DataFrame) -> int:
    """Partitions for the documents' rows: the session's number, or more where one would get more than PART_BYTES."""
    return max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), (_size(docs) or 0) // PART_BYTES)


def pack(docs: DataFrame, notes: Callable[[np.ndarray, np.ndarray], bytes] | None = None, most: int = PACKED_BYTES) -> DataFrame:
    """The documents in batches of at most ``most`` bytes (or one document).

    ``notes`` makes, of a batch's bytes and offsets, what later rounds need again.
    """

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, squeeze = TaskContext.get().partitionId() << 32, zstandard.ZstdCompressor(level=3)
        for rows, buf, off in tn.batches(it, most):
            ids = pa.array([rows.column(0).to_pylist()], pa.list_(pa.int64()))
            columns = [pa.array([number]), ids, pa.array([np.diff(off).tobytes()], pa.binary()), pa.array([squeeze.compress(buf.tobytes())], pa.binary())]
            columns.append(pa.array([notes(buf, off) if notes else b""], pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, names=["batch", "ids", "sizes", "texts", "notes"])
            number += 1

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, PACKED)


def unpack(batch: pa.Table) -> tuple[list, np.ndarray, np.ndarray]:
    """Document ids, bytes and offsets of a packed batch."""
    off = np.concatenate(([0], np.cumsum(np.frombuffer(batch.column("sizes")[0].as_py(), np.int64))))
    raw = zstandard.ZstdDecompressor().decompress(batch.column("texts")[0].as_py(), max_output_size=int(off[-1])) if off[-1] else b""
    return batch.column("ids")[0].as_py(), np.frombuffer(raw, np.uint8), off


def _edges(keys: np.ndarray, bits: int) -> np.ndarray:
    """Where each range of names by leading bits begins among sorted ones, and the end."""
    edge = np.searchsorted(keys, np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits))
    return np.concatenate(([0], edge, [len(keys)]))


def send(batch: int, to: Buckets, keys: np.ndarray, *more: np.ndarray) -> pa.Table:
    """Rows (bucket, grp, batch, names) of sorted distinct keys."""
    edge = _edges(keys, to.coarse)
    full = np.flatnonzero(np.diff(edge))
    blobs = [encode(keys[edge[b] : edge[b + 1]], *(x[edge[b] : edge[b + 1]] for x in more)) for b in full.tolist()]
    own = np.full(len(full), batch, np.int64)
    return pa.table({"bucket": pa.array(full, pa.int32()), "grp": pa.array(to.group(own), pa.int32()), "batch": pa.array(own), "names": pa.array(blobs, pa.binary())})


def _decoded(table: pa.Table) -> list[list[np.ndarray]]:
    return [decode(b.as_buffer().to_pybytes()) for b in table.column("names")]


def _joined(rows: list[list[np.ndarray]]) -> list[np.ndarray]:
    return [np.concatenate([r[k] for r in rows]) for k in range(len(rows[0]))]


def _tagged(table: pa.Table) -> list[np.ndarray]:
    """All names of rows that each come from one batch, what goes with them, and their batches."""
    rows = _decoded(table)
    return [*_joined(rows), np.repeat(table.column("batch").to_numpy(), [len(r[0]) for r in rows]).view(np.uint64)]


def _deal(to: Buckets):
    """The names of a range and a group of batches, to the range's buckets."""

    def run(table: pa.Table) -> pa.Table:
        planes = _tagged(table)
        order = np.argsort(planes[0], kind="stable")
        planes = [x[order] for x in planes]
        at, grp = table.column("bucket")[0].as_py(), table.column("grp")[0].as_py()
        first = at << (to.bits - to.coarse)
        rest = planes[0] << np.uint64(to.coarse)  # what is left of a name orders it in its range
        edge = _edges(rest, to.bits - to.coarse)
        full = np.flatnonzero(np.diff(edge))
        blobs = [encode(*(x[edge[b] : edge[b + 1]] for x in planes)) for b in full.tolist()]
        n = len(full)
        return pa.table({"bucket": pa.array(np.full(n, at, np.int32)), "grp": pa.array(np.full(n, grp, np.int32)), "fine": pa.array((full + first).astype(np.int32)), "names": pa.array(blobs, pa.binary())})

    return run


def _home(table: pa.Table) -> pa.Table:
    """Verdicts of a range's buckets for a group of batches, to each of these."""
    *planes, of = _joined(_decoded(table))
    order = np.argsort(of, kind="stable")
    begin = np.flatnonzero(starts(of[order]))
    at = np.split(order, begin[1:]) if len(order) else []
    return pa.table({"batch": pa.array(of[order][begin].view(np.int64)), "names": pa.array([encode(*(x[k] for x in planes)) for k in at], pa.binary())})


def per_bucket(sent: DataFrame, to: Buckets, f: Callable[[pa.Table], pa.Table]) -> DataFrame:
    """``f`` of each bucket's names, which gathers them and replies; its verdicts by batch."""
    if to.direct:
        return sent.groupBy("bucket").applyInArrow(f, GOT)
    dealt = sent.groupBy("bucket", "grp").applyInArrow(_deal(to), _DEALT)
    return dealt.groupBy("fine").applyInArrow(f, _BACK).groupBy("bucket", "grp").applyInArrow(_home, GOT)


def bucket_of(table: pa.Table) -> int:
    return table.column("fine" if "fine" in table.column_names else "bucket")[0].as_py()


def gather(table: pa.Table) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """All names of a bucket in order, what goes with them, and the batch of each."""
    planes = _joined(_decoded(table)) if "fine" in table.column_names else _tagged(table)
    order = np.argsort(planes[0], kind="stable")
    keys, *more, of = (x[order] for x in planes)
    return keys, more, of.view(np.int64)


def reply(table: pa.Table, to: Buckets, of: np.ndarray, chosen: np.ndarray, keys: np.ndarray, *more: np.ndarray) -> pa.Table:
    """The chosen names, with what goes with them, for the batches that they are of."""
    at = np.flatnonzero(chosen)
    if "fine" not in table.column_names:
        at = at[np.argsort(of[at], kind="stable")]
        batches, begin = np.unique(of[at], return_index=True)
        blobs = [encode(keys[x], *(m[x] for m in more)) for x in np.split(at, begin[1:])] if len(at) else []
        return pa.table({"batch": pa.array(batches, pa.int64()), "names": pa.array(blobs, pa.binary())})
    at = at[np.argsort(to.group(of[at]), kind="stable")]
    groups, begin = np.unique(to.group(of[at]), return_index=True)
    blobs = [encode(keys[x], *(m[x] for m in more), of[x].view(np.uint64)) for x in np.split(at, begin[1:])] if len(at) else []
    return pa.table({"bucket": pa.array(np.full(len(blobs), table.column("bucket")[0].as_py(), np.int32)), "grp": pa.array(groups, pa.int32()), "names": pa.array(blobs, pa.binary())})


def starts(*keys: np.ndarray) -> np.ndarray:
    """Where a run of equal values (in all arrays) begins."""
    n = len(keys[0])
    new = np.zeros(n, dtype=bool)
    if n:
        new[0] = True
        for k in keys:
            new[1:] |= k[1:] != k[:-1]
    return new


def shared(sent: DataFrame, to: Buckets) -> DataFrame:
    """Back to each batch: its names that another batch also sent.

    With each name goes a check (or none), and a 1 if the batch itself holds
    the name repeatedly.
    """

    def run(table: pa.Table) -> pa.Table:
        keys, (*check, multi), of = gather(table)
        if check:
            order = np.lexsort((check[0], keys))
            keys, check, multi, of = keys[order], [check[0][order]], multi[order], of[order]
        begin = np.flatnonzero(starts(keys, *check))
        count = np.diff(np.append(begin, len(keys)))
        many = (count > 1) | (np.add.reduceat(multi, begin) > 0)
        return reply(table, to, of, np.repeat(many, count), keys, *check)

    return per_bucket(sent, to, run)


def counted(sent: DataFrame, to: Buckets) -> DataFrame:
    """Back to each batch: its names that stand in several places of all batches, with their number of places."""

    def run(table: pa.Table) -> pa.Table:
        keys, (n,), of = gather(table)
        begin = np.flatnonzero(starts(keys))
        total = np.repeat(np.add.reduceat(n, begin), np.diff(np.append(begin, len(keys))))
        return reply(table, to, of, total > 1, keys, total)

    return per_bucket(sent, to, run)


def smallest(sent: DataFrame, to: Buckets) -> DataFrame:
    """Back to each batch: its (name, check) with the smallest value of all batches, where that is smaller than its own."""

    def run(table: pa.Table) -> pa.Table:
        keys, (check, value), of = gather(table)
        order = np.lexsort((check, keys))
        keys, check, value, of = keys[order], check[order], value[order], of[order]
        begin = np.flatnonzero(starts(keys, check))
        low = np.repeat(np.minimum.reduceat(value, begin), np.diff(np.append(begin, len(keys))))
        return reply(table, to, of, low < value, keys, check, low)

    return per_bucket(sent, to, run)


def received(table: pa.Table, width: int = 1) -> list[np.ndarray]:
    """All verdicts that a batch got, in the order of the names."""
    if not table.num_rows:
        return [np.zeros(0, np.uint64)] * width
    rows = [decode(b.as_buffer().to_pybytes()) for b in table.column("names")]
    out = [np.concatenate([r[k] for r in rows]) for k in range(width)]
    order = np.argsort(out[0], kind="stable")
    return [x[order] for x in out]


def found(keys: np.ndarray, among: np.ndarray) -> np.ndarray:
    """Whether each key is one of the sorted others."""
    if not len(among):
        return np.zeros(len(keys), dtype=bool)
    at = np.searchsorted(among, keys)
    at[at == len(among)] = 0
    return among[at] == keys


def per_batch(packed: DataFrame, got: DataFrame, f: Callable[[pa.Table, pa.Table], pa.Table], schema: str) -> DataFrame:
    """``f`` of each batch and the verdicts it got (none: no rows)."""
    return packed.groupBy("batch").cogroup(got.groupBy("batch")).applyInArrow(f, schema)


def each(packed: DataFrame, f: Callable[[pa.Table], pa.Table], schema: str) -> DataFrame:
    """``f`` of each batch, before any verdict."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in it:
            for k in range(rows.num_rows):
                yield from f(pa.Table.from_batches([rows.slice(k, 1)])).to_batches()

    return packed.mapInArrow(run, schema)
