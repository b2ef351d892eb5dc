"""MinHash near-dedup by an inverted join on signature coordinates.

A text's set is its distinct ``n``-word shingles (fewer words: all of them as
one; no words: empty, linked with nothing). Texts with equal sets make a class,
named by a number of its own; only the text of its smallest doc_id goes on.
``COORDINATES`` minima sign a set, and a pair with ``least_matches`` equal ones
goes to the check of its full sets; a pair at the threshold has fewer with a
probability of about 1e-7.

Every (coordinate, value) pair is an inverted list. How long each list is, is
counted over the whole corpus first, and a class is posted in the lists of its
rarest coordinates only, ``COORDINATES - least_matches + 1`` of them (prefix): two
classes with enough matches meet in one of these lists, and the long lists are
skipped, unless a class has nothing rarer. Lists of one member are not posted.
Collisions of those that meet are counted over the whole signature.

Groups of copies are never expanded into all pairs. In each list the member
whose values are the most frequent is the hub, and all others are checked
against it; links join components. Where a list still holds several
components, its members meet in blocks of a bounded size, which count collisions
across components, verify the likeliest pairs first, and return only links that
join two components: fewer rows than members. Lists of more than ``BLOCK`` members
are first divided by a second coordinate: two classes with enough matches share
two of their rarest ``COORDINATES - least_matches + 2``. Blocks compare sets of 32-bit
hashes; all links are confirmed on full sets, and should one of them fail the
step is repeated with these. No link that could join two components stays unchecked.

Words are ``[^\\x20\\x09-\\x0D]+`` after A-Z became a-z; null is empty. Rows
with a null doc_id belong to no component. Rows that share a doc_id are judged
each for itself: a row is told by its doc_id and a 64-bit hash of its text, and a
component is shown by its smallest doc_id, so unlike texts of one doc_id may show
the same component_id. ``kept`` is true for every row that has this doc_id;
``near_dedup`` keeps one row of each component. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from almanac.llm import exchange as ex
from almanac.llm import textnp as tn
from almanac.llm.store import checkpoint
from almanac.operators.graph import components

COORDINATES = 64
#: Members of a list that are compared with as many others at once.
BLOCK = 2048
_A = np.random.RandomState(77).randint(0, 1 << 62, COORDINATES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def least_matches(percent: int, coordinates: int = COORDINATES) -> int:
    """Collisions that a pair at the threshold has but for about 1 in 10**8."""
    p = percent / 100
    return max(1, int(coordinates * p - 5.6 * (coordinates * p * (1 - p)) ** 0.5))


def sets(buf: np.ndarray, off: np.ndarray, n: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each document."""
    buf = tn.LOWER[buf]
    s, e, first = tn.spans(buf, off, tn.NONSPACE)
    w = tn.span_hash(buf, s, e)
    h = tn.ngram_hash(w, n)
    out = []
    for d in range(len(off) - 1):
        a, b = int(first[d]), int(first[d + 1])
        if b - a >= n:
            out.append(np.unique(h[a : b - n + 1]))
        elif b > a:
            out.append(tn.ngram_hash(w[a:b], b - a, salt=b - a))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def _sign(it: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    for rows, buf, off in tn.batches(it):
        own = sets(buf, off, n)
        size = np.array([len(x) for x in own], np.int64)
        full = np.flatnonzero(size)
        low = np.zeros((len(own), COORDINATES), np.uint64)
        digest = np.zeros((2, len(own)), np.uint64)
        if len(full):
            u = np.concatenate(own)
            at = np.concatenate(([0], np.cumsum(size)))[full]
            for k in range(COORDINATES):
                low[full, k] = np.minimum.reduceat(u * _A[k], at)
            for k in range(2):
                digest[k, full] = np.add.reduceat(tn.mix(u + np.uint64(k + 1)), at)
        sig = np.ascontiguousarray((tn.mix(low) >> np.uint64(32)).astype(np.uint32))
        yield pa.RecordBatch.from_arrays(
            [rows.column(0), rows.column(2), pa.array(size), *(pa.array(x.view(np.int64)) for x in digest), pa.array([x.tobytes() for x in sig], pa.binary())],
            names=["doc_id", "t", "n_shingles", "h1", "h2", "sig"],
        )


def _signatures(blobs: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(blobs), np.uint32).reshape(-1, COORDINATES)


def _keys(sig: np.ndarray) -> np.ndarray:
    """The (coordinate, value) pairs of signatures, as numbers."""
    return (np.arange(COORDINATES, dtype=np.uint64) << np.uint64(32)) | sig.astype(np.uint64)


def _chunks(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Classes in rows of a batch each: reps and signatures."""
    number = TaskContext.get().partitionId() << 32
    for rows in it:
        if rows.num_rows:
            reps = np.array(rows.column(0).to_pylist(), np.int64).tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([number]), pa.array([reps], pa.binary()), pa.array([b"".join(rows.column(1).to_pylist())], pa.binary())], names=["batch", "reps", "sigs"])
            number += 1


def _name_lists(to: ex.Buckets):
    def run(chunk: pa.Table) -> pa.Table:
        names, n = np.unique(tn.mix(_keys(_signatures(chunk.column("sigs").to_pylist()))), return_counts=True)
        return ex.send(chunk.column("batch")[0].as_py(), to, names, n.astype(np.uint64))

    return run


def _post(least: int):
    """The lists in which each class of a chunk is posted, from the lengths of those that several classes share."""

    def run(chunk: pa.Table, got: pa.Table) -> pa.Table:
        reps = np.frombuffer(b"".join(chunk.column("reps").to_pylist()), np.int64)
        keys = _keys(_signatures(chunk.column("sigs").to_pylist()))
        names, (shared, n) = tn.mix(keys), ex.received(got, 2)
        count = np.ones(keys.shape, np.int64)
        if len(shared):
            at = np.searchsorted(shared, names)
            at[at == len(shared)] = 0
            count = np.where(shared[at] == names, n[at].astype(np.int64), 1)
        order = np.lexsort((names, count), axis=1)
        place = np.empty_like(order)
        np.put_along_axis(place, order, np.broadcast_to(np.arange(COORDINATES), order.shape), axis=1)
        prefix = COORDINATES - least + 1
        bit = np.uint64(1) << np.arange(COORDINATES, dtype=np.uint64)
        posted = (place < prefix) & (count > 1)
        mask, more = (np.where(x, bit, np.uint64(0)).sum(1, dtype=np.uint64).view(np.int64) for x in (posted, (place <= prefix) & (count > 1)))
        weight = np.where(posted, count, 0).sum(1)
        row, coordinate = np.nonzero(posted)
        return pa.table({"key": keys[row, coordinate].view(np.int64), "rep": reps[row], "w": weight[row], "mask": mask[row], "more": more[row]})

    return run


def _divide(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Members of a long list once for each further coordinate among their rarest."""
    for rows in it:
        keys = _keys(_signatures(rows.column(5).to_pylist())) if rows.num_rows else np.zeros((0, COORDINATES), np.uint64)
        key = rows.column(0).to_numpy().astype(np.uint64)
        more = rows.column(4).to_numpy().view(np.uint64)
        on = ((more[:, None] >> np.arange(COORDINATES, dtype=np.uint64)) & np.uint64(1)).astype(bool) & (keys != key[:, None])
        row, coordinate = np.nonzero(on)
        yield pa.RecordBatch.from_arrays([*(rows.column(k).take(pa.array(row)) for k in range(5)), pa.array(keys[row, coordinate].view(np.int64))], names=["key", "rep", "comp", "mask", "more", "key2"])


def _matches(it: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    for rows in it:
        if rows.num_rows:
            x, y = (_signatures(rows.column(k).to_pylist()) for k in (2, 3))
            ok = pa.array((x == y).sum(1) >= least)
            yield pa.RecordBatch.from_arrays([rows.column(0).filter(ok), rows.column(1).filter(ok)], names=["a", "b"])


def _sets(it: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    for rows, buf, off in tn.batches(it):
        yield pa.RecordBatch.from_arrays([rows.column(0), pa.array([x.tobytes() for x in sets(buf, off, n)], pa.binary())], names=["rep", "items"])


def _verify(it: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    for rows in it:
        ok = [_similar(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64), percent) for x, y in zip(rows.column(2), rows.column(3), strict=True)]
        mask = pa.array(ok, pa.bool_())
        yield pa.RecordBatch.from_arrays([rows.column(0).filter(mask), rows.column(1).filter(mask)], names=["a", "b"])


def _similar(x: np.ndarray, y: np.ndarray, percent: int, slack: int = 0) -> bool:
    """Whether sorted sets are similar enough; slack: elements that may be missing by collisions."""
    if 100 * min(len(x), len(y)) + 100 * slack < percent * max(len(x), len(y)):
        return False
    both = len(x) + len(y) - len(np.unique(np.concatenate((x, y))))
    return 100 * (both + slack) >= percent * (len(x) + len(y) - both - slack)


def _block(t: pa.Table, least: int, percent: int, exact: bool) -> pa.RecordBatch:
    """Links that join components among the members of two blocks of one list."""
    rep, comp, side = (t.column(n).to_numpy() for n in ("rep", "comp", "side"))
    sig = _signatures(t.column("sig").to_pylist())
    mask, more = (((t.column(n).to_numpy().view(np.uint64)[:, None] >> np.arange(COORDINATES, dtype=np.uint64)) & np.uint64(1)).astype(bool) for n in ("mask", "more"))
    own, second = t.column("key")[0].as_py() >> 32, t.column("key2")[0].as_py() >> 32
    left, right = np.flatnonzero(side & 1), np.flatnonzero(side & 2)
    pairs: list[tuple[int, int, int]] = []
    for k in left.tolist():
        other = right[comp[right] != comp[k]]
        if t.column("i")[0] == t.column("j")[0]:
            other = other[other > k]
        same = sig[other] == sig[k]
        m = same.sum(1)
        near = m >= least
        other, m, same = other[near], m[near], same[near]
        if len(other):  # a pair is looked at in the first of its lists
            here = np.argmax(same & mask[other] & mask[k], 1) == own
            if second >= 0:
                same = same & more[other] & more[k]
                same[:, own] = False
                here &= np.argmax(same, 1) == second
            pairs += zip((-m[here]).tolist(), [k] * int(here.sum()), other[here].tolist(), strict=True)
    parent: dict[int, int] = {}

    def root(c: int) -> int:
        while parent.setdefault(c, c) != c:
            parent[c] = c = parent[parent[c]]
        return c

    items, size = t.column("items"), t.column("n").to_numpy()
    held: dict[int, np.ndarray] = {}
    out = []
    for _, x, y in sorted(pairs):
        cx, cy = root(int(comp[x])), root(int(comp[y]))
        if cx != cy:
            for k in (x, y):
                if k not in held:
                    held[k] = np.frombuffer(items[k].as_buffer(), np.uint64 if exact else np.uint32)
            lost = int(size[x] - len(held[x]) + size[y] - len(held[y]))
            if _similar(held[x], held[y], percent, lost):
                parent[max(cx, cy)] = min(cx, cy)
                out.append((int(min(rep[x], rep[y])), int(max(rep[x], rep[y]))))
    return pa.RecordBatch.from_arrays([pa.array([p[k] for p in out], pa.int64()) for k in (0, 1)], names=["a", "b"])


def _blocks(it: Iterator[pa.RecordBatch], least: int, percent: int, exact: bool) -> Iterator[pa.RecordBatch]:
    """``_block`` of each (key, key2, i, j); rows come sorted by these."""
    rest: list[pa.Table] = []
    last = None
    for rows in it:
        if not rows.num_rows:
            continue
        t = pa.Table.from_batches([rows])
        at = np.stack([t.column(n).to_numpy() for n in ("key", "key2", "i", "j")])
        edges = [0, *(np.flatnonzero((at[:, 1:] != at[:, :-1]).any(0)) + 1).tolist(), t.num_rows]
        for x, y in zip(edges[:-1], edges[1:], strict=True):
            now = tuple(at[:, x])
            if rest and now != last:
                yield _block(pa.concat_tables(rest), least, percent, exact)
                rest = []
            rest.append(t.slice(x, y - x))
            last = now
    if rest:
        yield _block(pa.concat_tables(rest), least, percent, exact)


def _short(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sets by the leading 32 bits of their hashes, with their true sizes.

    Elements of one set that fall together show by the size; elements of two sets
    that do can only make a pair look more alike, and full sets tell these apart.
    """
    for rows in it:
        full = [np.frombuffer(x.as_buffer(), np.uint64) for x in rows.column(1)]
        small = [np.unique((x >> np.uint64(32)).astype(np.uint32)).tobytes() for x in full]
        yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(small, pa.binary()), pa.array([len(x) for x in full], pa.int64())], names=["rep", "items", "n"])


def _labelled(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """One row per document: doc_id, t (hash of the text), n_shingles, and of its component the least (doc_id, t) as m."""
    least = least_matches(percent)
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("t"))
    signed = checkpoint(own.mapInArrow(lambda it: _sign(it, n), "doc_id long, t long, n_shingles long, h1 long, h2 long, sig binary"))
    classes = signed.where("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("h1", "h2").agg(F.min(F.struct("doc_id", "t")).alias("m"), F.first("sig").alias("sig"))
    classes = checkpoint(classes.withColumn("rep", F.monotonically_increasing_id()))

    # the lists in which each class is posted, by their lengths over all classes; each with its hub
    to = ex.buckets(docs)
    chunks = classes.select("rep", "sig").mapInArrow(_chunks, "batch long, reps binary, sigs binary").repartition(ex.parts(docs), "batch")
    lengths = ex.counted(ex.each(chunks, _name_lists(to), ex.SENT), to)
    posts = checkpoint(ex.per_batch(chunks, lengths, _post(least), "key long, rep long, w long, mask long, more long"))
    hubs = posts.groupBy("key").agg(F.max(F.struct("w", (-F.col("rep")).alias("r"))).alias("m")).select("key", (-F.col("m.r")).alias("hub"))
    pairs = posts.join(hubs, "key").where("rep != hub").select(F.least("rep", "hub").alias("a"), F.greatest("rep", "hub").alias("b")).distinct()
    sig = classes.select("rep", "sig")
    pairs = pairs.join(sig.toDF("a", "sa"), "a").join(sig.toDF("b", "sb"), "b").select("a", "b", "sa", "sb").mapInArrow(lambda it: _matches(it, least), "a long, b long")

    # full sets of all that are posted, once
    wanted = classes.select("m.doc_id", "m.t", "rep").join(posts.select("rep").distinct(), "rep", "left_semi")
    full = checkpoint(own.join(wanted, ["doc_id", "t"]).select("rep", "text").mapInArrow(lambda it: _sets(it, n), "rep long, items binary"))
    links = checkpoint(_linked(full, pairs, percent))
    labels = components(links)
    for exact in (False, True):
        more = checkpoint(_across(posts, classes, full, labels, least, percent, exact))
        new = checkpoint(_linked(full, more, percent))
        if not new.isEmpty():
            links = links.union(new)
            labels = components(links)
        if more.join(new, ["a", "b"], "left_anti").isEmpty():
            break  # else short hashes have led a block astray; full ones do not
    named = classes.select("h1", "h2", "m", "rep").join(labels, classes["rep"] == labels["node"], "left").select("h1", "h2", "m", F.coalesce("label", "rep").alias("label"))
    low = named.groupBy("label").agg(F.min("m").alias("m"))
    component = named.drop("m").join(low, "label").select("h1", "h2", "m")
    return signed.select("doc_id", "t", "n_shingles", "h1", "h2").join(component, ["h1", "h2"], "left").drop("h1", "h2")


def near_dup(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept."""
    component_id = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("m.doc_id"))
    out = _labelled(docs, n, percent).select("doc_id", "n_shingles", component_id.alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def _linked(full: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets are similar enough."""
    both = pairs.select("a", "b").join(full.toDF("a", "ia"), "a").join(full.toDF("b", "ib"), "b").select("a", "b", "ia", "ib")
    return both.mapInArrow(lambda it: _verify(it, percent), "a long, b long").distinct()


def _across(posts: DataFrame, classes: DataFrame, full: DataFrame, labels: DataFrame, least: int, percent: int, exact: bool) -> DataFrame:
    """Links between components from the lists that hold several of them.

    What is left of a list after its division, if it still has more than BLOCK
    members, is split: members are dealt into blocks by a hash, and every two
    blocks meet in a group of their own.
    """
    at = posts.drop("w").join(labels, posts["rep"] == labels["node"], "left").select("key", "rep", F.coalesce("label", "rep").alias("comp"), "mask", "more")
    sig = classes.select("rep", "sig")

    def several(rows: DataFrame, *by: str) -> DataFrame:
        held = rows.groupBy(*by).agg(F.count("*").alias("c"), F.min("comp").alias("x"), F.max("comp").alias("y")).where("x != y").select(*by, "c")
        return rows.join(held, list(by))

    at = several(at, "key")
    long = at.where(F.col("c") > BLOCK).drop("c").join(sig, "rep").select("key", "rep", "comp", "mask", "more", "sig").mapInArrow(_divide, "key long, rep long, comp long, mask long, more long, key2 long")
    names = ["key", "key2", "rep", "comp", "mask", "more", "c"]
    at = at.where(F.col("c") <= BLOCK).withColumn("key2", F.lit(-1).cast("long")).select(*names).union(several(long, "key", "key2").select(*names))
    at = at.withColumn("nb", F.ceil(F.col("c") / BLOCK).cast("int")).withColumn("own", F.pmod(F.xxhash64("rep"), F.col("nb")).cast("int"))
    meet = F.explode(F.expr("transform(sequence(0, nb - 1), o -> struct(least(o, own) AS i, greatest(o, own) AS j, CASE WHEN o = own THEN 3 WHEN own < o THEN 1 ELSE 2 END AS side))"))
    small = full.withColumn("n", (F.length("items") / 8).cast("long")) if exact else full.mapInArrow(_short, "rep long, items binary, n long")
    held = ["rep", "comp", "mask", "more", "sig", "items", "n"]
    at = at.join(sig, "rep").join(small, "rep").select("key", "key2", *held, meet.alias("m")).select("key", "key2", F.col("m.i").alias("i"), F.col("m.j").alias("j"), F.col("m.side").alias("side"), *held)
    group = ["key", "key2", "i", "j"]
    return at.repartition(*group).sortWithinPartitions(*group).mapInArrow(lambda it: _blocks(it, least, percent, exact), "a long, b long").distinct()


def near_dedup(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """The documents without all rows but one of each component: that of the smallest doc_id, then hash of its text."""
    own = _labelled(docs, n, percent).where("n_shingles > 0 AND doc_id IS NOT NULL")
    rows = checkpoint(own.groupBy("doc_id", F.col("t").alias("__near_t")).agg(F.first("m").alias("m"), F.count("*").alias("c")))
    gone = rows.where("NOT (doc_id = m.doc_id AND __near_t = m.t)").select("doc_id", "__near_t")
    out = docs.withColumn("__near_t", F.xxhash64("text")).join(gone, ["doc_id", "__near_t"], "left_anti")
    twice = rows.where("c > 1").select("doc_id", "__near_t")
    if not twice.isEmpty():  # equal texts of one doc_id
        one = out.join(twice, ["doc_id", "__near_t"], "left_semi").dropDuplicates(["doc_id", "__near_t"])
        out = out.join(twice, ["doc_id", "__near_t"], "left_anti").unionByName(one)
    return out.select(*[f"`{c}`" for c in docs.columns])


def op6(spark, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents on four-word shingles."""
    return near_dup(spark.read.parquet(f"{sf_dir}/documents.parquet"), n=4, percent=80)
