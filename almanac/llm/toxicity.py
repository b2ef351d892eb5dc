"""Toxicity: a bidirectional gated recurrent network with attention pooling.

A word's input is the embedding of its hash beside the mean embedding of its
character trigrams. Two gated recurrent layers read a window of ``WINDOW`` words
from either end; attention pools their states into one logit. All windows of a
text are scored, each overlapping the next by half; a text scores as its most
toxic window. Training, in numpy on the driver, learns from each labelled text
by its window of the highest score at the time.

The labelled sample has at most ``MAX_LABELLED`` rows of at most ``MAX_CHARS``
characters (the lowest hashes of their ids); scoring reads whole texts. Words
are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after A-Z became a-z. Texts without
words (null and empty ones too) have one window without words and score below
one half by rule; without labelled rows every score is 0.5. Repeated rows are
scored each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from almanac.llm import textnp as tn
from almanac.llm.columns import adding, plus
from almanac.llm.quality import labelled

MAX_LABELLED, MAX_CHARS = 3000, 8_000
WINDOW, STRIDE = 64, 32
WORDS, TRIGRAMS = 8192, 4096
WIDTH, HIDDEN = 8, 8
EPOCHS, BATCH = 9, 64
#: Windows that are scored at once.
BLOCK = 4096


def vocabulary(buf: np.ndarray, s: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of the distinct words: their hash buckets, trigram buckets, and those' first places; and each word's number."""
    h, at, of = np.unique(tn.span_hash(buf, s, e), return_index=True, return_inverse=True)
    bucket = (h % np.uint64(WORDS)).astype(np.int64)
    s, e = s[at], e[at]
    size = e - s
    first = np.concatenate(([0], np.cumsum(size)))[:-1]
    place = np.repeat(s - first, size) + np.arange(size.sum())
    mid = buf[place].astype(np.uint32)
    left, right = np.zeros_like(mid), np.zeros_like(mid)
    left[1:], right[:-1] = mid[:-1], mid[1:]
    left[first], right[(first + size) - 1] = 0, 0
    tri = ((((left << np.uint32(16)) | (mid << np.uint32(8)) | right) * np.uint32(2654435761)) >> np.uint32(20)).astype(np.int64) % TRIGRAMS
    return bucket, tri, first, of


def windows(first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, number of words, and document of each window; every document has one."""
    n = np.diff(first)
    count = np.maximum(1, -(-(n - (WINDOW - STRIDE)) // STRIDE))
    doc = np.repeat(np.arange(len(n)), count)
    k = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    start = first[:-1][doc] + k * STRIDE
    return start, np.minimum(first[1:][doc] - start, WINDOW), doc


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


class Network:
    """Parameters by name; float32 throughout."""

    def __init__(self, seed: int = 5) -> None:
        r = np.random.RandomState(seed)
        f = np.float32
        self.p = {
            "word": (r.standard_normal((WORDS, WIDTH)) * 0.1).astype(f),
            "char": (r.standard_normal((TRIGRAMS, WIDTH)) * 0.1).astype(f),
            "w": (r.standard_normal((2 * WIDTH, 6 * HIDDEN)) * 0.4).astype(f),
            "b": np.zeros(6 * HIDDEN, f),
            "uf": (r.standard_normal((HIDDEN, 3 * HIDDEN)) * 0.3).astype(f),
            "ub": (r.standard_normal((HIDDEN, 3 * HIDDEN)) * 0.3).astype(f),
            "wa": (r.standard_normal((2 * HIDDEN, HIDDEN)) * 0.4).astype(f),
            "va": (r.standard_normal(HIDDEN) * 0.4).astype(f),
            "u": (r.standard_normal(2 * HIDDEN) * 0.3).astype(f),
            "c": np.full(1, -1.0, f),
        }

    def inputs(self, bucket: np.ndarray, tri: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Embeddings of the distinct words, and their share of both layers' gates (a last row of zeros)."""
        count = np.diff(np.append(first, len(tri))).astype(np.float32)[:, None]
        char = np.add.reduceat(self.p["char"][tri], first, axis=0) / count if len(first) else np.zeros((0, WIDTH), np.float32)
        x = np.concatenate((self.p["word"][bucket], char), axis=1)
        return x, np.concatenate((x @ self.p["w"] + self.p["b"], np.zeros((1, 6 * HIDDEN), np.float32)))

    def _layer(self, gates: np.ndarray, idx: np.ndarray, mask: np.ndarray, u: np.ndarray, back: bool, keep: list | None) -> np.ndarray:
        h = np.zeros((len(idx), HIDDEN), np.float32)
        out = np.zeros((idx.shape[1], len(idx), HIDDEN), np.float32)
        own = gates[:, 3 * HIDDEN :] if back else gates[:, : 3 * HIDDEN]
        for t in range(idx.shape[1])[:: -1 if back else 1]:
            x, hu, m = own[idx[:, t]], h @ u, mask[:, t : t + 1]
            zr = _sigmoid(x[:, : 2 * HIDDEN] + hu[:, : 2 * HIDDEN])
            z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
            n = np.tanh(x[:, 2 * HIDDEN :] + r * hu[:, 2 * HIDDEN :])
            if keep is not None:
                keep.append((t, h, z, r, n, hu[:, 2 * HIDDEN :], m))
            h = h + m * (1 - z) * (n - h)
            out[t] = h
        return out

    def logits(self, gates: np.ndarray, idx: np.ndarray, mask: np.ndarray, keep: dict | None = None) -> np.ndarray:
        """Logit of each window; idx: (window, place) into the words."""
        p = self.p
        steps = ([], []) if keep is not None else (None, None)
        hs = np.concatenate((self._layer(gates, idx, mask, p["uf"], False, steps[0]), self._layer(gates, idx, mask, p["ub"], True, steps[1])), axis=2)
        a = np.tanh(hs @ p["wa"])
        e = a @ p["va"] + (mask.T - 1) * 1e4
        e = np.exp(e - e.max(0))
        e /= e.sum(0)
        pooled = np.einsum("tb,tbh->bh", e, hs)
        if keep is not None:
            keep |= {"steps": steps, "hs": hs, "a": a, "e": e, "pooled": pooled}
        return pooled @ p["u"] + p["c"]

    def gradients(self, words: tuple, idx: np.ndarray, mask: np.ndarray, y: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients of the mean weighted logistic loss over the windows."""
        p, k = self.p, {}
        bucket, tri, first = words
        x, gates = self.inputs(bucket, tri, first)
        d = ((_sigmoid(self.logits(gates, idx, mask, k)) - y) * weight / len(y)).astype(np.float32)
        g = {"c": np.array([d.sum()], np.float32), "u": k["pooled"].T @ d}
        dp = d[:, None] * p["u"]
        de = np.einsum("bh,tbh->tb", dp, k["hs"])
        de = k["e"] * (de - (k["e"] * de).sum(0))
        g["va"] = np.einsum("tb,tbh->h", de, k["a"])
        da = de[:, :, None] * p["va"] * (1 - k["a"] ** 2)
        g["wa"] = np.einsum("tbi,tbj->ij", k["hs"], da)
        dhs = k["e"][:, :, None] * dp + da @ p["wa"].T
        dgates = np.zeros_like(gates)
        for side, name in enumerate(("uf", "ub")):
            u, part = p[name], slice(3 * HIDDEN * side, 3 * HIDDEN * (side + 1))
            dh, gu = np.zeros((len(y), HIDDEN), np.float32), np.zeros_like(u)
            for t, h, z, r, n, un, m in reversed(k["steps"][side]):
                dh = dh + dhs[t, :, HIDDEN * side : HIDDEN * (side + 1)]
                dm = dh * m
                dn = dm * (1 - z) * (1 - n * n)
                dz = dm * (h - n) * z * (1 - z)
                dr = dn * un * r * (1 - r)
                dhu = np.concatenate((dz, dr, dn * r), axis=1)
                np.add.at(dgates[:, part], idx[:, t], np.concatenate((dz, dr, dn), axis=1))
                gu += h.T @ dhu
                dh = dh * (1 - m) + dm * z + dhu @ u.T
            g[name] = gu
        dgates = dgates[:-1]
        g["w"], g["b"] = x.T @ dgates, dgates.sum(0)
        dx = dgates @ p["w"].T
        g["word"] = np.zeros_like(p["word"])
        np.add.at(g["word"], bucket, dx[:, :WIDTH])
        size = np.diff(np.append(first, len(tri)))
        g["char"] = np.zeros_like(p["char"])
        np.add.at(g["char"], tri, np.repeat(dx[:, WIDTH:] / size[:, None], size, axis=0))
        return g


def _index(of: np.ndarray, start: np.ndarray, size: np.ndarray, pad: int) -> tuple[np.ndarray, np.ndarray]:
    place = np.arange(WINDOW)
    mask = place < size[:, None]
    at = np.minimum(start[:, None] + place, max(len(of) - 1, 0))
    idx = np.where(mask, of[at], pad) if len(of) else np.full(mask.shape, pad)
    return idx, mask.astype(np.float32)


def score_texts(net: Network, buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Score of each text; and its most toxic window's first word."""
    buf = tn.LOWER[buf]
    s, e, first = tn.spans(buf, off, tn.ALNUM)
    bucket, tri, at, of = vocabulary(buf, s, e)
    _, gates = net.inputs(bucket, tri, at)
    start, size, doc = windows(first)
    logit = np.empty(len(start), np.float32)
    for a in range(0, len(start), BLOCK):
        idx, mask = _index(of, start[a : a + BLOCK], size[a : a + BLOCK], len(gates) - 1)
        logit[a : a + BLOCK] = net.logits(gates, idx, mask)
    new = np.searchsorted(doc, np.arange(len(off) - 1))
    top = np.maximum.reduceat(logit, new)
    best = np.zeros(len(top), np.int64)
    hit = np.flatnonzero(logit == top[doc])
    best[doc[hit[::-1]]] = start[hit[::-1]]
    score = np.round(_sigmoid(top.astype(np.float64)), 6)
    return np.where(np.diff(first) == 0, np.minimum(score, 0.01), score), best


def train(texts: list[str], labels: np.ndarray, epochs: int = EPOCHS) -> Network | None:
    """A network fitted to the labelled texts; None without any."""
    if not len(texts):
        return None
    net = Network()
    buf, off = tn.flatten(pa.array(texts, pa.large_string()))
    buf = tn.LOWER[buf]
    s, e, first = tn.spans(buf, off, tn.ALNUM)
    bucket, tri, at, of = vocabulary(buf, s, e)
    y = labels.astype(np.float32)
    weight = np.where(y > 0, np.float32(min(4.0, max(1.0, (1 - y.mean()) / max(y.mean(), 1e-3) / 2))), np.float32(1))
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.p.items()}
    rng, step = np.random.RandomState(11), 0
    tail = np.append(at, len(tri))
    for epoch in range(epochs):
        _, best = score_texts(net, buf, off) if epoch else (None, first[:-1])
        size = np.minimum(first[1:] - best, WINDOW)
        order = rng.permutation(len(y))
        rate = 0.02 * (1 - 0.9 * epoch / epochs)
        for a in range(0, len(y), BATCH):
            own = order[a : a + BATCH]
            idx, mask = _index(of, best[own], size[own], len(bucket))
            # only the words that the batch holds
            used, inverse = np.unique(idx, return_inverse=True)
            used_words = used[used < len(bucket)]
            inverse = np.where(idx == len(bucket), len(used_words), inverse.reshape(idx.shape))
            n = tail[used_words + 1] - tail[used_words]
            begin = np.cumsum(n) - n
            t = tri[np.repeat(tail[used_words] - begin, n) + np.arange(n.sum())]
            g = net.gradients((bucket[used_words], t, begin), inverse, mask, y[own], weight[own])
            step += 1
            for k, v in net.p.items():
                m, q = moments[k]
                m += 0.1 * (g[k] - m)
                q += 0.01 * (g[k] ** 2 - q)
                v -= (rate * (m / (1 - 0.9**step)) / (np.sqrt(q / (1 - 0.99**step)) + 1e-6)).astype(np.float32)
    return net


def fit(docs: DataFrame, labels: DataFrame, most: int = MAX_LABELLED) -> Network | None:
    """The network learnt from at most ``most`` labelled rows outside the held-out fifth (see quality.labelled)."""
    rows = labelled(docs.where(F.length("text") <= MAX_CHARS), labels, "toxic", 5, 0, most).toPandas().sort_values(["doc_id", "text"])
    return train(rows["text"].tolist(), rows["label"].to_numpy())


def score(docs: DataFrame, net: Network | None) -> DataFrame:
    """The documents with the column toxicity_score (replaced if there is one)."""
    sent = docs.sparkSession.sparkContext.broadcast(net)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, buf, off in tn.batches(it):
            s = score_texts(sent.value, buf, off)[0] if sent.value is not None else np.full(rows.num_rows, 0.5)
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(s, pa.float64())], names=[*rows.schema.names, "toxicity_score"])

    return adding(docs, ("toxicity_score",), lambda own: own.mapInArrow(run, plus(own.schema, "toxicity_score double")))


def op7(spark, sf_dir: str) -> DataFrame:
    """Toxicity score of every document; a null doc_id is not held out."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    net = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    return score(docs, net).select("doc_id", held.alias("held_out"), F.col("toxicity_score").alias("score"), (F.col("toxicity_score") >= 0.5).cast("int").alias("predicted"))
