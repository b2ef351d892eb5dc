"""Classifiers: gradients, held-out accuracy, and odd inputs."""

import re

import numpy as np
import pyarrow as pa

from almanac.llm import quality, textnp as tn, toxicity
from tests.llm.conftest import frame

SF = "/root/testdata/sf0.01"


def accuracy(spark, scored):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = scored.where("held_out").join(labels, "doc_id").collect()
    return rows


def test_quality_held_out(spark):
    rows = accuracy(spark, quality.op8(spark, SF))
    assert np.mean([r["predicted"] == r["quality"] for r in rows]) > 0.93
    assert np.mean([r["predicted"] for r in rows if r["quality"] == 1]) > 0.95


def test_toxicity_held_out(spark):
    rows = accuracy(spark, toxicity.op7(spark, SF))
    assert np.mean([r["predicted"] == r["toxic"] for r in rows]) > 0.9


def test_odd_inputs(spark, docs, none, rows):
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 1), (2, 0, 1), (3, 1, None), (999, 0, 1)], "doc_id long, quality int, toxic int")
    for module, name in ((quality, "quality_score"), (toxicity, "toxicity_score")):
        for some in (labels, labels.limit(0)):
            model = module.fit(docs, some)
            got = module.score(docs.withColumn(name, docs["h"]), model).collect()
            assert len(got) == len(rows) and all(0 <= r[name] <= 1 for r in got)
            assert module.score(none, model).count() == 0
    kept = quality.quality_filter(frame(spark, rows), labels)
    assert kept.columns == docs.columns


def test_gradients():
    texts = ["alpha beta gamma delta", "beta beta", "gamma epsilon zeta eta theta"]
    buf, off = tn.flatten(pa.array(texts))
    s, e, first = tn.spans(buf, off, tn.ALNUM)
    bucket, tri, at, of = toxicity.vocabulary(buf, s, e)
    start, size, _ = toxicity.windows(first)
    idx, mask = toxicity._index(of, start, size, len(bucket))
    net, y, w = toxicity.Network(), np.array([1.0, 0, 1], np.float32), np.ones(3, np.float32)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}

    def loss():
        z = net.logits(net.inputs(bucket, tri, at)[1], idx, mask)
        return float(np.mean(np.log1p(np.exp(-np.where(y > 0, z, -z)))))

    grads = net.gradients((bucket, tri, at), idx, mask, y, w)
    rng = np.random.RandomState(0)
    for name, g in grads.items():
        places = np.argwhere(g != 0)
        for k in rng.permutation(len(places))[:4]:
            p, old = tuple(places[k]), net.p[name][tuple(places[k])]
            net.p[name][p] = old + 1e-3
            up = loss()
            net.p[name][p] = old - 1e-3
            down = loss()
            net.p[name][p] = old
            assert abs((up - down) / 2e-3 - g[p]) < 2e-4 + 0.05 * abs(g[p]), name


def test_all_windows_overlap():
    start, size, doc = toxicity.windows(np.array([0, 0, 10, 100, 300]))
    assert doc.tolist() == [0, 1, 2, 2, 3, 3, 3, 3, 3, 3][: len(doc)]
    for d, (a, b) in enumerate([(0, 0), (0, 10), (10, 100), (100, 300)]):
        covered = {x for s, n, k in zip(start, size, doc, strict=True) if k == d for x in range(s, s + n)}
        assert covered == set(range(a, b))


def test_votes_by_plain_cosines():
    """Each score is the vote of the nearest rows, ties with the last included, by a loop over all of them."""
    r = np.random.RandomState(4)
    texts = [" ".join(r.choice(["alpha", "beta", "gamma", "delta", "zz zz"], r.randint(3, 40))) for _ in range(60)] + ["alpha beta"] * 30
    x = quality.features(*tn.flatten(pa.array(texts))).astype(np.float32)
    y = (np.arange(90) % 3 > 0).astype(int)
    model = quality.Model(x, y, rank=8)
    got = model.score(x, neighbours=7)
    for k in range(90):
        v = (x[k] * model.weight / np.linalg.norm(x[k] * model.weight) - model.mean) @ model.basis
        v = v / np.linalg.norm(v)
        sims = np.array([float(v @ u) for u in model.vectors])
        last = np.sort(sims)[-7]
        near = [j for j in range(90) if sims[j] >= last - 2e-6]
        votes = [max(sims[j], 0) ** 4 + 1e-9 for j in near]
        assert abs(got[k] - sum(a * y[j] for a, j in zip(votes, near, strict=True)) / sum(votes)) < 1e-3
    assert not np.isclose(got, got[0]).all()


def test_learnt_rows_are_bounded(spark):
    """One labelled id that many rows hold is one row to learn from, the same in any order."""
    docs = spark.range(3000).selectExpr("id % 3 AS doc_id", "concat('text ', id) AS text").union(spark.range(3, 40).selectExpr("id", "concat('other ', id)"))
    labels = spark.range(40).selectExpr("id AS doc_id", "CAST(id % 2 AS int) AS quality")
    rows = quality.labelled(docs, labels, "quality", 3, 1, 10).collect()
    assert 0 < len(rows) <= 10 and len({r["doc_id"] for r in rows}) == len(rows)
    assert sorted(map(tuple, rows)) == sorted(map(tuple, quality.labelled(docs.repartition(7), labels, "quality", 3, 1, 10).collect()))


def test_fit_leaves_the_sample_to_a_task(spark):
    """The driver's Python holds the fitted quality model, not the rows that it is learnt from."""
    import tracemalloc

    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    labels = docs.selectExpr("doc_id", "CAST(doc_id % 2 AS int) AS quality")
    tracemalloc.start()
    try:
        model = quality.fit(docs, labels, 600)
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert len(model.y) == len(model.vectors) == 600
    assert most < 600 * quality.WIDTH * 2  # one matrix of halves


def test_names_with_dots(spark, rows):
    from almanac.llm import decontaminate, fingerprint, line_dedup

    docs = frame(spark, rows[:20]).withColumnRenamed("key", "a.b").withColumnRenamed("batch", "__line_repeats").withColumnRenamed("lang", "__own0")
    bench = spark.createDataFrame([(1, "zu zu")], "item_id long, text string")
    for out in (quality.score(docs, quality.fit(docs, spark.createDataFrame([], "doc_id long, quality int"))), toxicity.score(docs, None), fingerprint.fingerprint(docs), decontaminate.scan(docs, bench), line_dedup.runs(docs), line_dedup.mark(docs)):
        assert set(docs.columns) <= set(out.columns)
        got = out.select("`a.b`", "`__line_repeats`", "`__own0`").collect()
        assert len(got) == 20 and {tuple(r) for r in got} == {("k", "b", "en")}


def plain_score(net, text):
    """One word after another, one window after another, in plain numbers."""
    from math import exp, tanh

    p, hidden, sig = net.p, toxicity.HIDDEN, lambda v: 1 / (1 + exp(-v))
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text))

    def gates(word):
        raw = np.frombuffer(word.encode(), np.uint8)
        h = int(tn.span_hash(raw, np.array([0]), np.array([len(raw)]))[0])
        b = [0, *raw.tolist(), 0]
        tri = [(((b[k] << 16 | b[k + 1] << 8 | b[k + 2]) * 2654435761) % 2**32 >> 20) % toxicity.TRIGRAMS for k in range(len(raw))]
        x = np.concatenate((p["word"][h % toxicity.WORDS], p["char"][tri].mean(0)))
        return x @ p["w"] + p["b"]

    def layer(inputs, u):
        h, out = np.zeros(hidden), []
        for x in inputs:
            hu, new = h @ u, np.zeros(hidden)
            for k in range(hidden):
                z, r = sig(x[k] + hu[k]), sig(x[hidden + k] + hu[hidden + k])
                new[k] = z * h[k] + (1 - z) * tanh(x[2 * hidden + k] + r * hu[2 * hidden + k])
            h = new
            out.append(h)
        return out

    best = -1e9
    for a in range(0, max(len(words) - toxicity.STRIDE, 1), toxicity.STRIDE):
        own = [gates(w) for w in words[a : a + toxicity.WINDOW]]
        there, back = layer([g[: 3 * hidden] for g in own], p["uf"]), layer([g[3 * hidden :] for g in own][::-1], p["ub"])[::-1]
        states = [np.concatenate(x) for x in zip(there, back, strict=True)]
        e = [exp(float(np.tanh(x @ p["wa"]) @ p["va"])) for x in states]
        pooled = sum(k * x for k, x in zip(e, states, strict=True)) / sum(e)
        best = max(best, float(pooled @ p["u"] + p["c"][0]))
    return sig(best)


def test_scores_by_plain_recurrence():
    r = np.random.RandomState(9)
    texts = [" ".join(r.choice(["Alpha", "beta", "gamma!", "délta", "x1", "y"], n)) for n in (1, 5, 63, 64, 65, 96, 97, 150)]
    net = toxicity.train(texts * 3, np.arange(24) % 2, epochs=1)
    got, _ = toxicity.score_texts(net, *tn.flatten(pa.array(texts)))
    for text, x in zip(texts, got, strict=True):
        assert abs(plain_score(net, text) - x) < 1e-4
