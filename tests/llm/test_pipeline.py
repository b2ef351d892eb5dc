"""The pipeline's stages, one on another, and the registry."""

import re

import corpus_pipeline
from almanac.llm import queries
from tests.llm.conftest import frame

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    sizes = [docs.count()]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        if k < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == COLUMNS
            assert 0 < docs.count() <= sizes[-1]
            sizes.append(docs.count())
    assert sizes[1] < sizes[0] and sizes[3] < sizes[2]
    kept = {r["doc_id"] for r in spark.read.parquet(str(tmp_path / "3")).select("doc_id").collect()}
    assert {r["doc_id"] for r in docs.collect()} == kept
    whole = corpus_pipeline.run(spark, SF)
    assert sorted(map(tuple, whole.select("doc_id", "start", "length", "ids_crc32").collect())) == sorted(map(tuple, docs.select("doc_id", "start", "length", "ids_crc32").collect()))


def test_empty_and_odd(spark):
    for rows in ([], [(1, None), (2, ""), (2, ""), (None, "x\ny\nz\n" * 9)]):
        docs = frame(spark, rows)
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SF)
        docs.count()


def test_columns_stay(spark):
    """Columns whose names the stages use for their own come back as they were."""
    rows = [(k, "some words of a text " * 9 + str(k), "p", "q", None, "r", "`s", 1.5) for k in range(4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, quality_score string, N_Words string, hit_spans string, n_lines string, `a.b` string, n_removed double")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns
        for r in out.collect():
            assert tuple(r)[2:] == ("p", "q", None, "r", "`s", 1.5)


def test_names():
    assert [len([q for q in queries.QUERIES if re.match(rf"op{n}_", q)]) for n in range(1, 11)] == [1] * 10
    assert len(corpus_pipeline.STAGES) == 5
