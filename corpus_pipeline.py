"""A training corpus from ``documents``: five stages, each on all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from almanac.llm import decontaminate, line_dedup, near_dup, packing, quality, store


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return quality.quality_filter(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without chunks of lines that stand earlier in the corpus."""
    return line_dedup.line_dedup(docs)


def near_dup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five words, 0.8)."""
    return near_dup.near_dedup(docs)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without benchmark passages; documents that are mostly such go."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, packed into windows of tokens."""
    return packing.pack(docs, packing.tokenizer_path())


STAGES = [
    ("quality classifier", quality_stage),
    ("line dedup", line_stage),
    ("MinHash near-dedup", near_dup_stage),
    ("benchmark decontamination", decontaminate_stage),
    ("packing", packing_stage),
]

#: SQL expresses neither the classifier nor the tokenizer; see the tests.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each over what the one before returned.

    Between stages the rows are written as Parquet, in the folder that executors
    share, and read again, so a lost executor costs one stage at most. The last
    stage reads the folder of the one before it, which stays until the folder is emptied.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = store.rewritten(docs, f"pipeline-{k}")
    return docs
