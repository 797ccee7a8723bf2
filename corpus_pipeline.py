"""A training corpus from raw documents: toxic documents go, repeated lines go, one of each group of near copies stays, documents with benchmark items go, the rest is encoded.

Every stage takes what its predecessor kept, written as Parquet and read again, so that a lost executor never makes a later stage repeat an earlier one.
A toxicity model and near-duplicate classes are no SQL, hence no ORACLE_SQL; the tests hold the whole run against a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import bayes_join, factorization, line_runs, queries, tiling
from millrace.sources.session import cut_lineage

ORACLE_SQL = None


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below the threshold."""
    model = queries.toxicity_model(docs, queries.table(spark, sf_dir, "labels"))
    return docs.where(factorization.scorer(spark, model)("text") < queries.TOXIC_FROM)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that three or more of them hold, except in the largest id."""
    return line_runs.with_kept_text(docs)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest id of each group of near copies."""
    return bayes_join.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return tiling.without_contaminated(docs, queries.table(spark, sf_dir, "benchmark"))


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the documents that remain."""
    return queries.round_trip(docs)


STAGES = [
    ("toxicity", toxicity),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", jaccard_join),
    ("benchmark decontamination", decontamination),
    ("byte-level BPE", byte_bpe),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
