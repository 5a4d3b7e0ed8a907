"""From documents to packed training sequences, in five stages.

Each stage takes what the one before it kept, as a table of documents, and returns documents; the last returns pieces of
sequences. SQL can't express the first, fourth and fifth stages, so there is no ORACLE_SQL. Other columns, whatever their
names, pass through the stages as they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lumenpep.llm import exact_dedup, langid, mixing, ngram_join, packing
from lumenpep.llm.common import new_path

#: Documents of no known language, or whose language is this uncertain, go.
LEAST_SCORE = 0.4


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without letters (null and empty texts among them), and those whose letters show no language. Where
    nothing is labelled, all with a letter stay. Repeated rows are judged each; an empty table stays empty."""
    return langid.accepted(docs, LEAST_SCORE)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text stays, the one with the largest doc_id, a null one last; a null text is the empty one."""
    return exact_dedup.kept_rows(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies stays, the one with the smallest doc_id, a null one last; texts without
    words are in none and stay."""
    return ngram_join.representatives(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it: those without words not at all, a null source as one of its
    own."""
    return mixing.mixed_rows(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences; a null or empty text is its end id alone."""
    return packing.pack(docs)


STAGES = [("language", language), ("exact copies", exact), ("near copies", near), ("mix", mix), ("pack", pack)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            path = new_path(spark, f"pipeline-{i}")
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
