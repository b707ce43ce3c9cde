"""The corpus pipeline: language ID, near duplicates, decontamination, personal data, mixing."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from marketloom.llm import decontaminate, language_id, mixing, near_duplicates, pii
from marketloom.llm.common import read_table, remove, shared_folder


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or that fit no learned language, go."""
    return language_id.drop_unidentified(docs)


def unique(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five words, 0.8) stays, that of the smallest doc_id; unlike texts stay."""
    return near_duplicates.drop_near_duplicate_texts(docs, size=5, num=8, den=10)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return decontaminate.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def redacted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts is replaced by its kind; n_chars follows."""
    return pii.redact(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture: a row for each copy of a document, with copy_no."""
    return mixing.mixture(docs)


STAGES = [
    ("language_id", languages),
    ("near_duplicates", unique),
    ("decontamination", decontaminated),
    ("personal_data", redacted),
    ("mixing", mixed),
]

#: Language ID fits a model, which SQL can't express; the tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's result is written to the shared folder and read again.

    A stage's files go when the next one's are written; the last ones are what the result reads.
    """
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = read_table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs.write.parquet(f"{folder}/{k}-{name}")
            docs = spark.read.parquet(f"{folder}/{k}-{name}")
            if k:
                remove(spark, f"{folder}/{k - 1}-{STAGES[k - 1][0]}")
    return docs
