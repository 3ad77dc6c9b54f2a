"""From raw documents to token counts: five stages, each written as Parquet and read again by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loyaltide.llm import exact_dedup, mixing, quality, simhash
from loyaltide.llm.common import read, unused
from loyaltide.llm.queries import bpe_digests
from loyaltide.plans.staging import remove_path, scratch_path, staged_in

GOOD = 0.3  # scores below are rejected
REPEATED = 1.5  # passes over a source, at most; every document occurs at least once
ORACLE_SQL = None  # a classifier has no SQL; tests compare with a plain version


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the quality classifier rejects."""
    model = quality.fit(docs, read(spark, sf_dir, "labels"))
    score = unused(docs, "__score")
    return quality.scored(docs, model, score_col=score).where(F.col(score) >= GOOD).drop(score)


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest id."""
    return exact_dedup.without_duplicates(docs)


def different_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near copies the one with the smallest id."""
    return simhash.without_near_duplicates(docs)


def mixed_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources brought nearer to each other: a document of a small source may occur twice, none is lost."""
    return mixing.mixed_rows(docs, max_repetition=REPEATED)


def encoded_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of every occurrence."""
    return bpe_digests(docs)


STAGES = [
    ("quality", good_documents),
    ("exact_dedup", distinct_documents),
    ("near_dedup", different_documents),
    ("mixing", mixed_documents),
    ("bpe", encoded_documents),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``. What a stage staged, and its input, go once its output is written."""
    docs, before = read(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        with staged_in(spark) as scope:
            stage(spark, docs, sf_dir).write.parquet(path)
        scope.remove()
        docs = spark.read.parquet(path)
        if before:
            remove_path(spark, before)
        before = path
    return docs
