"""A training-data pipeline over ``documents``: quality rules, near duplicates,
secrets, source mixing, tokens.

Each stage takes (spark, docs, sf_dir), works on every row of its predecessor
and returns a DataFrame; ``run`` writes each result as Parquet in the shared
checkpoint folder and hands on what it reads back.  All but the last return
the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm import mixing, ngram_join, piece_sampling, quality_rules, secret_scan
from starloom.llm.common import load, ready, written
from starloom.llm.queries import vocabulary


def _sized(docs: DataFrame) -> DataFrame:
    """n_chars follows a text that a stage has changed."""
    return docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else docs


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    ready(spark)
    return quality_rules.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group linked by shingles."""
    return ngram_join.one_of_each(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secret spans masked."""
    return _sized(secret_scan.without_secrets(docs))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words that the mix takes: a row for each epoch that takes words of a document."""
    return _sized(mixing.mixed(docs))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sampled pieces of every row."""
    return piece_sampling.encode(docs, vocabulary("piece_bpe_32k.model"))


STAGES = [("quality_rules", quality), ("ngram_join", near_duplicates), ("secret_scan", secrets),
          ("mixing", mix), ("sentencepiece", tokens)]

#: Hashed draws, randomness tests and sampled pieces are beyond SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
