"""One query per operator over its whole table, and the SQL twins of those
that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm import (ann, hard_negatives, mixing, ngram_join, pii, piece_sampling, prefix_trie, quality_eb, quality_rules, secret_scan, simhash,
                          token_store, toxicity)
from starloom.llm.common import load, scratch_path

QueryFn = Callable[[SparkSession, str], DataFrame]


def vocabulary(name: str) -> str:
    """Path of a public tokenizer's file, the same on every machine of the cluster."""
    import public_tokenizers
    return str(public_tokenizers.path(name))


def op1_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(load(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0)


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.measure(load(spark, sf_dir, "documents"))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.detect(load(spark, sf_dir, "documents")))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken(load(spark, sf_dir, "documents"))


def op6_quality_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_eb.classify(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"), host_col="source", path_col="lang")


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    token_store.write_token_files(load(spark, sf_dir, "documents"), path, vocabulary("word_bpe_49k.json"), end_id=1)
    return token_store.index_and_checksums(spark, path)


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(secret_scan.scan(load(spark, sf_dir, "documents")))


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_sampling.encode(load(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(load(spark, sf_dir, "documents"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(load(spark, sf_dir, "conversations"))


def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(load(spark, sf_dir, "documents"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.expr("CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END")
    return hard_negatives.mine(load(spark, sf_dir, "embeddings"), label, F.col("id") % 100 == 0)


QUERIES: dict[str, QueryFn] = {f.__name__: f for f in (op1_nearest, op2_quality_rules, op3_pii, op4_toxicity, op5_mixing, op6_quality_sites, op7_token_files, op8_secret_scan,
                                                          op9_sentencepiece, op10_ngram_join, op11_prefix_trie, op12_simhash, op13_hard_negatives)}

ORACLE_SQL: dict[str, str] = {"op2_quality_rules": quality_rules.SQL, "op5_mixing": mixing.sql(), "op11_prefix_trie": prefix_trie.SQL, "op13_hard_negatives": hard_negatives.SQL}
