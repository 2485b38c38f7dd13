"""Registered queries of the corpus operators: thin digests over each operator, with their SQL where SQL can express them."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (bpe, embedding_dedup, histogram_packing, jaccard_join, licenses, merkle, packing, periodic, quality_model, quality_rules, secrets,
                          token_store, toxicity)
from tidemark.llm.common import documents, table
from tidemark.llm.library import read_tokenizer

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


@query
def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.scan_documents(documents(spark, sf_dir)))


@query
def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.report(documents(spark, sf_dir))


@query
def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_model.classify(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


@query
def op4_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicate_components(documents(spark, sf_dir), jaccard_join.Likeness(3, 90, 100))


@query
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    chain = toxicity.fit(docs, toxicity.label_categories(table(spark, sf_dir, "labels")), toxicity.CATEGORIES)
    return toxicity.score_documents(docs, chain)


@query
def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.report(documents(spark, sf_dir))


@query
def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        ranks = f.read().splitlines()
    return bpe.digest(documents(spark, sf_dir), ranks, public_tokenizers.PATTERN)


@query
def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"), 0.93)


@query
def op9_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = read_tokenizer(public_tokenizers.path("byte_bpe_50k.json"))
    return token_store.read_store(token_store.write_store(documents(spark, sf_dir), tokenizer, end_id=2))


@query
def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = read_tokenizer(public_tokenizers.path("word_bpe_49k.json"))
    return packing.pack_documents(documents(spark, sf_dir), tokenizer, end_id=1, capacity=4096)


@query
def op11_histogram_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = read_tokenizer(public_tokenizers.path("byte_bpe_50k.json"))
    return histogram_packing.pack_documents(documents(spark, sf_dir), tokenizer, end_id=1, capacity=2048)


def repeat_by_id(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The contract's planted repetition: one id in ten repeats a stretch of its own words up to the end."""
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + k % p] for k in range(n - a)]


@query
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.digest(periodic.detect_runs(documents(spark, sf_dir), min_words=12, prepare=repeat_by_id))


@query
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    tampered = F.when(chosen, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    return merkle.manifest(documents(spark, sf_dir), tampered)


ORACLES["op2_quality_rules"] = quality_rules.ORACLE_SQL
ORACLES["op6_licenses"] = licenses.oracle_sql()
