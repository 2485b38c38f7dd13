"""Corpus pipeline: toxic documents go, poor ones go, one of each near-duplicate group stays, secrets are masked, the rest is packed."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import jaccard_join, packing, quality_rules, secrets, toxicity
from tidemark.llm.common import documents, fresh, table
from tidemark.llm.library import read_tokenizer
from tidemark.session import materialise


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the chain, learnt from the labels, does not reject."""
    chain = toxicity.fit(docs, toxicity.label_categories(table(spark, sf_dir, "labels")), toxicity.CATEGORIES)
    return toxicity.drop_toxic(docs, chain)


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return quality_rules.keep_documents(docs)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group linked by five-word shingles at a similarity of 0.8 or more."""
    return jaccard_join.drop_near_duplicates(docs, jaccard_join.Likeness(5, 80, 100))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets masked; n_chars follows the new text where it changed."""
    old = fresh(docs, "old")
    masked = secrets.redact(docs.withColumn(old, F.col("text")))
    changed = ~F.col("text").eqNullSafe(F.col(old))
    n = F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return masked.withColumn("n_chars", n).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every token piece of what is left, with its sequence and place."""
    return packing.pack_documents(docs, read_tokenizer(public_tokenizers.path("word_bpe_49k.json")), end_id=1, capacity=4096)


STAGES = [("toxicity", drop_toxic), ("quality_rules", drop_poor), ("ngram_jaccard", drop_copies), ("secrets", mask_secrets), ("packing", pack)]

# The learnt first stage and the tokenizer have no SQL form; tests compare with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pipeline over all documents; every stage is written before the next one reads it."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return docs
