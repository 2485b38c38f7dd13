"""Registered corpus queries against their DuckDB SQL, and the pipeline against a plain version."""

from __future__ import annotations

import brute
import corpus_pipeline
import harness
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.llm import toxicity
from tidemark.llm.common import documents, table
from tidemark.llm.queries import ORACLES, QUERIES

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(spark, name):
    for sf in (SMALL, "/root/testdata/sf0.01"):
        assert harness.same(QUERIES[name](spark, sf).toPandas(), harness.duck(sf).execute(ORACLES[name]).df()) is None


def test_fourteen_queries():
    import __spark_entry__
    assert {q.split("_")[0] for q in QUERIES} == {f"op{n}" for n in range(1, 14)} and "pipeline" in __spark_entry__.queries()


def test_pipeline_stages(spark):
    """Every stage but the first, whose model is tested elsewhere, against its definition on the stage's own input."""
    docs = documents(spark, SMALL)
    (_, toxic), (_, poor), (_, copies), (_, masked), _ = corpus_pipeline.STAGES
    chain = toxicity.fit(docs, toxicity.label_categories(table(spark, SMALL, "labels")), toxicity.CATEGORIES)
    rejected = {r["doc_id"] for r in toxicity.score_documents(docs, chain).where("rejected").collect()}
    a = toxic(spark, docs, SMALL).toPandas().sort_values("doc_id")
    assert set(a.doc_id) == {r["doc_id"] for r in docs.select("doc_id").collect()} - rejected and list(a.columns) == docs.columns
    b = poor(spark, spark.createDataFrame(a), SMALL).toPandas().sort_values("doc_id")
    assert b.doc_id.tolist() == [d for d, t in zip(a.doc_id, a.text, strict=True) if brute.quality_counts(t)[-1]] and list(b.columns) == docs.columns
    c = copies(spark, spark.createDataFrame(b), SMALL).toPandas().sort_values("doc_id")
    comp = brute.components(b.doc_id.tolist(), brute.jaccard_links([brute.shingles(t, 5) for t in b.text], 80, 100))
    assert c.doc_id.tolist() == [i for i, k in zip(b.doc_id, comp, strict=True) if i == k] and list(c.columns) == docs.columns
    d = masked(spark, spark.createDataFrame(c), SMALL).toPandas().sort_values("doc_id")
    assert d.doc_id.tolist() == c.doc_id.tolist() and list(d.columns) == docs.columns
    for old, new, n, m in zip(c.text, d.text, c.n_chars, d.n_chars, strict=True):
        assert (new == old and n == m) if not brute.base_spans(old) + brute.added_spans(old) else (not brute.base_spans(new) and m == len(new))
    packed = corpus_pipeline.run(spark, SMALL)
    assert packed.select("doc_id").distinct().count() == len(d)
    assert packed.groupBy("sequence_id").agg(F.sum("length").alias("n")).agg(F.max("n")).first()[0] <= 4096
    assert isinstance(packed.toPandas(), pd.DataFrame)
