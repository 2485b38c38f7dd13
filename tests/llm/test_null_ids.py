"""Null ids among exact copies in the Jaccard join."""

from tidemark.llm import jaccard_join


def test_null_id_copy_does_not_hide_real_ids(spark):
    text = " ".join(f"word{i}" for i in range(60))
    rows = [(None, text), (7, text), (5, text), (9, "other text of its own that nobody shares with this one here at all"), (None, "null id only, words that stand alone in this table today")]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    got = jaccard_join.near_duplicate_components(d).collect()
    ids = sorted(((r["doc_id"], r["component_id"]) for r in got), key=str)
    assert ids == sorted([(None, 5), (5, 5), (7, 5), (9, 9), (None, None)], key=str)
    kept = [r["doc_id"] for r in jaccard_join.drop_near_duplicates(d).collect()]
    assert sorted(kept, key=str) == [5, 9, None]
