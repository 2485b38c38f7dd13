"""Queries that read few columns derive those alone; the wide tables are built for queries that read them."""

import pytest
from harness import same

from tidemark.plans import workspace
from tidemark.plans.catalogue import QUERIES, backtest, events, ingest
from tidemark.plans.workspace import Workspace

SF = "/root/testdata/sf0.001"


def stored(sf: str) -> set[str]:
    return {k[2] for k in workspace._store if k[1] == sf}


@pytest.fixture(scope="module")
def fresh():
    """The same data under a path for which nothing is stored yet."""
    return "/root/testdata/./sf0.001"


@pytest.mark.parametrize("name", ["U11_trend_score", "U14_regime_counts", "L04_relative_label", "B03_period_summary", "T04_order_sequence"])
def test_no_wide_table_is_built(spark, fresh, name):
    assert QUERIES[name](spark, fresh).count() > 0 and "frame" not in stored(fresh)


def test_only_needed_windows_are_planned(spark, fresh):
    plan = QUERIES["U11_trend_score"](spark, fresh)._jdf.queryExecution().optimizedPlan().toString()
    assert "stddev_samp" not in plan and "macd" not in plan and "y_bin" not in plan


def test_named_columns_equal_the_wide_table(spark, fresh):
    cols, wide = dict.fromkeys((*backtest.RULES, *events.EVENTS)), Workspace(spark, SF).outcomes()
    assert same(Workspace(spark, fresh).outcomes(*cols).toPandas(), wide.select(*cols).toPandas()) is None


def test_order_books_are_stored_compressed(spark, fresh):
    files = spark.read.text(ingest.order_book_path(Workspace(spark, fresh))).inputFiles()
    assert files and all(f.endswith(".json.gz") for f in files)
