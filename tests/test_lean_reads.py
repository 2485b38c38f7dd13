"""Queries that failed by disk on large tables store no wide table: neither the frame nor all columns of the scored rows or outcomes."""

import pytest

from tidemark.plans import daily, workspace
from tidemark.plans.catalogue import QUERIES
from tidemark.plans.catalogue.daily import ran
from tidemark.plans.workspace import Workspace

FRESH = "/root/testdata/./././sf0.001"           # the same data under a path for which nothing is stored yet


@pytest.mark.parametrize("name", ["P01_capped_topk", "L09_take_profit", "L05_realised", "E05_event_benchmarks", "E08_pick_verdict", "E09_take_profit_stats", "D14_latest_run",
                                  "D10_ticker_lookup", "T17_break_even", "S20_scores_daily"])
def test_no_wide_table_is_stored(spark, name):
    assert QUERIES[name](spark, FRESH).columns
    wide = {k[2] for k in workspace._store if k[1] == FRESH and k[3:] == ((),)}
    assert wide.isdisjoint({"frame", "scored", "outcomes"})


def test_unstored_columns_equal_the_stored_ones(spark):
    cols = ["ticker", "date", "value_score", "regime", "fwd_ret_5"]
    a, b = Workspace(spark, FRESH).scored_plan(*cols), Workspace(spark, FRESH).scored(*cols)
    assert b.count() > 0 and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_daily_run_stores_the_columns_it_reads_and_returns_them_all(spark, monkeypatch):
    stored, write = {}, daily.materialise
    monkeypatch.setattr(daily, "materialise", lambda d, name: stored.setdefault(name, d.columns) and write(d, name))
    _, out = ran(Workspace(spark, FRESH))
    assert {"features", "outcomes"}.isdisjoint(stored) and stored["scored"] == list(daily.READ)
    assert {*daily.READ, "breadth_ema50", "ret5_xr", "hh10", "vni_ret5", "limit"} < set(out["scored"].columns) and out["regimes"].count() > 0
