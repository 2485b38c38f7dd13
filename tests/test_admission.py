"""Buys of names with fewer than min_bars bars are rejected."""

import pytest
from harness import duck, same

from tidemark.plans.catalogue import ORACLES, QUERIES, ledger
from tidemark.plans.workspace import Workspace

SF = "/root/testdata/sf0.001"


def test_a_name_is_admitted_from_the_200th_bar(spark):
    ws = Workspace(spark, SF)
    bars = ws.frame().selectExpr("ticker", "date as session", "nbars", "liq20")
    n = ledger.eligible(ws).join(bars, ["ticker", "session"]).agg({"nbars": "min"}).first()[0]
    assert n == ws.cfg.min_bars == 200
    buys = ledger.admitted(ws).where("side = 'BUY'").join(bars, ["ticker", "session"], "left")
    young = buys.where("coalesce(nbars, 0) < 200").groupBy("reject").count().collect()
    assert young and {r["reject"] for r in young} <= {"not_eligible", "late_book"}
    assert ledger.trades(ws).where("side = 'BUY'").join(bars, ["ticker", "session"]).where("nbars < 200").count() == 0


CHANGED = ["T03_admission", "T06_fifo_lots", "T06_sale_results", "T07_sellable", "T08_open_positions", "T09_nav", "T10_index_curve", "T11_counterparts", "T12_scorecard",
           "T13_drawdown", "T14_journal", "T15_ticket_maths", "D15_leaderboard"]


@pytest.mark.parametrize("name", CHANGED)
def test_ledger_follows_its_twin(spark, name):
    assert "nbars > 20)" not in ORACLES[name]
    assert same(QUERIES[name](spark, SF).toPandas(), duck(SF).execute(ORACLES[name]).df()) is None


def test_orders_of_a_session_without_bars_stay_in_the_ledger(spark):
    """Before the first bar, in a gap and after the last bar; positions follow the dates."""
    from datetime import date, timedelta

    from tidemark.config import Config
    from tidemark.operators import ledger
    day = [date(2024, 1, 1) + timedelta(days=i) for i in range(8)]
    cal = spark.createDataFrame([(d, i) for i, d in enumerate(d for d in day[1:7] if d != day[5])], "date date, di long")
    rows = [("a", "X", day[1], "BUY", "ATO", None, "filled", 10.0, 1e6, 1), *[("a", "X", day[i], "SELL", "ATO", "100", "no_price", None, None, 10 + i) for i in (0, 5, 7)]]
    d = spark.createDataFrame(rows, "agent string, ticker string, session date, side string, type string, qty string, status string, price double, value_vnd double, order_no long")
    got = {r["order_no"]: r["status"] for r in ledger.settle_sales(ledger.add_size(d, Config()), cal, Config()).collect()}
    assert got == {1: "filled", 10: "no_position", 15: "no_price", 17: "no_price"}
