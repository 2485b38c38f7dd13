"""The prediction log and its checks derive the columns they read; no wide table is built for them."""

from harness import same

from tidemark.operators import labels
from tidemark.plans import workspace
from tidemark.plans.catalogue import QUERIES, livelog
from tidemark.plans.workspace import Workspace

SF, FRESH = "/root/testdata/sf0.001", "/root/testdata/././sf0.001"


def test_health_checks_build_no_wide_table(spark):
    assert QUERIES["Q06_health_checks"](spark, FRESH).count() == 1
    assert {k[2] for k in workspace._store if k[1] == FRESH}.isdisjoint({"frame", "outcomes"})


def test_log_outcomes_equal_the_wide_ones(spark):
    cols = ["ticker", "date", "real", "net", "y_bin", "buyable"]
    ws, wide = Workspace(spark, FRESH), Workspace(spark, SF)
    assert same(livelog._outcomes(ws).select(*cols).toPandas(), labels.add_outcome(wide.scored().where("fwd_ret_5 is not null"), wide.cfg).select(*cols).toPandas()) is None
