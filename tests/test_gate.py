"""The gate asks for 60 test days."""

from harness import duck, same

from tidemark.plans.catalogue import ORACLES, QUERIES, backtest

SF = "/root/testdata/sf0.001"


def test_gate_asks_for_sixty_test_days(spark, monkeypatch):
    seen, gate = [], backtest.op.gate
    monkeypatch.setattr(backtest.op, "gate", lambda model, baseline, cfg: seen.append(cfg.min_test_days) or gate(model, baseline, cfg))
    got = QUERIES["B10_gate"](spark, SF).toPandas()
    assert seen == [60]
    assert same(got, duck(SF).execute(ORACLES["B10_gate"]).df()) is None
