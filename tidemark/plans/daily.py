"""The daily run as one composition: ingest, checks, scoring, gate, picks, log, settlement, evaluation.

State in, state out: every table is a DataFrame, so a caller reads them from and writes them to its own storage.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.config import Config
from tidemark.functions.expr import last_rows
from tidemark.operators import backtest, events, features, ingest, labels, livelog, quality, selection, universe
from tidemark.session import materialise
from tidemark.sources.bars import normalise, split_index


@dataclass(frozen=True)
class DailyState:
    panel: DataFrame                 # ticker, date, open, high, low, close, volume, turnover
    index: DataFrame                 # index bars
    industry: DataFrame              # ticker, industry
    log: DataFrame                   # prediction log
    signals: DataFrame               # signal log
    quarantine: DataFrame            # ticker
    exchange_map: DataFrame | None = None


def take_batch(state: DailyState, batch: DataFrame, cfg: Config) -> tuple[DailyState, DataFrame]:
    """Panel and index with the batch merged in, and the batch's status per ticker. A column `seq` orders repeated keys."""
    stocks, idx = split_index(normalise(batch))
    seq = "seq" if "seq" in stocks.columns else None
    more = [seq] if seq else []
    panel, status = ingest.reconcile(state.panel, stocks.select(*state.panel.columns, *more), cfg, seq)
    index = ingest.upsert(state.index, idx.select(*state.index.columns, *more), seq=seq)
    industry = ingest.upsert_dim(state.industry, stocks, seq=seq) if "industry" in stocks.columns else state.industry
    return replace(state, panel=materialise(panel, "panel"), index=materialise(index, "index"), industry=industry), materialise(status, "status")


def checked(state: DailyState, status: DataFrame | None, today: str, cfg: Config) -> DailyState:
    """Stop on repeated keys or non-positive prices; update the quarantine."""
    row = quality.qc(state.panel, today, cfg).first()
    if row["blocking"]:
        raise ValueError(f"quality checks block the run: {row.asDict()}")
    none = state.quarantine.limit(0)
    part = (lambda s: status.where(F.col("status") == s)) if status is not None else (lambda s: none)
    q = quality.quarantine(quality.jumps(state.panel), part("quarantine"), state.quarantine, part("replaced"), part("revalidated"))
    return replace(state, quarantine=materialise(q, "quarantine"))


# Scored columns that a run reads.
READ = ("ticker", "date", "industry", "close", "limit", "ret20", "p_up_5", "p_lr", "value_top30", "value_score", "value_mode", "regime", "trend_score", "rsi14",
        "vol_ratio20", "atr14_pct", "liq20", "near_ceiling", "near_floor", "exch_src", "open_t1", "close_t6", "open_gap_t1", "ret_t5_day", "fwd_ret_5", "y_bin")


def scored_frame(state: DailyState, score: Callable[[DataFrame], DataFrame], cfg: Config, now_utc: str, asof: str | None = None) -> DataFrame:
    """Eligible rows with features, cross-section, labels and scores, from what was known at that moment (a plan, not stored)."""
    bars = universe.select_symbols(quality.visible(state.panel, now_utc, asof), cfg)
    index = quality.visible(state.index, now_utc, asof)
    exch = universe.infer_exchange(bars, cfg, state.exchange_map)
    # the small dimensions join the narrow bars: joined after the windows they would share one oversized code stage
    bars = features.add_index_features(universe.add_exchange(bars, exch), index, cfg)
    f = universe.add_flags(labels.add_labels(features.add_features(bars, cfg), cfg), cfg)
    return score(universe.cross_section(f, state.industry, cfg))


def report_table(scored: DataFrame, picks: DataFrame, gate_pass: bool, quarantine: DataFrame, cfg: Config) -> DataFrame:
    """Picked rows of the last date with ranks, day change, risks, action and reasons."""
    d = selection.add_day_change(selection.add_ranks(scored, "p_up_5", cfg), labels.session_index(scored))
    mine = last_rows(d).join(picks.select("ticker", "rank_sel"), "ticker")
    t = selection.add_action(selection.add_risk_flags(mine, last_rows(scored), cfg, quarantine), gate_pass)
    cols = ["rank_sel", "ticker", "industry", "close", "p_up_5", "rank_all", "rank_pool", "d_p", "value_score", "value_mode", "trend_score", "regime",
            "regime_prev", "atr14_pct", "liq20", "action", "reasons"]
    return t.select(*cols, F.array_join("risks", "; ").alias("risks"))


def run_daily(state: DailyState, score: Callable[[DataFrame], DataFrame], cfg: Config, now_utc: str, batch: DataFrame | None = None,
              asof: str | None = None) -> tuple[DailyState, dict[str, DataFrame]]:
    """One run. Returns the new state and the tables to publish."""
    status = None
    if batch is not None:
        state, status = take_batch(state, batch, cfg)
    state = checked(state, status, now_utc[:10], cfg)
    names = state.panel.groupBy("date").count().agg(F.max("count")).first()[0]              # measured: decides the plan of the cross-sections
    cfg = cfg.but(names_bound=names or 0)
    wide = scored_frame(state, score, cfg, now_utc, asof)       # all columns, for the caller to write
    sc = materialise(wide.select(*READ), "scored")
    out = labels.add_outcome(sc.where("fwd_ret_5 is not null"), cfg)
    test = out.where(F.col("date") >= F.lit(cfg.test_start).cast("date"))
    gate = materialise(backtest.gate(backtest.strategy_report(test, "p_up_5", cfg, "model"), backtest.strategy_report(test, "p_lr", cfg, "logistic"), cfg), "gate")
    g = gate.first()                                           # one row
    ok = bool(g and g["strategy_pass"])
    last = sc.select(F.max("date")).first()[0]
    picks = materialise(selection.capped_topk(last_rows(sc), "p_up_5", cfg, exclude=state.quarantine), "picks")
    table = materialise(report_table(sc, picks, ok, state.quarantine, cfg), "report")
    signals = livelog.append_signals(livelog.settle_signals(state.signals, out), table.withColumn("entry_date_est", F.lit(None).cast("date")), str(last), ok, cfg)
    switch, cal = events.market_switch(quality.visible(state.index, now_utc, asof), cfg), labels.session_index(sc)
    back = materialise(livelog.backfill_dates(sc, state.log, cfg.test_start), "back")
    log = livelog.record(state.log, sc, selection.capped_topk(sc.join(F.broadcast(back), "date", "left_semi"), "p_up_5", cfg), back, switch, cal, cfg, "backfill")
    log = livelog.record(materialise(log, "log"), sc, picks, picks.select("date"), switch, cal, cfg, "live", state.quarantine)
    log = materialise(livelog.settle(livelog.fill_descriptive(log, sc), out, F.lit(last), cfg), "log")
    ev = materialise(livelog.evaluate(log, cfg), "evaluations")
    state = replace(state, log=log, signals=materialise(signals, "signals"))
    return state, {"scored": wide, "gate": gate, "report": table, "evaluations": ev, "live_summary": livelog.live_summary(ev), "regimes": universe.regime_counts(sc)}
