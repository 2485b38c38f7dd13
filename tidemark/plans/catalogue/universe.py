"""Universe and per-date cross-section."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import universe as op
from tidemark.functions.expr import last_rows
from tidemark.functions.ranks import add_pct_ranks
from tidemark.plans.catalogue.registry import query, report
from tidemark.plans.catalogue.sqltext import chain

K = ["ticker", "date"]
SC = chain("scored")


def agents(ws):
    """Four agents; each covers the industries whose number has its remainder."""
    n = ws.table("nation").select("n_name", (F.col("n_nationkey") % 4).alias("a"))
    return n.groupBy("a").agg(F.collect_set("n_name").alias("industries")).select(
        F.concat(F.lit("A"), F.col("a") + 1).alias("id"), "industries",
        (0.01 + 0.005 * F.col("a")).alias("risk_per_trade"), (0.15 + 0.05 * F.col("a")).alias("max_weight"),
        F.lit(0.2).alias("min_cash"), F.lit(3).alias("max_per_industry"))


AGENTS = """
ag as (select 'A' || (n_nationkey % 4 + 1) as agent, n_name industry, 0.01e0 + 0.005e0*(n_nationkey % 4) risk_per_trade,
              0.15e0 + 0.05e0*(n_nationkey % 4) max_weight from nation)"""


@query("U01_symbol_filter", report("sym", "ticker date", "close", ctes=chain("sym")))
def symbol_filter(ws):
    """Full-match code pattern and first date."""
    return op.select_symbols(ws.panel(), ws.cfg).select(*K, "close")


@query("U02_infer_exchange", chain("exch") + """, mp as (select distinct ticker, 'HNX' exchange from sym where sid % 11 = 3)
select exch.ticker, coalesce(mp.exchange, exch) exch, case when mp.exchange is not null then 'map' else exch_src end exch_src
from exch left join mp using (ticker)""")
def infer_exchange(ws):
    """Exchange from the return quantile, overridden by an explicit map."""
    m = ws.symbols().where("sid % 11 = 3").select(F.lower("ticker").alias("ticker"), F.lit("hnx").alias("exchange")).distinct()
    return op.infer_exchange(ws.symbols(), ws.cfg, m)


@query("U03_price_limit", report('(select distinct ticker, exch, "limit" from frame)', "ticker exch", '"limit"', ctes=chain("frame")))
def price_limit(ws):
    """Daily price limit per ticker."""
    return op.add_exchange(ws.symbols().select("ticker").distinct(), ws.exchanges()).select("ticker", "exch", "limit")


@query("U04_eligible", report("frame", "ticker date eligible", ctes=chain("frame")))
def eligible(ws):
    """Liquidity, history and volume test per bar."""
    return ws.features().select(*K, "eligible")


@query("U05_near_limits", report("frame", "ticker date", ints="near_ceiling near_floor", ctes=chain("frame")))
def near_limits(ws):
    """Bars that closed at the daily limit."""
    return op.add_flags(ws.features().drop("eligible", "near_ceiling", "near_floor"), ws.cfg).select(*K, "near_ceiling", "near_floor")


@query("U06_breadth", report("(select distinct date, breadth_ema50 from scored)", "date", "breadth_ema50", ctes=SC))
def breadth(ws):
    """Share of eligible names above EMA50 per date."""
    e = ws.features().where("eligible")
    return op.add_breadth_joined(e.select(*K, "dist_ema50")).select("date", "breadth_ema50").distinct()


@query("U07_pct_rank", chain("scored") + """, r as (select ticker, date,
  case when ret20 is not null then (rank() over (partition by date order by ret20) + (count(*) over (partition by date, ret20) - 1)/2e0)
       / count(ret20) over (partition by date) end up,
  case when ret20 is not null then (rank() over (partition by date order by ret20 desc) + (count(*) over (partition by date, ret20) - 1)/2e0)
       / count(ret20) over (partition by date) end down from scored)\n""" + report("r", "ticker date", "up down"))
def pct_rank(ws):
    """Average-tie percent rank, both directions."""
    e = ws.features().where("eligible").select(*K, "ret20")
    return add_pct_ranks(e, ["date"], {"up": ("ret20", True), "down": ("ret20", False)}, ws.cfg.split).select(*K, "up", "down")


@query("U07_pct_rank_by_value_range", report("scored", "ticker date", "ret5_xr ret20_xr", ctes=SC))
def pct_rank_split(ws):
    """The same ranks by counted value ranges, the plan for dates too large for one task."""
    e = ws.features().where("eligible").select(*K, "ret5", "ret20")
    return add_pct_ranks(e, ["date"], {"ret5_xr": ("ret5", True), "ret20_xr": ("ret20", True)}, split=True).select(*K, "ret5_xr", "ret20_xr")


@query("U08_value_score", report("scored", "ticker date value_mode", "value_score", ctes=SC))
def value_score(ws):
    """Mean of four percent ranks."""
    return op.add_value(ws.features().where("eligible"), ws.cfg).select(*K, "value_mode", "value_score")


@query("U09_value_pool", report("scored", "ticker date value_top30", ctes=SC))
def value_pool(ws):
    """Top 30 % by value score."""
    return op.add_value(ws.features().where("eligible"), ws.cfg).select(*K, "value_top30")


@query("U10_regime", report("scored", "ticker date regime", ctes=SC))
def regime(ws):
    """Trend regime."""
    return op.add_regime(ws.features().where("eligible")).select(*K, "regime")


@query("U11_trend_score", report("scored", "ticker date", "trend_score", ctes=SC))
def trend_score(ws):
    """Bounded trend score."""
    return op.add_regime(ws.features().where("eligible")).select(*K, "trend_score")


@query("U12_cross_ranks", report("scored", "ticker date", "ret5_xr ret20_xr vol_ratio20_xr volat20_xr rsi14_xr", ctes=SC))
def cross_ranks(ws):
    """Percent ranks of five features per date."""
    xr = [f"{c}_xr" for c in ("ret5", "ret20", "vol_ratio20", "volat20", "rsi14")]
    return op.add_cross_ranks(ws.features().where("eligible"), ws.cfg).select(*K, *xr)


@query("U13_industry", chain("sym", "ind") + "\nselect ticker, date, industry from sym left join ind using (ticker)")
def industry(ws):
    """Industry enrichment."""
    return op.add_industry(ws.symbols(), ws.industry()).select(*K, "industry")


@query("U14_regime_counts", SC + """
select regime, count(*) n_universe, count(*) filter (value_top30) n_pool from scored where date = (select max(date) from scored) group by 1""")
def regime_counts(ws):
    """Rows per regime on the last date."""
    last = last_rows(ws.features().where("eligible"))       # ranks are per date, so the other dates need none
    return op.count_regimes(op.add_regime(op.add_value(last, ws.cfg)))


@query("U15_agent_candidates", SC + "," + AGENTS + """, t as (select a.agent, s.* from scored s join ag a using (industry) where date = (select max(date) from scored))
select agent, ticker, regime, """ + ", ".join(f"case when abs({c}*100) < 0.05e0 then 0e0 else round({c}*100,1) end as {c}" for c in ("ret5", "ret20", "dist_ema50"))
    + """, round(trend_score,2)+0 as trend_score, near_ceiling::bigint near_ceiling from t""")
def agent_candidates(ws):
    """Last date's rows within each agent's industries."""
    return op.candidates(ws.scored(), agents(ws)).select("agent", "ticker", "regime", "ret5", "ret20", "dist_ema50", "trend_score", "near_ceiling")
