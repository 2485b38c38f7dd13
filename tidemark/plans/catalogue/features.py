"""Per-ticker features over the generated panel."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import features as op
from tidemark.plans.catalogue.registry import query, report
from tidemark.plans.catalogue.sqltext import chain

K = ["ticker", "date"]
FEAT = chain("feat")


def _all(ws):
    return op.add_features(ws.symbols(), ws.cfg)


def _reg(name: str, cols: str, build=None, **per):
    fn = build or _all
    doc = f"Feature columns {cols} for every bar."

    def run(ws):
        return fn(ws).select(*K, *cols.split())
    run.__doc__ = doc
    query(name, report("feat", "ticker date", cols, ctes=FEAT, **per), **per)(run)


_reg("F01_returns", "ret1 ret5 ret20 ret60", lambda ws: op.add_returns(ws.symbols()))
_reg("F02_ema", "ema20 ema50 ema200", lambda ws: op.add_trend(ws.symbols(), ws.cfg))
_reg("F04_ema_distance", "dist_ema20 dist_ema50 dist_ema200", lambda ws: op.add_trend(ws.symbols(), ws.cfg))
_reg("F05_ema_spread_slope", "ema20_50 ema50_slope10", lambda ws: op.add_trend(ws.symbols(), ws.cfg))
_reg("F06_true_range_atr", "tr atr14_pct", lambda ws: op.add_directional(ws.symbols(), ws.cfg))
_reg("F07_directional_index", "plus_di minus_di", lambda ws: op.add_directional(ws.symbols(), ws.cfg))
_reg("F08_adx", "dx adx14 di_diff", lambda ws: op.add_directional(ws.symbols(), ws.cfg))
_reg("F09_rsi", "rsi14", lambda ws: op.add_directional(ws.symbols(), ws.cfg))
_reg("F10_macd_hist", "macd_hist", lambda ws: op.add_macd(ws.symbols(), ws.cfg))
_reg("F11_volatility", "volat20 volat60", lambda ws: op.add_volatility(ws.symbols()))
_reg("F12_volume_ratio", "vol_ratio20", lambda ws: op.add_activity(ws.symbols()))
_reg("F13_liquidity", "liq20 log_liq20", lambda ws: op.add_activity(ws.symbols()))
_reg("F14_range_position", "pos20 pos60", lambda ws: op.add_range_position(ws.symbols()))
_reg("F15_year_extremes", "dd252 up252", lambda ws: op.add_range_position(ws.symbols()))
_reg("F16_close_location", "clv", lambda ws: op.add_range_position(ws.symbols()))
_reg("F17_swing_structure", "hh10 hl10", lambda ws: op.add_range_position(ws.symbols()))
_reg("F_all_features", "ret1 ret5 ret20 ret60 dist_ema20 dist_ema50 dist_ema200 ema20_50 ema50_slope10 atr14_pct adx14 di_diff rsi14 "
     "macd_hist volat20 volat60 vol_ratio20 log_liq20 pos20 pos60 dd252 up252 clv hh10 hl10")


@query("F03_wilder", chain("feat") + ", wv as (select ticker, date, atr14_pct*close v from feat)\n" + report("wv", "ticker date", "v"))
def wilder(ws):
    """Wilder(14) of the true range, first value at bar 14."""
    return op.add_directional(ws.symbols(), ws.cfg).select(*K, (F.col("atr14_pct") * F.col("close")).alias("v"))


@query("F18_bar_number", report("feat", "ticker date", ints="nbars", ctes=FEAT))
def bar_number(ws):
    """1-based bar number per ticker."""
    return op.add_position(ws.symbols()).select(*K, "nbars")


@query("F19_index_features", chain("sym", "xfeat") + "\n" + report(
    "(select s.ticker, s.date, vni_ret5, vni_ret20, vni_dist_ema50 from sym s left join xfeat x on x.date = s.date)",
    "ticker date", "vni_ret5 vni_ret20 vni_dist_ema50"))
def index_join(ws):
    """Index return and trend columns joined on date."""
    return op.add_index_features(ws.symbols().select(*K), ws.index(), ws.cfg)


@query("F20_index_outlook", chain("xfeat") + "\n" + report(
    "(select date, close, vni_ret1 chg1, vni_ret5 chg5, vni_ret20 chg20, d50 dist_ema50, d200 dist_ema200 from xfeat)",
    "date", "close chg1 chg5 chg20 dist_ema50 dist_ema200"))
def index_outlook(ws):
    """Index changes and distance to EMA50/EMA200 without a minimum history."""
    return op.index_outlook(ws.index(), ws.cfg)
