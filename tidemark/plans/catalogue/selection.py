"""Basket selection and report columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.expr import last_rows
from tidemark.operators import labels, selection as op
from tidemark.plans.catalogue.registry import query, report
from tidemark.plans.catalogue.sqltext import chain, pct

K = ["ticker", "date"]


def topk(src: str, score: str, out: str, by: str = "date", pool: str = "value_top30", extra: str = "") -> str:
    """CTEs for the capped top-K of a relation."""
    return f"""
{out}_1 as (select *, row_number() over (partition by {by}, coalesce(industry, ticker) order by {score} desc nulls last, ticker) ri
   from {src} where {pool} {extra}),
{out} as (select * from (select *, row_number() over (partition by {by} order by {score} desc nulls last, ticker) rank_sel from {out}_1 where ri <= 3)
   where rank_sel <= 10)"""


BAD = "sid % 10 = 2"      # names treated as quarantined in these queries


def quarantined(ws):
    return ws.scored().where(BAD).select("ticker").distinct()


@query("P01_capped_topk", chain("scored") + "," + topk("scored", "ret20", "sel", extra=f"and not ({BAD})")
       + "\n" + report("sel", "ticker date", "ret20", "rank_sel"))
def capped_topk(ws):
    """Ten best of the pool per date, three per industry, quarantined names left out."""
    s = ws.scored(*K, "industry", "value_top30", "ret20", "sid")
    return op.capped_topk(s, "ret20", ws.cfg, exclude=s.where(BAD).select("ticker").distinct()).select(*K, "ret20", "rank_sel")


SOFT = f"""
so as (select *, 0.75e0*({pct('p_up_5')}) + 0.25e0*({pct('value_score')}) soft from scored)"""


@query("P02_soft_value", chain("scored") + "," + SOFT + "," + topk("so", "soft", "sel", pool="true") + "\n" + report("sel", "ticker date", "soft", "rank_sel"))
def soft_value(ws):
    """Blend of model and value ranks over the whole universe."""
    return op.capped_topk(op.add_soft_score(ws.scored(), "p_up_5", "soft", ws.cfg), "soft", ws.cfg, pool=None).select(*K, "soft", "rank_sel")


RANKS = """
rk as (select *, rank() over (partition by date order by p_up_5 desc) rank_all,
   case when value_top30 then rank() over (partition by date, value_top30 order by p_up_5 desc) end rank_pool from scored)"""


@query("P03_ranks", chain("scored") + "," + RANKS + "\n" + report("rk", "ticker date", "", "rank_all rank_pool"))
def ranks(ws):
    """Competition ranks in the universe and in the pool."""
    return op.add_ranks(ws.scored(*K, "p_up_5", "value_top30"), "p_up_5", ws.cfg).select(*K, "rank_all", "rank_pool")


@query("P03_ranks_by_value_range", chain("scored") + "," + RANKS + "\n" + report("rk", "ticker date", "", "rank_all rank_pool"))
def ranks_split(ws):
    """The same ranks by counted value ranges."""
    return op.add_ranks(ws.scored(*K, "p_up_5", "value_top30"), "p_up_5", ws.cfg.but(names_bound=10**12)).select(*K, "rank_all", "rank_pool")


DAYS = """
sd as (select date, row_number() over (order by date) - 1 sdi from (select distinct date from scored)),
dc0 as (select s.*, sdi, lag(sdi) over w ldi, lag(p_up_5) over w lp, lag(regime) over w lr from scored s join sd using (date)
   window w as (partition by ticker order by date)),
dc as (select *, case when ldi = sdi - 1 then p_up_5 - lp end d_p, case when ldi = sdi - 1 then lr end regime_prev from dc0)"""


@query("P04_day_change", chain("scored") + "," + DAYS + "," + topk("dc", "p_up_5", "sel") + "\n" + report("sel", "ticker date regime_prev", "d_p"))
def day_change(ws):
    """Change of the score and previous regime of the picks."""
    d = op.add_day_change(ws.scored(), labels.session_index(ws.scored()))
    return op.capped_topk(d, "p_up_5", ws.cfg).select(*K, "regime_prev", "d_p")


RISK = f"""
q9 as (select date, quantile_cont(atr14_pct, 0.9) q90 from scored group by 1),
ri as (select s.*, list_filter([case when near_ceiling = 1 then 'at_ceiling' end, case when near_floor = 1 then 'at_floor' end,
   case when liq20 < 1.5*90000 then 'thin_liquidity' end, case when regime = 'Downtrend' then 'downtrend' end,
   case when atr14_pct > q90 then 'high_volatility' end, case when {BAD} then 'quarantined' end,
   case when exch_src = 'inferred' then 'exchange_inferred' end, 'proxy_value'], lambda x: x is not null) risks,
   list_filter([case when near_ceiling = 1 then 'at_ceiling' end, case when near_floor = 1 then 'at_floor' end,
   case when regime = 'Downtrend' then 'downtrend' end, case when {BAD} then 'quarantined' end], lambda x: x is not null) blocking
   from sel s left join q9 using (date))"""


def _risky(ws, cfg=None):
    sel = op.capped_topk(ws.scored(), "ret20", ws.cfg)
    return op.add_risk_flags(sel, ws.scored(), cfg or ws.cfg, quarantined(ws))


@query("P05_risk_flags", chain("scored") + "," + topk("scored", "ret20", "sel") + "," + RISK
       + "\nselect ticker, date, array_to_string(risks, ',') risks, array_to_string(blocking, ',') blocking from ri")
def risk_flags(ws):
    """Risk flags of the picks and the blocking ones among them."""
    return _risky(ws).select(*K, F.array_join("risks", ",").alias("risks"), F.array_join("blocking", ",").alias("blocking"))


@query("P05_risk_flags_by_value_range", chain("scored") + "," + topk("scored", "ret20", "sel") + "," + RISK
       + "\nselect ticker, date, array_to_string(risks, ',') risks, array_to_string(blocking, ',') blocking from ri")
def risk_flags_split(ws):
    """The same flags with the quantile found by counted value ranges."""
    return _risky(ws, ws.cfg.but(names_bound=10**12)).select(*K, F.array_join("risks", ",").alias("risks"), F.array_join("blocking", ",").alias("blocking"))


@query("P06_action", chain("scored") + "," + topk("scored", "ret20", "sel") + "," + RISK + """, ac as (select *, date >= date '2000-01-01' g from ri)
select ticker, date, case when g and len(blocking) = 0 then 'consider' else 'watch' end as action,
  case when g and len(blocking) = 0 then '' else array_to_string(list_concat(case when g then [] else ['gate_not_passed'] end, blocking), '; ') end reasons from ac""")
def action(ws):
    """consider / watch with reasons; here the gate passes from 2000 on."""
    return op.add_action(_risky(ws), F.col("date") >= F.lit("2000-01-01").cast("date")).select(*K, "action", "reasons")


@query("P07_top_uptrend", chain("scored") + "\n" + report("""(select * from scored where date = (select max(date) from scored) and regime = 'Uptrend'
   order by trend_score desc, ticker limit 10)""", "ticker", "trend_score close"))
def top_uptrend(ws):
    """Strongest uptrend names of the last date."""
    return op.top_uptrend(ws.scored()).select("ticker", "trend_score", "close")


PLAN = """
sg as (select ticker, industry, rsi14, coalesce(industry, ticker) ind, row_number() over (order by rsi14, ticker) i
   from scored where date = (select max(date) from scored) and rsi14 < 50),
hd as (select ticker, coalesce(industry, ticker) ind from scored where date = (select max(date) from scored) and sid % 13 = 4),
st(i, n_open, inds, status) as (
   select 0::bigint, (select count(*) from hd)::bigint, coalesce((select list(ind) from hd), []), ''::varchar
   union all
   select s.i, t.n_open + (x.status = 'planned')::int, case when x.status = 'planned' then list_append(t.inds, s.ind) else t.inds end, x.status
   from st t join sg s on s.i = t.i + 1, lateral (select case when t.n_open >= 10 then 'skipped_full'
      when len(list_filter(t.inds, lambda v: v = s.ind)) >= 3 then 'skipped_industry'
      when s.ticker in (select ticker from hd) then 'skipped_holding' else 'planned' end status) x)"""


@query("P08_next_session_plan", chain("scored") + "," + PLAN + """
select ticker, industry, round(rsi14, 6) rsi14, status, case when status = 'planned' then 0.1e0 end amount from st join sg using (i)""")
def next_session_plan(ws):
    """Entries for the next session within free slots and industry caps."""
    last = last_rows(ws.scored())
    return op.plan_next_session(last.where("rsi14 < 50"), last.where("sid % 13 = 4").select("ticker", "industry"), 1.0, ws.cfg)
