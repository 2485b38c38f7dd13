"""Market brief and dashboard queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import brief as op, livelog as lv
from tidemark.plans.catalogue import ledger as led
from tidemark.plans.catalogue.livelog import EVAL, LOG, LOGGED, SIG, evaluations, settled, signals
from tidemark.plans.catalogue.registry import query, report
from tidemark.plans.catalogue.sqltext import chain, ewm

LE = LOG + "," + EVAL


@query("D01_market_overview", chain("xfeat") + "\n" + report(
    "(select date, close, vni_ret1 chg1, vni_ret5 chg5, vni_ret20 chg20, d50 dist_ema50, d200 dist_ema200 from xfeat where date = (select max(date) from xfeat))", "date",
    "close chg1 chg5 chg20 dist_ema50 dist_ema200"))
def market_overview(ws):
    """Index on the last date."""
    return op.market_overview(ws.index(), ws.cfg)


@query("D02_breadth", chain("sym") + f""",
b1 as (select *, row_number() over w - 1 pos, count(close) over w cnt_close, close/lag(close) over w - 1 r from sym window w as (partition by ticker order by date)),
b2 as (select *, {ewm('close', '(2e0/51)', 50)} e from b1 window w as (partition by ticker order by date)),
dy as (select date, count(*) filter (r > 0) advancers, count(*) filter (r < 0) decliners, count(*) filter (r = 0) unchanged, avg(coalesce(close > e, false)::int::double) above_ema50,
   sum(close*volume*1000) v from b2 group by 1),
u as (select *, v/avg(v) over (order by date rows between 20 preceding and 1 preceding) value_ratio from dy)\n"""
       + report("(select * from u where date = (select max(date) from u))", "date", "above_ema50 value_ratio", "advancers decliners unchanged"))
def breadth(ws):
    """Advancers, decliners, value against the previous 20 dates."""
    return op.breadth_brief(ws.symbols(), ws.cfg)


def _win(name: str, a: int, b: int) -> str:
    f = f"(order by data_date rows between {a} preceding and {'current row' if b == 0 else str(b) + ' preceding'})"
    se = lambda c: f"case when count({c}) over {f} > 1 then 2*stddev_samp({c}) over {f}/sqrt(count({c}) over {f}) end"
    return f"""
{name} as (select data_date, count(*) over {f} n, avg(ic) over {f} mean_ic, {se('ic')} ic_noise, avg(ex) over {f} excess, {se('ex')} excess_noise, avg(li) over {f} lift, avg(ca) over {f} calib
   from (select *, tn07_net - market_net ex, case when tn07_net is not null then tn07_hit - pool_hit end li, case when tn07_net is not null then pred_mean - tn07_hit end ca from le))"""


HF = "mean_ic ic_noise excess excess_noise lift calib"


@query("D03_rolling_health", LE + "," + _win("h", 19, 0) + "\n" + report("h", "data_date", HF, "n"))
def rolling_health(ws):
    """Rolling 20-date means with noise."""
    return op.health_window(evaluations(ws)).select("data_date", "n", *HF.split())


@query("D04_health_state", LE + "," + _win("h", 19, 0) + """
select data_date, case when n < 20 then 'na' when mean_ic <= 1e-12 and excess <= 1e-12 then 'bad' when coalesce(mean_ic <= 1e-12, false) or coalesce(excess <= 1e-12, false) or coalesce(abs(calib) > 0.15e0, false)
  then 'watch' else 'ok' end state from h""")
def health_state(ws):
    """State of the model by fixed rules."""
    return op.add_health_state(op.health_window(evaluations(ws))).select("data_date", "state")


@query("D05_health_trend", LE + "," + _win("h", 19, 0) + "," + _win("g", 39, 20) + """,
j as (select h.*, g.mean_ic pi, g.excess pe, g.lift pl, g.calib pc from h join g using (data_date))
select data_date, case when mean_ic is null or pi is null then 'none' when abs(mean_ic-pi) < coalesce(ic_noise, 0) then 'flat' when mean_ic > pi then 'up' else 'down' end ic_trend,
  case when excess is null or pe is null then 'none' when abs(excess-pe) < coalesce(excess_noise, 0) then 'flat' when excess > pe then 'up' else 'down' end excess_trend,
  case when lift is null or pl is null then 'none' when abs(lift-pl) < 0.05e0 then 'flat' when lift > pl then 'up' else 'down' end lift_trend,
  case when calib is null or pc is null then 'none' when abs(abs(calib)-abs(pc)) < 0.05e0 then 'flat' when -abs(calib) > -abs(pc) then 'up' else 'down' end calib_trend from j""")
def health_trend(ws):
    """Current against previous window."""
    return op.health_trend(evaluations(ws))


@query("D06_edge_curves", LE + """,
u as (select data_date, sum(coalesce((tn07_net-market_net)/5, 0)) over w cum_top, sum(case when tn06r_n > 0 then coalesce(tn06r_n*(tn06r_net-market_net)/10, 0) else 0 end) over w cum_event
   from le window w as (order by data_date))\n""" + report("u", "data_date", "cum_top cum_event"))
def edge_curves(ws):
    """Cumulative edges."""
    return op.edge_curves(evaluations(ws))


@query("D07_track_curves", SIG + """,
td as (select data_date, avg(net) a, avg(excess) b from sg where status = 'settled' group by 1),
u as (select data_date, sum(a) over (order by data_date) cum_net, sum(b) over (order by data_date) cum_excess from td)\n""" + report("u", "data_date", "cum_net cum_excess"))
def track_curves(ws):
    """Cumulative net and excess of the signals."""
    return op.track_curves(lv.track_daily(signals(ws)))


@query("D08_live_tiles", LE + """,
u as (select count(*) n_days, count(*) filter (source = 'live') n_live, avg(ic) ic_mean, avg((ic > 1e-12)::int::double) ic_pos, avg(tn07_net-market_net) vs_market, avg(tn07_net-pool_net) vs_random,
   avg(pred_mean) filter (tn07_net is not null) pred, avg(tn07_hit) filter (tn07_net is not null) hit, coalesce(sum(tn06r_n) filter (tn06r_n > 0), 0) n_events,
   sum(tn06r_n*tn06r_net) filter (tn06r_n > 0)/sum(tn06r_n) filter (tn06r_n > 0) event_net, sum(tn06r_n*(tn06r_net-market_net)) filter (tn06r_n > 0)/sum(tn06r_n) filter (tn06r_n > 0) event_vs_market
   from le)\n""" + report("u", "", "ic_mean ic_pos vs_market vs_random pred hit event_net event_vs_market", "n_days n_live n_events"))
def live_tiles(ws):
    """Headline figures."""
    return op.live_tiles(evaluations(ws))


@query("D09_watch_list", LOG + """,
d3 as (select data_date, row_number() over (order by data_date desc) - 1 k from (select distinct data_date from st) qualify k < 3),
g as (select ticker, max(rsi14) filter (k=0) rsi14, max(vol_ratio20) filter (k=0) vol_ratio20, count(*) filter (k=1) > 0 b, count(*) filter (k=2) > 0 c from st join d3 using (data_date) where rsi14 < 42 group by 1),
u as (select ticker, rsi14, vol_ratio20, case when b and c then 3 when b then 2 else 1 end streak, coalesce(vol_ratio20 >= 1.05e0, false) volume_ok from g where rsi14 is not null),
v as (select *, streak + volume_ok::int score from u order by score desc, rsi14, ticker limit 8)\n""" + report("v", "ticker volume_ok", "rsi14 vol_ratio20", "streak score"))
def watch_list(ws):
    """Names close to an event."""
    return op.watch_list(settled(ws), ws.cfg)


@query("D10_ticker_lookup", LOG + """,
p as (select * from st where ticker = (select min(ticker) from st) order by data_date desc limit 120),
s as (select * from scored where ticker = (select min(ticker) from st) order by date desc limit 60),
u as (select p.data_date, coalesce(case when p.data_date < date '2001-03-01' then p.regime end, s.regime) regime, coalesce(p.p_up_5, s.p_up_5) p_up_5, p.status, p.net, s.atr14_pct, s.liq20, s.exch
   from p left join s on s.date = p.data_date)\n""" + report("u", "data_date regime status exch", "p_up_5 net atr14_pct liq20"))
def ticker_lookup(ws):
    """History of one ticker, gaps filled from the score table."""
    log = settled(ws).withColumn("regime", F.when(F.col("data_date") < F.lit("2001-03-01").cast("date"), F.col("regime")))
    scores = ws.scored_plan("ticker", "date", "close", "p_up_5", "value_score", "regime", "trend_score", "atr14_pct", "liq20", "exch")
    t = op.ticker_lookup(log, scores, log.select(F.min("ticker")).scalar())
    return t.select("data_date", "regime", "status", "exch", "p_up_5", "net", "atr14_pct", "liq20")


@query("D11_ticker_overview", LOG + """,
r as (select *, row_number() over (partition by ticker order by data_date desc) i from st qualify i <= 120),
u as (select ticker, max(data_date) data_date, max(close) filter (i=1) as close, max(close) filter (i=1)/max(close) filter (i=2)-1 chg1, max(close) filter (i=1)/max(close) filter (i=6)-1 chg5,
   max(close) filter (i=1)/max(close) filter (i=21)-1 chg20, min(close) lo, max(close) hi, coalesce(min(i) filter (not coalesce(rsi14 < 42, false)), count(*)+1)-1 low_rsi_streak,
   count(*) filter (tn07_pick) n_picked, count(*) n_rows, count(*) filter (status='settled') n_settled, avg(net) filter (status='settled') mean_net,
   avg((net > 0)::int::double) filter (status='settled') win_share from r group by 1),
v as (select *, (close-lo)/nullif(hi-lo, 0) pos_in_range from u)\n"""
       + report("v", "ticker data_date", "close chg1 chg5 chg20 lo hi mean_net win_share pos_in_range", "low_rsi_streak n_picked n_rows n_settled"))
def ticker_overview(ws):
    """One row per ticker."""
    return op.ticker_overview(settled(ws), ws.cfg)


@query("D12_business_days", chain("panel") + """,
d as (select distinct date + (sid % 7)::int d from panel),
x as (select d, unnest(generate_series(1, 30)) k from d),
y as (select d, d + k::int e, row_number() over (partition by d order by k) i from x where dayofweek(d + k::int) not in (0, 6))
select d as date, max(e) filter (i=1) plus1, max(e) filter (i=5) plus5, max(e) filter (i=12) plus12 from y group by 1""")
def business_days(ws):
    """Weekdays ahead of each date."""
    d = ws.panel().select(F.date_add("date", (F.col("sid") % 7).cast("int")).alias("date")).distinct()
    return d.select("date", *[op.add_business_days(F.col("date"), n).alias(f"plus{n}") for n in (1, 5, 12)])


PAPER = """
pt0 as (select st.*, cal.di, (select max(di) from cal) m from st join cal on cal.date = st.data_date where tn06r_signal),
pt as (select ticker, data_date, case when di = m then 'planned' when di+5-m > 0 then 'open' when status = 'unfilled_ceiling' then 'skipped_ceiling' else 'closed' end status, di+5-m sl, net from pt0)"""


@query("D13_plan_split", LOG + "," + PAPER + """,
b as (select case status when 'planned' then 'planned' when 'open' then case when sl <= 1 then 'due' else 'hold' end when 'closed' then 'closed' end bucket, case when status = 'closed' then net end pnl from pt),
u as (select bucket, count(*) n, avg((pnl > 0)::int::double) win_share, avg(pnl) mean_pnl from b where bucket is not null group by 1)\n""" + report("u", "bucket", "win_share mean_pnl", "n"))
def plan_split(ws):
    """Planned, due, hold, closed."""
    return op.plan_split(op.paper_trades(settled(ws), ws.calendar(), ws.cfg))


@query("D14_latest_run", LE + """
select max(data_date) last_prediction, count(*) filter (data_date = (select max(data_date) from st)) rows_last_date, count(*) filter (status='open' and data_date < (select max(data_date) from st) - 11) n_stuck,
  count(*) filter (status='open') n_open, (select max(date) from scored) last_score, (select max(data_date) from le) last_evaluation from st""")
def latest_run(ws):
    """Freshness of the published tables."""
    return op.latest_run(settled(ws), ws.scored(*LOGGED), evaluations(ws))


@query("D14_status_counts", LOG + "\nselect status, count(*) n from st group by 1")
def status_counts(ws):
    """Rows per status."""
    return settled(ws).groupBy("status").agg(F.count(F.lit(1)).alias("n"))


@query("D14_health_samples", LE + "," + _win("h", 19, 0) + """,
i as (select *, row_number() over (order by data_date) i, count(*) over () m from h),
u as (select 'last' sample, * from i where i = m union all select 'previous', * from i where i = m-20 union all select 'first', * from i where i = 20)\n""" + report("u", "sample data_date", HF, "n"))
def health_samples(ws):
    """Last, previous and first 20 dates."""
    return op.health_samples(evaluations(ws))


@query("D15_leaderboard", led.TRC + "," + led.NAV + "\n" + report("(select agent, date, ret_cum, rank() over (order by ret_cum desc) place from nv where date = (select max(date) from nv))",
                                                                "agent date", "ret_cum", "place"))
def leaderboard(ws):
    """Portfolios by return."""
    return op.leaderboard(led.navs(ws))
