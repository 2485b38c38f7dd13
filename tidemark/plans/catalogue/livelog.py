"""Prediction log, settlement, evaluation, signal log, rollback."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import events, labels, livelog as op, selection
from tidemark.plans.catalogue.events import cool_sql
from tidemark.plans.catalogue.registry import query, report
from tidemark.plans.catalogue.selection import topk
from tidemark.plans.catalogue.sqltext import chain, pct
from tidemark.plans.workspace import _stored, Workspace
from tidemark.session import materialise

START, SECOND = "2000-10-02", "2001-08-06"       # first logged date; dates from SECOND on arrive in a later, live batch
DAY = "2001-08-06"                               # date rolled back
BAD = "sid % 10 = 2"
# Scored columns that the logs read, with those behind an outcome.
LOGGED = ("ticker", "date", "sid", "industry", "close", "p_up_5", "p_lr", "value_top30", "value_score", "regime", "trend_score", "rsi14", "vol_ratio20",
          "fwd_ret_5", "y_bin", "limit", "ret_t5_day", "open_t1", "close_t6", "open_gap_t1")


def _outcomes(ws):
    """Outcomes of the rows the logs read, so that one stored table serves both."""
    return labels.add_outcome(ws.scored(*LOGGED).where("fwd_ret_5 is not null"), ws.cfg)


def _log(ws):
    """Two batches: backfill before SECOND, then a live batch whose earlier dates are ignored."""
    sc, cfg = ws.scored(*LOGGED), ws.cfg
    sw, cal = events.market_switch(ws.index(), cfg), labels.session_index(sc)
    bad = sc.where(BAD).select("ticker").distinct()
    dates = sc.select("date").distinct().where(F.col("date") >= F.lit(START).cast("date"))
    first = op.record(op.empty_log(ws.spark), sc, selection.capped_topk(sc, "p_up_5", cfg), dates.where(F.col("date") < F.lit(SECOND).cast("date")),
                      sw, cal, cfg, "backfill")
    return op.record(materialise(first, "log"), sc, selection.capped_topk(sc, "p_up_5", cfg, exclude=bad), dates, sw, cal, cfg, "live", bad)


@_stored
def recorded(ws: Workspace):
    return materialise(_log(ws), "log")


@_stored
def settled(ws: Workspace):
    last = ws.panel().select(F.max("date")).scalar()
    return materialise(op.settle(recorded(ws), _outcomes(ws), last, ws.cfg), "log")


@_stored
def signals(ws: Workspace):
    """Picks of every logged date as a signal log, settled."""
    sel = selection.capped_topk(selection.add_ranks(ws.scored(*LOGGED).where(F.col("date") >= F.lit(START).cast("date")), "p_up_5", ws.cfg), "p_up_5", ws.cfg)
    act = F.when(F.col("regime") == "Downtrend", "watch").otherwise("consider")
    log = sel.select(F.col("date").alias("data_date"), "ticker", "rank_pool", "p_up_5", "value_score", "trend_score", "regime", act.alias("action"),
                     F.lit("").alias("reasons"), F.lit(True).alias("gate_pass"), F.lit("base").alias("model_version"), F.lit("open").alias("status"),
                     F.lit(None).cast("date").alias("entry_date_est"), *[F.lit(None).cast("double").alias(c) for c in op.SIGNAL_OUTCOME])
    return materialise(op.settle_signals(log, _outcomes(ws)), "signals")


LOG = chain("oc", "cal") + f""",
sd as (select date, row_number() over (order by date) - 1 di from (select distinct date from scored)),
fl0 as (select s.*, di, coalesce(s.vni_dist_ema50 < 0, false) regime_on from scored s join sd using (date)),
fl as (select *, coalesce(rsi14 < 42 and lag(rsi14,1) over w < 42 and lag(di,1) over w = di-1 and lag(rsi14,2) over w < 42 and lag(di,2) over w = di-2
   and vol_ratio20 >= 1.05e0, false) and regime_on cond from fl0 window w as (partition by ticker order by date)),
lg0 as (select * from fl where date >= date '{START}'),
lc as (select ticker, date, di from lg0 where cond),""" + cool_sql("lc", "ticker", "lk") + "," + topk("lg0", "p_up_5", "sa") + "," \
    + topk("lg0", "p_up_5", "sb", extra=f"and not ({BAD})") + f""",
lg as (select l.date data_date, l.ticker, case when l.date < date '{SECOND}' then 'backfill' else 'live' end source, 'base' model_version, industry, close, p_up_5, p_lr,
   rank() over (partition by l.date order by p_up_5 desc) rank_all, value_top30, value_score, regime, trend_score,
   case when l.date < date '{SECOND}' then exists (select 1 from sa where sa.ticker = l.ticker and sa.date = l.date)
        else exists (select 1 from sb where sb.ticker = l.ticker and sb.date = l.date) end tn07_pick, rsi14, vol_ratio20, regime_on tn06r_regime_on,
   exists (select 1 from lk where lk.ticker = l.ticker and lk.date = l.date) and not (l.date >= date '{SECOND}' and {BAD}) tn06r_signal,
   'open' status from lg0 l),
st as (select lg.* exclude (status), case when o."real" is null then 'open' when not o.buyable then 'unfilled_ceiling' else 'settled' end status, o."real", o.net, o.y_bin,
   case when o."real" is not null then (select max(date) from panel) end settled_on from lg left join oc o on o.ticker = lg.ticker and o.date = lg.data_date)"""


@query("V01_record", LOG + "\n" + report("lg", "data_date ticker source model_version regime value_top30 tn07_pick tn06r_regime_on tn06r_signal status",
                                         "close p_up_5 p_lr value_score trend_score rsi14 vol_ratio20", "rank_all"))
def record(ws):
    """Log after two batches; logged dates are not rewritten."""
    return recorded(ws).drop("real", "net", "y_bin", "settled_on", "industry")


@query("V02_masked_signals", LOG + f"\nselect data_date, ticker, source from lg where tn06r_signal")
def masked(ws):
    """Stored signals: quarantine masks after the cooldown."""
    return recorded(ws).where("tn06r_signal").select("data_date", "ticker", "source")


@query("V03_backfill_dates", LOG + f"""
select distinct date from scored where date >= date '{START}' and date < (select max(date) from scored) and date not in (select data_date from lg where data_date < date '{SECOND}')""")
def backfill_dates(ws):
    """Dates of the test period the log does not hold yet."""
    log = recorded(ws).where(F.col("data_date") < F.lit(SECOND).cast("date"))
    return op.backfill_dates(ws.scored(*LOGGED), log, START)


@query("V04_fill_descriptive", LOG + "\n" + report("lg", "data_date ticker industry regime", "value_score trend_score"))
def fill_descriptive(ws):
    """Descriptive columns restored on rows that lost them."""
    lost = F.col("data_date") < F.lit("2001-06-01").cast("date")
    log = recorded(ws)
    holed = log.withColumns({c: F.when(~lost, F.col(c)) for c in op.DESC})
    return op.fill_descriptive(holed, ws.scored(*LOGGED)).select("data_date", "ticker", "industry", "regime", "value_score", "trend_score")


@query("V05_settle", LOG + "\n" + report("st", "data_date ticker status settled_on", '"real" net y_bin'))
def settle(ws):
    """Outcomes filled in."""
    return settled(ws).select("data_date", "ticker", "status", "settled_on", "real", "net", "y_bin")


SIG = chain("oc") + f""",
sx as (select *, case when value_top30 then rank() over (partition by date, value_top30 order by p_up_5 desc) end rank_pool from scored where date >= date '{START}'),""" \
    + topk("sx", "p_up_5", "sel") + """,
un as (select date, avg(fwd_ret_5) u from oc group by 1),
sg as (select s.date data_date, s.ticker, rank_pool, s.p_up_5, s.regime, case when s.regime = 'Downtrend' then 'watch' else 'consider' end as action,
   case when o."real" is null then 'open' when not o.buyable then 'unfilled_ceiling' else 'settled' end status,
   case when o.buyable then o."real" end gross, case when o.buyable then o.net end net, case when o.buyable then o.y_bin end y_bin,
   case when o.buyable then u end univ_mean, case when o.buyable then o.net - u end excess
   from sel s left join oc o on o.ticker = s.ticker and o.date = s.date left join un on un.date = s.date)"""


@query("V06_append_signals", SIG + f"""\n""" + report(f"""(select data_date, ticker, status, rank_pool, net from sg where data_date <> date '{DAY}'
   union all select date, ticker, 'open', null, null from (select *, row_number() over (partition by coalesce(industry, ticker) order by p_lr desc, ticker) ri
     from scored where date = date '{DAY}' and value_top30) where ri <= 3 qualify row_number() over (order by p_lr desc, ticker) <= 10)""",
                                                       "data_date ticker status", "net", "rank_pool"))
def append_signals(ws):
    """Re-run of one date: its rows are replaced."""
    day = ws.scored(*LOGGED).where(F.col("date") == F.lit(DAY).cast("date"))
    sel = selection.capped_topk(day, "p_lr", ws.cfg).select("ticker", F.lit(None).cast("long").alias("rank_pool"), "p_up_5", "value_score", "trend_score", "regime",
                                                           F.lit("watch").alias("action"), F.lit("").alias("reasons"), F.lit(None).cast("date").alias("entry_date_est"))
    return op.append_signals(signals(ws), sel, DAY, False, ws.cfg).select("data_date", "ticker", "status", "rank_pool", "net")


@query("V07_settle_signals", SIG + "\n" + report("sg", "data_date ticker status action", "gross net y_bin univ_mean excess"))
def settle_signals(ws):
    """Settled signals with excess over the universe."""
    return signals(ws).select("data_date", "ticker", "status", "action", *op.SIGNAL_OUTCOME)


@query("V08_signal_summary", SIG + """,
sm as (select coalesce(action, 'all') as action, count(*) n, count(distinct data_date) as days, avg(y_bin) hit, avg(net) net, avg(excess) excess,
   case when grouping(action) = 1 then (select count(*) from sg where status = 'open') end n_open from sg where status = 'settled' group by grouping sets ((action), ()))\n"""
       + report("sm", '"action"', "hit net excess", "n days n_open"))
def signal_summary(ws):
    """Totals and per action."""
    return op.signal_summary(signals(ws))


EVAL = f"""
le0 as (select *, case when status = 'settled' then p_up_5 end p, case when status = 'settled' then "real" end x from st where status in ('settled', 'unfilled_ceiling')),
le1 as (select *, {pct('p', by='data_date')} q, {pct('x', by='data_date')} rx, status = 'settled' f from le0),
le as (select data_date, min(source) source, count(*) filter (f) n, case when count(*) filter (f) > 5 then corr(q, rx) end ic, avg(net) filter (f) market_net,
   avg(net) filter (f and value_top30) pool_net, count(*) filter (f and tn07_pick) tn07_n, avg(net) filter (f and tn07_pick) tn07_net,
   avg(y_bin) filter (f and tn07_pick) tn07_hit, avg(y_bin) filter (f and value_top30) pool_hit, avg(p_up_5) filter (f and tn07_pick) pred_mean,
   avg(net) filter (f and q > 0.9) top_decile_net, avg(net) filter (f and q <= 0.1) bottom_decile_net, bool_or(tn06r_regime_on) tn06r_regime_on,
   count(*) filter (f and tn06r_signal) tn06r_n, avg(net) filter (f and tn06r_signal) tn06r_net from le1 group by 1)"""
EVF = "ic market_net pool_net tn07_net tn07_hit pool_hit pred_mean top_decile_net bottom_decile_net tn06r_net"


@_stored
def evaluations(ws: Workspace):
    return materialise(op.evaluate(settled(ws), ws.cfg), "evaluations")


@query("V09_live_evaluation", LOG + "," + EVAL + "\n" + report("le", "data_date source tn06r_regime_on", EVF, "n tn07_n tn06r_n"))
def live_evaluation(ws):
    """Daily scores of the settled log."""
    return op.evaluate(settled(ws), ws.cfg).drop("model_version")


@query("V10_live_summary", LOG + "," + EVAL + """,
ls0 as (select 'all' scope, * from le union all select 'live', * from le where source = 'live'),
ls as (select scope, count(*) as days, avg(ic) ic_mean, avg(coalesce(ic > 1e-12, false)::int::double) ic_pos_days, avg(tn07_net) tn07_net, avg(tn07_net-market_net) tn07_vs_market,
   avg(tn07_net-pool_net) tn07_vs_random, avg(tn07_hit) filter (tn07_net is not null) tn07_hit, avg(pred_mean) filter (tn07_net is not null) tn07_pred_mean,
   coalesce(sum(tn06r_n) filter (tn06r_n > 0), 0) tn06r_trades, sum(tn06r_n*tn06r_net) filter (tn06r_n > 0)/sum(tn06r_n) filter (tn06r_n > 0) tn06r_net,
   sum(tn06r_n*(tn06r_net-market_net)) filter (tn06r_n > 0)/sum(tn06r_n) filter (tn06r_n > 0) tn06r_vs_market from ls0 group by 1)\n"""
       + report("ls", "scope", "ic_mean ic_pos_days tn07_net tn07_vs_market tn07_vs_random tn07_hit tn07_pred_mean tn06r_net tn06r_vs_market", "days tn06r_trades"))
def live_summary(ws):
    """Live and overall means."""
    return op.live_summary(evaluations(ws))


@query("V11_track_record", SIG + """,
tr as (select coalesce(action, 'all') as action, count(*) n_settled, count(distinct data_date) n_days, avg(y_bin) hit_rate, avg(net) avg_net, avg(excess) avg_excess,
   stddev_samp(net) sd_net from sg where status = 'settled' group by grouping sets ((action), ()))\n"""
       + report("tr", '"action"', "hit_rate avg_net avg_excess sd_net", "n_settled n_days"))
def track_record(ws):
    """Per action with grand total."""
    return op.track_record(signals(ws))


@query("V12_track_daily", SIG + """,
td as (select data_date, count(*) n, avg(net) avg_net, avg(excess) avg_excess, avg(y_bin) hit from sg where status = 'settled' group by 1)\n"""
       + report("td", "data_date", "avg_net avg_excess hit", "n"))
def track_daily(ws):
    """Settled signals per date."""
    return op.track_daily(signals(ws))


def _mixed(ws):
    """Settled log whose rows before 2001-07-01 were settled on DAY."""
    early = (F.col("data_date") < F.lit("2001-07-01").cast("date")) & F.col("settled_on").isNotNull()
    return settled(ws).withColumn("settled_on", F.when(early, F.lit(DAY).cast("date")).otherwise(F.col("settled_on")))


@query("V13_rollback_bars", chain("panel") + f"\nselect date, count(*) n from panel where date <> date '{DAY}' group by 1")
def rollback_bars(ws):
    """Bars left per date."""
    return op.rollback_bars(ws.panel(), DAY).groupBy("date").agg(F.count(F.lit(1)).alias("n"))


@query("V13_rollback_log", LOG + f""",
rb as (select data_date, ticker, settled_on is not null and data_date < date '2001-07-01' re, status, "real", settled_on from st where data_date <> date '{DAY}'),
rc as (select data_date, ticker, case when re then 'open' else status end status, case when not re then "real" end as "real", case when not re then settled_on end settled_on from rb)\n"""
       + report("rc", "data_date ticker status settled_on", '"real"'))
def rollback_log(ws):
    """Log after the rollback."""
    return op.rollback_log(_mixed(ws), DAY).select("data_date", "ticker", "status", "settled_on", "real")


@query("V13_rollback_signals", SIG + f""",
p6 as (select distinct date from panel where date < date '{DAY}' order by 1 desc limit 6),
rb as (select *, data_date in (select date from p6) and status in ('settled','unfilled_ceiling') re from sg where data_date <> date '{DAY}'),
rc as (select data_date, ticker, case when re then 'open' else status end status, case when not re then net end net, case when not re then excess end excess from rb)\n"""
       + report("rc", "data_date ticker status", "net excess"))
def rollback_signals(ws):
    """Signal log after the rollback."""
    return op.rollback_signals(signals(ws), ws.panel(), DAY).select("data_date", "ticker", "status", "net", "excess")


@query("V13_rollback_evaluations", LOG + "," + EVAL + f"\nselect data_date from le where data_date <> date '{DAY}' and data_date >= date '2001-07-01'")
def rollback_evaluations(ws):
    """Evaluations left after the rollback."""
    return op.rollback_evaluations(evaluations(ws), _mixed(ws), DAY).select("data_date")
