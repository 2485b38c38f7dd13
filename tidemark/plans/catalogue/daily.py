"""The whole daily run on the generated panel."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.draws import draw32
from tidemark.operators import livelog
from tidemark.plans.catalogue.registry import query
from tidemark.plans.catalogue.selection import topk
from tidemark.plans.catalogue.sqltext import chain
from tidemark.plans.daily import DailyState, run_daily
from tidemark.plans.workspace import Workspace, _stored

BAR = ["ticker", "date", "open", "high", "low", "close", "volume", "turnover"]
SPLIT = "2001-09-03"
SIGNALS = ("data_date date, ticker string, rank_pool bigint, p_up_5 double, value_score double, trend_score double, regime string, action string, reasons string, "
           "gate_pass boolean, model_version string, status string, entry_date_est date, gross double, net double, y_bin double, univ_mean double, excess double")


def hash_score(e):
    day = F.date_format("date", "yyyy-MM-dd")
    return e.withColumns({n: draw32(n, F.col("ticker"), day) / F.lit(4294967296.0) for n in ("p_up_5", "p_lr")})


@_stored
def ran(ws: Workspace):
    """Base panel up to SPLIT, the rest delivered as one mixed batch with the index rows."""
    cut = F.lit(SPLIT).cast("date")
    all_bars = ws.panel().select(*BAR)
    spark = ws.spark
    state = DailyState(all_bars.where(F.col("date") <= cut), ws.index().where(F.col("date") <= cut), ws.industry(), livelog.empty_log(spark),
                       spark.createDataFrame([], SIGNALS), spark.createDataFrame([], "ticker string"))
    idx = ws.index().withColumn("turnover", F.lit(None).cast("double")).select(*BAR)
    batch = all_bars.unionByName(idx).where(F.col("date") > cut)
    return run_daily(state, hash_score, ws.cfg, "2001-11-12 10:00:00", batch)


@query("daily_run_log", chain("oc") + ",\nlg as (select * from scored where date >= date '2001-04-01')," + topk("lg", "p_up_5", "sel") + """
select l.date data_date, case when l.date = (select max(date) from scored) then 'live' else 'backfill' end source, count(*) n, count(s.ticker) n_picked, count(o.ticker) n_known
from lg l left join sel s on s.ticker = l.ticker and s.date = l.date left join oc o on o.ticker = l.ticker and o.date = l.date group by all""")
def daily_run_log(ws):
    """Prediction log after a full daily run: rows, picks and settled rows per date."""
    log = ran(ws)[0].log
    return log.groupBy("data_date", "source").agg(F.count(F.lit(1)).alias("n"), F.count_if("tn07_pick").alias("n_picked"), F.count("real").alias("n_known"))


@query("daily_run_report", chain("scored") + ",\nlg as (select * from scored where date = (select max(date) from scored))," + topk("lg", "p_up_5", "sel") + """
select ticker, rank_sel, round(p_up_5, 6) p_up_5, regime from sel""")
def daily_run_report(ws):
    """Report table of the last date."""
    return ran(ws)[1]["report"].select("ticker", "rank_sel", "p_up_5", "regime")
