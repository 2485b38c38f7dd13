"""Streaming jobs replayed from files; each equals its batch twin."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tidemark.operators import universe
from tidemark.plans.catalogue import events as ev
from tidemark.plans.catalogue.events import COND, cool_sql
from tidemark.plans.catalogue.registry import ORACLES, query, report
from tidemark.plans.catalogue.sqltext import chain
from tidemark.session import materialise, shared_dir
from tidemark.streaming import jobs

BAR = ["ticker", "date", "open", "high", "low", "close", "volume", "turnover"]


def _root(ws) -> str:
    return f"{shared_dir(ws.spark)}/{ws.spark.sparkContext.applicationId}/stream-{uuid.uuid4().hex[:12]}"


def _drop_files(df, path: str, cuts: list[str]):
    """One file per date range, written in order."""
    lo = None
    for hi in [*cuts, None]:
        d = df
        if lo:
            d = d.where(F.col("date") > F.lit(lo).cast("date"))
        if hi:
            d = d.where(F.col("date") <= F.lit(hi).cast("date"))
        d.repartition(1).write.mode("append").parquet(path)     # one file is one delivery
        lo = hi


@query("W01_inbox_stream", chain("sym") + "\n" + report("sym", "ticker date", "open high low close volume turnover"))
def inbox(ws):
    """Panel grown from dropped files equals the panel loaded at once."""
    r = _root(ws)
    d = ws.symbols().select(*BAR)
    jobs.write_panel(d.where("date <= date '2001-06-01'"), f"{r}/panel")
    new = d.where("date > date '2001-06-01'")
    _drop_files(new, f"{r}/inbox", ["2001-08-01"])
    jobs.ingest_stream(ws.spark, f"{r}/inbox", f"{r}/panel", f"{r}/ck", ws.cfg).awaitTermination()
    return jobs.read_panel(ws.spark, f"{r}/panel").drop("month")


@query("W02_session_bars", """with e as (select event_type ticker, date_trunc('day', ts) d, ts, value, event_id from events),
w as (select max(ts) - interval 5 day m from events),
u as (select ticker, cast(d as date) date, min_by(value, (ts, event_id)) as open, max(value) high, min(value) low, max_by(value, (ts, event_id)) as close, sum(value) volume, count(*) n_ticks from e group by 1, 2, d
   having d + interval 1 day <= (select m from w))\n""" + report("u", "ticker date", "open high low close volume", "n_ticks"))
def session_bars(ws):
    """Daily bars from ticks, written only once the session is behind the watermark."""
    r = _root(ws)
    src = ws.table("events").select("event_id", F.col("event_type").alias("ticker"), F.col("ts").cast("timestamp").alias("ts"), F.col("value").alias("price"), F.col("value").alias("qty"))
    src.repartitionByRange(4, "ts").write.parquet(f"{r}/in")
    t = ws.spark.readStream.schema(src.schema).parquet(f"{r}/in")
    jobs.session_stream(t, f"{r}/bars", f"{r}/ck").awaitTermination()
    return ws.spark.read.parquet(f"{r}/bars")


W02_SQL = ORACLES["W02_session_bars"]


@query("W02_corrected_bars", W02_SQL[:W02_SQL.rindex("\nselect")] + """,
lo as (select ticker, max(date) last from u group by 1),
c0 as (select ticker, date, open, high, low, close*1.01e0 as close, volume, n_ticks + 1 n_ticks from u
   union all select ticker, last + 1, 1e0, 2e0, 0.5e0, 1.5e0, 10e0, 3 from lo),
c as (select * from (select *, dense_rank() over (partition by ticker order by date desc) k from c0) where k <= 5),
v as (select * exclude (k) from c union all select u.* from u anti join c using (ticker, date))""" + "\n" + report("v", "ticker date", "open high low close volume", "n_ticks"))
def corrected_bars(ws):
    """Session bars after a later delivery: of a correction to all sessions and one newer one, only the newest five count."""
    bars = materialise(session_bars(ws), "bars")
    again = bars.withColumns({"close": F.col("close") * 1.01, "n_ticks": F.col("n_ticks") + 1})
    newer = bars.groupBy("ticker").agg(F.date_add(F.max("date"), 1).alias("date")).select(
        "ticker", "date", *[F.lit(v).alias(c) for c, v in (("open", 1.0), ("high", 2.0), ("low", 0.5), ("close", 1.5), ("volume", 10.0))], F.lit(3).cast("long").alias("n_ticks"))
    return jobs.correct_sessions(bars, again.unionByName(newer))


SETTLED = chain("oc", "exch") + """,
l as (select sym.*, coalesce(case e.exch when 'HOSE' then 0.07e0 when 'HNX' then 0.10e0 else 0.15e0 end, 0.15e0) lim from sym left join exch e using (ticker)),
x as (select *, lead(open) over w o1, lead(close,4) over w c4, lead(close,5) over w c5, lead(close,6) over w c6, lead(date,5) over w d5, lead(date,6) over w d6 from l window w as (partition by ticker order by date)),
y as (select ticker, date data_date, case when c5/c4-1 <= -(lim-0.005e0) then c6/o1-1 else c5/o1-1 end as "real", case when c5/c4-1 <= -(lim-0.005e0) then d6 else d5 end settled_on,
   case when o1/close-1 >= lim-0.005e0 then 'unfilled_ceiling' else 'settled' end status from x where c5 is not null)
"""


@query("W03_settlement_stream", SETTLED + report("(select * from y where \"real\" is not null)", "ticker data_date settled_on status", '"real"'))
def settlement(ws):
    """Every bar as a prediction, settled from keyed state."""
    r = _root(ws)
    d = universe.add_exchange(ws.symbols(), ws.exchanges()).select("ticker", "date", "open", "close", "limit", F.lit(True).alias("signal"))
    _drop_files(d, f"{r}/in", ["1998-03-01", "2000-07-01"])
    t = ws.spark.readStream.schema(d.schema).option("maxFilesPerTrigger", 1).parquet(f"{r}/in")
    jobs.run_to_table(jobs.settle_stream(t, ws.cfg), f"{r}/out", f"{r}/ck", ("late",)).awaitTermination()
    return jobs.read_output(ws.spark, f"{r}/out", jobs.SETTLE_OUT).select("ticker", "data_date", "settled_on", "status", "real")


@query("W04_cooldown_stream", chain("oc", "cal") + "," + COND + ", cr as (select * from co where cond_rsi)," + cool_sql("cr", "ticker", "ev") + "\nselect ticker, date, cast(di as bigint) di from ev")
def cooldown(ws):
    """Kept events from keyed state."""
    r = _root(ws)
    d = ev.flags(ws, ev.EVENTS).where("cond_rsi").select("ticker", "date", "di")
    _drop_files(d, f"{r}/in", ["1999-06-01", "2000-06-01"])
    t = ws.spark.readStream.schema(d.schema).option("maxFilesPerTrigger", 1).parquet(f"{r}/in")
    jobs.run_to_table(jobs.cooldown_stream(t, ws.cfg), f"{r}/out", f"{r}/ck", ("late",)).awaitTermination()
    return jobs.read_output(ws.spark, f"{r}/out", jobs.COOL_OUT)


@query("W05_redelivery", chain("sym") + "\n" + report("sym", "ticker date", "close volume"))
def redelivery(ws):
    """The same file dropped twice adds nothing."""
    r = _root(ws)
    d = ws.symbols().select(*BAR, F.col("date").cast("timestamp").alias("ts"))
    for _ in range(2):
        d.repartition(1).write.mode("append").parquet(f"{r}/in")
    t = ws.spark.readStream.schema(d.schema).option("maxFilesPerTrigger", 1).parquet(f"{r}/in")
    jobs.run_to_table(jobs.first_delivery(t, late="4000 days"), f"{r}/out", f"{r}/ck").awaitTermination()
    return ws.spark.read.parquet(f"{r}/out").select("ticker", "date", "close", "volume")
