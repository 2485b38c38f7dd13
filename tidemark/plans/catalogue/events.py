"""Event study."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import events as op
from tidemark.operators import labels
from tidemark.plans.catalogue.backtest import boot_sql
from tidemark.plans.catalogue.labels import LEVELS
from tidemark.plans.catalogue.registry import query, report
from tidemark.plans.catalogue.sqltext import chain
from tidemark.session import materialise

R = 200
B = 2000
IS_END = "2000-01-01"
# Outcome columns that the cooldown and the take-profit events read.
EVENTS = ("ticker", "date", "rsi14", "vol_ratio20", "real", "net", "buyable")
STUDY = (*EVENTS, "y_bin")

COND = """
co0 as (select oc.*, di, coalesce(vni_dist_ema50 < 0, false) regime_on from oc join cal using (date)),
co as (select *, coalesce(rsi14 < 42, false) cond_rsi, coalesce(rsi14 < 42 and lag(rsi14,1) over w < 42 and lag(di,1) over w = di-1
   and lag(rsi14,2) over w < 42 and lag(di,2) over w = di-2 and vol_ratio20 >= 1.05e0, false) cond_cap from co0
   window w as (partition by ticker order by date))"""


def cool_sql(src: str, key: str, out: str) -> str:
    """Greedy cooldown of src(key.., di) by recursion over each key's ordered sessions."""
    k = key.split(",")
    on = " and ".join(f"c.{x.strip()} = s.{x.strip()}" for x in k)
    ck = ", ".join(f"c.{x.strip()}" for x in k)
    return f"""
{out}_s as (select {key}, di, row_number() over (partition by {key} order by di) i from (select distinct {key}, di from {src})),
{out}_c({key}, i, di, last, keep) as (
   select {key}, i, di, di, true from {out}_s where i = 1
   union all
   select {ck}, s.i, s.di, case when s.di - c.last > 5 then s.di else c.last end, s.di - c.last > 5
   from {out}_c c join {out}_s s on {on} and s.i = c.i + 1),
{out} as (select x.* from {src} x join {out}_c c using ({key}, di) where c.keep)"""


SETS = """
sy as (select 'capitulation' system, * from co where cond_cap and buyable and regime_on
   union all select 'rsi_only', * from co where cond_rsi and buyable and regime_on
   union all select 'no_regime', * from co where cond_cap and buyable)"""

EV = chain("oc", "cal") + "," + COND + "," + SETS + "," + cool_sql("sy", "system, ticker", "ev")


def flags(ws, cols=()):
    return op.add_conditions(ws.outcomes(*cols), ws.calendar(), op.market_switch(ws.index(), ws.cfg), ws.cfg)


def events(ws, cols=()):
    return op.event_sets(flags(ws, cols), ws.cfg)


@query("E01_market_switch", chain("xfeat") + "\nselect date, coalesce(vni_dist_ema50 < 0, false) regime_on from xfeat")
def market_switch(ws):
    """Index below its EMA50."""
    return op.market_switch(ws.index(), ws.cfg)


@query("E02_streak_condition", chain("oc", "cal") + "," + COND + "\nselect ticker, date, cond_rsi, cond_cap, regime_on from co")
def streak(ws):
    """Low RSI on three adjacent sessions with volume."""
    return flags(ws).select("ticker", "date", "cond_rsi", "cond_cap", "regime_on")


@query("E03_cooldown", chain("oc", "cal") + "," + COND + ", cr as (select * from co where cond_rsi)," + cool_sql("cr", "ticker", "ev")
       + "\nselect ticker, date, cast(di as bigint) di from ev")
def cooldown(ws):
    """Events more than five sessions after the last kept one."""
    return op.cooldown(flags(ws).where("cond_rsi").select("ticker", "date", "di"), ws.cfg).select("ticker", "date", "di")


@query("E04_event_sets", EV + "\nselect system, ticker, date from ev")
def event_sets(ws):
    """Buyable events of the three systems."""
    return events(ws).select("system", "ticker", "date")


BENCH = f"""
dy as (select system, date, count(*) n, avg(net) net from ev group by 1, 2),
mk as (select date, avg(net) market from oc where buyable group by 1),
nd as (select distinct date, n from dy),
po as (select date, ticker, net, row_number() over (partition by date order by ('0x' || substr(md5('ix|' || ticker), 1, 8))::bigint, ticker) pos from oc where buyable),
ps as (select date, max(pos) size from po group by 1),
rk0 as (select n, date, least(n, size)::bigint k, size, rep from nd join ps using (date), (select unnest(range({R})) rep)),
fy(n, date, rep, size, k, j, acc) as (
   select n, date, rep, size, k, size-k+1, []::bigint[] from rk0 where k > 0
   union all
   select f.n, f.date, f.rep, f.size, f.k, f.j+1, list_append(f.acc, case when list_contains(f.acc, t.t) then f.j else t.t end)
   from fy f, lateral (select ('0x' || substr(md5('7|event|' || f.n || '|' || f.date::varchar || '|' || f.rep || '|' || f.j), 1, 8))::bigint % f.j + 1 t) t where f.j <= f.size),
fd as (select n, date, rep, unnest(acc) pos from fy where j = size + 1),
rr as (select n, date, rep, avg(net) rn from fd join po using (date, pos) group by all),
rm as (select n, date, avg(rn) random from rr group by all),
be as (select dy.*, random, market, x.vni5 from dy left join rm using (n, date) left join mk using (date) left join xfeat x using (date))"""


def benches(ws, ev):
    return op.event_benchmarks(ws.outcomes(*STUDY), ev, labels.index_forward(ws.index(), ws.cfg), ws.cfg, R)


@query("E05_event_benchmarks", EV + "," + BENCH + "\n" + report("be", "system date", "net random market vni5", "n"))
def event_benchmarks(ws):
    """Random, market and index references per event day."""
    return benches(ws, materialise(events(ws, STUDY), "events")).select("system", "date", "net", "random", "market", "vni5", "n")


STATS = f"""
rs as (select 'ev:' || o || '|' || system g, date, n, case o when 'random' then net-random when 'market' then net-market else net-vni5 end x
   from be, (select unnest(['random','market','vni5']) o)),
rc as (select *, sum(n) over (partition by g order by date)::bigint upto from rs where x is not null),
rx as (select g, unnest(range(upto-n, upto)) idx, x from rc),""" + boot_sql("rx", "bs", B) + """,
s1 as (select system, count(*) n_trades, avg(net) net_per_trade, avg((net>0)::int::double) hit_net_pos, avg(y_bin) hit_ybin, median(net) median_net from ev group by 1),
s2 as (select system, count(*) n_days, sum(n*(net-random))/sum(n) filter (random is not null) vs_random, sum(n*(net-market))/sum(n) filter (market is not null) vs_market,
   sum(n*(net-vni5))/sum(n) filter (vni5 is not null) vs_vni5 from be group by 1),
ss as (select s1.*, s2.* exclude (system), r.lo vs_random_lo, r.hi vs_random_hi, m.lo vs_market_lo, m.hi vs_market_hi, v.lo vs_vni5_lo, v.hi vs_vni5_hi
   from s1 join s2 using (system) left join bs r on r.g = 'ev:random|' || system left join bs m on m.g = 'ev:market|' || system
   left join bs v on v.g = 'ev:vni5|' || system)"""
FIELDS = ("net_per_trade hit_net_pos hit_ybin median_net vs_random vs_market vs_vni5 vs_random_lo vs_random_hi vs_market_lo vs_market_hi vs_vni5_lo vs_vni5_hi")


def stats(ws):
    ev = materialise(events(ws, STUDY), "events")
    return op.event_stats(ev, materialise(benches(ws, ev), "benches"), ws.cfg.but(boot=B))


@query("E06_event_stats", EV + "," + BENCH + "," + STATS + "\n" + report("ss", "system", FIELDS, "n_trades n_days"))
def event_stats(ws):
    """Trade statistics and weighted edges with intervals."""
    return stats(ws)


TIME = """
td as (select date, avg(net) net, bool_or(regime_on) as "on" from co where buyable group by 1),
ts as (select 'timing' g, row_number() over (order by date) - 1 idx, net x from td where "on"),""" + boot_sql("ts", "tb", B) + """,
tt as (select count(*) filter ("on") days_on, avg(net) filter ("on") net_on, avg(net) net_all, avg(net) filter (not "on") net_off,
   (select lo from tb) lo, (select hi from tb) hi from td)"""


@query("E07_timing", chain("oc", "cal") + "," + COND + "," + TIME + "\n" + report("tt", "", "net_on net_all net_off lo hi", "days_on"))
def timing(ws):
    """Equal-weight market on, off and all days."""
    return op.timing(flags(ws), ws.cfg.but(boot=B))


VERDICT = """
v1 as (select max(n_trades) filter (system='capitulation') n, max(vs_market) filter (system='capitulation') vm, max(vs_market_lo) filter (system='capitulation') lo,
   max(vs_random) filter (system='capitulation') vr, max(vs_market) filter (system='rsi_only') other from ss),
v2 as (select coalesce(n >= 30, false) enough_trades, coalesce(vm > 0 and lo > 0, false) beats_market, coalesce(vr > 0, false) beats_random,
   coalesce(vm > other, false) beats_rsi_only from v1)"""


@query("E08_pick_verdict", EV + "," + BENCH + "," + STATS + "," + VERDICT + """
select *, case when enough_trades and beats_market and beats_random and beats_rsi_only then 'GO' when not enough_trades then 'NOT ENOUGH EVIDENCE' else 'NO-GO' end verdict from v2""")
def pick_verdict(ws):
    """Verdict on picking."""
    return op.pick_verdict(stats(ws), ws.cfg)


@query("E08_timing_verdict", chain("oc", "cal") + "," + COND + "," + TIME + """,
v2 as (select coalesce(days_on >= 20, false) enough_days, coalesce(net_on > 0 and lo > 0, false) on_days_profitable, coalesce(net_on > net_all, false) beats_all_days from tt)
select *, case when enough_days and on_days_profitable and beats_all_days then 'GO' when not enough_days then 'NOT ENOUGH EVIDENCE' else 'NO-GO' end verdict from v2""")
def timing_verdict(ws):
    """Verdict on timing."""
    return op.timing_verdict(op.timing(flags(ws), ws.cfg.but(boot=B)))


def tp_rows(ws, cols=EVENTS):
    """Base rule (tp 0) and every level for the capitulation events."""
    parts = flags(ws, cols).withColumn("period", op.period_of(IS_END))       # the period is chosen first, then the cooldown runs
    ev = op.event_sets(parts, ws.cfg, within=("period",)).where("system = 'capitulation'").select("ticker", "date", "di", "real", "net")
    tp = labels.take_profit(ev, ws.panel(), ws.calendar(), LEVELS, ws.cfg).select("ticker", "date", "tp", "net", "held", "tp_hit")
    base = ev.select("ticker", "date", F.lit(0.0).alias("tp"), "net", F.lit(ws.cfg.horizon).alias("held"), F.lit(False).alias("tp_hit"))
    return tp.unionByName(base)


def tp_stats(ws):
    market = ws.outcomes(*EVENTS).where("buyable").groupBy("date").agg(F.avg("net").alias("market"))
    return op.take_profit_stats(tp_rows(ws), market, IS_END)


TPS = chain("oc", "cal") + "," + COND + "," + SETS + """,
syp as (select case when date < date '2000-01-01' then 'IS' else 'OOS' end period, * from sy),""" + cool_sql("syp", "period, system, ticker", "ev") + """,
e9 as (select ticker, date, di, "real", net from ev where system = 'capitulation'),
px as (select ticker, di, open, high from panel join cal using (date)),
tpj as (select e.*, p1.open entry, p3.open o3, p3.high h3, p4.open o4, p4.high h4, p5.open o5, p5.high h5, t.tp,
   p1.open*(1+t.tp) target from e9 e cross join (select unnest([0.02e0, 0.03e0, 0.05e0, 0.08e0]) tp) t
   left join px p1 on p1.ticker = e.ticker and p1.di = e.di+1 left join px p3 on p3.ticker = e.ticker and p3.di = e.di+3
   left join px p4 on p4.ticker = e.ticker and p4.di = e.di+4 left join px p5 on p5.ticker = e.ticker and p5.di = e.di+5),
tpg as (select ticker, date, tp, case when o3 >= target then o3/entry-1 when h3 >= target then tp when o4 >= target then o4/entry-1
   when h4 >= target then tp when o5 >= target then o5/entry-1 when h5 >= target then tp else "real" end gross,
   case when o3 >= target or h3 >= target then 3 when o4 >= target or h4 >= target then 4 else 5 end held,
   coalesce(o3 >= target, false) or coalesce(h3 >= target, false) or coalesce(o4 >= target, false) or coalesce(h4 >= target, false)
   or coalesce(o5 >= target, false) or coalesce(h5 >= target, false) tp_hit from tpj),
tpa as (select ticker, date, tp, (1-0.0015e0)*(1+gross)*(1-0.0015e0-0.001e0)-1 net, held, tp_hit from tpg
   union all select ticker, date, 0e0, net, 5, false from e9),
mk as (select date, avg(net) market from oc where buyable group by 1),
tps as (select case when date < date '2000-01-01' then 'IS' else 'OOS' end period, tp, count(*) n_trades, avg(net) net_per_trade, avg(net-market) vs_market,
   avg(tp_hit::int::double) tp_hit_rate, avg(held) avg_held from tpa left join mk using (date) group by 1, 2)"""


@query("E09_take_profit_grid", TPS + "\n" + report("tps", "period", "tp net_per_trade vs_market tp_hit_rate avg_held", "n_trades"))
def take_profit_grid(ws):
    """Statistics per period and take-profit level."""
    return tp_stats(ws)


def tp_full_stats(ws):
    """Every statistic of E06 per period and level, with hit rate and mean sessions held."""
    by = ("period", "tp")
    ev = materialise(tp_rows(ws, STUDY).withColumn("period", op.period_of(IS_END)).join(ws.outcomes(*STUDY).select("ticker", "date", "y_bin"), ["ticker", "date"], "left"), "tp_events")
    b = op.event_benchmarks(ws.outcomes(*STUDY), ev, labels.index_forward(ws.index(), ws.cfg), ws.cfg, R, by)
    held = ev.groupBy(*by).agg(F.avg(F.col("tp_hit").cast("double")).alias("tp_hit_rate"), F.avg("held").alias("avg_held"))
    return op.event_stats(ev, materialise(b, "tp_benches"), ws.cfg.but(boot=B), by).join(held, list(by))


TPF = TPS.replace("select date, avg(net) market from oc", "select date, avg(net) market_tp from oc").replace("\nmk as (", "\nmk0 as (").replace("left join mk using", "left join mk0 using").replace(
    "avg(net-market) vs_market", "avg(net-market_tp) vs_market") + """,
ev9 as (select case when tpa.date < date '2000-01-01' then 'IS' else 'OOS' end || '|' || tpa.tp::varchar system, tpa.*, oc.y_bin from tpa left join oc using (ticker, date)),""" + (
    BENCH + "," + STATS).replace("from ev group", "from ev9 group") + """,
sf as (select tps.period, tps.tp, tps.tp_hit_rate, tps.avg_held, ss.* from tps join ss on ss.system = tps.period || '|' || tps.tp::varchar)"""


@query("E09_take_profit_stats", TPF + "\n" + report("sf", "period", "tp tp_hit_rate avg_held " + FIELDS, "n_trades n_days"))
def take_profit_full(ws):
    """All statistics of E06 per period and take-profit level."""
    return tp_full_stats(ws)


@query("E09_take_profit_choice", TPS + """,
bi as (select * from tps where period = 'IS' and tp > 0 order by net_per_trade desc, tp desc limit 1),
cc as (select case when (select net_per_trade from bi) > (select net_per_trade from tps where period = 'IS' and tp = 0) then (select tp from bi) end choice),
r as (select choice, coalesce(n_trades >= 30, false) enough_trades, coalesce(net_per_trade > (select net_per_trade from tps where period = 'OOS' and tp = 0), false) beats_base,
   coalesce(vs_market > 0, false) beats_market from cc left join (select * from tps where period = 'OOS') o on o.tp = choice)
select *, case when choice is null then 'KEEP BASE' when enough_trades and beats_base and beats_market then 'GO' else 'NO-GO' end verdict from r""")
def take_profit_choice(ws):
    """Level chosen in sample, judged out of sample."""
    return op.choose_take_profit(materialise(tp_stats(ws), "tp_stats"))


@query("E10_buy_and_hold", chain("scored") + """,
sp as (select * from scored where date between date '1999-06-05' and date '2001-02-10'),
b as (select min(date) a, max(date) b from sp),
h as (select (select close from idx, b where date <= b.b order by date desc limit 1) / (select close from idx, b where date <= b.a order by date desc limit 1) - 1 index_hold,
   (select exp(sum(ln(1+r)))-1 from (select avg(ret1) r from sp group by date)) universe_hold)\n""" + report("h", "", "index_hold universe_hold"))
def buy_and_hold(ws):
    """Index and equal-weight universe over a period."""
    return op.buy_and_hold(ws.scored(), ws.index(), "1999-06-05", "2001-02-10")
