"""Backtest statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import backtest as op
from tidemark.plans.catalogue.registry import query, report
from tidemark.plans.catalogue.selection import SOFT, topk
from tidemark.plans.catalogue.sqltext import chain, pct

OC = chain("oc")
B = 2000          # bootstrap repeats of these queries
R = 200           # random repeats of these queries
# Outcome columns that these queries read (scores and labels; baskets; strategies).
SCORES = ("ticker", "date", "p_up_5", "p_lr", "fwd_ret_5", "y_bin")
BASKETS = (*SCORES, "ret20", "industry", "value_top30", "vni_dist_ema50", "real", "net", "buyable")
RULES = (*BASKETS, "value_score", "trend_score")

BASKET = """
bk0 as (select date, count(*) filter (buyable) n, count(*) filter (not buyable) n_skip_ceiling, avg("real") filter (buyable) gross,
   avg(net) filter (buyable) net, avg(y_bin) filter (buyable) hit from sel group by 1),
bk1 as (select date, avg(fwd_ret_5) univ, avg(net) market_net, avg(y_bin) base_univ, avg(fwd_ret_5) filter (value_top30) pool_mean,
   avg(y_bin) filter (value_top30) base_pool from oc group by 1),
bk as (select *, net - univ excess, net - pool_mean excess_pool from bk0 join bk1 using (date))"""


def basket_sql(score: str) -> str:
    return OC + "," + topk("oc", score, "sel") + "," + BASKET


def ic_sql(score: str, where: str = "true", name: str = "ic", src: str = "oc") -> str:
    return f"""
{name}r as (select date, {pct(score)} a, {pct('fwd_ret_5')} b from {src} where {where}),
{name} as (select date, corr(a, b) ic, count(*) n from {name}r group by 1 having count(*) > 5)"""


def boot_sql(src: str, out: str, b: int = B) -> str:
    """Twin of the block bootstrap over src(g, idx, x)."""
    return f"""
{out}_n as (select g, count(*) n, avg(x) mean from {src} group by 1),
{out}_u as (select *, ceil(n/5e0)::bigint nb, n - (ceil(n/5e0)::bigint-1)*5 tail from {out}_n where n >= 10),
{out}_d as (select u.g, u.n, u.nb, u.tail, b, j, ('0x' || substr(md5('7|' || u.g || '|' || b || '|' || j), 1, 8))::bigint % (u.n - 4) start
   from {out}_u u, (select unnest(range({b})) b), lateral (select unnest(range(u.nb)) j)),
{out}_m as (select d.g, d.b, sum(s.x)/max(d.n) m from {out}_d d join {src} s on s.g = d.g and s.idx >= d.start
   and s.idx < d.start + case when d.j = d.nb - 1 then d.tail else 5 end group by 1, 2),
{out} as (select n.g, n.n, n.mean, c.lo, c.hi from {out}_n n left join
   (select g, quantile_cont(m, 0.025) lo, quantile_cont(m, 0.975) hi from {out}_m group by 1) c using (g))"""


@query("B01_daily_basket", basket_sql("ret20") + "\n" + report("(select * from bk where n > 0)", "date", "hit net univ base_pool", "n"))
def daily_basket(ws):
    """After-cost return of the capped top-K momentum basket per date."""
    return op.bought_days(op.daily_basket(ws.outcomes(*BASKETS), "ret20", ws.cfg)).select("date", "hit", "net", "univ", "base_pool", "n")


@query("B02_extended_basket", basket_sql("ret20") + "\n" + report("bk", "date", "gross net hit univ pool_mean base_univ base_pool excess excess_pool",
                                                                 "n n_skip_ceiling"))
def extended_basket(ws):
    """Basket with skipped names, pool and universe references."""
    return op.daily_basket(ws.outcomes(*BASKETS), "ret20", ws.cfg).drop("market_net")


@query("B03_period_summary", basket_sql("ret20") + "\n" + report("""(select count(*) n_days, min(date) "first", max(date) "last", avg(hit) hit_top10,
   avg(base_pool) base_pool, avg(hit)-avg(base_pool) lift, avg(net) net_top10, avg(univ) univ_mean, avg(excess) excess_ret_5 from bk where n > 0)""",
   '"first" "last"', "hit_top10 base_pool lift net_top10 univ_mean excess_ret_5", "n_days"))
def period_summary(ws):
    """Means over the dates and lift."""
    return op.summarise_basket(op.daily_basket(ws.outcomes(*BASKETS), "ret20", ws.cfg))


@query("B04_daily_ic", OC + "," + ic_sql("p_up_5") + "\n" + report("ic", "date", "ic", "n"))
def daily_ic(ws):
    """Rank correlation per date."""
    return op.daily_ic(ws.outcomes(*SCORES), "p_up_5", ws.cfg)


@query("B05_pool_ic", OC + "," + ic_sql("p_up_5", "value_top30") + "\n" + report("ic", "date", "ic", "n"))
def pool_ic(ws):
    """Rank correlation inside the value pool."""
    return op.daily_ic(ws.outcomes(*BASKETS).where("value_top30"), "p_up_5", ws.cfg)


CALIB = """
cb as (select case when p_up_5 > 0 and p_up_5 <= .2e0 then 1 when p_up_5 > .2e0 and p_up_5 <= .3e0 then 2 when p_up_5 > .3e0 and p_up_5 <= .4e0 then 3
   when p_up_5 > .4e0 and p_up_5 <= .5e0 then 4 when p_up_5 > .5e0 and p_up_5 <= .6e0 then 5 when p_up_5 > .6e0 and p_up_5 <= 1 then 6 end band, * from oc),
ca as (select band, avg(p_up_5) p, avg(y_bin) actual, count(*) n from cb where band is not null group by 1 having count(*) >= 30)"""


@query("B06_calibration", OC + "," + CALIB + "\n" + report("ca", "", "p actual", "band n"))
def calibration(ws):
    """Mean score and hit rate per band with at least 30 rows."""
    return op.calibration(ws.outcomes(*SCORES), "p_up_5", 30)


@query("B07_monotone", OC + "," + CALIB + """, mo as (select coalesce(actual > lag(actual) over (order by band), true) up from ca)
select count(*) >= 3 and bool_and(up) calib_monotone from mo""")
def monotone(ws):
    """Strictly rising hit rates over at least three bands."""
    return op.monotone(op.calibration(ws.outcomes(*SCORES), "p_up_5", 30))


DEC = """
dr as (select *, row_number() over (partition by date order by p_up_5, ticker) r, count(*) over (partition by date) m from oc),
de as (select date, greatest(0, (10*(r-1)+m-2)//(m-1)-1) decile, fwd_ret_5 from dr where m > 1)"""


@query("B08_deciles", OC + "," + DEC + """, dm as (select date, decile, avg(fwd_ret_5) mean_ret, count(*) n from de group by 1, 2)\n"""
       + report("dm", "date", "mean_ret", "decile n"))
def deciles(ws):
    """Mean forward return per score decile."""
    return op.decile_means(ws.outcomes(*SCORES), "p_up_5", ws.cfg)


@query("B08_decile_spread", OC + "," + DEC + """, dm as (select date, avg(fwd_ret_5) filter (decile = 9) - avg(fwd_ret_5) filter (decile = 0) spread
   from de group by 1)\n""" + report("(select * from dm where spread is not null)", "date", "spread"))
def decile_spread(ws):
    """Top minus bottom decile, with positions found by counted value ranges."""
    return op.decile_spread(ws.outcomes(*SCORES), "p_up_5", ws.cfg.but(names_bound=10**12))


SER = """
se as (select 'excess' g, row_number() over (order by date) - 1 idx, excess x from bk where n > 0 and excess is not null)"""


@query("B09_block_bootstrap", basket_sql("ret20") + "," + SER + "," + boot_sql("se", "bs") + "\n" + report("bs", "g", "mean lo hi", "n"))
def block_bootstrap(ws):
    """Moving-block 95 % interval of the mean daily excess."""
    b = op.bought_days(op.daily_basket(ws.outcomes(*BASKETS), "ret20", ws.cfg))
    return op.block_bootstrap(op.as_series(b, "excess", "excess"), ws.cfg.but(boot=B))


def _gate_sql() -> str:
    parts, series = [], []
    for nm, col in (("m", "p_up_5"), ("l", "p_lr")):
        parts.append(topk("te", col, f"sel{nm}") + f""",
bk{nm} as (select date, avg(net) net, avg(y_bin) hit from sel{nm} where buyable group by 1),
bb{nm} as (select * from bk{nm} join tu using (date))""" + "," + ic_sql(col, name=f"ic{nm}", src="te"))
    series = """
ser as (select 'lightgbm:excess' g, row_number() over (order by date) - 1 idx, net - univ x from bbm union all
        select 'lightgbm:ic', row_number() over (order by date) - 1, ic from icm)"""
    head = OC + """,
te as (select * from oc where date >= date '2001-04-01'),
tu as (select date, avg(fwd_ret_5) univ, avg(y_bin) filter (value_top30) base_pool from te group by 1)"""
    calib = CALIB.replace("from oc)", "from te)")
    return head + "," + ",".join(parts) + "," + series + "," + boot_sql("ser", "bs") + "," + calib + """,
mo as (select coalesce(actual > lag(actual) over (order by band), true) up from ca),
g as (select (select count(*) from bbm) n, (select avg(net - univ) from bbm) ex, (select avg(net-univ) from bbl) exl, (select avg(hit)-avg(base_pool) from bbm) lift,
   (select mean from bs where g like '%:ic') icm, (select lo from bs where g like '%:ic') iclo, (select count(*) >= 3 and bool_and(up) from mo) mono),
ck as (select unnest([{'ord': 1, 'name': 'enough_test_days', 'pass': coalesce(n >= 60, false)}, {'ord': 2, 'name': 'excess_positive', 'pass': coalesce(ex > 0, false)},
   {'ord': 3, 'name': 'ic_positive_ci_above_zero', 'pass': coalesce(icm > 0 and iclo > 0, false)}, {'ord': 4, 'name': 'lift_positive', 'pass': coalesce(lift > 0, false)},
   {'ord': 5, 'name': 'calibration_monotone', 'pass': coalesce(mono, false)}, {'ord': 6, 'name': 'beats_logistic', 'pass': coalesce(ex > exl, false)}]) c from g)
select c.ord::bigint ord, c.name as name, c.pass as pass, (select bool_and(c.pass) from ck) strategy_pass from ck"""


@query("B10_gate", _gate_sql())
def gate(ws):
    """Six ordered checks on the test period and their conjunction."""
    cfg = ws.cfg.but(boot=B)
    t = ws.outcomes(*BASKETS).where(F.col("date") >= F.lit(cfg.test_start).cast("date"))
    g = op.gate(op.strategy_report(t, "p_up_5", cfg, "lightgbm"), op.strategy_report(t, "p_lr", cfg, "logistic"), cfg)
    return g.select(F.posexplode("checks").alias("ord", "c"), "strategy_pass").select((F.col("ord") + 1).alias("ord"), "c.name", "c.pass", "strategy_pass")


RND = f"""
po as (select date, ticker, net, row_number() over (partition by date order by ('0x' || substr(md5('ix|' || ticker), 1, 8))::bigint, ticker) pos
   from oc where value_top30 and buyable),
ps as (select date, max(pos) size from po group by 1),
rk0 as (select b.date, least(b.n, s.size)::bigint k, s.size, rep from bk b join ps s using (date), (select unnest(range({R})) rep) where b.n > 0),
fl as (select date, rep, unnest(list_reduce(range(size-k+1, size+1), lambda acc, j: acc, []::bigint[])) pos from rk0 where false),
fy(date, rep, size, k, j, acc) as (
   select date, rep, size, k, size-k+1, []::bigint[] from rk0 where k > 0
   union all
   select f.date, f.rep, f.size, f.k, f.j+1, list_append(f.acc, case when list_contains(f.acc, t.t) then f.j else t.t end)
   from fy f, lateral (select ('0x' || substr(md5('7|rand|' || f.date::varchar || '|' || f.rep || '|' || f.j), 1, 8))::bigint % f.j + 1 t) t where f.j <= f.size),
fd as (select date, rep, unnest(acc) pos from fy where j = size + 1),
rr as (select date, rep, avg(net) rand_net from fd join po using (date, pos) group by 1, 2)"""
RND = RND.replace(RND[RND.index("fl as ("):RND.index("fy(date")], "")
RVS = """
rv as (select b.*, r.random, r.rand_pctile from bk b join (select date, avg(rand_net) random, avg((rand_net < net - 1e-12)::int::double) rand_pctile
   from rr join bk using (date) group by 1) r using (date) where b.n > 0)"""


def _rand(ws, cfg=None):
    cfg = cfg or ws.cfg
    b = op.daily_basket(ws.outcomes(*BASKETS), "ret20", cfg)
    return b, op.random_benchmark(ws.outcomes(*BASKETS), b, cfg, R)


@query("B11_random_benchmark", basket_sql("ret20") + "," + RND + "\n" + report("rr", "date", "rand_net", "rep"))
def random_benchmark(ws):
    """Mean net of k random pool names, repeated."""
    return _rand(ws)[1]


@query("B12_random_percentile", basket_sql("ret20") + "," + RND + "," + RVS + "\n" + report("rv", "date", "net random rand_pctile"))
def random_percentile(ws):
    """Share of random repeats below the basket."""
    return op.against_random(*_rand(ws)).select("date", "net", "random", "rand_pctile")


@query("B13_market_timed", basket_sql("ret20") + """, mt as (select b.date, coalesce(v > 0, false) mkt_up, case when v > 0 then net else 0 end net_timed
   from bk b left join (select date, max(vni_dist_ema50) v from oc group by 1) using (date) where n > 0)\n""" + report("mt", "date mkt_up", "net_timed"))
def market_timed(ws):
    """Basket return only while the index is above its EMA50."""
    b = op.bought_days(op.daily_basket(ws.outcomes(*BASKETS), "ret20", ws.cfg))
    return op.market_timed(b, ws.outcomes(*BASKETS)).select("date", "mkt_up", "net_timed")


VS = """
vl as (select date, 'random' other, net - random x from rv union all select date, 'market_net', net - market_net from rv
   union all select rv.date, 'vni5', net - x.vni5 from rv join xfeat x using (date)),
vs0 as (select 'vs|' || other g, row_number() over (partition by other order by date) - 1 idx, x from vl where x is not null)"""


def _with_index(ws, daily):
    from tidemark.operators.labels import index_forward
    return daily.join(F.broadcast(index_forward(ws.index(), ws.cfg)), "date", "left")     # one row per session


@query("B14_versus", basket_sql("ret20") + "," + RND + "," + RVS + "," + VS + "," + boot_sql("vs0", "bs") + """,
vw as (select b.*, substr(b.g, 4) other, w.win_days from bs b join (select g, avg((x > 1e-12)::int::double) win_days from vs0 group by 1) w using (g))\n"""
       + report("vw", "other", "mean lo hi win_days", "n"))
def versus(ws):
    """Edge over random, market and index: mean, interval, winning days."""
    daily = _with_index(ws, op.against_random(*_rand(ws)))
    return op.versus(daily, ws.cfg.but(boot=B), ("random", "market_net", "vni5"))


@query("B15_compound", basket_sql("ret20") + "\n" + report("(select exp(sum(ln(1+net/5)))-1 net_cum, exp(sum(ln(1+market_net/5)))-1 market_net_cum from bk where n > 0)",
                                                         "", "net_cum market_net_cum"))
def compound(ws):
    """Compound return of overlapping baskets."""
    return op.compound(op.bought_days(op.daily_basket(ws.outcomes(*BASKETS), "ret20", ws.cfg)), ("net", "market_net"))


def _variants_sql() -> str:
    arms = [("V0_model", "p_up_5", "value_top30"), ("V4_soft_value", "soft", "true"), ("V6_logistic", "p_lr", "value_top30"),
            ("R1_momentum20", "ret20", "value_top30"), ("R2_trend_score", "trend_score", "value_top30"), ("R3_value_score", "value_score", "value_top30")]
    un = " union all ".join(f"select '{v}' variant, {c} score, {p} in_pool, ticker, date, industry, fwd_ret_5, \"real\", net, y_bin, buyable, vni_dist_ema50 from so"
                            for v, c, p in arms)
    return OC + "," + SOFT.replace("from scored", "from oc") + f""",
lg0 as ({un}),
lg as (select *, case when date between date '2000-04-01' and date '2000-06-30' then 1 when date between date '2000-07-01' and date '2000-09-30' then 2
   when date between date '2000-10-01' and date '2000-12-31' then 3 when date between date '2001-01-01' and date '2001-03-31' then 4 end fold from lg0),
lf as (select * from lg where fold is not null),""" + topk("lf", "score", "sel", "variant, fold, date", "in_pool") + """,
vb0 as (select variant, fold, date, count(*) filter (buyable) n, avg(net) filter (buyable) net, avg(y_bin) filter (buyable) hit from sel group by all),
vb1 as (select variant, fold, date, avg(net) market_net, avg(y_bin) filter (in_pool) base_pool, max(vni_dist_ema50) v from lf group by all),
vb as (select * from vb0 join vb1 using (variant, fold, date) where n > 0),
po as (select variant, fold, date, net, row_number() over (partition by variant, fold, date order by ('0x' || substr(md5('ix|' || ticker), 1, 8))::bigint, ticker) pos
   from lf where in_pool and buyable),
ps as (select variant, fold, date, max(pos) size from po group by all),
rk0 as (select variant, fold, date, least(n, size)::bigint k, size, rep from vb join ps using (variant, fold, date), (select unnest(range(20)) rep)),
fy(variant, fold, date, rep, size, k, j, acc) as (
   select variant, fold, date, rep, size, k, size-k+1, []::bigint[] from rk0 where k > 0
   union all
   select f.variant, f.fold, f.date, f.rep, f.size, f.k, f.j+1, list_append(f.acc, case when list_contains(f.acc, t.t) then f.j else t.t end)
   from fy f, lateral (select ('0x' || substr(md5('7|rand|' || f.variant || '|' || f.fold || '|' || f.date::varchar || '|' || f.rep || '|' || f.j), 1, 8))::bigint % f.j + 1 t) t
   where f.j <= f.size),
fd as (select variant, fold, date, rep, unnest(acc) pos from fy where j = size + 1),
rr as (select variant, fold, date, rep, avg(net) rn from fd join po using (variant, fold, date, pos) group by all),
rm as (select variant, fold, date, avg(rn) random from rr group by all),""" + f"""
ir as (select variant, fold, date, {pct('score', by='variant, fold, date')} a, {pct('fwd_ret_5', by='variant, fold, date')} b from lf),
ic0 as (select variant, fold, date, corr(a, b) ic from ir group by all having count(*) > 5),
ic as (select variant, fold, avg(ic) ic from ic0 group by all),
ex as (select variant, fold, avg(net) net, avg(net-random) vs_random, avg(net-market_net) vs_market,
   avg(case when v > 0 then net else 0 end) net_timed, avg(hit-base_pool) lift, count(*) n_days, avg(coalesce(v > 0, false)::int::double) pct_mkt_up
   from vb join rm using (variant, fold, date) group by all),
exs as (select * from ex left join ic using (variant, fold))"""


@query("B17_simple_rules", _variants_sql() + "\n" + report("exs", "variant", "net vs_random vs_market net_timed lift pct_mkt_up ic", "fold n_days"))
def simple_rules(ws):
    """Models and simple rules through the same statistics, per fold."""
    return op.experiment_rows(op.strategies(ws.outcomes(*RULES), ws.cfg), ws.cfg, 20)


@query("B16_variant_summary", _variants_sql() + """,
su as (select variant, avg(net) net, avg(net_timed) net_timed, avg(vs_random) vs_random, avg(vs_market) vs_market, avg(ic) ic, avg(lift) lift,
   count(*) filter (vs_random > 1e-12) folds_beat_rand, count(*) filter (vs_market > 1e-12) folds_beat_mkt from exs group by 1),
el as (select *, variant not like 'R%' and ic > 0 and folds_beat_rand >= 3 and folds_beat_mkt >= 3 eligible from su),
fi as (select *, eligible and vs_market > (select max(vs_market) from su where variant like 'R%') fit from el),
ch as (select *, coalesce(fit and variant = (select variant from fi where fit order by vs_market desc limit 1), false) chosen from fi)\n"""
       + report("ch", "variant eligible chosen", "net net_timed vs_random vs_market ic lift", "folds_beat_rand folds_beat_mkt"))
def variant_summary(ws):
    """Means over folds, eligibility and the chosen variant."""
    return op.variant_summary(op.experiment_rows(op.strategies(ws.outcomes(*RULES), ws.cfg), ws.cfg, 20))


@query("B18_per_fold", OC + """,
of as (select *, case when date between date '2000-04-01' and date '2000-06-30' then 1 when date between date '2000-07-01' and date '2000-09-30' then 2
   when date between date '2000-10-01' and date '2000-12-31' then 3 when date between date '2001-01-01' and date '2001-03-31' then 4 end fold from oc),""" + topk("of", "p_up_5", "sel") + """,
pf as (select fold, date, avg(net) net, avg(y_bin) hit from sel where buyable and fold is not null group by all),
pu as (select date, avg(fwd_ret_5) univ, avg(y_bin) filter (value_top30) base_pool from oc group by 1),
pg as (select fold, count(*) n_days, avg(hit) hit_top10, avg(net) net_top10, avg(net-univ) excess_ret_5 from pf join pu using (date) group by 1)\n"""
       + report("pg", "", "hit_top10 net_top10 excess_ret_5", "fold n_days"))
def per_fold(ws):
    """Period summary in every walk-forward fold."""
    d = ws.outcomes(*BASKETS).withColumn("fold", op.fold_of(F.col("date"), ws.cfg.folds)).where("fold is not null")
    s = op.summarise_basket(op.daily_basket(d, "p_up_5", ws.cfg, ("fold", "date")), ("fold",))
    return s.select("fold", "n_days", "hit_top10", "net_top10", "excess_ret_5")
