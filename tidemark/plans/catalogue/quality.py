"""Quality checks and source comparison."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import quality as op
from tidemark.plans.catalogue import livelog
from tidemark.plans.catalogue.ingest import BATCH
from tidemark.plans.catalogue import ingest as ing
from tidemark.plans.catalogue.registry import query, report
from tidemark.plans.catalogue.sqltext import chain

SYM = chain("sym")


def dirty(ws):
    """Panel with repeated keys, impossible prices and late jumps."""
    m = F.col("sid") % 20
    d = ws.symbols()
    odd = F.pmod(F.datediff("date", F.lit("1995-01-02").cast("date")) / 7, F.lit(2)) == 1
    d = d.withColumns({"low": F.when((m == 5) & (F.month("date") == 6), F.col("high") * 1.01).otherwise(F.col("low")),
                       "open": F.when((m == 6) & (F.col("date") == F.lit("1999-08-02").cast("date")), -1.0).otherwise(F.col("open")),
                       "close": F.when((m == 7) & odd & (F.col("date") >= F.lit("2001-09-01").cast("date")), F.col("close") * 1.5).otherwise(F.col("close"))})
    copies = F.when((m == 9) & (F.col("date") == F.lit("2000-05-01").cast("date")), F.array(F.lit(1), F.lit(2), F.lit(3))).otherwise(F.array(F.lit(1)))
    return d.withColumn("_c", F.explode(copies)).drop("_c")


DIRTY = """
di as (select ticker, date, sid, case when sid % 20 = 6 and date = date '1999-08-02' then -1e0 else open end as open, high,
   case when sid % 20 = 5 and month(date) = 6 then high*1.01e0 else low end as low,
   case when sid % 20 = 7 and ((date - date '1995-01-02')//7) % 2 = 1 and date >= date '2001-09-01' then close*1.5e0 else close end as close, volume, turnover
   from (select *, unnest(case when sid % 20 = 9 and date = date '2000-05-01' then [1,2,3] else [1] end) from sym))"""
D = SYM + "," + DIRTY


@query("Q01_qc_summary", D + """
select sum(dup)::bigint dups, (select count(*) from di where open <= 0 or high <= 0 or low <= 0 or close <= 0) nonpositive_price, (select count(*) from di where high < low) high_lt_low,
  (select max(date) from di) last_date, (select count(*) from di where date = (select max(date) from di)) n_tickers_last_day,
  (date '2001-11-12' - (select max(date) from di))::bigint stale_days, date '2001-11-12' - (select max(date) from di) > 5 stale,
  sum(dup) > 0 or (select count(*) from di where open <= 0 or high <= 0 or low <= 0 or close <= 0) > 0 as blocking
from (select count(*) - 1 dup from di group by ticker, date)""")
def qc(ws):
    """Panel checks of a damaged panel."""
    return op.qc(dirty(ws), "2001-11-12", ws.cfg)


JUMPS = """
ju as (select distinct ticker from (select ticker, date, abs(close/lag(close) over (partition by ticker order by date)-1) r from di)
   where r > 0.16e0 and date > (select max(date) from di) - 90)"""


@query("Q02_jumps", D + "," + JUMPS + "\nselect ticker from ju")
def jumps(ws):
    """Recent moves too large for any price limit."""
    return op.jumps(dirty(ws))


@query("Q03_quarantine", D + "," + JUMPS + "," + BATCH + """,
ol as (select distinct ticker from sym where sid % 4 = 3)
(select ticker from (select ticker from ju union select ticker from bs where status='quarantine' union select ticker from ol)
  where ticker not in (select ticker from bs where status in ('replaced','revalidated'))) union select ticker from ju""")
def quarantine(ws):
    """Set algebra of quarantined tickers."""
    s = ing.op.batch_status(ing.base(ws), ing.batch(ws), ws.cfg)
    old = ws.symbols().where("sid % 4 = 3").select("ticker").distinct()
    return op.quarantine(op.jumps(dirty(ws)), s.where("status = 'quarantine'"), old, s.where("status = 'replaced'"), s.where("status = 'revalidated'"))


@query("Q04_visible_sessions", SYM + """
select 'open' kind, max(date) last, count(*) n from sym where date < date '2001-10-29' union all select 'closed', max(date), count(*) from sym
union all select 'asof', max(date), count(*) from sym where date <= date '2000-03-15'""")
def visible(ws):
    """Unfinished session hidden before 15:30 local time, shown after; as-of cut."""
    p, out = ws.symbols(), None
    for kind, v in (("open", op.visible(p, "2001-10-29 08:29:00")), ("closed", op.visible(p, "2001-10-29 08:30:00")), ("asof", op.visible(p, "2001-10-29 00:00:00", "2000-03-15"))):
        r = v.agg(F.lit(kind).alias("kind"), F.max("date").alias("last"), F.count(F.lit(1)).alias("n"))
        out = r if out is None else out.unionByName(r)
    return out


@query("Q05_audit", chain("panel") + """,
d as (select ticker, date, high, low, close, close/lag(close) over w - 1 r, date - lag(date) over w gap from
   (select * replace (case when sid % 20 = 7 and month(date) = 3 then close*1.5e0 else close end as close) from panel) window w as (partition by ticker order by date)),
x as (select *, date >= date '1998-01-01' late, date >= date '1998-01-01' and regexp_full_match(ticker, '[A-Z0-9]{6}') plain from d)
select count(*) filter (late and gap > 10) gaps_over_10d, count(*) filter (close > high*1.001e0 or close < low*0.999e0) close_outside, count(*) filter (late and abs(r) > 0.155e0) big_moves,
  count(distinct ticker) filter (late and abs(r) > 0.155e0) big_move_tickers, count(*) filter (plain and abs(r) > 0.155e0) big_moves_plain, count(*) filter (plain and r < -0.3e0) falls_over_30pct from x""")
def audit(ws):
    """Gaps, closes outside the bar, large moves."""
    p = ws.panel().withColumn("close", F.when((F.col("sid") % 20 == 7) & (F.month("date") == 3), F.col("close") * 1.5).otherwise(F.col("close")))
    return op.audit(p, "1998-01-01", ws.cfg.ticker_pattern)


@query("Q05_liquid_by_median", SYM + ", u as (select ticker, median(turnover) median_turnover from sym where date >= date '1998-01-01' group by 1 having median(turnover) >= 90000)\n"
       + report("u", "ticker", "median_turnover"))
def liquid_by_median(ws):
    """Tickers by median turnover."""
    return op.liquid_by_median(ws.symbols(), "1998-01-01", 90_000.0)


@query("Q05_tickers_per_date", SYM + "\nselect date, count(ticker) n_tickers from sym group by 1 order by 1 desc limit 10")
def tickers_per_date(ws):
    """Breadth of the last ten dates."""
    return op.tickers_per_date(ws.symbols())


@query("Q06_health_checks", livelog.LOG + """,
h as (select max(data_date) d from st),
v as (select vol_ratio20, row_number() over (order by vol_ratio20, ticker) r, count(*) over () n from st where data_date = (select d from h) and vol_ratio20 is not null),
b as (select count(*) n from (select unnest(generate_series((select d from h) + interval 1 day, timestamp '2001-11-07', interval 1 day)) x) where dayofweek(x) not in (0, 6))
select d last_date, round((select vol_ratio20 from v where r = n//2+1), 6) median_vol_ratio, (select count(*) from st where status = 'open' and data_date < d - 11) n_stuck, b.n business_days_late,
  case when b.n > 3 then 'fail' when b.n > 1 then 'warn' else 'ok' end freshness, (select vol_ratio20 from v where r = n//2+1) < 0.5e0 partial_bar from h, b""")
def health_checks(ws):
    """Freshness, partial bar and stuck rows."""
    log = livelog.settled(ws)
    return op.health_checks(log, log.select("data_date"), "2001-11-06 18:00:00", ws.cfg)


@query("Q07_coverage", SYM + '\nselect ticker, count(*) as "rows", min(date) as "first", max(date) as "last" from sym group by 1')
def coverage(ws):
    """Rows and range per ticker."""
    return op.coverage(ws.symbols())


@query("Q07_coverage_summary", SYM + """, c as (select ticker, count(*) n, min(date) f from sym group by 1)
select count(*) tickers, sum(n)::bigint as "rows", min(n) min_rows, max(n) max_rows, min(f) first_min, max(f) first_max,
  (select count(*) from (select unnest(generate_series(timestamp '1995-01-01', timestamp '2001-11-07', interval 1 day)) x) where dayofweek(x) not in (0, 6)) expected_weekdays from c""")
def coverage_summary(ws):
    """Extremes over tickers and expected weekdays."""
    return op.coverage_summary(ws.symbols(), "1995-01-01", "2001-11-07")


def other(ws):
    """Second source: every tenth ticker 2 % off, some in units, small noise elsewhere."""
    k = F.when(F.col("sid") % 10 == 3, 1.02).when(F.col("sid") % 10 == 4, 0.001).otherwise(1 + (F.col("sid") % 7) * 0.0005)
    return ws.symbols().where("(sid + day(date)) % 5 <> 0").withColumn("close", F.col("close") * k)


OTHER = """
ot as (select * replace (close*(case when sid % 10 = 3 then 1.02e0 when sid % 10 = 4 then 0.001e0 else 1+(sid % 7)*0.0005e0 end) as close) from sym where (sid + day(date)) % 5 <> 0)"""


def actions(ws):
    """Corporate actions by ticker and week."""
    wk = (F.datediff("date", F.lit("1995-01-02").cast("date")) / 7).cast("long")
    return ws.symbols().select("ticker", "date", F.when((F.col("sid") + wk) % 60 == 0, 0.5).otherwise(0.0).alias("dividend"),
                               F.when((F.col("sid") + wk) % 97 == 0, 2.0).otherwise(0.0).alias("split"))


ACTS = """
ac as (select ticker, date, case when (sid + (date - date '1995-01-02')//7) % 60 = 0 then 0.5e0 else 0e0 end dividend,
   case when (sid + (date - date '1995-01-02')//7) % 97 = 0 then 2e0 else 0e0 end split from sym)"""


@query("Q08_event_counts", SYM + "," + ACTS + "\nselect count(*) filter (dividend > 0) n_dividends, count(*) filter (split > 0) n_splits from ac")
def event_counts(ws):
    """Dividends and splits."""
    return op.event_counts(actions(ws))


@query("Q08_event_attribution", SYM + "," + OTHER + "," + ACTS + """,
p as (select ticker, max(abs(o.close/s.close-1)) worst from sym s join ot o using (ticker, date) where date <= date '2001-06-30' group by 1),
l as (select ticker, count(*) n from ac where date > date '2001-06-30' and (dividend > 0 or split > 0) group by 1)
select count(*) filter (worst > 0.005e0 and n is not null) over_with_event, count(*) filter (worst > 0.005e0 and n is null) over_without_event, count(*) filter (not worst > 0.005e0) as "within"
from p left join l using (ticker)""")
def event_attribution(ws):
    """Deviating tickers with and without a later corporate action."""
    return op.event_attribution(ws.symbols(), other(ws), actions(ws), "2001-06-30", ws.cfg)


PAIR = SYM + "," + OTHER + """,
pr as (select ticker, date, o.close/s.close r from sym s join ot o using (ticker, date))"""


@query("Q09_compare_sources", PAIR + """,
u as (select ticker, count(*) n, median(r) median_ratio, avg((abs(r-1) <= 0.005e0)::int::double) share_raw, avg((abs(r*1000-1) <= 0.005e0)::int::double) share_x1000 from pr group by 1)\n"""
       + report("u", "ticker", "median_ratio share_raw share_x1000", "n"))
def compare_sources(ws):
    """Two sources per ticker."""
    return op.compare_sources(ws.symbols(), other(ws))


@query("Q10_deviation", SYM + "," + OTHER + """,
rf as (select 'raw' ref, ticker, date, close from sym union all select 'second', ticker, date, close from ot),
dv as (select rf.ref, ticker, abs(s.close/rf.close-1) d from rf join sym s using (ticker, date)),
u as (select ticker, ref, count(*) n, avg((d <= 0.005e0)::int::double) as "within", max(d)*100 max_pct from dv group by 1, 2)\n""" + report("u", "ticker ref", '"within" max_pct', "n"))
def deviation(ws):
    """Several references at once."""
    return op.deviation(ws.symbols(), {"raw": ws.symbols(), "second": other(ws)})


@query("Q11_overlap_stats", PAIR + ", u as (select ticker, avg(abs(r-1)) mean_diff, max(abs(r-1)) max_diff, count(*) n from pr group by 1)\n" + report("u", "ticker", "mean_diff max_diff", "n"))
def overlap_stats(ws):
    """Deviation per ticker."""
    return op.overlap_stats(ws.symbols(), other(ws))


@query("Q11_worst_overlap", PAIR + ", u as (select ticker, max(abs(r-1)) max_diff, count(*) n from pr group by 1 order by round(max(abs(r-1)), 12) desc, ticker limit 10)\n" + report("u", "ticker", "max_diff", "n"))
def worst_overlap(ws):
    """Ten worst tickers."""
    s = op.overlap_stats(ws.symbols(), other(ws)).withColumn("max_diff", F.round("max_diff", 12))
    return s.orderBy(F.desc("max_diff"), "ticker").limit(10).select("ticker", "max_diff", "n")


@query("Q11_overlap_totals", PAIR + """, u as (select count(*) overlap_rows, avg(abs(r-1))*100 mean_pct, max(abs(r-1))*100 max_pct,
   (select count(*) from (select ticker from pr group by 1 having max(abs(r-1)) > 0.005e0)) tickers_over_tol from pr)\n""" + report("u", "", "mean_pct max_pct", "overlap_rows tickers_over_tol"))
def overlap_totals(ws):
    """Totals over all overlaps."""
    return op.overlap_totals(ws.symbols(), other(ws), ws.cfg)


@query("Q12_ratio_counts", chain("sym", "idx") + "," + OTHER + """,
a as (select ticker, date, close from ot union all select ticker, date, close*1.001e0 from idx), b as (select ticker, date, close from sym union all select ticker, date, close from idx),
u as (select a.ticker, a.close/b.close r from a join b using (ticker, date) where date = date '2001-09-03')
select count(*) filter (ticker <> 'VNINDEX' and abs(r-1) <= 0.005e0) inside, count(*) filter (ticker <> 'VNINDEX' and abs(r-1) > 0.005e0) outside,
  round(max(r) filter (ticker = 'VNINDEX'), 6) index_ratio from u""")
def ratio_counts(ws):
    """One day's close ratios."""
    c = ["ticker", "date", "close"]
    a = other(ws).select(*c).unionByName(ws.index().select("ticker", "date", (F.col("close") * 1.001).alias("close")))
    return op.ratio_counts(a, ws.symbols().select(*c).unionByName(ws.index().select(*c)), "2001-09-03", "VNINDEX")


@query("Q13_availability", SYM + "," + OTHER + """,
s as (select 'panel' source, ticker, date, close from sym union all select 'second', ticker, date, close from ot),
u as (select source, ticker, count(*) as "rows", max(date) last_date, max_by(close, date) last_close from s group by 1, 2)\n""" + report("u", "source ticker last_date", "last_close", '"rows"'))
def availability(ws):
    """Rows, last date and last close per source and ticker."""
    return op.availability({"panel": ws.symbols(), "second": other(ws)})
