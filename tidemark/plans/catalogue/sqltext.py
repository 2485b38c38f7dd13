"""Shared SQL for the twins: the panel and everything derived from it, as chained CTEs."""

from __future__ import annotations

CODE = "case when {0} % 50 = 49 then 'W' else '' end || lpad(upper(to_base({0}, 36)), 6, '0')"

PANEL = f"""
a0 as (select l_suppkey s, cast(date_trunc('week', l_shipdate) as date) d,
              sum(l_orderkey*7 + l_partkey*13)::bigint k, sum(l_partkey)::bigint kp, sum(l_orderkey)::bigint ko,
              sum(l_linenumber)::bigint kl, sum(l_quantity) volume, sum(l_extendedprice) turnover
       from lineitem group by 1, 2),
b0 as (select *, ((k % 997)/996e0 - 0.5e0)*2*(case s % 3 when 0 then 0.07e0 when 1 then 0.10e0 else 0.15e0 end) r from a0),
c0 as (select *, 20e0*exp(sum(ln(1+r)) over (partition by s order by d)) as close from b0),
e0 as (select *, coalesce(lag(close) over (partition by s order by d), 20e0)
              * (1+((kp % 201)/100e0-1)*(case when kp % 23 = 0 then 0.11e0 else 0.01e0 end)) as open from c0),
panel as (select {CODE.format('s')} as ticker, d as date, open, greatest(open,close)*(1+(kl % 11)/1000e0) high,
       least(open,close)*(1-(ko % 11)/1000e0) low, close, volume, turnover, s as sid from e0)"""

INDEX = """
ix1 as (select date, volume, close/coalesce(lag(close) over (partition by ticker order by date), 20e0) - 1 r from panel),
ix2 as (select date, avg(r) m, sum(volume) volume from ix1 group by 1),
ix3 as (select date, volume, 1000e0*exp(sum(m) over (order by date)) as close from ix2),
ix4 as (select *, coalesce(lag(close) over (order by date), 1000e0) as open from ix3),
idx as (select 'VNINDEX' ticker, date, open, greatest(open,close)*1.002e0 high, least(open,close)*0.998e0 low, close, volume from ix4)"""

SYMBOLS = """
sym as (select * from panel where regexp_full_match(ticker, '[A-Z0-9]{6}') and date >= date '1995-01-01')"""

EXCH = """
exr as (select ticker, abs(close/lag(close) over (partition by ticker order by date) - 1) r from sym),
exq as (select ticker, quantile_cont(r, 0.999) q from exr group by 1),
exch as (select ticker, case when q <= 0.072e0 then 'HOSE' when q <= 0.102e0 then 'HNX' else 'UPCOM' end exch, 'inferred' exch_src from exq)"""

IND = f"""
ind as (select {CODE.format('s_suppkey')} as ticker, case when s_suppkey % 17 <> 0 then n_name end as industry
        from supplier join nation on s_nationkey = n_nationkey)"""


def ewm(x: str, alpha: str, need: int, w: str = "w") -> str:
    """Closed form of the recursion over the running window w (needs pos and cnt_<x>)."""
    b = f"(1e0-{alpha})"
    return (f"case when cnt_{x} >= {need} then power({b}, pos) * sum((case when cnt_{x} = 1 then 1e0 else {alpha} end)"
            f" * {x} * power({b}, -pos)) over {w} end")


_W = "window w as (partition by ticker order by date)"


def features(src: str = "sym", p: str = "f", extra: str = "") -> str:
    """Feature frame CTEs over a bar relation; the result is `<p>eat`."""
    def full(agg, x, n, need=None):
        fr = f"over (partition by ticker order by date rows between {n-1} preceding and current row)"
        return f"case when count({x}) {fr} >= {need or n} then {agg}({x}) {fr} end"
    old = "over (partition by ticker order by date rows between 19 preceding and 10 preceding)"
    e = lambda n: f"(2e0/{n+1})"
    wil = "(1e0/14)"
    return f"""
{p}1 as (select *, row_number() over w nbars, row_number() over w - 1 pos, lag(close) over w pc, lag(high) over w ph, lag(low) over w pl,
   close/lag(close,1) over w - 1 ret1, close/lag(close,5) over w - 1 ret5, close/lag(close,20) over w - 1 ret20,
   close/lag(close,60) over w - 1 ret60, count(close) over w cnt_close from {src} {_W}),
{p}2 as (select *, greatest(high-low, abs(high-pc), abs(low-pc)) tr,
   case when high-ph > pl-low and high-ph > 0 then high-ph else 0e0 end pdm,
   case when pl-low > high-ph and pl-low > 0 then pl-low else 0e0 end mdm,
   case when pc is not null then greatest(close-pc, 0e0) end gain, case when pc is not null then greatest(pc-close, 0e0) end loss from {p}1),
{p}3 as (select *, count(tr) over w cnt_tr, count(pdm) over w cnt_pdm, count(mdm) over w cnt_mdm, count(gain) over w cnt_gain,
   count(loss) over w cnt_loss from {p}2 {_W}),
{p}4 as (select *, {ewm('close', e(20), 20)} ema20, {ewm('close', e(50), 50)} ema50, {ewm('close', e(200), 200)} ema200,
   {ewm('close', e(12), 12)} - {ewm('close', e(26), 26)} macd,
   {ewm('tr', wil, 14)} atr, {ewm('pdm', wil, 14)} sp, {ewm('mdm', wil, 14)} sm, {ewm('gain', wil, 14)} sg, {ewm('loss', wil, 14)} sl
   from {p}3 {_W}),
{p}5 as (select *, 100*sp/nullif(atr,0) plus_di, 100*sm/nullif(atr,0) minus_di, count(macd) over w cnt_macd from {p}4 {_W}),
{p}6 as (select *, 100*abs(plus_di-minus_di)/nullif(plus_di+minus_di,0) dx from {p}5),
{p}7 as (select *, count(dx) over w cnt_dx, {ewm('macd', e(9), 9)} sig from {p}6 {_W}),
{p}8 as (select *, {ewm('dx', wil, 14)} adx14, {full('max','high',20)} hi20, {full('min','low',20)} lo20, {full('max','high',60)} hi60,
   {full('min','low',60)} lo60, {full('max','high',252,120)} hi252, {full('min','low',252,120)} lo252,
   {full('max','high',10,1)} h10, {full('min','low',10,1)} l10,
   case when count(high) {old} = 10 then max(high) {old} end h20, case when count(low) {old} = 10 then min(low) {old} end l20,
   {full('avg','volume',20)} mv20, {full('avg','coalesce(turnover,0)',20,15)} liq20 from {p}7 {_W}),
{p}eat as (select ticker, date, sid, open, high, low, close, volume, turnover, nbars, ret1, ret5, ret20, ret60,
   close/ema20-1 dist_ema20, close/ema50-1 dist_ema50, close/ema200-1 dist_ema200, ema20/ema50-1 ema20_50,
   ema50/lag(ema50,10) over w - 1 ema50_slope10, tr, plus_di, minus_di, dx, ema20, ema50, ema200, atr/close atr14_pct, adx14,
   (plus_di-minus_di)/nullif(plus_di+minus_di,0) di_diff,
   case when sl = 0 and sg > 0 then 100e0 when sl > 0 then 100e0-100e0/(1+sg/sl) end rsi14,
   (macd-sig)/close macd_hist, {full('stddev_samp','ret1',20)} volat20, {full('stddev_samp','ret1',60)} volat60,
   volume/nullif(mv20,0) vol_ratio20, liq20, ln(1+liq20) log_liq20, (close-lo20)/nullif(hi20-lo20,0) pos20,
   (close-lo60)/nullif(hi60-lo60,0) pos60, close/hi252-1 dd252, close/lo252-1 up252,
   ((close-low)-(high-close))/nullif(high-low,0) clv, h10/h20-1 hh10, l10/l20-1 hl10 {extra} from {p}8 {_W})"""


IDXFEAT = f"""
xf1 as (select *, row_number() over w - 1 pos, count(close) over w cnt_close from idx {_W}),
xfeat as (select date, close, close/lag(close,1) over w - 1 vni_ret1, close/lag(close,5) over w - 1 vni_ret5, close/lag(close,20) over w - 1 vni_ret20,
   close/({ewm('close', '(2e0/51)', 50)}) - 1 vni_dist_ema50, close/({ewm('close', '(2e0/51)', 1)}) - 1 d50,
   close/({ewm('close', '(2e0/201)', 1)}) - 1 d200, lead(close,5) over w / close - 1 vni5 from xf1 {_W})"""

LABELS = f"""
lab0 as (select *, lead(open) over w open_t1, lead(close,4) over w c4, lead(close,5) over w close_t5, lead(close,6) over w close_t6 from feat {_W}),
lab1 as (select *, open_t1/close-1 open_gap_t1, close_t5/c4-1 ret_t5_day, close_t5/open_t1-1 fwd_ret_5 from lab0),
lab as (select *, case when fwd_ret_5 is null then null when coalesce(fwd_ret_5 > 0.5e0*atr14_pct, false) then 1e0 else 0e0 end y_bin from lab1)"""

FRAME = """
fr0 as (select lab.*, coalesce(e.exch, 'UPCOM') exch, coalesce(e.exch_src, 'inferred') exch_src,
   case coalesce(e.exch, 'UPCOM') when 'HOSE' then 0.07e0 when 'HNX' then 0.10e0 else 0.15e0 end as "limit",
   x.vni_ret5, x.vni_ret20, x.vni_dist_ema50 from lab left join exch e using (ticker) left join xfeat x on x.date = lab.date),
frame as (select *, coalesce(liq20 >= 90000 and nbars >= 200 and volume > 0, false) eligible,
   coalesce(ret1 >= "limit"-0.005e0, false)::int near_ceiling, coalesce(ret1 <= -("limit"-0.005e0), false)::int near_floor from fr0)"""


def pct(x: str, asc: bool = True, by: str = "date") -> str:
    d = "asc" if asc else "desc"
    return (f"case when {x} is not null then (rank() over (partition by {by} order by {x} {d} nulls last)"
            f" + (count(*) over (partition by {by}, {x}) - 1)/2e0) / count({x}) over (partition by {by}) end")


SCORED = f"""
u1 as (select f.*, i.industry, avg(coalesce(dist_ema50 > 0, false)::int::double) over (partition by date) breadth_ema50,
   ({pct('dd252', False)} + {pct('dist_ema200', False)} + {pct('volat60', False)} + {pct('liq20')})/4 value_score,
   {pct('ret5')} ret5_xr, {pct('ret20')} ret20_xr, {pct('vol_ratio20')} vol_ratio20_xr, {pct('volat20')} volat20_xr, {pct('rsi14')} rsi14_xr,
   case when dist_ema50 > 0 and ema20_50 > 0 and adx14 >= 20 then 'Uptrend' when dist_ema50 < 0 and ema20_50 < 0 and adx14 >= 20 then 'Downtrend'
        else 'Sideways' end regime, 0.5e0*tanh(10*ema20_50) + 0.5e0*di_diff trend_score
   from frame f left join ind i using (ticker) where eligible),
scored as (select *, 'technical_proxy' value_mode, coalesce({pct('value_score')} >= 0.7e0, false) value_top30,
   ('0x' || substr(md5('p_up_5|' || ticker || '|' || date::varchar), 1, 8))::bigint / 4294967296e0 p_up_5,
   ('0x' || substr(md5('p_lr|' || ticker || '|' || date::varchar), 1, 8))::bigint / 4294967296e0 p_lr from u1)"""

NET = "(1-0.0015e0)*(1+{0})*(1-0.0015e0-0.001e0)-1"

OUT = f"""
oc0 as (select *, case when ret_t5_day <= -("limit"-0.005e0) and close_t6 is not null then close_t6/open_t1-1 else fwd_ret_5 end as "real"
   from scored where fwd_ret_5 is not null),
oc as (select *, {NET.format('"real"')} as net, not coalesce(open_gap_t1 >= "limit"-0.005e0, false) as buyable from oc0)"""

CAL = """
cal as (select date, row_number() over (order by date) - 1 di from (select distinct date from panel))"""


def chain(*names: str) -> str:
    """with-clause of the named parts and everything before them."""
    order = {"panel": PANEL, "idx": INDEX, "sym": SYMBOLS, "exch": EXCH, "ind": IND, "feat": features(), "xfeat": IDXFEAT,
             "lab": LABELS, "frame": FRAME, "scored": SCORED, "oc": OUT, "cal": CAL}
    needs = {"panel": (), "idx": ("panel",), "sym": ("panel",), "exch": ("sym",), "ind": (), "feat": ("sym",), "xfeat": ("idx",),
             "lab": ("feat",), "frame": ("lab", "exch", "xfeat"), "scored": ("frame", "ind"), "oc": ("scored",), "cal": ("panel",)}
    want: set[str] = set()

    def add(n):
        if n not in want:
            want.add(n)
            for m in needs[n]:
                add(m)
    for n in names:
        add(n)
    return "with recursive " + ",".join(order[n] for n in order if n in want)
