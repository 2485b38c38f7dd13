"""Order and trade-ledger analytics over generated order books."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import features, ledger as op
from tidemark.operators.universe import add_exchange
from tidemark.plans.catalogue.events import EV, EVENTS, events
from tidemark.plans.catalogue.ingest import ORD, orders
from tidemark.plans.catalogue.registry import query, report
from tidemark.plans.catalogue.sqltext import chain
from tidemark.plans.catalogue.universe import AGENTS, agents
from tidemark.plans.workspace import Workspace, _stored
from tidemark.session import materialise

CAPITAL = 1.0e12


@_stored
def book(ws: Workspace):
    """Orders with their order number, carried in the reason text."""
    return materialise(orders(ws).withColumn("order_no", F.regexp_extract("reason", "([0-9]+)$", 1).cast("long")), "book")


def limits(ws):
    return add_exchange(ws.symbols().select("ticker").distinct(), ws.exchanges()).select("ticker", "limit")


@_stored
def eligible(ws: Workspace):
    """(ticker, session) of liquid names with enough bars, from turnover alone."""
    d = features.derive(ws.symbols(), features.activity(), keep=("nbars",))
    keep = d.where((F.col("liq20") >= ws.cfg.liq_min) & (F.col("nbars") >= ws.cfg.min_bars))
    return materialise(keep.select("ticker", F.col("date").alias("session")), "eligible_bars")


@_stored
def fills(ws: Workspace):
    b = op.session_bars(ws.symbols(), limits(ws))
    return materialise(op.fill_orders(book(ws), b, ws.cfg), "fills")


@_stored
def admitted(ws: Workspace):
    return materialise(op.admit(fills(ws), eligible(ws), ws.industry(), agents(ws)), "admitted")


@_stored
def results(ws: Workspace):
    """Every admitted order with its final status."""
    return materialise(op.settle_sales(op.add_size(admitted(ws).where("reject is null"), ws.cfg), ws.calendar(), ws.cfg), "results")


@_stored
def trades(ws: Workspace):
    return materialise(results(ws).where("status = 'filled'"), "trades")


LIM = """
lm as (select distinct ticker, "limit" l from frame),
sb as (select ticker, date session, open, high, low, close, lag(close) over (partition by ticker order by date) prev from sym),
fi0 as (select o.*, b.open, b.high, b.low, b.close, b.prev, coalesce(lm.l, 0.07e0) l,
   case type when 'ATO' then open when 'ATC' then close else case when side = 'BUY' then case when open <= lim then open when low <= lim then lim end
        else case when open >= lim then open when high >= lim then lim end end end price
   from od o left join sb b on b.ticker = o.ticker and b.session = o.session left join lm on lm.ticker = o.ticker where side in ('BUY','SELL')),
fi as (select *, case when open is null then 'no_price' when price is null then 'unfilled_limit' when side = 'BUY' and coalesce(price >= prev*(1+l-0.005e0), false) then 'unfilled_ceiling'
   when side = 'SELL' and coalesce(price <= prev*(1-l+0.005e0), false) then 'unfilled_floor' else 'filled' end status from fi0)"""
FILL = chain("frame", "ind") + "," + ORD + "," + LIM


@query("T01_fill_price", FILL + "\n" + report("(select *, o_orderkey order_no from fi)", "agent session ticker side type", "price", "order_no"))
def fill_price(ws):
    """Price each order would trade at."""
    return fills(ws).select("agent", "session", "ticker", "side", "type", "price", "order_no")


@query("T02_fill_status", FILL + "\nselect agent, session, ticker, side, status, o_orderkey order_no from fi")
def fill_status(ws):
    """Filled, or why not."""
    return fills(ws).select("agent", "session", "ticker", "side", "status", "order_no")


ADMIT = AGENTS + """,
el as (select ticker, date session from frame where liq20 >= 90000 and nbars >= 200),
ad as (select f.*, i.industry, case when committed_at > f.session::timestamp + interval 2 hour then 'late_book' when side = 'BUY' and el.ticker is null then 'not_eligible'
   when side = 'BUY' and ag.agent is null then 'out_of_scope' end reject
   from fi f left join el on el.ticker = f.ticker and el.session = f.session left join ind i on i.ticker = f.ticker left join ag on ag.agent = f.agent and ag.industry = i.industry)"""
ADM = FILL + "," + ADMIT


@query("T03_admission", ADM + """
select distinct agent, session, '*' ticker, reject from ad where reject = 'late_book' union all select agent, session, ticker, reject from ad where reject <> 'late_book'""")
def admission(ws):
    """Rejected books and orders."""
    return op.rejections(admitted(ws))


RANK = "case type when 'ATO' then case side when 'SELL' then 0 else 1 end when 'ATC' then case side when 'SELL' then 3 else 4 end else 2 end"


@query("T04_order_sequence", FILL + f"""
select agent, session, o_orderkey order_no, row_number() over (partition by agent, session, ticker order by {RANK}, o_orderkey) seq, {RANK}::bigint rank from fi""")
def order_sequence(ws):
    """Execution order of a session, counted per name."""
    d = fills(ws).withColumn("rank", op.order_rank()).withColumn("one", F.lit(1))
    from tidemark.functions.running import running_total
    s = running_total(d, ["agent", "session", "ticker"], ["rank"], ["order_no"], "one", "seq")
    return s.select("agent", "session", "order_no", "seq", "rank")


SIZE = """
sz as (select *, case when side = 'BUY' then floor(value_vnd/(price*1000*100))*100 else try_cast(qty as bigint) end::bigint sh from ad)"""


@query("T05_order_size", ADM + "," + SIZE + ", u as (select *, o_orderkey order_no, sh*price*1000 amt from sz where status = 'filled' and side = 'BUY'), v as (select *, amt/1e6 amount, amt*0.0015e0/1e6 fee, sh shares from u)\n"
       + report("v", "agent ticker", "amount fee", "order_no shares"))
def order_size(ws):
    """Whole lots, amount and fee of filled buys (millions)."""
    s = op.add_size(admitted(ws).where("status = 'filled' and side = 'BUY'"), ws.cfg)
    return s.select("agent", "ticker", (F.col("amount") / 1e6).alias("amount"), (F.col("fee") / 1e6).alias("fee"), "order_no", "shares")


EXEC = SIZE + f""",
cdi as (select date, row_number() over (order by date) - 1 di from (select distinct date from panel)),
ev0 as (select agent, ticker, sum(sh) ever from sz where side = 'BUY' and status = 'filled' and reject is null group by all),
xe0 as (select sz.*, di, 2*({RANK}) rk, coalesce(case when side = 'SELL' and qty = 'all' then coalesce(ever, 0) else sh end, 0)::bigint want
   from sz left join cdi on cdi.date = sz.session left join ev0 using (agent, ticker) where reject is null),
xe1 as (select *, case when side = 'BUY' then di + 2 else di end at1, case when side = 'BUY' then 1 else rk end rk1, case when status <> 'filled' then 0 when side = 'BUY' then want else -want end x from xe0),
xe2 as (select *, sum(x) over (partition by agent, ticker order by at1, rk1, o_orderkey) s from xe1),
xe3 as (select *, least(0, coalesce(min(s) over (partition by agent, ticker order by at1, rk1, o_orderkey rows between unbounded preceding and 1 preceding), 0)) lo from xe2),
xe4 as (select *, case when side = 'SELL' then least(want, s - x - lo) else want end cut from xe3),
xe5 as (select *, sum(case when status <> 'filled' then 0 when side = 'BUY' then cut else -cut end) over (partition by agent, ticker order by di, rk, o_orderkey) held from xe4),
re as (select * exclude (status), case when side = 'SELL' and cut <= 0 then case when held > 0 then 'not_sellable_T+2' else 'no_position' end
   when side = 'BUY' and status = 'filled' and cut <= 0 then 'no_cash' else status end status from xe5),
tr as (select agent, ticker, session, type, side, price, o_orderkey order_no, {RANK} rk, cut::bigint shares, cut*price*1000 amount, cut*price*1000*0.0015e0 fee,
   case when side = 'SELL' then cut*price*1000*0.001e0 else 0e0 end tax from re where status = 'filled')"""
TR = ADM + "," + EXEC
LOTS = """
tb as (select *, sum(shares) over (partition by agent, ticker order by session, rk, order_no)::bigint upto from tr where side = 'BUY'),
tz as (select *, sum(shares) over (partition by agent, ticker order by session, rk, order_no)::bigint upto from tr where side = 'SELL'),
lo as (select b.agent, b.ticker, b.order_no buy_no, z.order_no sell_no, b.price buy_price, z.price sell_price,
   (least(b.upto, z.upto) - greatest(b.upto - b.shares, z.upto - z.shares))::bigint qty
   from tb b join tz z on z.agent = b.agent and z.ticker = b.ticker and b.upto > z.upto - z.shares and z.upto > b.upto - b.shares)"""


@query("T06_fifo_lots", TR + "," + LOTS + "\n" + report("lo", "agent ticker", "buy_price sell_price", "buy_no sell_no qty"))
def fifo_lots(ws):
    """Sold shares matched to the oldest lots."""
    return op.fifo_lots(trades(ws)).select("agent", "ticker", "buy_price", "sell_price", "buy_no", "sell_no", "qty")


SALES = LOTS + """,
co2 as (select agent, ticker, sell_no, sum(qty*buy_price*1000) c from lo group by all),
sl as (select z.agent, z.ticker, z.order_no sell_no, z.shares, c, z.amount - z.fee - z.tax - c*1.0015e0 pnl from tz z join co2 on co2.agent = z.agent and co2.ticker = z.ticker and co2.sell_no = z.order_no)"""


def sales(ws):
    t = trades(ws)
    return op.sale_results(t, op.fifo_lots(t), ws.cfg)


@query("T06_sale_results", TR + "," + SALES + ", u as (select *, c/1e6 as cost_m, pnl/1e6 pnl_m from sl)\n" + report("u", "agent ticker", "cost_m pnl_m", "sell_no shares"))
def sale_results(ws):
    """Cost and result of every sale (millions)."""
    return sales(ws).select("agent", "ticker", (F.col("cost") / 1e6).alias("cost_m"), (F.col("pnl") / 1e6).alias("pnl_m"), "sell_no", "shares")


MOVES = """
mv as (select agent, ticker, di, sum(case when side='BUY' then shares else 0 end)::bigint bought, sum(case when side='SELL' then shares else 0 end)::bigint sold,
   sum(case when side='BUY' then -(amount+fee) else amount-fee-tax end) flow from tr join cal on cal.date = tr.session group by all)"""
TRC = chain("frame", "ind", "cal", "idx") + "," + ORD + "," + LIM + "," + ADMIT + "," + EXEC


def moves(ws):
    return op.daily_moves(trades(ws), ws.calendar())


@query("T07_sellable", TRC + "," + MOVES + """,
sb2 as (select agent, ticker, di, greatest(0, coalesce(sum(bought) over (partition by agent, ticker order by di range between unbounded preceding and 2 preceding), 0)
   - coalesce(sum(sold) over (partition by agent, ticker order by di range between unbounded preceding and 1 preceding), 0))::bigint sellable,
   greatest(0, coalesce(sum(bought) over (partition by agent, ticker order by di range between unbounded preceding and 3 preceding), 0)
   - coalesce(sum(sold) over (partition by agent, ticker order by di range between unbounded preceding and 1 preceding), 0))::bigint sellable_at_open from mv)
select * from sb2""")
def sellable(ws):
    """Settled shares per session."""
    return op.sellable(moves(ws))


@query("T08_open_positions", TRC + "," + LOTS + """,
so as (select agent, ticker, sum(shares) s from tr where side = 'SELL' group by all),
rm as (select tb.*, least(shares, greatest(0, upto - coalesce(s, 0)))::bigint lft from tb left join so using (agent, ticker)),
lp as (select ticker, max_by(close, date) last_price from sym group by 1),
op as (select agent, ticker, sum(lft)::bigint qty, sum(lft*price)/sum(lft) avg_cost, min(session) first_buy from rm where lft > 0 group by all),
u as (select op.*, last_price, qty*last_price*1000/1e6 mkt_value, (last_price*(1-0.0015e0-0.001e0) - avg_cost*1.0015e0)*qty*1000/1e6 pnl from op left join lp using (ticker))\n"""
       + report("u", "agent ticker first_buy", "avg_cost last_price mkt_value pnl", "qty"))
def open_positions(ws):
    """What is still held, at cost and at market (millions)."""
    p = op.open_positions(trades(ws), ws.symbols(), ws.cfg)
    return p.withColumns({"mkt_value": F.col("mkt_value") / 1e6, "pnl": F.col("pnl") / 1e6})


NAV = MOVES + """,
fc as (select ticker, unnest(range(di, nx+1)) di, close from (select ticker, di, close, coalesce(lead(di) over (partition by ticker order by di) - 1, (select max(di) from cal)) nx from sym join cal using (date))),
hq as (select agent, ticker, di, sum(bought - sold) over (partition by agent, ticker order by di) q, coalesce(lead(di) over (partition by agent, ticker order by di) - 1, (select max(di) from cal)) nx from mv),
hx as (select agent, ticker, q, unnest(range(di, nx+1)) di from hq where q > 0),
hv as (select agent, di, sum(q*close*1000*(1-0.0015e0-0.001e0)) hv, count(*) n_open from hx left join fc using (ticker, di) group by all),
fw as (select agent, di, sum(flow) flow from mv group by all),
gr as (select agent, unnest(range(min(di), (select max(di) from cal)+1)) di from fw group by agent),
n0 as (select gr.agent, gr.di, cal.date, 1e12 + sum(coalesce(flow, 0)) over (partition by gr.agent order by gr.di) cash, coalesce(hv, 0) hv, coalesce(n_open, 0) n_open
   from gr left join fw using (agent, di) left join hv using (agent, di) join cal using (di)),
nv as (select *, cash + hv nav, cash + hv - coalesce(lag(cash + hv) over (partition by agent order by di), 1e12) pnl_day, (cash+hv)/1e12 - 1 ret_cum from n0)"""


@_stored
def navs(ws: Workspace):
    cal = ws.calendar()
    return materialise(op.nav(moves(ws), op.filled_closes(ws.symbols(), cal), cal, CAPITAL, ws.cfg), "navs")


@query("T09_nav", TRC + "," + NAV + ", u as (select *, cash/1e6 cash_m, nav/1e6 nav_m, pnl_day/1e6 pnl_m from nv)\n" + report("u", "agent date", "cash_m nav_m pnl_m ret_cum", "n_open", 3, ret_cum=6),
       digits=3, ret_cum=6)
def nav(ws):
    """Cash, value and result per agent and session (millions)."""
    return navs(ws).select("agent", "date", (F.col("cash") / 1e6).alias("cash_m"), (F.col("nav") / 1e6).alias("nav_m"), (F.col("pnl_day") / 1e6).alias("pnl_m"), "ret_cum", "n_open")


CURVE = """
nd as (select distinct date from nv),
cu as (select date, 1e12*(1-0.0015e0)/(select min_by(open, date) from idx where date >= (select min(date) from nd)) * last_value(close ignore nulls) over (order by date)*(1-0.0015e0-0.001e0) nav
   from nd left join (select date, close from idx) using (date))"""


def curve(ws):
    return op.index_curve(ws.index(), navs(ws), CAPITAL, ws.cfg)


@query("T10_index_curve", TRC + "," + NAV + "," + CURVE + ", u as (select date, nav/1e6 nav_m from cu)\n" + report("u", "date", "nav_m", digits=3), digits=3)
def index_curve(ws):
    """Buy-and-hold of the index (millions)."""
    return curve(ws).select("date", (F.col("nav") / 1e6).alias("nav_m"))


@query("T11_counterparts", ADM + """,
pl as (select ag.agent, el.session, el.ticker, row_number() over (partition by ag.agent, el.session order by ('0x' || substr(md5('ix|' || el.ticker), 1, 8))::bigint, el.ticker) pos,
   count(*) over (partition by ag.agent, el.session) size from el join ind using (ticker) join ag on ag.industry = ind.industry),
by as (select distinct agent, session, ticker from ad where side = 'BUY'),
bz as (select b.*, ('0x' || substr(md5('pair|' || b.agent || '|' || b.session::varchar || '|' || b.ticker), 1, 8))::bigint % s.size + 1 pos
   from by b join (select distinct agent, session, size from pl) s on s.agent = b.agent and s.session = b.session)
select bz.agent, bz.session, bz.ticker, pl.ticker counterpart from bz join pl on pl.agent = bz.agent and pl.session = bz.session and pl.pos = bz.pos""".replace("by as (", "bys as (").replace("from by b", "from bys b"))
def counterparts(ws):
    """Random name of the same scope for every buy."""
    return op.counterparts(admitted(ws).where("side = 'BUY'"), eligible(ws), ws.industry(), agents(ws), ws.cfg)


@query("T12_scorecard", TRC + "," + SALES + "," + NAV + "," + CURVE + """,
dd as (select agent, nav/max(nav) over (partition by agent order by date)-1 dd from nv),
u as (select n.agent, max_by(nav, date)/1e6 nav_m, max_by(ret_cum, date) ret_cum, (select min(dd) from dd where dd.agent = n.agent) max_drawdown, max_by(cash/nav, date) cash_share,
   (select count(*) from sl where sl.agent = n.agent) closed, (select avg((pnl > 0)::int::double) from sl where sl.agent = n.agent) win_rate,
   (select avg(pnl)/1e6 from sl where sl.agent = n.agent) avg_pnl_m, (select count(*) from tr where tr.agent = n.agent and side = 'BUY') buys,
   max_by(ret_cum, date) - (select max_by(nav, date)/min_by(nav, date)-1 from cu) vs_index from nv n group by n.agent)\n"""
       + report("u", "agent", "nav_m ret_cum max_drawdown cash_share win_rate avg_pnl_m vs_index", "closed buys", nav_m=3), nav_m=3)
def scorecard(ws):
    """Portfolio scorecard."""
    c = op.scorecard(navs(ws), sales(ws), trades(ws), curve(ws))
    return c.select("agent", (F.col("nav") / 1e6).alias("nav_m"), "ret_cum", "max_drawdown", "cash_share", "win_rate", (F.col("avg_pnl") / 1e6).alias("avg_pnl_m"), "vs_index", "closed", "buys")


@query("T13_drawdown", TRC + "," + NAV + """,
dd as (select agent, nav/max(nav) over (partition by agent order by date)-1 dd, n_open from nv), u as (select agent, min(dd) max_drawdown, avg(n_open) avg_open from dd group by 1)\n"""
       + report("u", "agent", "max_drawdown avg_open"))
def drawdown(ws):
    """Deepest fall and mean number of open names."""
    return op.drawdown(navs(ws))


@query("T14_journal", TRC + "," + NAV + """,
fl as (select agent, session, ticker, side, min_by({'status': status, 'shares': case when status = 'filled' then cut end, 'price': price}, o_orderkey) f from re group by all)
select o.agent, o.session, o.ticker, o.side, o_orderkey order_no, case when f is not null then f.status when o.session <= (select max(date) from nv) then 'rejected' else 'pending' end as result,
  f.shares::bigint shares, round(f.price, 6) price from od o left join fl on fl.agent = o.agent and fl.session = o.session and fl.ticker = o.ticker and fl.side = o.side where o.side in ('BUY','SELL')""")
def journal(ws):
    """Result of every order: executed, why not, rejected or pending."""
    last = navs(ws).agg(F.max("date").alias("_last"))
    books = book(ws).crossJoin(F.broadcast(last))           # one row
    return op.journal(books, results(ws), F.col("_last"))


def agent_navs(ws):
    n = navs(ws).groupBy("agent").agg(F.max_by("nav", "date").alias("nav"))
    return agents(ws).select(F.col("id").alias("agent"), "risk_per_trade", "max_weight").join(n, "agent")


@query("T15_ticket_maths", TRC + "," + NAV + """,
an as (select agent, any_value(risk_per_trade) rpt, any_value(max_weight) mw, (select max_by(nav, date) from nv where nv.agent = ag.agent) nav from ag group by agent),
u as (select o.agent, o.session, o.ticker, o_orderkey order_no, stop_loss/lim-1 to_stop, take_profit/lim-1 to_target, (take_profit/lim-1)/(1-stop_loss/lim) reward_risk,
   value_vnd*(lim-stop_loss)/lim/1e6 cash_at_risk, floor(value_vnd/(lim*1000)/100)*100 shares, value_vnd/nav nav_share, least(mw*nav, rpt*nav/((lim-stop_loss)/lim))/1e6 risk_size
   from od o join an using (agent) where side = 'BUY' and type = 'LO')\n""" + report("u", "agent session ticker", "to_stop to_target reward_risk cash_at_risk nav_share risk_size", "order_no shares", risk_size=2, cash_at_risk=9), risk_size=2, cash_at_risk=9)
def ticket_maths(ws):
    """Stop, target, risk and size of limit buys (millions)."""
    t = op.ticket_maths(book(ws).where("side = 'BUY' and type = 'LO'"), agent_navs(ws))
    return t.withColumns({"cash_at_risk": F.col("cash_at_risk") / 1e6, "risk_size": F.col("risk_size") / 1e6})


@query("T16_next_books", chain("sym") + "," + ORD + """,
la as (select agent, date '2001-05-15' + (substr(agent, 2)::int * 30) l from (select distinct agent from od)),
bs as (select agent, session, count(*) filter (side='BUY') n_buy, count(*) filter (side='SELL') n_sell, count(*) filter (side='HOLD') n_hold, count(*) filter (side='WATCH') n_watch from od group by all),
pk as (select agent, coalesce(min(session) filter (session > l), max(session)) session from bs join la using (agent) group by 1)
select bs.* from bs join pk using (agent, session)""")
def next_books(ws):
    """Book of each agent's next session."""
    last = F.date_add(F.lit("2001-05-15").cast("date"), F.substring("agent", 2, 3).cast("int") * 30)
    n = book(ws).select("agent").distinct().select("agent", last.alias("date"))
    return op.next_books(book(ws), n)


BE = EV + """,
ck as (select ticker, di, di+1 e, di+5 x, open_t1 ep, net pnl from ev where system = 'rsi_only'),
pc as (select ticker, di, close from panel join cal using (date)),
bt as (select c.ticker, c.di, min(case when p.close >= ep*(1 + (1.0015e0)/(1-0.0015e0-0.001e0) - 1) then p.di - c.e + 1 end) f, max(pnl) pnl
   from ck c left join pc p on p.ticker = c.ticker and p.di between c.e and c.x group by all),
u as (select count(*) n, avg((f is not null)::int::double) share_reached, median(f) median_session, avg((pnl > 0)::int::double) win_share, avg(pnl) mean_pnl, max(pnl) best, min(pnl) worst from bt)\n"""


@query("T17_break_even", BE + report("u", "", "share_reached median_session win_share mean_pnl best worst", "n"))
def break_even(ws):
    """When closed trades first covered their costs."""
    ev = events(ws, (*EVENTS, "open_t1")).where("system = 'rsi_only'")
    c = ev.select("ticker", (F.col("di") + 1).alias("entry_di"), (F.col("di") + 5).alias("exit_di"), F.col("open_t1").alias("entry_price"), F.col("net").alias("pnl"))
    px = ws.panel().join(F.broadcast(ws.calendar()), "date").select("ticker", "di", "close")
    return op.break_even_report(c, px, ws.cfg)
