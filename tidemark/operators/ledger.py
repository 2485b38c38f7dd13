"""Order fills, admission, lots, positions, NAV, scorecards. Prices are in thousands, amounts in units of money."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.config import Config
from tidemark.functions.draws import draw32
from tidemark.functions.expr import break_even, change, ratio, truth
from tidemark.functions.ranks import add_row_number
from tidemark.functions.running import match_intervals, running_total

LOT = 100
CHUNK = 10_000                   # orders per chunk of a running total


# ---- fills ----
def session_bars(bars: DataFrame, exchanges_limit: DataFrame) -> DataFrame:
    """Bars with the previous close and the ticker's price limit, keyed (ticker, session)."""
    w = Window.partitionBy("ticker").orderBy("date")
    b = bars.select("ticker", F.col("date").alias("session"), "open", "high", "low", "close", F.lag("close").over(w).alias("prev"))
    return b.join(exchanges_limit.select("ticker", F.col("limit").alias("_lim")), "ticker", "left")


def fill_price() -> Column:
    """Auction orders take the open or close; a limit order takes the open when better, else its limit when touched."""
    lo = F.col("limit")
    buy = F.when(F.col("open") <= lo, F.col("open")).when(F.col("low") <= lo, lo)
    sell = F.when(F.col("open") >= lo, F.col("open")).when(F.col("high") >= lo, lo)
    return (F.when(F.col("type") == "ATO", F.col("open")).when(F.col("type") == "ATC", F.col("close"))
             .when(F.col("side") == "BUY", buy).otherwise(sell))


def fill_orders(orders: DataFrame, bars: DataFrame, cfg: Config) -> DataFrame:
    """BUY and SELL orders with fill price and status (bars from session_bars)."""
    o = orders.where(F.col("side").isin("BUY", "SELL")).withColumn("type", F.coalesce("type", F.lit("ATO")))
    j = o.join(bars, ["ticker", "session"], "left").withColumn("price", fill_price())
    lim = F.coalesce("_lim", F.lit(0.07))
    up, down = F.col("prev") * (1 + lim - cfg.near), F.col("prev") * (1 - lim + cfg.near)
    st = (F.when(F.col("open").isNull(), "no_price").when(F.col("price").isNull(), "unfilled_limit")
           .when((F.col("side") == "BUY") & truth(F.col("price") >= up), "unfilled_ceiling")
           .when((F.col("side") == "SELL") & truth(F.col("price") <= down), "unfilled_floor").otherwise("filled"))
    return j.withColumn("status", st).drop("open", "high", "low", "close", "prev", "_lim")


def admit(orders: DataFrame, eligible: DataFrame, industry: DataFrame, agents: DataFrame, open_hour_utc: int = 2) -> DataFrame:
    """Adds reject: late_book (whole book, committed after the deadline), not_eligible, out_of_scope; null when admitted.

    Sales need no universe test. eligible: (ticker, session); agents: id, industries[].
    """
    scope = agents.select(F.col("id").alias("agent"), F.explode("industries").alias("industry")).distinct().withColumn("_scope", F.lit(True))
    j = (orders.join(eligible.select("ticker", "session", F.lit(True).alias("_elig")), ["ticker", "session"], "left")
               .join(industry.select("ticker", "industry"), "ticker", "left")
               .join(scope, ["agent", "industry"], "left"))
    late = F.col("committed_at") > F.col("session").cast("timestamp") + F.make_dt_interval(hours=F.lit(open_hour_utc))
    buy = F.col("side") == "BUY"
    rej = (F.when(truth(late), "late_book").when(buy & F.col("_elig").isNull(), "not_eligible").when(buy & F.col("_scope").isNull(), "out_of_scope"))
    return j.withColumn("reject", rej).drop("_elig", "_scope")


def rejections(admitted: DataFrame) -> DataFrame:
    """One '*' row per late book, one row per other rejected order."""
    late = admitted.where("reject = 'late_book'").select("agent", "session", F.lit("*").alias("ticker"), "reject").distinct()
    return late.unionByName(admitted.where("reject is not null and reject <> 'late_book'").select("agent", "session", "ticker", "reject"))


def order_rank() -> Column:
    """Execution order inside a session: sell at open, buy at open, limit orders, sell at close, buy at close."""
    sell = F.col("side") == "SELL"
    return (F.when(F.col("type") == "ATO", F.when(sell, 0).otherwise(1)).when(F.col("type") == "ATC", F.when(sell, 3).otherwise(4)).otherwise(2))


def add_size(filled: DataFrame, cfg: Config) -> DataFrame:
    """Whole lots a buy order's amount pays for; requested shares of a sale (null for "all"); amount, fee and tax."""
    lots = F.floor(F.col("value_vnd") / (F.col("price") * 1000 * LOT)) * LOT
    df = filled.withColumn("shares", F.when(F.col("side") == "BUY", lots).otherwise(F.col("qty").try_cast("bigint")).cast("long"))
    return add_costs(df, cfg)


def add_costs(df: DataFrame, cfg: Config) -> DataFrame:
    amt = F.col("shares") * F.col("price") * 1000
    return df.withColumns({"amount": amt, "fee": amt * cfg.fee, "tax": F.when(F.col("side") == "SELL", amt * cfg.tax).otherwise(F.lit(0.0))})


def session_positions(orders: DataFrame, calendar: DataFrame) -> DataFrame:
    """(session, di) of the orders' sessions; one without bars stands half a step behind the last session before it (one row per session)."""
    cal = F.broadcast(calendar.select("date", "di"))
    before = orders.select("session").distinct().join(cal, F.col("date") <= F.col("session"), "left").groupBy("session").agg(F.max("date").alias("date"), F.max("di").alias("di"))
    at = F.when(F.col("date") == F.col("session"), F.col("di").cast("double")).otherwise(F.coalesce("di", F.lit(-1)) + 0.5)
    return before.select("session", at.alias("di"))


def settle_sales(sized: DataFrame, calendar: DataFrame, cfg: Config) -> DataFrame:
    """Admitted orders with final status and shares: buys as sized, sales cut to settled shares.

    A share can be sold from the second session after its purchase on, at the open from the third on. So a buy is credited two
    sessions later, behind that session's opening sales, and with the running sum S of signed shares the settled position before a
    row is S minus the smallest S so far (at most 0): the cut needs no loop. "all" stands for everything ever bought of the name.
    A sale without settled shares gets not_sellable_T+2 or, when nothing is held, no_position; a buy too small for a lot no_cash.
    Orders of a session without bars keep their place between the sessions around it.
    Needs order_no and agent, ticker, session; calendar: date, di.
    """
    buy, keys = F.col("side") == "BUY", ["agent", "ticker"]
    ever = sized.where("side = 'BUY' and status = 'filled'").groupBy(*keys).agg(F.sum("shares").alias("_ever"))
    d = sized.join(F.broadcast(session_positions(sized, calendar)), "session", "left").join(ever, keys, "left")
    filled, rank = F.col("status") == "filled", order_rank() * 2
    want = F.when(F.coalesce(F.col("qty") == "all", F.lit(False)), F.coalesce("_ever", F.lit(0))).otherwise(F.coalesce("shares", F.lit(0)))
    d = d.withColumns({"_want": F.when(buy, F.coalesce("shares", F.lit(0))).otherwise(want).cast("long"), "_chunk": F.floor(F.col("order_no") / CHUNK)})
    d = d.withColumns({"_at": F.when(buy, F.col("di") + 2).otherwise(F.col("di")), "_rank": F.when(buy, F.lit(1)).otherwise(rank),
                       "_x": F.when(filled, F.when(buy, F.col("_want")).otherwise(-F.col("_want"))).otherwise(0).cast("long")})
    d = running_total(d, keys, ["_at", "_rank", "_chunk"], ["order_no"], "_x", "_s", "_low")
    d = d.withColumn("_cut", F.when(buy, F.col("_want")).otherwise(F.least("_want", F.col("_s") - F.col("_x") - F.col("_low"))))
    d = d.withColumns({"_at": F.col("di"), "_rank": rank, "_x": F.when(filled, F.when(buy, F.col("_cut")).otherwise(-F.col("_cut"))).otherwise(0).cast("long")})
    d = running_total(d, keys, ["_at", "_rank", "_chunk"], ["order_no"], "_x", "_s")
    empty = F.col("_cut") <= 0
    status = (F.when(~buy & empty, F.when(F.col("_s") > 0, "not_sellable_T+2").otherwise("no_position"))
               .when(buy & filled & empty, "no_cash").otherwise(F.col("status")))
    d = d.withColumns({"status": status, "shares": F.when(status == "filled", F.col("_cut"))})
    return add_costs(d, cfg).drop("_ever", "_want", "_chunk", "_at", "_rank", "_x", "_s", "_low", "_cut", "di")


def execute(sized: DataFrame, calendar: DataFrame, cfg: Config) -> DataFrame:
    """Ledger of executed orders."""
    return settle_sales(sized, calendar, cfg).where("status = 'filled'")


# ---- lots ----
def _ends(trades: DataFrame, side: str) -> DataFrame:
    d = trades.where(F.col("side") == side).withColumns({"_rank": order_rank(), "_chunk": F.floor(F.col("order_no") / CHUNK)})
    return running_total(d, ["agent", "ticker"], ["session", "_rank", "_chunk"], ["order_no"], "shares", "upto").drop("_rank", "_chunk")


def fifo_lots(trades: DataFrame) -> DataFrame:
    """(agent, ticker, sell, buy, qty, prices): every sold share matched to the oldest lot still held."""
    buys = _ends(trades, "BUY").select("agent", "ticker", "upto", F.col("order_no").alias("buy_no"), F.col("price").alias("buy_price"), F.col("session").alias("buy_session"))
    sells = _ends(trades, "SELL").select("agent", "ticker", "upto", F.col("order_no").alias("sell_no"), F.col("price").alias("sell_price"), F.col("session").alias("sell_session"))
    return match_intervals(buys, sells, ["agent", "ticker"], ["buy_no", "buy_price", "buy_session"], ["sell_no", "sell_price", "sell_session"])


def sale_results(trades: DataFrame, lots: DataFrame, cfg: Config) -> DataFrame:
    """Sales with cost and pnl = amount - fee - tax - cost * (1 + fee)."""
    cost = lots.groupBy("agent", "ticker", "sell_no").agg(F.sum(F.col("qty") * F.col("buy_price") * 1000).alias("cost"))
    s = trades.where("side = 'SELL'").withColumnRenamed("order_no", "sell_no").join(cost, ["agent", "ticker", "sell_no"])
    return s.withColumn("pnl", F.col("amount") - F.col("fee") - F.col("tax") - F.col("cost") * (1 + cfg.fee))


def daily_moves(trades: DataFrame, calendar: DataFrame) -> DataFrame:
    """(agent, ticker, di): shares bought and sold and cash flow of the session; bounds later windows by the calendar."""
    t = trades.join(F.broadcast(calendar.select(F.col("date").alias("session"), "di")), "session")
    buy = F.col("side") == "BUY"
    flow = F.when(buy, -(F.col("amount") + F.col("fee"))).otherwise(F.col("amount") - F.col("fee") - F.col("tax"))
    return t.groupBy("agent", "ticker", "di").agg(F.sum(F.when(buy, F.col("shares")).otherwise(0)).alias("bought"),
                                                  F.sum(F.when(~buy, F.col("shares")).otherwise(0)).alias("sold"), F.sum(flow).alias("cash_flow"))


def sellable(moves: DataFrame) -> DataFrame:
    """Per (agent, ticker, di): shares that may be sold at that session (bought two sessions ago; three at the open)."""
    w = Window.partitionBy("agent", "ticker").orderBy("di")
    upto = lambda k: F.coalesce(F.sum("bought").over(w.rangeBetween(Window.unboundedPreceding, -k)), F.lit(0))
    gone = F.coalesce(F.sum("sold").over(w.rangeBetween(Window.unboundedPreceding, -1)), F.lit(0))
    zero = F.lit(0).cast("long")
    return moves.select("agent", "ticker", "di", F.greatest(zero, upto(2) - gone).alias("sellable"), F.greatest(zero, upto(3) - gone).alias("sellable_at_open"))


def open_positions(trades: DataFrame, bars: DataFrame, cfg: Config) -> DataFrame:
    """Remaining lots per (agent, ticker): shares, average cost, last price, market value, pnl, first buy."""
    sold = trades.where("side = 'SELL'").groupBy("agent", "ticker").agg(F.sum("shares").alias("_sold"))
    b = _ends(trades, "BUY").join(sold, ["agent", "ticker"], "left")
    left = F.least(F.col("shares"), F.greatest(F.lit(0), F.col("upto") - F.coalesce("_sold", F.lit(0))))
    b = b.withColumn("left", left).where("left > 0")
    p = b.groupBy("agent", "ticker").agg(F.sum("left").alias("qty"), (F.sum(F.col("left") * F.col("price")) / F.sum("left")).alias("avg_cost"), F.min("session").alias("first_buy"))
    last = bars.groupBy("ticker").agg(F.max_by("close", "date").alias("last_price"))
    p = p.join(last, "ticker", "left")
    return p.withColumns({"mkt_value": F.col("qty") * F.col("last_price") * 1000,
                          "pnl": (F.col("last_price") * (1 - cfg.fee - cfg.tax) - F.col("avg_cost") * (1 + cfg.fee)) * F.col("qty") * 1000})


def filled_closes(bars: DataFrame, calendar: DataFrame) -> DataFrame:
    """(ticker, di, close) for every session from a ticker's first bar on, carrying the last close over gaps."""
    w = Window.partitionBy("ticker").orderBy("di")
    end = calendar.select(F.max("di")).scalar()
    b = bars.select("ticker", "date", "close").join(F.broadcast(calendar), "date").withColumn("_next", F.coalesce(F.lead("di").over(w) - 1, end))
    return b.select("ticker", F.explode(F.sequence("di", "_next")).alias("di"), "close")


def nav(moves: DataFrame, closes: DataFrame, calendar: DataFrame, capital: float, cfg: Config) -> DataFrame:
    """(agent, date): cash, nav, pnl_day, ret_cum, open names. Holdings are valued at what a sale would bring."""
    w = Window.partitionBy("agent", "ticker").orderBy("di")
    end = calendar.select(F.max("di")).scalar()
    held = moves.withColumns({"q": F.sum(F.col("bought") - F.col("sold")).over(w), "_next": F.coalesce(F.lead("di").over(w) - 1, end)}).where("q > 0")
    held = held.select("agent", "ticker", "q", F.explode(F.sequence("di", "_next")).alias("di"))
    value = (held.join(closes, ["ticker", "di"], "left").groupBy("agent", "di")
                 .agg(F.sum(F.col("q") * F.col("close") * 1000 * (1 - cfg.fee - cfg.tax)).alias("held_value"), F.count(F.lit(1)).alias("n_open")))
    flow = moves.groupBy("agent", "di").agg(F.sum("cash_flow").alias("flow"))
    first = flow.groupBy("agent").agg(F.min("di").alias("d0"))
    grid = first.withColumn("di", F.explode(F.sequence("d0", end))).drop("d0")
    d = Window.partitionBy("agent").orderBy("di")          # one row per session
    n = grid.join(flow, ["agent", "di"], "left").join(value, ["agent", "di"], "left").join(F.broadcast(calendar), "di")
    n = n.withColumn("cash", capital + F.sum(F.coalesce("flow", F.lit(0.0))).over(d))
    n = n.withColumn("nav", F.col("cash") + F.coalesce("held_value", F.lit(0.0)))
    return n.select("agent", "date", "di", "cash", "nav", (F.col("nav") - F.coalesce(F.lag("nav").over(d), F.lit(capital))).alias("pnl_day"),
                    (F.col("nav") / capital - 1).alias("ret_cum"), F.coalesce("n_open", F.lit(0)).alias("n_open"))


def index_curve(index: DataFrame, dates: DataFrame, capital: float, cfg: Config) -> DataFrame:
    """Buy at the first date's open, value at the last close known on each date."""
    first = dates.select(F.min("date")).scalar()
    units = index.where(F.col("date") >= first).select(F.min_by("open", "date")).scalar()
    w = Window.orderBy("date")                              # one row per session
    u = dates.select("date").distinct().join(index.select("date", "close"), "date", "left")
    c = F.last("close", ignorenulls=True).over(w)
    return u.select("date", (F.lit(capital) * (1 - cfg.fee) / units * c * (1 - cfg.fee - cfg.tax)).alias("nav"))


def counterparts(buys: DataFrame, eligible: DataFrame, industry: DataFrame, agents: DataFrame, cfg: Config) -> DataFrame:
    """For every buy one eligible name of the agent's scope, drawn by a hash of (agent, session, ticker)."""
    scope = agents.select(F.col("id").alias("agent"), F.explode("industries").alias("industry")).distinct()
    pool = (eligible.select("ticker", "session").join(industry.select("ticker", "industry"), "ticker").join(scope, "industry")
                    .withColumn("_h", draw32("ix", F.col("ticker")).cast("double")))
    pool = add_row_number(pool, ["agent", "session"], "_h", "ticker", "pos", "size", cfg.split)
    size = pool.groupBy("agent", "session").agg(F.max("size").alias("size"))
    b = buys.select("agent", "session", "ticker").distinct().join(size, ["agent", "session"])
    b = b.withColumn("pos", F.pmod(draw32("pair", F.col("agent"), F.date_format("session", "yyyy-MM-dd"), F.col("ticker")), F.col("size")) + 1)
    return b.join(pool.select("agent", "session", "pos", F.col("ticker").alias("counterpart")), ["agent", "session", "pos"]).select("agent", "session", "ticker", "counterpart")


# ---- reports ----
def scorecard(navs: DataFrame, sales: DataFrame, trades: DataFrame, index_nav: DataFrame) -> DataFrame:
    """Per agent: last nav, return, drawdown, closed sales, win rate, mean pnl, edge over the index, buys, cash share."""
    w = Window.partitionBy("agent").orderBy("date")
    n = navs.withColumn("_dd", F.col("nav") / F.max("nav").over(w) - 1)
    last = n.groupBy("agent").agg(F.max_by("nav", "date").alias("nav"), F.max_by("ret_cum", "date").alias("ret_cum"), F.least(F.min("_dd"), F.lit(0.0)).alias("max_drawdown"),
                                  F.max_by(F.col("cash") / F.col("nav"), F.col("date")).alias("cash_share"))
    closed = sales.groupBy("agent").agg(F.count(F.lit(1)).alias("closed"), F.avg((F.col("pnl") > 0).cast("double")).alias("win_rate"), F.avg("pnl").alias("avg_pnl"))
    buys = trades.where("side = 'BUY'").groupBy("agent").agg(F.count(F.lit(1)).alias("buys"))
    bench = index_nav.select(change(F.max_by("nav", "date"), F.min_by("nav", "date"))).scalar()
    cards = last.join(closed, "agent", "left").join(buys, "agent", "left")
    return cards.fillna(0, ["closed", "buys"]).withColumn("vs_index", F.col("ret_cum") - bench)


def vs_counterpart(cards: DataFrame, partner_cards: DataFrame) -> DataFrame:
    """Return of each agent minus that of its random counterpart."""
    p = partner_cards.select("agent", F.col("ret_cum").alias("_p"))
    return cards.join(p, "agent", "left").select("agent", "ret_cum", (F.col("ret_cum") - F.col("_p")).alias("vs_counterpart"))


def drawdown(navs: DataFrame) -> DataFrame:
    """Per agent: deepest fall from a running peak and mean number of open names."""
    w = Window.partitionBy("agent").orderBy("date")
    d = navs.select("agent", (F.col("nav") / F.max("nav").over(w) - 1).alias("dd"), "n_open")
    return d.groupBy("agent").agg(F.min("dd").alias("max_drawdown"), F.avg("n_open").alias("avg_open"))


def journal(orders: DataFrame, ledger: DataFrame, last_session: Column) -> DataFrame:
    """Every BUY/SELL order with its result: filled, the reason it was not, rejected, or pending."""
    keys = ["agent", "session", "ticker", "side"]
    first = ledger.groupBy(*keys).agg(F.min_by(F.struct("status", "shares", "price"), "order_no").alias("f"))
    j = orders.where(F.col("side").isin("BUY", "SELL")).join(first, keys, "left")
    res = F.when(F.col("f").isNotNull(), F.col("f.status")).when(F.col("session") <= last_session, "rejected").otherwise("pending")
    return j.select(*keys, "order_no", res.alias("result"), F.col("f.shares").alias("shares"), F.col("f.price").alias("price"))


def ticket_maths(buys: DataFrame, navs: DataFrame) -> DataFrame:
    """Distances to stop and target, reward to risk, cash at risk, whole-lot shares, share of NAV, risk-based size.

    navs: agent, nav, risk_per_trade, max_weight.
    """
    j = buys.join(navs, "agent")
    e, sl, tp, v = F.col("limit"), F.col("stop_loss"), F.col("take_profit"), F.col("value_vnd")
    stop, goal = change(sl, e), change(tp, e)
    both = (stop < 0) & (goal > 0)
    return j.select("agent", "session", "ticker", "order_no", stop.alias("to_stop"), goal.alias("to_target"), F.when(both, goal / -stop).alias("reward_risk"),
                    (v * (e - sl) / e).alias("cash_at_risk"), (F.floor(v / (e * 1000) / LOT) * LOT).cast("long").alias("shares"), ratio(v, F.col("nav")).alias("nav_share"),
                    F.least(F.col("max_weight") * F.col("nav"), ratio(F.col("risk_per_trade") * F.col("nav"), (e - sl) / e)).alias("risk_size"))


def next_books(orders: DataFrame, navs: DataFrame) -> DataFrame:
    """Per agent the earliest session after its last NAV date, else its latest; counts by side."""
    last = navs.groupBy("agent").agg(F.max("date").alias("_last"))
    by_s = orders.groupBy("agent", "session").agg(*[F.count_if(F.col("side") == s).alias(f"n_{s.lower()}") for s in ("BUY", "SELL", "HOLD", "WATCH")])
    j = by_s.join(last, "agent", "left").withColumn("_after", F.coalesce(F.col("session") > F.col("_last"), F.lit(True)))
    pick = j.groupBy("agent").agg(F.coalesce(F.min(F.when(F.col("_after"), F.col("session"))), F.max("session")).alias("session"))
    return by_s.join(pick, ["agent", "session"], "left_semi")


def break_even_report(closed: DataFrame, closes: DataFrame, cfg: Config) -> DataFrame:
    """closed: ticker, entry_di, exit_di, entry_price, pnl. First held session whose close covers the costs, and totals.

    A trade is joined to its own sessions only (equality on ticker and session number).
    """
    k = closed.withColumn("trade", F.concat_ws("|", "ticker", F.col("entry_di").cast("string"))).withColumn("di", F.explode(F.sequence("entry_di", "exit_di")))
    hit = F.when(F.col("close") >= F.col("entry_price") * (1 + break_even(cfg)), F.col("di") - F.col("entry_di") + 1)
    t = k.join(closes, ["ticker", "di"], "left").groupBy("trade").agg(F.min(hit).alias("first"), F.max("pnl").alias("pnl"))
    return t.agg(F.count(F.lit(1)).alias("n"), F.avg(F.col("first").isNotNull().cast("double")).alias("share_reached"),
                 F.percentile("first", 0.5).alias("median_session"), F.avg((F.col("pnl") > 0).cast("double")).alias("win_share"),
                 F.avg("pnl").alias("mean_pnl"), F.max("pnl").alias("best"), F.min("pnl").alias("worst"))
