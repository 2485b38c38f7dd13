"""Market brief and dashboard aggregations. Tables keyed by date hold one row per session."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.config import Config
from tidemark.functions.ewm import smooth
from tidemark.functions.expr import NOISE, change, last_rows, ratio, truth
from tidemark.operators.features import add_position, index_outlook

WINDOW = 20         # fixed value: dates of the rolling health window


def market_overview(index: DataFrame, cfg: Config) -> DataFrame:
    """Index close, change over 1/5/20 sessions, distance to EMA50/EMA200 on the last date."""
    return last_rows(index_outlook(index, cfg))


def breadth_brief(bars: DataFrame, cfg: Config) -> DataFrame:
    """Last date: advancers, decliners, unchanged, share above EMA50, traded value against the 20 dates before."""
    w = Window.partitionBy("ticker").orderBy("date")
    b = add_position(bars).withColumn("r", change(F.col("close"), F.lag("close").over(w)))
    b = smooth(b, "ticker", "date", [("ema50", "close", 2.0 / 51, 50)])
    day = b.groupBy("date").agg(F.count_if(F.col("r") > 0).alias("advancers"), F.count_if(F.col("r") < 0).alias("decliners"), F.count_if(F.col("r") == 0).alias("unchanged"),
                                F.avg(truth(F.col("close") > F.col("ema50")).cast("double")).alias("above_ema50"), F.sum(F.col("close") * F.col("volume") * 1000).alias("_v"))
    past = Window.orderBy("date").rowsBetween(-20, -1)
    return last_rows(day.withColumn("value_ratio", ratio("_v", F.avg("_v").over(past)))).drop("_v")


def health_window(ev: DataFrame, back_from: int = WINDOW - 1, back_to: int = 0, suffix: str = "") -> DataFrame:
    """Rolling means over the rows [-back_from, -back_to] of the evaluation with twice the standard error."""
    w = Window.orderBy("data_date").rowsBetween(-back_from, -back_to)
    has = F.col("tn07_net").isNotNull()
    e = ev.withColumns({"_ex": F.col("tn07_net") - F.col("market_net"), "_li": F.when(has, F.col("tn07_hit") - F.col("pool_hit")),
                        "_ca": F.when(has, F.col("pred_mean") - F.col("tn07_hit"))})
    se = lambda c: F.when(F.count(c).over(w) > 1, 2 * F.stddev_samp(c).over(w) / F.sqrt(F.count(c).over(w)))
    out = {"n": F.count(F.lit(1)).over(w), "mean_ic": F.avg("ic").over(w), "ic_noise": se("ic"), "excess": F.avg("_ex").over(w), "excess_noise": se("_ex"),
           "lift": F.avg("_li").over(w), "calib": F.avg("_ca").over(w)}
    return e.withColumns({k + suffix: v for k, v in out.items()}).drop("_ex", "_li", "_ca")


def health_state(n: Column, ic: Column, excess: Column, calib: Column) -> Column:
    """na below 20 dates; bad when both fail; watch when one fails or calibration is off by over 0.15; else ok."""
    a, b = ic <= NOISE, excess <= NOISE
    return F.when(n < WINDOW, "na").when(a & b, "bad").when(truth(a) | truth(b) | truth(F.abs(calib) > 0.15), "watch").otherwise("ok")


def add_health_state(h: DataFrame) -> DataFrame:
    return h.withColumn("state", health_state(F.col("n"), F.col("mean_ic"), F.col("excess"), F.col("calib")))


def _direction(cur: Column, prev: Column, noise: Column, near_zero: bool = False) -> Column:
    u, v = (-F.abs(cur), -F.abs(prev)) if near_zero else (cur, prev)
    return F.when(cur.isNull() | prev.isNull(), "none").when(F.abs(u - v) < F.coalesce(noise, F.lit(0.0)), "flat").when(u > v, "up").otherwise("down")


def health_trend(ev: DataFrame) -> DataFrame:
    """Current 20 dates against the 20 before: flat inside the noise, else up or down."""
    h = health_window(health_window(ev), 2 * WINDOW - 1, WINDOW, "_prev")
    c = F.col
    return h.select("data_date", _direction(c("mean_ic"), c("mean_ic_prev"), c("ic_noise")).alias("ic_trend"),
                    _direction(c("excess"), c("excess_prev"), c("excess_noise")).alias("excess_trend"), _direction(c("lift"), c("lift_prev"), F.lit(0.05)).alias("lift_trend"),
                    _direction(c("calib"), c("calib_prev"), F.lit(0.05), True).alias("calib_trend"))


def edge_curves(ev: DataFrame) -> DataFrame:
    """Cumulative edge of the top basket (a fifth of capital a day) and of events (a tenth per trade)."""
    w = Window.orderBy("data_date").rowsBetween(Window.unboundedPreceding, 0)
    top = F.coalesce((F.col("tn07_net") - F.col("market_net")) / 5, F.lit(0.0))
    evt = F.when(F.col("tn06r_n") > 0, F.col("tn06r_n") * (F.col("tn06r_net") - F.col("market_net")) / 10).otherwise(F.lit(0.0))
    return ev.select("data_date", F.sum(top).over(w).alias("cum_top"), F.sum(F.coalesce(evt, F.lit(0.0))).over(w).alias("cum_event"))


def track_curves(daily: DataFrame) -> DataFrame:
    w = Window.orderBy("data_date").rowsBetween(Window.unboundedPreceding, 0)
    return daily.select("data_date", F.sum("avg_net").over(w).alias("cum_net"), F.sum("avg_excess").over(w).alias("cum_excess"))


def live_tiles(ev: DataFrame) -> DataFrame:
    has, sig = F.col("tn07_net").isNotNull(), F.col("tn06r_n") > 0
    n6 = F.sum(F.when(sig, F.col("tn06r_n")))
    return ev.agg(F.count(F.lit(1)).alias("n_days"), F.count_if(F.col("source") == "live").alias("n_live"), F.avg("ic").alias("ic_mean"),
                  F.avg(F.when(F.col("ic").isNotNull(), (F.col("ic") > NOISE).cast("double"))).alias("ic_pos"), F.avg(F.col("tn07_net") - F.col("market_net")).alias("vs_market"),
                  F.avg(F.col("tn07_net") - F.col("pool_net")).alias("vs_random"), F.avg(F.when(has, F.col("pred_mean"))).alias("pred"), F.avg(F.when(has, F.col("tn07_hit"))).alias("hit"),
                  F.coalesce(n6, F.lit(0)).alias("n_events"), (F.sum(F.when(sig, F.col("tn06r_n") * F.col("tn06r_net"))) / n6).alias("event_net"),
                  (F.sum(F.when(sig, F.col("tn06r_n") * (F.col("tn06r_net") - F.col("market_net")))) / n6).alias("event_vs_market"))


def watch_list(log: DataFrame, cfg: Config, n: int = 8) -> DataFrame:
    """Names with low RSI on the last date: streak over the last three dates, volume flag, score; best n."""
    days = log.select("data_date").distinct().orderBy(F.desc("data_date")).limit(3)
    days = days.withColumn("k", F.row_number().over(Window.orderBy(F.desc("data_date"))) - 1)          # three rows
    low = log.join(F.broadcast(days), "data_date").where(F.col("rsi14") < cfg.rsi_max)
    at = lambda k, c: F.max(F.when(F.col("k") == k, F.col(c)))
    g = low.groupBy("ticker").agg(at(0, "rsi14").alias("rsi14"), at(0, "vol_ratio20").alias("vol_ratio20"), at(1, "rsi14").isNotNull().alias("_b"), at(2, "rsi14").isNotNull().alias("_c"))
    g = g.where("rsi14 is not null").withColumns({"streak": F.when(F.col("_b") & F.col("_c"), 3).when(F.col("_b"), 2).otherwise(1),
                                                  "volume_ok": truth(F.col("vol_ratio20") >= cfg.vol_min)})
    g = g.withColumn("score", F.col("streak") + F.col("volume_ok").cast("int")).drop("_b", "_c")
    return g.orderBy(F.desc("score"), "rsi14", "ticker").limit(n)


def ticker_lookup(log: DataFrame, scores: DataFrame, ticker: Column, n_pred: int = 120, n_score: int = 60) -> DataFrame:
    """Latest predictions of a ticker with the score table's values where the prediction has none."""
    p = log.where(F.col("ticker") == ticker).orderBy(F.desc("data_date")).limit(n_pred)
    s = scores.where(F.col("ticker") == ticker).withColumnRenamed("date", "data_date").orderBy(F.desc("data_date")).limit(n_score)
    both = [c for c in ("close", "p_up_5", "value_score", "regime", "trend_score") if c in s.columns]
    s = s.select("data_date", *[F.col(c).alias(f"_{c}") for c in both], "atr14_pct", "liq20", "exch")
    j = p.join(s, "data_date", "left").withColumns({c: F.coalesce(c, f"_{c}") for c in both})
    return j.drop(*[f"_{c}" for c in both])


def ticker_overview(log: DataFrame, cfg: Config, n: int = 120) -> DataFrame:
    """Per ticker over its latest n predictions: changes, range, low-RSI streak, picks, settled results."""
    w = Window.partitionBy("ticker").orderBy(F.desc("data_date"))
    r = log.withColumn("i", F.row_number().over(w)).where(F.col("i") <= n)
    at = lambda k: F.max(F.when(F.col("i") == k, F.col("close")))
    done = F.col("status") == "settled"
    fail = F.min(F.when(~truth(F.col("rsi14") < cfg.rsi_max), F.col("i")))
    g = r.groupBy("ticker").agg(
        F.max("data_date").alias("data_date"), at(1).alias("close"), *[change(at(1), at(k + 1)).alias(f"chg{k}") for k in (1, 5, 20)],
        F.min("close").alias("lo"), F.max("close").alias("hi"), (F.coalesce(fail, F.count(F.lit(1)) + 1) - 1).alias("low_rsi_streak"),
        F.count_if("tn07_pick").alias("n_picked"), F.count(F.lit(1)).alias("n_rows"), F.count_if(done).alias("n_settled"),
        F.avg(F.when(done, F.col("net"))).alias("mean_net"), F.avg(F.when(done, (F.col("net") > 0).cast("double"))).alias("win_share"))
    return g.withColumn("pos_in_range", ratio(F.col("close") - F.col("lo"), F.col("hi") - F.col("lo")))


def add_business_days(date: Column, n: int) -> Column:
    """n-th weekday after the date."""
    if n == 0:
        return date
    days = F.sequence(F.date_add(date, 1), F.date_add(date, n + 2 * (n // 5 + 1)))
    return F.element_at(F.filter(days, lambda d: ~F.dayofweek(d).isin(1, 7)), n)


def paper_trades(log: DataFrame, calendar: DataFrame, cfg: Config) -> DataFrame:
    """Event signals as trades as of the calendar's last session: planned, open (sessions_left) or closed (pnl)."""
    last = calendar.select(F.max("di")).scalar()
    t = log.where("tn06r_signal").join(F.broadcast(calendar.withColumnRenamed("date", "data_date")), "data_date")
    left = F.col("di") + cfg.horizon - last
    st = F.when(F.col("di") == last, "planned").when(left > 0, "open").when(F.col("status") == "unfilled_ceiling", "skipped_ceiling").otherwise("closed")
    return t.select("ticker", "data_date", st.alias("status"), F.when(st == "open", left).alias("sessions_left"), F.when(st == "closed", F.col("net")).alias("pnl"))


def plan_split(trades: DataFrame) -> DataFrame:
    """Counts of planned, due (last session), hold and closed trades; win share and mean result of the closed ones."""
    b = (F.when(F.col("status") == "planned", "planned").when((F.col("status") == "open") & (F.col("sessions_left") <= 1), "due")
          .when(F.col("status") == "open", "hold").when(F.col("status") == "closed", "closed"))
    t = trades.withColumn("bucket", b).where("bucket is not null")
    return t.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.avg((F.col("pnl") > 0).cast("double")).alias("win_share"), F.avg("pnl").alias("mean_pnl"))


def latest_run(log: DataFrame, scores: DataFrame, ev: DataFrame) -> DataFrame:
    """Last prediction, score and evaluation dates, rows on the last date, rows open for over 11 days."""
    last = log.select(F.max("data_date")).scalar()
    return log.agg(F.max("data_date").alias("last_prediction"), F.count_if(F.col("data_date") == last).alias("rows_last_date"),
                   F.count_if((F.col("status") == "open") & (F.col("data_date") < F.date_sub(last, 11))).alias("n_stuck"), F.count_if(F.col("status") == "open").alias("n_open")) \
              .withColumns({"last_score": scores.select(F.max("date")).scalar(), "last_evaluation": ev.select(F.max("data_date")).scalar()})


def health_samples(ev: DataFrame) -> DataFrame:
    """Window statistics of the last, the previous and the first 20 evaluated dates."""
    w = Window.orderBy("data_date")
    h = health_window(ev).withColumn("i", F.row_number().over(w)).withColumn("m", F.count(F.lit(1)).over(Window.partitionBy()))
    tag = F.array_compact(F.array(F.when(F.col("i") == F.col("m"), "last"), F.when(F.col("i") == F.col("m") - WINDOW, "previous"), F.when(F.col("i") == WINDOW, "first")))
    return h.withColumn("sample", F.explode(tag)).select("sample", "data_date", "n", "mean_ic", "ic_noise", "excess", "excess_noise", "lift", "calib")


def leaderboard(navs: DataFrame) -> DataFrame:
    """Portfolios of the last date by cumulative return."""
    return last_rows(navs).select("agent", "date", "ret_cum", F.rank().over(Window.orderBy(F.desc("ret_cum"))).alias("place"))    # one row per portfolio
