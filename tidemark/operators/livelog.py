"""Append-only prediction log, settlement, live evaluation, signal log, rollback."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.config import Config
from tidemark.functions.expr import NOISE, truth
from tidemark.functions.ranks import add_min_ranks, add_pct_ranks
from tidemark.operators.events import add_conditions, cooldown

# Log columns.
PRED = ["data_date", "ticker", "source", "model_version", "industry", "close", "p_up_5", "p_lr", "rank_all", "value_top30", "value_score",
        "regime", "trend_score", "tn07_pick", "rsi14", "vol_ratio20", "tn06r_regime_on", "tn06r_signal"]
ACT = ["status", "real", "net", "y_bin", "settled_on"]
DESC = ["industry", "value_score", "regime", "trend_score"]
LOG_SCHEMA = ("data_date date, ticker string, source string, model_version string, industry string, close double, p_up_5 double, p_lr double, "
              "rank_all bigint, value_top30 boolean, value_score double, regime string, trend_score double, tn07_pick boolean, rsi14 double, "
              "vol_ratio20 double, tn06r_regime_on boolean, tn06r_signal boolean, status string, real double, net double, y_bin double, settled_on date")


def empty_log(spark) -> DataFrame:
    return spark.createDataFrame([], LOG_SCHEMA)


def backfill_dates(scored: DataFrame, log: DataFrame, test_start: str) -> DataFrame:
    """Dates from the test start up to, not including, the last one that the log does not hold yet."""
    d = scored.select("date").distinct().where(F.col("date") >= F.lit(test_start).cast("date"))
    d = d.where(F.col("date") < scored.select(F.max("date")).scalar())
    return d.join(log.select(F.col("data_date").alias("date")).distinct(), "date", "left_anti")


def record(log: DataFrame, scored: DataFrame, picks: DataFrame, dates: DataFrame, switch: DataFrame, calendar: DataFrame, cfg: Config,
           source: str, quarantine: DataFrame | None = None) -> DataFrame:
    """Log plus one row per name for every wanted date not logged before; logged predictions never change.

    A quarantined name's signal is stored as false but still starts its cooldown within the batch.
    """
    want = dates.select("date").distinct().join(log.select(F.col("data_date").alias("date")).distinct(), "date", "left_anti")
    back = F.explode(F.array(*[F.col("di") - k for k in range(3)])).alias("di")             # the conditions look two sessions back
    near = want.join(calendar, "date").select(back).distinct().join(calendar, "di").select("date")
    f = add_conditions(scored.join(F.broadcast(near), "date", "left_semi"), calendar, switch, cfg)
    f = f.join(F.broadcast(want), "date", "left_semi")                                      # sessions only
    prior = (log.where("tn06r_signal").select("ticker", F.col("data_date").alias("date")).join(F.broadcast(calendar), "date")
                .groupBy("ticker").agg(F.max("di").alias("last")))
    hits = cooldown(f.where("cond_cap and regime_on").select("ticker", "date", "di"), cfg, prior=prior)
    f = f.join(hits.select("ticker", "date", F.lit(True).alias("_hit")), ["ticker", "date"], "left")
    if quarantine is not None:
        f = f.join(quarantine.select("ticker", F.lit(True).alias("_bad")).distinct(), "ticker", "left")
    else:
        f = f.withColumn("_bad", F.lit(None).cast("boolean"))
    f = f.join(picks.select("ticker", "date", F.lit(True).alias("_pick")), ["ticker", "date"], "left")
    f = add_min_ranks(f, ["date"], {"rank_all": ("p_up_5", False)}, cfg.split)
    new = f.select(
        F.col("date").alias("data_date"), "ticker", F.lit(source).alias("source"), F.lit(cfg.model_version).alias("model_version"),
        "industry", "close", "p_up_5", "p_lr", "rank_all", "value_top30", "value_score", "regime", "trend_score",
        truth(F.col("_pick")).alias("tn07_pick"), "rsi14", "vol_ratio20", F.col("regime_on").alias("tn06r_regime_on"),
        (truth(F.col("_hit")) & ~truth(F.col("_bad"))).alias("tn06r_signal"), F.lit("open").alias("status"),
        *[F.lit(None).cast("double").alias(c) for c in ("real", "net", "y_bin")], F.lit(None).cast("date").alias("settled_on"))
    return log.unionByName(new)


def fill_descriptive(log: DataFrame, scored: DataFrame) -> DataFrame:
    """Descriptive columns of rows that have no regime yet; predictions stay as they are."""
    src = scored.select(F.col("date").alias("data_date"), "ticker", *[F.col(c).alias(f"_{c}") for c in DESC], F.lit(True).alias("_known"))
    j = log.join(src, ["data_date", "ticker"], "left")
    fill = F.col("regime").isNull() & truth(F.col("_known"))
    return j.withColumns({c: F.when(fill, F.col(f"_{c}")).otherwise(F.col(c)) for c in DESC}).select(*log.columns)


def settle(log: DataFrame, outcomes: DataFrame, last_date, cfg: Config) -> DataFrame:
    """Open rows whose outcome is known get it; a ceiling gap marks them unfilled but keeps the values."""
    src = outcomes.select(F.col("date").alias("data_date"), "ticker", F.col("real").alias("_r"), F.col("net").alias("_n"),
                          F.col("y_bin").alias("_y"), F.col("buyable").alias("_b"))
    j = log.join(src, ["data_date", "ticker"], "left")
    hit = (F.col("status") == "open") & F.col("_r").isNotNull()
    return j.withColumns({
        "real": F.when(hit, F.col("_r")).otherwise(F.col("real")), "net": F.when(hit, F.col("_n")).otherwise(F.col("net")),
        "y_bin": F.when(hit, F.col("_y")).otherwise(F.col("y_bin")),
        "settled_on": F.when(hit, last_date).otherwise(F.col("settled_on")),
        "status": F.when(hit & ~F.col("_b"), "unfilled_ceiling").when(hit, "settled").otherwise(F.col("status"))}).select(*log.columns)


def evaluate(log: DataFrame, cfg: Config) -> DataFrame:
    """One row per prediction date with settled rows."""
    s = log.where("status in ('settled', 'unfilled_ceiling')")
    s = s.withColumns({"_p": F.when(F.col("status") == "settled", F.col("p_up_5")), "_x": F.when(F.col("status") == "settled", F.col("real"))})
    s = add_pct_ranks(s, ["data_date"], {"_q": ("_p", True), "_rx": ("_x", True)}, cfg.split, ("ticker", "data_date"))
    fill = F.col("status") == "settled"
    pool, pick, sig = fill & F.col("value_top30"), fill & F.col("tn07_pick"), fill & F.col("tn06r_signal")
    avg = lambda c, x: F.avg(F.when(c, F.col(x)))
    n = F.count_if(fill)
    ev = s.groupBy("data_date").agg(
        F.min("source").alias("source"), F.min("model_version").alias("model_version"), n.alias("n"),
        F.when(n > 5, F.corr(F.when(fill, F.col("_q")), F.when(fill, F.col("_rx")))).alias("ic"),
        avg(fill, "net").alias("market_net"), avg(pool, "net").alias("pool_net"), F.count_if(pick).alias("tn07_n"),
        avg(pick, "net").alias("tn07_net"), avg(pick, "y_bin").alias("tn07_hit"), avg(pool, "y_bin").alias("pool_hit"),
        avg(pick, "p_up_5").alias("pred_mean"), avg(fill & (F.col("_q") > 0.9), "net").alias("top_decile_net"),
        avg(fill & (F.col("_q") <= 0.1), "net").alias("bottom_decile_net"), F.bool_or("tn06r_regime_on").alias("tn06r_regime_on"),
        F.count_if(sig).alias("tn06r_n"), avg(sig, "net").alias("tn06r_net"))
    return ev.withColumn("ic", F.when(~F.isnan("ic"), F.col("ic")))


def live_summary(ev: DataFrame) -> DataFrame:
    """Means for the live dates and for all dates; event figures weighted by trades."""
    e = ev.withColumn("scope", F.explode(F.when(F.col("source") == "live", F.array(F.lit("live"), F.lit("all"))).otherwise(F.array(F.lit("all")))))
    has, sig = F.col("tn07_net").isNotNull(), F.col("tn06r_n") > 0
    w = F.sum(F.when(sig, F.col("tn06r_n")))
    return e.groupBy("scope").agg(
        F.count(F.lit(1)).alias("days"), F.avg("ic").alias("ic_mean"), F.avg(truth(F.col("ic") > NOISE).cast("double")).alias("ic_pos_days"),
        F.avg("tn07_net").alias("tn07_net"), F.avg(F.col("tn07_net") - F.col("market_net")).alias("tn07_vs_market"),
        F.avg(F.col("tn07_net") - F.col("pool_net")).alias("tn07_vs_random"), F.avg(F.when(has, F.col("tn07_hit"))).alias("tn07_hit"),
        F.avg(F.when(has, F.col("pred_mean"))).alias("tn07_pred_mean"), F.coalesce(w, F.lit(0)).alias("tn06r_trades"),
        (F.sum(F.when(sig, F.col("tn06r_n") * F.col("tn06r_net"))) / w).alias("tn06r_net"),
        (F.sum(F.when(sig, F.col("tn06r_n") * (F.col("tn06r_net") - F.col("market_net")))) / w).alias("tn06r_vs_market"))


# ---- signal log ----
SIGNAL_OUTCOME = ["gross", "net", "y_bin", "univ_mean", "excess"]


def append_signals(log: DataFrame, picks: DataFrame, run_date: str, gate_pass: bool, cfg: Config) -> DataFrame:
    """Rows of the run date are replaced by the new picks."""
    d = F.lit(run_date).cast("date")
    new = picks.withColumns({"data_date": d, "gate_pass": F.lit(gate_pass), "model_version": F.lit(cfg.model_version), "status": F.lit("open"),
                             **{c: F.lit(None).cast("double") for c in SIGNAL_OUTCOME}})
    return log.where(F.col("data_date") != d).unionByName(new.select(*log.columns))


def settle_signals(log: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Open signals with a known outcome: unfilled ones keep nulls, the rest get results and the date's universe mean."""
    univ = outcomes.groupBy("date").agg(F.avg("fwd_ret_5").alias("_u"))
    src = outcomes.join(F.broadcast(univ), "date").select(
        F.col("date").alias("data_date"), "ticker", F.col("real").alias("_r"), F.col("net").alias("_n"), F.col("y_bin").alias("_y"),
        F.col("buyable").alias("_b"), "_u")
    j = log.join(src, ["data_date", "ticker"], "left")
    known = (F.col("status") == "open") & F.col("_r").isNotNull()
    done = known & F.col("_b")
    put = {"gross": F.col("_r"), "net": F.col("_n"), "y_bin": F.col("_y"), "univ_mean": F.col("_u"), "excess": F.col("_n") - F.col("_u")}
    return j.withColumns({**{c: F.when(done, v).otherwise(F.col(c)) for c, v in put.items()},
                          "status": F.when(known & ~F.col("_b"), "unfilled_ceiling").when(done, "settled").otherwise(F.col("status"))}).select(*log.columns)


def signal_summary(log: DataFrame) -> DataFrame:
    """Totals over settled signals (action 'all', with the open count) and per action."""
    s = log.where("status = 'settled'")
    t = s.groupingSets([["action"], []], "action").agg(
        F.grouping("action").alias("_g"), F.count(F.lit(1)).alias("n"), F.count_distinct("data_date").alias("days"), F.avg("y_bin").alias("hit"),
        F.avg("net").alias("net"), F.avg("excess").alias("excess"))
    n_open = log.where("status = 'open'").select(F.count(F.lit(1))).scalar()
    return t.select(F.when(F.col("_g") == 1, "all").otherwise(F.col("action")).alias("action"), "n", "days", "hit", "net", "excess",
                    F.when(F.col("_g") == 1, n_open).alias("n_open"))


def track_record(signals: DataFrame) -> DataFrame:
    """Settled signals per action with a grand total labelled 'all'."""
    t = signals.where("status = 'settled'").groupingSets([["action"], []], "action").agg(
        F.count(F.lit(1)).alias("n_settled"), F.count_distinct("data_date").alias("n_days"), F.avg("y_bin").alias("hit_rate"),
        F.avg("net").alias("avg_net"), F.avg("excess").alias("avg_excess"), F.stddev_samp("net").alias("sd_net"))
    return t.withColumn("action", F.coalesce("action", F.lit("all")))


def track_daily(signals: DataFrame) -> DataFrame:
    return signals.where("status = 'settled'").groupBy("data_date").agg(
        F.count(F.lit(1)).alias("n"), F.avg("net").alias("avg_net"), F.avg("excess").alias("avg_excess"), F.avg("y_bin").alias("hit"))


# ---- rollback of one data date ----
def rollback_bars(bars: DataFrame, day: str) -> DataFrame:
    return bars.where(F.col("date") != F.lit(day).cast("date"))


def rollback_log(log: DataFrame, day: str) -> DataFrame:
    """The date's predictions go; rows settled on that date reopen."""
    d = F.lit(day).cast("date")
    re = truth(F.col("settled_on") == d)
    out = log.where(F.col("data_date") != d).withColumn("_re", re)
    vals = {c: F.when(~F.col("_re"), F.col(c)) for c in ("real", "net", "y_bin", "settled_on")}
    return out.withColumns({**vals, "status": F.when(F.col("_re"), "open").otherwise(F.col("status"))}).drop("_re")


def rollback_signals(signals: DataFrame, bars: DataFrame, day: str) -> DataFrame:
    """The date's signals go; signals of the six sessions before it reopen."""
    d = F.lit(day).cast("date")
    prev = bars.where(F.col("date") < d).select(F.col("date").alias("data_date")).distinct().orderBy(F.desc("data_date")).limit(6)
    out = signals.where(F.col("data_date") != d).join(F.broadcast(prev.withColumn("_p", F.lit(True))), "data_date", "left")
    out = out.withColumn("_re", truth(F.col("_p")) & F.col("status").isin("settled", "unfilled_ceiling"))
    vals = {c: F.when(~F.col("_re"), F.col(c)) for c in SIGNAL_OUTCOME}
    return out.withColumns({**vals, "status": F.when(F.col("_re"), "open").otherwise(F.col("status"))}).drop("_re", "_p").select(*signals.columns)


def rollback_evaluations(ev: DataFrame, log: DataFrame, day: str) -> DataFrame:
    """Evaluations of the date itself and of every reopened prediction date go."""
    d = F.lit(day).cast("date")
    gone = log.where(F.col("settled_on") == d).select("data_date").distinct()
    return ev.where(F.col("data_date") != d).join(F.broadcast(gone), "data_date", "left_anti")
