"""Basket selection and the report columns of picked names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.config import Config
from tidemark.functions.expr import last_rows, truth
from tidemark.functions.ranks import add_min_ranks, add_pct_ranks, group_quantile


def capped_topk(df: DataFrame, score: str, cfg: Config, by: tuple[str, ...] = ("date",), pool: str | None = "value_top30",
                exclude: DataFrame | None = None) -> DataFrame:
    """Best K per group, at most `max_per_industry` per industry (a missing industry counts as its own).

    Both row_number filters are literal, so Spark keeps only the first rows of a group before the shuffle.
    """
    if pool:
        df = df.where(F.col(pool))
    if exclude is not None:
        df = df.join(exclude.select("ticker").distinct(), "ticker", "left_anti")
    best = [F.col(score).desc_nulls_last(), F.col("ticker")]
    df = df.withColumn("_ind", F.coalesce("industry", "ticker"))
    df = df.withColumn("_ri", F.row_number().over(Window.partitionBy(*by, "_ind").orderBy(*best))).where(F.col("_ri") <= cfg.max_per_industry)
    df = df.withColumn("rank_sel", F.row_number().over(Window.partitionBy(*by).orderBy(*best))).where(F.col("rank_sel") <= cfg.topk)
    return df.drop("_ind", "_ri")


def add_soft_score(df: DataFrame, score: str, out: str, cfg: Config, by: tuple[str, ...] = ("date",)) -> DataFrame:
    """0.75 * percent rank of the score + 0.25 * percent rank of value_score over the whole universe."""
    df = add_pct_ranks(df, list(by), {"_sr": (score, True), "_vr": ("value_score", True)}, cfg.split)
    return df.withColumn(out, 0.75 * F.col("_sr") + 0.25 * F.col("_vr")).drop("_sr", "_vr")


def add_ranks(df: DataFrame, score: str, cfg: Config) -> DataFrame:
    """rank_all over the date, rank_pool over the date's value pool."""
    df = df.withColumn("_pool_score", F.when(F.col("value_top30"), F.col(score)))
    return add_min_ranks(df, ["date"], {"rank_all": (score, False), "rank_pool": ("_pool_score", False)}, cfg.split).drop("_pool_score")


def add_day_change(df: DataFrame, calendar: DataFrame) -> DataFrame:
    """d_p and regime_prev against the previous date of the frame; null when the name was absent then."""
    w = Window.partitionBy("ticker").orderBy("date")
    df = df.join(F.broadcast(calendar.select("date", F.col("di").alias("_di"))), "date")
    there = F.lag("_di").over(w) == F.col("_di") - 1
    return df.withColumns({"d_p": F.when(there, F.col("p_up_5") - F.lag("p_up_5").over(w)),
                           "regime_prev": F.when(there, F.lag("regime").over(w))}).drop("_di")


def _flag_list(flags: list[tuple[Column, str]]) -> Column:
    return F.array_compact(F.array(*[F.when(truth(c), F.lit(n)) for c, n in flags]))


def add_risk_flags(df: DataFrame, universe: DataFrame, cfg: Config, quarantine: DataFrame | None = None) -> DataFrame:
    """risks and blocking arrays; the volatility bar is the 90 % quantile of the date's whole universe."""
    bar = group_quantile(universe, ["date"], "atr14_pct", 0.9, "_q90", cfg.split)
    df = df.join(F.broadcast(bar), "date", "left")          # one row per session
    if quarantine is None:
        df = df.withColumn("_bad", F.lit(False))
    else:
        q = quarantine.select("ticker").distinct().withColumn("_bad", F.lit(True))
        df = df.join(q, "ticker", "left").withColumn("_bad", truth(F.col("_bad")))
    up, down = (F.col("near_ceiling") == 1, "at_ceiling"), (F.col("near_floor") == 1, "at_floor")
    trend, bad = (F.col("regime") == "Downtrend", "downtrend"), (F.col("_bad"), "quarantined")
    soft = [(F.col("liq20") < 1.5 * cfg.liq_min, "thin_liquidity"), (F.col("atr14_pct") > F.col("_q90"), "high_volatility"),
            (F.col("exch_src") == "inferred", "exchange_inferred"), (F.lit(True), "proxy_value")]
    return df.withColumns({"risks": _flag_list([up, down, soft[0], trend, soft[1], bad, soft[2], soft[3]]),
                           "blocking": _flag_list([up, down, trend, bad])}).drop("_q90", "_bad")


def add_action(df: DataFrame, gate_pass: bool | Column) -> DataFrame:
    """consider / watch, with the reasons against in one string."""
    g = gate_pass if isinstance(gate_pass, Column) else F.lit(gate_pass)
    ok = g & (F.size("blocking") == 0)
    why = F.concat(F.when(~g, F.array(F.lit("gate_not_passed"))).otherwise(F.array().cast("array<string>")), F.col("blocking"))
    return df.withColumns({"action": F.when(ok, "consider").otherwise("watch"),
                           "reasons": F.when(ok, "").otherwise(F.concat_ws("; ", why))})


def top_uptrend(df: DataFrame, n: int = 10) -> DataFrame:
    """Strongest uptrend names of the last date."""
    last = last_rows(df).where("regime = 'Uptrend'")
    return last.orderBy(F.col("trend_score").desc_nulls_last(), "ticker").limit(n)


def plan_next_session(signals: DataFrame, held: DataFrame, nav: float, cfg: Config) -> DataFrame:
    """Entries for the next session, lowest RSI first, within the free slots and the industry cap.

    signals: ticker, industry, rsi14 of the last date; held: ticker, industry of open positions (at most `slots`).
    Only the at most `slots` planned rows and three cut keys per industry are ever ordered; every other row is
    classified by comparing its own key with them.
    """
    key = F.struct(F.coalesce("rsi14", F.lit(float("inf"))).alias("r"), F.col("ticker").alias("t"))
    s = signals.withColumns({"_ind": F.coalesce("industry", "ticker"), "_k": key})
    h = held.select("ticker", F.coalesce("industry", "ticker").alias("_ind"))
    per_ind = F.broadcast(h.groupBy("_ind").agg(F.count(F.lit(1)).alias("_h")))
    s = (s.join(per_ind, "_ind", "left").withColumn("_h", F.coalesce("_h", F.lit(0)))
          .join(F.broadcast(h.select("ticker", F.lit(True).alias("_held")).distinct()), "ticker", "left"))
    free = s.where("_held is null")
    capped = (free.withColumn("_n", F.row_number().over(Window.partitionBy("_ind").orderBy("_k")))
                  .where(F.col("_n") <= cfg.max_per_industry).where(F.col("_n") + F.col("_h") <= cfg.max_per_industry))
    n_open = held.select(F.count(F.lit(1))).scalar()
    first = capped.orderBy("_k").limit(cfg.slots)
    order = (first.withColumn("_i", F.row_number().over(Window.orderBy("_k")))            # at most `slots` rows
                  .where(F.col("_i") + n_open <= cfg.slots))
    last, planned = order.select(F.max("_k")).scalar(), order.select(F.count(F.lit(1))).scalar()
    ind_cut = capped.where(F.col("_n") + F.col("_h") == cfg.max_per_industry).select("_ind", F.col("_k").alias("_indk"))
    s = s.join(ind_cut, "_ind", "left")
    full = (n_open + planned >= cfg.slots) & F.coalesce(F.col("_k") > last, F.lit(True))
    crowded = (F.col("_h") >= cfg.max_per_industry) | truth(F.col("_k") > F.col("_indk"))
    status = (F.when(full, "skipped_full").when(crowded, "skipped_industry").when(F.col("_held"), "skipped_holding")
               .otherwise("planned"))
    return s.select("ticker", "industry", "rsi14", status.alias("status"),
                    F.when(status == "planned", F.lit(nav / cfg.slots)).alias("amount"))
