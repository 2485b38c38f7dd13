"""Forward labels and realised outcomes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.config import Config
from tidemark.functions.expr import change, net, truth
from tidemark.functions.ranks import add_pct_ranks

def by_ticker():
    return Window.partitionBy("ticker").orderBy("date")


def add_labels(df: DataFrame, cfg: Config) -> DataFrame:
    """Next open, closes five and six bars ahead, forward return, hit label (needs atr14_pct)."""
    h = cfg.horizon
    lead = lambda c, n: F.lead(c, n).over(by_ticker())
    df = df.withColumns({"open_t1": lead("open", 1), "_c4": lead("close", h - 1), "close_t5": lead("close", h),
                         "close_t6": lead("close", h + 1)})
    df = df.withColumns({"open_gap_t1": change(F.col("open_t1"), F.col("close")),
                         "ret_t5_day": change(F.col("close_t5"), F.col("_c4")),
                         "fwd_ret_5": change(F.col("close_t5"), F.col("open_t1"))}).drop("_c4")
    hit = truth(F.col("fwd_ret_5") > cfg.label_atr_mult * F.col("atr14_pct")).cast("double")
    return df.withColumn("y_bin", F.when(F.col("fwd_ret_5").isNotNull(), hit))


def add_relative_label(df: DataFrame, cfg: Config) -> DataFrame:
    """y_xs: forward return in the date's top 30 %."""
    df = add_pct_ranks(df, ["date"], {"_yr": ("fwd_ret_5", True)}, cfg.split)
    return df.withColumn("y_xs", F.when(F.col("fwd_ret_5").isNotNull(), truth(F.col("_yr") >= 0.7).cast("double"))).drop("_yr")


def add_outcome(df: DataFrame, cfg: Config) -> DataFrame:
    """real (sale one session later when locked at the floor), net of costs, buyable at the next open."""
    edge = F.col("limit") - F.lit(cfg.near)
    locked = (F.col("ret_t5_day") <= -edge) & F.col("close_t6").isNotNull()
    df = df.withColumn("real", F.when(locked, change(F.col("close_t6"), F.col("open_t1"))).otherwise(F.col("fwd_ret_5")))
    return df.withColumns({"net": net(F.col("real"), cfg), "buyable": ~truth(F.col("open_gap_t1") >= edge)})


def index_forward(index: DataFrame, cfg: Config) -> DataFrame:
    """(date, vni5): index close to close five sessions ahead."""
    return index.select("date", change(F.lead("close", cfg.horizon).over(by_ticker()), F.col("close")).alias("vni5"))


def session_index(dates: DataFrame) -> DataFrame:
    """(date, di): position of each date in the calendar; the calendar bounds this window."""
    return dates.select("date").distinct().withColumn("di", (F.row_number().over(Window.orderBy("date")) - 1).cast("long"))


def take_profit(events: DataFrame, bars: DataFrame, calendar: DataFrame, levels: list[float], cfg: Config) -> DataFrame:
    """Early exits: one row per event and level with gross, held and hit.

    Shares bought at t+1 can be sold from t+3 on; a session that opens above the target sells at its open,
    one that trades through it sells at the target; otherwise the normal exit stands.
    """
    px = bars.join(F.broadcast(calendar), "date").select("ticker", F.col("di").alias("_d"), "open", "high")
    ahead = (events.select("ticker", "date", "di", "real", F.explode(F.array(*[F.lit(k) for k in (1, 3, 4, 5)])).alias("_k"))
                   .withColumn("_d", F.col("di") + F.col("_k")))
    j = ahead.join(px, ["ticker", "_d"], "left").groupBy("ticker", "date", "di", "real").agg(
        F.max(F.when(F.col("_k") == 1, F.col("open"))).alias("entry"),
        *[F.max(F.when(F.col("_k") == k, F.col(c))).alias(f"{c}{k}") for k in (3, 4, 5) for c in ("open", "high")])
    j = j.withColumn("tp", F.explode(F.array(*[F.lit(t) for t in levels]))).withColumn("_target", F.col("entry") * (1 + F.col("tp")))
    gross, held = F.col("real"), F.lit(cfg.horizon)
    for k in (5, 4, 3):
        at_open, at_high = truth(F.col(f"open{k}") >= F.col("_target")), truth(F.col(f"high{k}") >= F.col("_target"))
        gross = F.when(at_open, change(F.col(f"open{k}"), F.col("entry"))).when(at_high, F.col("tp")).otherwise(gross)
        held = F.when(at_open | at_high, F.lit(k)).otherwise(held)
    any_hit = F.lit(False)
    for k in (3, 4, 5):
        any_hit = any_hit | truth(F.col(f"open{k}") >= F.col("_target")) | truth(F.col(f"high{k}") >= F.col("_target"))
    return j.select("ticker", "date", "di", "tp", gross.alias("gross"), held.alias("held"), any_hit.alias("tp_hit"),
                    net(gross, cfg).alias("net"))
