"""Tradable universe and per-date cross-section."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.config import LIMITS, Config
from tidemark.functions.expr import change, last_rows, truth
from tidemark.functions.ranks import add_pct_ranks

def by_ticker():
    return Window.partitionBy("ticker").orderBy("date")


def select_symbols(bars: DataFrame, cfg: Config) -> DataFrame:
    """Plain stock codes from the first model date on (the start date seeds the recursive averages)."""
    return bars.where(F.col("ticker").rlike(f"^(?:{cfg.ticker_pattern})$") & (F.col("date") >= F.lit(cfg.first_date).cast("date")))


def infer_exchange(bars: DataFrame, cfg: Config, exchange_map: DataFrame | None = None) -> DataFrame:
    """(ticker, exch, exch_src) from the 99.9 % quantile of absolute one-bar returns; a map overrides."""
    r = bars.select("ticker", "date", F.abs(change(F.col("close"), F.lag("close").over(by_ticker()))).alias("r"))
    r = r.where(F.col("date") >= F.lit(cfg.exch_since).cast("date"))
    q = r.groupBy("ticker").agg(F.percentile("r", 0.999).alias("q"))   # at most one value per session
    out = q.select("ticker", F.when(F.col("q") <= 0.072, "HOSE").when(F.col("q") <= 0.102, "HNX").otherwise("UPCOM").alias("exch"),
                   F.lit("inferred").alias("exch_src"))
    if exchange_map is None:
        return out
    m = exchange_map.select(F.upper("ticker").alias("ticker"), F.upper("exchange").alias("_x")).dropDuplicates(["ticker"])
    return (out.join(m, "ticker", "left")
               .select("ticker", F.coalesce("_x", "exch").alias("exch"),
                       F.when(F.col("_x").isNotNull(), "map").otherwise(F.col("exch_src")).alias("exch_src")))


def add_exchange(df: DataFrame, exchanges: DataFrame) -> DataFrame:
    """exch, exch_src and the daily price limit; unknown tickers count as UPCOM."""
    df = (df.join(exchanges, "ticker", "left")
            .withColumn("exch", F.coalesce("exch", F.lit("UPCOM")))
            .withColumn("exch_src", F.coalesce("exch_src", F.lit("inferred"))))
    lim = F.when(F.col("exch") == "HOSE", LIMITS["HOSE"]).when(F.col("exch") == "HNX", LIMITS["HNX"]).otherwise(LIMITS["UPCOM"])
    return df.withColumn("limit", lim)


def add_flags(df: DataFrame, cfg: Config) -> DataFrame:
    edge = F.col("limit") - F.lit(cfg.near)
    return df.withColumns({
        "eligible": truth((F.col("liq20") >= cfg.liq_min) & (F.col("nbars") >= cfg.min_bars) & (F.col("volume") > 0)),
        "near_ceiling": truth(F.col("ret1") >= edge).cast("int"),
        "near_floor": truth(F.col("ret1") <= -edge).cast("int"),
    })


def add_breadth(e: DataFrame) -> DataFrame:
    """Share of the date's rows above their EMA50; unknown counts as not above."""
    above = truth(F.col("dist_ema50") > 0).cast("double")
    return e.withColumn("breadth_ema50", F.avg(above).over(Window.partitionBy("date")))


def add_breadth_joined(e: DataFrame) -> DataFrame:
    """Same by map-side combine and a join of one row per date."""
    b = e.groupBy("date").agg(F.avg(truth(F.col("dist_ema50") > 0).cast("double")).alias("breadth_ema50"))
    return e.join(F.broadcast(b), "date", "left")


def add_value(e: DataFrame, cfg: Config) -> DataFrame:
    parts = {"_v1": ("dd252", False), "_v2": ("dist_ema200", False), "_v3": ("volat60", False), "_v4": ("liq20", True)}
    e = add_pct_ranks(e, ["date"], parts, cfg.split)
    e = (e.withColumn("value_score", (F.col("_v1") + F.col("_v2") + F.col("_v3") + F.col("_v4")) / 4)
          .withColumn("value_mode", F.lit("technical_proxy")).drop(*parts))
    e = add_pct_ranks(e, ["date"], {"_vr": ("value_score", True)}, cfg.split)
    return e.withColumn("value_top30", truth(F.col("_vr") >= 1 - cfg.value_top_pct)).drop("_vr")


def add_regime(e: DataFrame) -> DataFrame:
    d, s, a = F.col("dist_ema50"), F.col("ema20_50"), F.col("adx14")
    return e.withColumns({
        "regime": F.when((d > 0) & (s > 0) & (a >= 20), "Uptrend").when((d < 0) & (s < 0) & (a >= 20), "Downtrend")
                   .otherwise("Sideways"),
        "trend_score": 0.5 * F.tanh(10 * s) + 0.5 * F.col("di_diff"),
    })


def add_cross_ranks(e: DataFrame, cfg: Config) -> DataFrame:
    return add_pct_ranks(e, ["date"], {f"{c}_xr": (c, True) for c in ("ret5", "ret20", "vol_ratio20", "volat20", "rsi14")}, cfg.split)


def add_industry(e: DataFrame, industry: DataFrame) -> DataFrame:
    """Left join on ticker; Spark broadcasts the dimension when its size allows."""
    return e.drop("industry").join(industry.select("ticker", "industry"), "ticker", "left")


def build_universe(feats: DataFrame, exchanges: DataFrame, industry: DataFrame, cfg: Config) -> DataFrame:
    """Feature frame -> eligible rows with cross-sectional columns."""
    return cross_section(add_flags(add_exchange(feats, exchanges), cfg), industry, cfg)


def cross_section(flagged: DataFrame, industry: DataFrame, cfg: Config) -> DataFrame:
    """Flagged frame -> eligible rows with cross-sectional columns."""
    e = add_industry(flagged.where("eligible"), industry)
    if cfg.split:
        from tidemark.session import materialise
        e = add_breadth_joined(materialise(e, "eligible"))
    else:
        e = add_breadth(e)
    return add_cross_ranks(add_regime(add_value(e, cfg)), cfg)


def regime_counts(e: DataFrame) -> DataFrame:
    """Rows per regime of the last date, for the universe and for the value pool."""
    return count_regimes(last_rows(e))


def count_regimes(rows: DataFrame) -> DataFrame:
    return rows.groupBy("regime").agg(F.count(F.lit(1)).alias("n_universe"), F.count_if("value_top30").alias("n_pool"))


def candidates(e: DataFrame, agents: DataFrame) -> DataFrame:
    """Rows of the last date per agent whose industry the agent covers (agents: id, industries[])."""
    last = last_rows(e)
    scope = agents.select(F.col("id").alias("agent"), F.explode("industries").alias("industry")).distinct()
    pct = {c: F.round(F.col(c) * 100, 1) for c in ("ret1", "ret5", "ret20", "ret60", "dist_ema50", "dist_ema200", "atr14_pct")}
    return (last.join(scope, "industry")
                .select("agent", "ticker", "industry", "close", *[v.alias(k) for k, v in pct.items()],
                        F.round("rsi14", 1).alias("rsi14"), "regime",
                        *[F.round(c, 2).alias(c) for c in ("trend_score", "pos20", "pos60", "vol_ratio20")],
                        "liq20", "near_ceiling", "near_floor"))
