"""Oversold-streak events: conditions, cooldown, benchmarks, statistics, verdicts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.config import Config
from tidemark.functions.expr import change, truth
from tidemark.functions.ranks import group_quantile
from tidemark.operators.backtest import as_series, block_bootstrap, random_mean, weighted_bootstrap
from tidemark.operators.features import index_features

# Event systems as (name, condition column, needs the market switch).
SYSTEMS = [("capitulation", "cond_cap", True), ("rsi_only", "cond_rsi", True), ("no_regime", "cond_cap", False)]


def market_switch(index: DataFrame, cfg: Config) -> DataFrame:
    """(date, regime_on): index below its EMA50; unknown counts as off."""
    return index_features(index, cfg).select("date", truth(F.col("vni_dist_ema50") < 0).alias("regime_on"))


def add_conditions(e: DataFrame, calendar: DataFrame, switch: DataFrame, cfg: Config) -> DataFrame:
    """di, cond_rsi, cond_cap (three calendar-adjacent low RSI sessions and volume), regime_on."""
    w = Window.partitionBy("ticker").orderBy("date")
    e = e.join(F.broadcast(calendar), "date")               # one row per session
    low = F.col("rsi14") < cfg.rsi_max
    prev = [truth((F.lag("rsi14", k).over(w) < cfg.rsi_max) & (F.lag("di", k).over(w) == F.col("di") - k)) for k in (1, 2)]
    e = e.withColumns({"cond_rsi": truth(low), "cond_cap": truth(low & prev[0] & prev[1] & (F.col("vol_ratio20") >= cfg.vol_min))})
    return e.join(F.broadcast(switch), "date", "left").withColumn("regime_on", truth(F.col("regime_on")))


def cooldown(events: DataFrame, cfg: Config, key: tuple[str, ...] = ("ticker",), prior: DataFrame | None = None) -> DataFrame:
    """Events further than `horizon` sessions after the last kept event of the key.

    Which events survive depends on the ones kept before, so each key's session numbers are folded in order;
    an array holds at most one entry per session of the calendar. `prior` (key, last) seeds the fold.
    """
    g = events.groupBy(*key).agg(F.array_sort(F.collect_set("di")).alias("_d"))
    if prior is None:
        g = g.withColumn("_seed", F.lit(None).cast("long"))
    else:
        g = g.join(prior.select(*key, F.col("last").cast("long").alias("_seed")), list(key), "left")
    start = F.struct(F.array().cast("array<bigint>").alias("kept"), F.col("_seed").alias("last"))

    def step(acc, d):
        free = acc["last"].isNull() | (d - acc["last"] > cfg.horizon)
        return F.when(free, F.struct(F.concat(acc["kept"], F.array(d)).alias("kept"), d.alias("last"))).otherwise(acc)
    kept = g.select(*key, F.explode(F.aggregate("_d", start, step, lambda a: a["kept"])).alias("di"))
    return events.join(kept, [*key, "di"])


def event_sets(e: DataFrame, cfg: Config, systems=SYSTEMS, within: tuple[str, ...] = ()) -> DataFrame:
    """Buyable events of every system after cooldown, labelled by system. within: columns (a period) that a cooldown never crosses."""
    hit = lambda c, reg: F.col(c) & F.col("buyable") & (F.col("regime_on") if reg else F.lit(True))
    tags = F.array_compact(F.array(*[F.when(hit(c, reg), F.lit(n)) for n, c, reg in systems]))
    return cooldown(e.withColumn("system", F.explode(tags)), cfg, (*within, "system", "ticker"))


def event_benchmarks(e: DataFrame, ev: DataFrame, index_fwd: DataFrame, cfg: Config, repeats: int, by: tuple[str, ...] = ("system",)) -> DataFrame:
    """Per event day: n, net, random (same number of names from the buyable universe), market, vni5."""
    day = ev.groupBy(*by, "date").agg(F.count(F.lit(1)).alias("n"), F.avg("net").alias("net"))
    market = e.where("buyable").groupBy("date").agg(F.avg("net").alias("market"))
    # draws depend on the date and the count only, so every system with the same count shares them
    need = day.select("date", F.col("n").alias("cnt"), "n").distinct()
    uni = e.select("date", "ticker", "net", "buyable", F.lit(True).alias("_all")).join(F.broadcast(need.select("date").distinct()), "date", "left_semi")
    rand = random_mean(uni, need, cfg, repeats, ("cnt", "date"), "_all", "event", ("date",)).withColumnRenamed("cnt", "n")
    return (day.join(rand, ["date", "n"], "left").join(F.broadcast(market), "date", "left")
               .join(F.broadcast(index_fwd), "date", "left"))


def weighted_days(bench: DataFrame, name: str, x: Column, by: tuple[str, ...]) -> DataFrame:
    """(g, date, n, x): each day's value and its number of trades."""
    return bench.select(F.concat_ws("|", F.lit(name), *[F.col(c) for c in by]).alias("g"), "date", "n", x.alias("x"))


def event_stats(ev: DataFrame, bench: DataFrame, cfg: Config, by: tuple[str, ...] = ("system",)) -> DataFrame:
    """Per system: trades, days, mean/median net, hits, trade-weighted edge over each benchmark with interval."""
    base = ev.groupBy(*by).agg(F.count(F.lit(1)).alias("n_trades"), F.avg("net").alias("net_per_trade"),
                               F.avg((F.col("net") > 0).cast("double")).alias("hit_net_pos"), F.avg("y_bin").alias("hit_ybin"))
    med = group_quantile(ev, list(by), "net", 0.5, "median_net", cfg.split)
    others = ("random", "market", "vni5")
    edge = [((F.sum(F.col("n") * (F.col("net") - F.col(o)))) / F.sum(F.when(F.col(o).isNotNull(), F.col("n")))).alias(f"vs_{o}") for o in others]
    day = bench.groupBy(*by).agg(F.count(F.lit(1)).alias("n_days"), *edge)
    series = None
    for o in others:
        s = weighted_days(bench, f"ev:{o}", F.col("net") - F.col(o), by)
        series = s if series is None else series.unionByName(s)
    ci = weighted_bootstrap(series, cfg)
    out = base.join(med, list(by)).join(day, list(by))
    for o in others:
        part = ci.select(F.col("g").alias("_g"), F.col("lo").alias(f"vs_{o}_lo"), F.col("hi").alias(f"vs_{o}_hi"))
        out = out.join(part, F.concat_ws("|", F.lit(f"ev:{o}"), *[F.col(c) for c in by]) == F.col("_g"), "left").drop("_g")
    return out


def timing(e: DataFrame, cfg: Config) -> DataFrame:
    """Equal-weight buyable market on days with the switch on, off and all days; interval for the on days."""
    day = e.where("buyable").groupBy("date").agg(F.avg("net").alias("net"), F.bool_or("regime_on").alias("on"))
    s = day.agg(F.count_if("on").alias("days_on"), F.avg(F.when(F.col("on"), F.col("net"))).alias("net_on"),
                F.avg("net").alias("net_all"), F.avg(F.when(~F.col("on"), F.col("net"))).alias("net_off"))
    ci = block_bootstrap(as_series(day.where("on"), "timing", "net"), cfg)
    return s.withColumns({"lo": ci.select(F.max("lo")).scalar(), "hi": ci.select(F.max("hi")).scalar()})


def pick_verdict(stats: DataFrame, cfg: Config) -> DataFrame:
    """Checks and verdict of the capitulation system against market, random and the RSI-only system."""
    pick = lambda s, c: F.max(F.when(F.col("system") == s, F.col(c)))
    m = stats.agg(pick("capitulation", "n_trades").alias("n"), pick("capitulation", "vs_market").alias("vm"),
                  pick("capitulation", "vs_market_lo").alias("lo"), pick("capitulation", "vs_random").alias("vr"),
                  pick("rsi_only", "vs_market").alias("other"))
    c = [truth(F.col("n") >= 30), truth((F.col("vm") > 0) & (F.col("lo") > 0)), truth(F.col("vr") > 0), truth(F.col("vm") > F.col("other"))]
    names = ["enough_trades", "beats_market", "beats_random", "beats_rsi_only"]
    return m.select(*[x.alias(n) for x, n in zip(c, names)]).withColumn(
        "verdict", F.when(F.expr(" and ".join(names)), "GO").when(~F.col("enough_trades"), "NOT ENOUGH EVIDENCE").otherwise("NO-GO"))


def timing_verdict(t: DataFrame) -> DataFrame:
    names = ["enough_days", "on_days_profitable", "beats_all_days"]
    c = [truth(F.col("days_on") >= 20), truth((F.col("net_on") > 0) & (F.col("lo") > 0)), truth(F.col("net_on") > F.col("net_all"))]
    return t.select(*[x.alias(n) for x, n in zip(c, names)]).withColumn(
        "verdict", F.when(F.expr(" and ".join(names)), "GO").when(~F.col("enough_days"), "NOT ENOUGH EVIDENCE").otherwise("NO-GO"))


def period_of(split_date: str) -> Column:
    """IS before the split date, OOS from it on."""
    return F.when(F.col("date") < F.lit(split_date).cast("date"), "IS").otherwise("OOS")


def take_profit_stats(tp: DataFrame, market: DataFrame, split_date: str) -> DataFrame:
    """(period, tp): trades, mean net, edge over market, hit rate, mean sessions held; tp 0 is the base rule."""
    d = tp.join(F.broadcast(market), "date", "left").withColumn("period", period_of(split_date))
    return d.groupBy("period", "tp").agg(
        F.count(F.lit(1)).alias("n_trades"), F.avg("net").alias("net_per_trade"), F.avg(F.col("net") - F.col("market")).alias("vs_market"),
        F.avg(F.col("tp_hit").cast("double")).alias("tp_hit_rate"), F.avg("held").alias("avg_held"))


def choose_take_profit(stats: DataFrame) -> DataFrame:
    """Level with the best in-sample mean net if it beats the base rule, and its out-of-sample checks."""
    i = F.col("period") == "IS"
    best = stats.agg(F.max(F.when(i & (F.col("tp") > 0), F.struct("net_per_trade", F.col("tp")))).alias("b"),
                     F.max(F.when(i & (F.col("tp") == 0), F.col("net_per_trade"))).alias("base"))
    c = best.select(F.when(F.col("b.net_per_trade") > F.col("base"), F.col("b.tp")).alias("choice"))
    o = stats.where("period = 'OOS'").select("tp", "n_trades", "net_per_trade", "vs_market")
    base = o.where("tp = 0").select(F.max("net_per_trade")).scalar()
    r = c.join(o, F.col("choice") == F.col("tp"), "left")
    names = ["enough_trades", "beats_base", "beats_market"]
    cond = [truth(F.col("n_trades") >= 30), truth(F.col("net_per_trade") > base), truth(F.col("vs_market") > 0)]
    return r.select("choice", *[x.alias(n) for x, n in zip(cond, names)]).withColumn(
        "verdict", F.when(F.col("choice").isNull(), "KEEP BASE").when(F.expr(" and ".join(names)), "GO").otherwise("NO-GO"))


def buy_and_hold(e: DataFrame, index: DataFrame, start: str, end: str) -> DataFrame:
    """Index as of end over as of start, and the compound of the universe's mean one-bar return in the period."""
    d = lambda s: F.lit(s).cast("date")
    span = e.where(F.col("date").between(d(start), d(end)))
    ends = span.agg(F.min("date").alias("a"), F.max("date").alias("b"))
    a, b = ends.select("a").scalar(), ends.select("b").scalar()
    at = lambda x: F.max_by(F.when(F.col("date") <= x, F.col("close")), F.when(F.col("date") <= x, F.col("date")))
    idx = index.select(change(at(b), at(a)).alias("index_hold"))
    ew = span.groupBy("date").agg(F.avg("ret1").alias("r")).select((F.exp(F.sum(F.log1p("r"))) - 1).alias("universe_hold"))
    return idx.withColumn("universe_hold", ew.scalar())
