"""After-cost basket statistics, rank correlation, calibration, bootstrap, gate.

Input is the outcome frame (fwd_ret_5 known; real, net, buyable present). `by` always ends with the date; everything
before it (variant, fold) only adds grouping keys, so many strategies are measured in one plan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.config import Config
from tidemark.functions.draws import draw32, explode_subset, spread
from tidemark.functions.expr import NOISE, truth
from tidemark.functions.ranks import add_pct_ranks, add_row_number
from tidemark.operators.selection import add_soft_score, capped_topk

BANDS = [0.0, 0.2, 0.3, 0.4, 0.5, 0.6, 1.0]      # fixed values: calibration bands, right-closed


def daily_basket(d: DataFrame, score: str, cfg: Config, by: tuple[str, ...] = ("date",), pool: str = "value_top30",
                 picks: DataFrame | None = None) -> DataFrame:
    """Per date: picks that could be bought, their gross/net/hit, and the universe and pool means.

    A date whose picks are all unbuyable keeps its row with n = 0.
    """
    sel = capped_topk(d, score, cfg, by, pool) if picks is None else picks
    can = F.col("buyable")
    mine = sel.groupBy(*by).agg(
        F.count_if(can).alias("n"), F.count_if(~can).alias("n_skip_ceiling"),
        F.avg(F.when(can, F.col("real"))).alias("gross"), F.avg(F.when(can, F.col("net"))).alias("net"),
        F.avg(F.when(can, F.col("y_bin"))).alias("hit"))
    in_pool = F.col(pool)
    every = d.groupBy(*by).agg(
        F.avg("fwd_ret_5").alias("univ"), F.avg("net").alias("market_net"), F.avg("y_bin").alias("base_univ"),
        F.avg(F.when(in_pool, F.col("fwd_ret_5"))).alias("pool_mean"), F.avg(F.when(in_pool, F.col("y_bin"))).alias("base_pool"))
    r = mine.join(every, list(by))
    return r.withColumns({"excess": F.col("net") - F.col("univ"), "excess_pool": F.col("net") - F.col("pool_mean")})


def bought_days(basket: DataFrame) -> DataFrame:
    return basket.where("n > 0")


def summarise_basket(basket: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Period means and lift over the date rows."""
    return bought_days(basket).groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_days"), F.min("date").alias("first"), F.max("date").alias("last"),
        F.avg("hit").alias("hit_top10"), F.avg("base_pool").alias("base_pool"),
        (F.avg("hit") - F.avg("base_pool")).alias("lift"), F.avg("net").alias("net_top10"),
        F.avg("univ").alias("univ_mean"), F.avg("excess").alias("excess_ret_5"))


def daily_ic(d: DataFrame, score: str, cfg: Config, by: tuple[str, ...] = ("date",), key: tuple[str, ...] = ("ticker", "date"),
             outcome: str = "fwd_ret_5") -> DataFrame:
    """Rank correlation of score and outcome per date with more than five rows."""
    d = d.where(F.col(outcome).isNotNull()).select(*dict.fromkeys([*by, *key, score, outcome]))
    d = add_pct_ranks(d, list(by), {"_a": (score, True), "_b": (outcome, True)}, cfg.split, key)
    ic = d.groupBy(*by).agg(F.corr("_a", "_b").alias("ic"), F.count(F.lit(1)).alias("n"))
    return ic.where((F.col("n") > 5) & F.col("ic").isNotNull() & ~F.isnan("ic"))


def band(p: Column) -> Column:
    """Number of the calibration band 1..6; null outside (0, 1]."""
    out = F.lit(None).cast("int")
    for i in range(len(BANDS) - 1, 0, -1):
        out = F.when((p > BANDS[i - 1]) & (p <= BANDS[i]), i).otherwise(out)
    return out


def calibration(d: DataFrame, score: str, min_rows: int = 0, by: tuple[str, ...] = ()) -> DataFrame:
    c = (d.withColumn("band", band(F.col(score))).where("band is not null").groupBy(*by, "band")
          .agg(F.avg(score).alias("p"), F.avg("y_bin").alias("actual"), F.count(F.lit(1)).alias("n")))
    return c.where(F.col("n") >= min_rows)


def monotone(cal: DataFrame, by: tuple[str, ...] = (), min_bands: int = 3) -> DataFrame:
    """True with at least three bands and strictly rising hit rates (six bands at most per group)."""
    w = Window.partitionBy(*by).orderBy("band") if by else Window.orderBy("band")
    c = cal.withColumn("_up", F.coalesce(F.col("actual") > F.lag("actual").over(w), F.lit(True)))
    return c.groupBy(*by).agg(((F.count(F.lit(1)) >= min_bands) & F.coalesce(F.bool_and("_up"), F.lit(False))).alias("calib_monotone"))


def deciles(d: DataFrame, score: str, cfg: Config, by: tuple[str, ...] = ("date",)) -> DataFrame:
    """Decile 0..9 by position within the date (equal scores by ticker); dates of one row have none."""
    d = add_row_number(d, list(by), score, "ticker", "_r", "_n", cfg.split)
    dec = F.greatest(F.lit(0), F.expr("(10 * (_r - 1) + _n - 2) div (_n - 1) - 1"))
    return d.where("_n > 1").withColumn("decile", dec.cast("long")).drop("_r", "_n")


def decile_means(d: DataFrame, score: str, cfg: Config, by: tuple[str, ...] = ("date",)) -> DataFrame:
    return deciles(d, score, cfg, by).groupBy(*by, "decile").agg(F.avg("fwd_ret_5").alias("mean_ret"), F.count(F.lit(1)).alias("n"))


def decile_spread(d: DataFrame, score: str, cfg: Config, by: tuple[str, ...] = ("date",)) -> DataFrame:
    m = decile_means(d, score, cfg, by).groupBy(*by).agg(
        (F.max(F.when(F.col("decile") == 9, F.col("mean_ret"))) - F.max(F.when(F.col("decile") == 0, F.col("mean_ret")))).alias("spread"))
    return m.where("spread is not null")


def as_series(df: DataFrame, name: str, x: str, by: tuple[str, ...] = ()) -> DataFrame:
    """(g, idx, x): one value per date in date order; g names the series. One row per session."""
    g = F.concat_ws("|", F.lit(name), *[F.col(c) for c in by])
    s = df.where(F.col(x).isNotNull()).select(g.alias("g"), "date", F.col(x).alias("x"))
    return s.select("g", (F.row_number().over(Window.partitionBy("g").orderBy("date")) - 1).cast("long").alias("idx"), "x")


def block_draws(usable: DataFrame, cfg: Config) -> DataFrame:
    """(g, n, tail, b, start, is_last): drawn block starts of every repeat b, for usable (g, n, nb, tail)."""
    reps = spread(usable.select("*", F.explode(F.sequence(F.lit(0), F.lit(cfg.boot - 1))).alias("b")), "g", "b")
    return (reps.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("nb") - 1)).alias("j"))
                .select("g", "n", "tail", "b", (F.col("j") == F.col("nb") - 1).alias("is_last"),
                        F.pmod(draw32(cfg.seed, F.col("g"), F.col("b"), F.col("j")), F.col("n") - cfg.block + 1).alias("start")))


def block_bootstrap(series: DataFrame, cfg: Config) -> DataFrame:
    """(g, n, mean, lo, hi): moving-block 95 % interval of the mean; null bounds when n < 2 * block.

    Each element is sent to the at most `block` blocks that hold it, blocks are summed once, and every drawn block
    is one equi-join row: B * n / block rows in all, spread over the cluster.
    """
    L = cfg.block
    size = series.groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.avg("x").alias("mean"))
    usable = (size.where(F.col("n") >= 2 * L).select("g", "n", F.ceil(F.col("n") / L).alias("nb"))
                  .withColumn("tail", F.col("n") - (F.col("nb") - 1) * L))
    sums = (series.join(F.broadcast(usable), "g")                     # one row per series name
                  .select("g", "n", "tail", "idx", "x", F.explode(F.sequence(F.lit(0), F.lit(L - 1))).alias("o"))
                  .withColumn("start", F.col("idx") - F.col("o")).where("start >= 0")
                  .where(F.col("start") <= F.col("n") - L)
                  .groupBy("g", "start").agg(F.sum("x").alias("whole"), F.sum(F.when(F.col("o") < F.col("tail"), F.col("x"))).alias("part")))
    draws = block_draws(usable, cfg)
    means = (draws.join(sums, ["g", "start"])
                  .groupBy("g", "b").agg((F.sum(F.when(F.col("is_last"), F.col("part")).otherwise(F.col("whole"))) / F.max("n")).alias("m")))
    ci = means.groupBy("g").agg(F.percentile("m", 0.025).alias("lo"), F.percentile("m", 0.975).alias("hi"))   # B values
    return size.join(ci, "g", "left").select("g", "n", "mean", "lo", "hi")


def weighted_bootstrap(days: DataFrame, cfg: Config) -> DataFrame:
    """block_bootstrap of the series in which each day's x stands n times, in date order, without a row per element.

    days (g, date, n, x) has one row per series and session; null x and n < 1 are left out. Running counts give each
    day its positions [from, upto). A drawn block starts inside one day and reaches at most `block` days, so that day's
    row carries the next ones and the block's sum is their values times the overlap. The day is found through equal
    cells of about N / days positions: at most two rows a day in all, of which a draw meets two on average, so they
    are broadcast and drawn blocks are summed where they are made.
    """
    L = cfg.block
    w = Window.partitionBy("g").orderBy("date")                       # one row per session
    steps = (days.where("x is not null and n > 0").select("g", "date", F.col("n").cast("long").alias("n"), "x")
                 .withColumn("u0", F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, 0))))
    steps = steps.select("g", "n", "u0", F.col("x").alias("x0"), (F.col("u0") - F.col("n")).alias("from"),
                         *[F.lead(c, k).over(w).alias(f"{a}{k}") for k in range(1, L) for a, c in (("u", "u0"), ("x", "x"))])
    size = steps.groupBy("g").agg(F.sum("n").alias("n"), (F.sum(F.col("n") * F.col("x0")) / F.sum("n")).alias("mean"),
                                  F.count(F.lit(1)).alias("days"))
    usable = (size.where(F.col("n") >= 2 * L).select("g", "n", F.ceil(F.col("n") / L).alias("nb"), F.ceil(F.col("n") / F.col("days")).alias("width"))
                  .withColumn("tail", F.col("n") - (F.col("nb") - 1) * L))
    guide = (steps.drop("n").join(F.broadcast(usable.select("g", "width")), "g")
                  .select("*", F.explode(F.expr("sequence(`from` div width, (u0 - 1) div width)")).alias("cell")))
    length = F.when(F.col("is_last"), F.col("tail")).otherwise(L)
    hits = (block_draws(usable.drop("width"), cfg).withColumn("end", F.col("start") + length)
            .join(F.broadcast(usable.select("g", "width")), "g").withColumn("cell", F.expr("start div width")).drop("width")
            .join(F.broadcast(guide.drop("width")), ["g", "cell"]).where("`from` <= start and start < u0"))
    total = F.col("x0") * (F.least("u0", "end") - F.col("start"))
    for k in range(1, L):
        part = F.least(f"u{k}", "end") - F.col(f"u{k - 1}")           # a day that the block does not reach is not read
        total = total + F.when((F.col("end") > F.col(f"u{k - 1}")) & F.col(f"u{k}").isNotNull(), F.col(f"x{k}") * part).otherwise(0.0)
    ci = (hits.groupBy("g", "b").agg((F.sum(total) / F.max("n")).alias("m"))
              .groupBy("g").agg(F.percentile("m", 0.025).alias("lo"), F.percentile("m", 0.975).alias("hi")))  # B values
    return size.join(ci, "g", "left").select("g", "n", "mean", "lo", "hi")


def drawn_names(d: DataFrame, basket: DataFrame, cfg: Config, repeats: int, by: tuple[str, ...], pool: str, tag: str, of: tuple[str, ...]) -> tuple[DataFrame, DataFrame]:
    """(by, rep, pos) of k names drawn without replacement, k as in the basket, and (of, pos, net) of the pool's buyable names.

    Names get a position by a hash of the ticker within `of`, a part of `by`; only the drawn positions are joined, so the cost does not grow
    with repeats times pool.
    """
    p = d.where(F.col(pool) & F.col("buyable")).select(*of, "ticker", "net").withColumn("_h", draw32("ix", F.col("ticker")).cast("double"))
    p = add_row_number(p, list(of), "_h", "ticker", "pos", "size", cfg.split)
    size = p.groupBy(*of).agg(F.max("size").alias("size"))
    k = bought_days(basket).select(*by, F.col("n").alias("k")).join(size, list(of))
    reps = k.withColumn("k", F.least("k", "size").cast("long")).withColumn("rep", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))))
    key = [F.col(c).cast("string") for c in by]
    return explode_subset(reps, "size", "k", cfg.seed, tag, *key, F.col("rep")), p.select(*of, "pos", "net")


def random_benchmark(d: DataFrame, basket: DataFrame, cfg: Config, repeats: int, by: tuple[str, ...] = ("date",),
                     pool: str = "value_top30", tag: str = "rand") -> DataFrame:
    """(by, rep, net): mean net of k names drawn without replacement from the date's buyable pool, k as in the basket."""
    draws, names = drawn_names(d, basket, cfg, repeats, by, pool, tag, by)
    return draws.join(names, [*by, "pos"]).groupBy(*by, "rep").agg(F.avg("net").alias("rand_net"))


def random_mean(d: DataFrame, basket: DataFrame, cfg: Config, repeats: int, by: tuple[str, ...], pool: str, tag: str, of: tuple[str, ...]) -> DataFrame:
    """(by, random): mean of random_benchmark over its repeats, which all draw the same number of names. d needs a net in every row.

    A position drawn in many repeats is counted before it is joined.
    """
    draws, names = drawn_names(d, basket, cfg, repeats, by, pool, tag, of)
    times = draws.groupBy(*by, "pos").agg(F.count(F.lit(1)).alias("times"))
    return times.join(names, [*of, "pos"]).groupBy(*by).agg((F.sum(F.col("net") * F.col("times")) / F.sum("times")).alias("random"))


def against_random(basket: DataFrame, rand: DataFrame, by: tuple[str, ...] = ("date",)) -> DataFrame:
    """Adds random (mean of the repeats) and rand_pctile (share of repeats below the basket)."""
    b = bought_days(basket)
    r = (rand.join(b.select(*by, F.col("net").alias("_net")), list(by)).groupBy(*by)
             .agg(F.avg("rand_net").alias("random"), F.avg((F.col("rand_net") < F.col("_net") - NOISE).cast("double")).alias("rand_pctile")))
    return b.join(r, list(by))


def versus(daily: DataFrame, cfg: Config, others: tuple[str, ...], by: tuple[str, ...] = ()) -> DataFrame:
    """(by, other, mean, lo, hi, win_days) of net minus each other column."""
    pairs = F.explode(F.array(*[F.struct(F.lit(o).alias("other"), (F.col("net") - F.col(o)).alias("x")) for o in others]))
    long = daily.select(*by, "date", pairs.alias("e")).select(*by, "date", "e.other", "e.x").where("x is not null")
    keys = (*by, "other")
    win = long.groupBy(*keys).agg(F.avg((F.col("x") > NOISE).cast("double")).alias("win_days"))
    ci = block_bootstrap(as_series(long, "vs", "x", keys), cfg)
    win = win.withColumn("g", F.concat_ws("|", F.lit("vs"), *[F.col(c) for c in keys]))
    return win.join(ci, "g").select(*keys, "n", "mean", "lo", "hi", "win_days")


def compound(daily: DataFrame, cols: tuple[str, ...], by: tuple[str, ...] = (), horizon: int = 5) -> DataFrame:
    """Overlapping baskets, one fifth of capital each: product of (1 + x/5) - 1."""
    return daily.groupBy(*by).agg(*[(F.exp(F.sum(F.log1p(F.col(c) / horizon))) - 1).alias(f"{c}_cum") for c in cols])


def market_timed(daily: DataFrame, regime: DataFrame) -> DataFrame:
    """net_timed: the basket only while the index stands above its EMA50 (regime: date, vni_dist_ema50)."""
    r = regime.groupBy("date").agg(F.max("vni_dist_ema50").alias("_v"))
    up = truth(F.col("_v") > 0)
    return daily.join(F.broadcast(r), "date", "left").withColumns({"mkt_up": up, "net_timed": F.when(up, F.col("net")).otherwise(F.lit(0.0))}).drop("_v")


def fold_of(date: Column, folds: tuple) -> Column:
    """1-based walk-forward fold of a date, null outside."""
    out = F.lit(None).cast("int")
    for i, (a, b) in enumerate(folds, 1):
        out = F.when(date.between(F.lit(a).cast("date"), F.lit(b).cast("date")), i).otherwise(out)
    return out


def strategies(d: DataFrame, cfg: Config) -> DataFrame:
    """One row per strategy and name: variant, score, in_pool. Rules and models share every later step."""
    d = add_soft_score(d, "p_up_5", "_soft", cfg)
    opts = [("V0_model", "p_up_5", F.col("value_top30")), ("V4_soft_value", "_soft", F.lit(True)), ("V6_logistic", "p_lr", F.col("value_top30")),
            ("R1_momentum20", "ret20", F.col("value_top30")), ("R2_trend_score", "trend_score", F.col("value_top30")),
            ("R3_value_score", "value_score", F.col("value_top30"))]
    e = F.explode(F.array(*[F.struct(F.lit(v).alias("variant"), F.col(c).alias("score"), p.alias("in_pool")) for v, c, p in opts]))
    keep = ["ticker", "date", "industry", "fwd_ret_5", "real", "net", "y_bin", "buyable", "vni_dist_ema50"]
    return d.select(*keep, e.alias("e")).select(*keep, "e.*")


def experiment_rows(long: DataFrame, cfg: Config, repeats: int = 200) -> DataFrame:
    """(variant, fold): period statistics of every strategy in every fold."""
    d = long.withColumn("fold", fold_of(F.col("date"), cfg.folds)).where("fold is not null")
    by = ("variant", "fold", "date")
    b = daily_basket(d, "score", cfg, by, "in_pool")
    r = against_random(b, random_benchmark(d, b, cfg, repeats, by, "in_pool"), by)
    r = market_timed(r, d)
    ic = daily_ic(d, "score", cfg, by, ("variant", "fold", "ticker", "date")).groupBy("variant", "fold").agg(F.avg("ic").alias("ic"))
    s = r.groupBy("variant", "fold").agg(
        F.avg("net").alias("net"), F.avg(F.col("net") - F.col("random")).alias("vs_random"),
        F.avg(F.col("net") - F.col("market_net")).alias("vs_market"), F.avg("net_timed").alias("net_timed"),
        F.avg(F.col("hit") - F.col("base_pool")).alias("lift"), F.count(F.lit(1)).alias("n_days"),
        F.avg(F.col("mkt_up").cast("double")).alias("pct_mkt_up"))
    return s.join(ic, ["variant", "fold"], "left")


def variant_summary(exp: DataFrame) -> DataFrame:
    """Means over folds, folds won, eligibility, and the chosen variant (must beat the best simple rule)."""
    s = exp.groupBy("variant").agg(
        *[F.avg(c).alias(c) for c in ("net", "net_timed", "vs_random", "vs_market", "ic", "lift")],
        F.count_if(F.col("vs_random") > NOISE).alias("folds_beat_rand"), F.count_if(F.col("vs_market") > NOISE).alias("folds_beat_mkt"))
    rule = F.col("variant").startswith("R")
    s = s.withColumn("eligible", truth((F.col("ic") > 0) & (F.col("folds_beat_rand") >= 3) & (F.col("folds_beat_mkt") >= 3)) & ~rule)
    w = Window.partitionBy(F.lit(1))              # one row per variant
    best_rule = F.max(F.when(rule, F.col("vs_market"))).over(w)
    s = s.withColumn("_fit", F.col("eligible") & truth(F.col("vs_market") > best_rule))
    top = F.max(F.when(F.col("_fit"), F.struct("vs_market", "variant"))).over(w)
    return s.withColumn("chosen", truth(F.col("_fit") & (F.col("variant") == top["variant"]))).drop("_fit")


def strategy_report(d: DataFrame, score: str, cfg: Config, name: str) -> DataFrame:
    """One row: period means, IC with interval, spread, calibration verdict."""
    b = daily_basket(d, score, cfg)
    ic = daily_ic(d, score, cfg)
    series = as_series(bought_days(b), f"{name}:excess", "excess").unionByName(as_series(ic, f"{name}:ic", "ic"))
    ci = block_bootstrap(series, cfg).groupBy().agg(
        F.max(F.when(F.col("g").endswith(":excess"), F.col("lo"))).alias("excess_lo"),
        F.max(F.when(F.col("g").endswith(":excess"), F.col("hi"))).alias("excess_hi"),
        F.max(F.when(F.col("g").endswith(":ic"), F.col("mean"))).alias("ic_daily"),
        F.max(F.when(F.col("g").endswith(":ic"), F.col("lo"))).alias("ic_lo"), F.max(F.when(F.col("g").endswith(":ic"), F.col("hi"))).alias("ic_hi"))
    sp = decile_spread(d, score, cfg).agg(F.avg("spread").alias("decile_spread"))
    mono = monotone(calibration(d, score, 30))
    out = summarise_basket(b).withColumn("strategy", F.lit(name))
    for part in (ci, sp, mono):
        out = out.join(F.broadcast(part), F.lit(True), "left")       # one-row summaries
    return out


# Names of the gate's checks, in order.
CHECKS = ["enough_test_days", "excess_positive", "ic_positive_ci_above_zero", "lift_positive", "calibration_monotone", "beats_logistic"]


def gate(model: DataFrame, baseline: DataFrame, cfg: Config) -> DataFrame:
    """One row: checks array<struct<name, pass>> and strategy_pass."""
    b = baseline.select(F.col("excess_ret_5").alias("_base"))
    m = model.join(F.broadcast(b), F.lit(True), "left")
    conds = [F.col("n_days") >= cfg.min_test_days, F.col("excess_ret_5") > 0, (F.col("ic_daily") > 0) & (F.col("ic_lo") > 0),
             F.col("lift") > 0, F.col("calib_monotone"), F.col("excess_ret_5") > F.col("_base")]
    checks = F.array(*[F.struct(F.lit(n).alias("name"), truth(c).alias("pass")) for n, c in zip(CHECKS, conds)])
    return m.select(checks.alias("checks")).withColumn("strategy_pass", F.forall("checks", lambda c: c["pass"]))
