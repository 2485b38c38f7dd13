"""Point-in-time features: windows per ticker over sessions.

A bar is unique per (ticker, date), so a ticker's window never exceeds the trading calendar. Every family is a list of
column layers; layers of equal depth share one window pass. Once a bar's position is known, every window is ordered by
(block of the recursive averages, date), which is the order of dates, so the whole feature frame costs one exchange (none
on a ticker-bucketed table) and two sorts: one for the position, one for everything else.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.config import Config
from tidemark.functions import ewm
from tidemark.functions.ewm import apply_layers, block_number
from tidemark.functions.expr import change, ratio

Layers = list[dict[str, Column]]
WILDER = 1.0 / 14
ORDER = ["_part", "date"]        # block of sessions, then date: dates in order, and the order the recursive averages need


def by_ticker():
    return Window.partitionBy("ticker").orderBy(ORDER)


def seen(x: str, expr: Column | None = None) -> dict[str, Column]:
    return ewm.seen(x, expr, "ticker", ORDER)


def smooth_layers(specs: list[tuple[str, str, float, int]]) -> Layers:
    return ewm.smooth_layers(specs, "ticker", "date", part=F.col("_part"))


def derive(df: DataFrame, *families: Layers, keep: tuple[str, ...] = ()) -> DataFrame:
    """Add position, then the families; of nbars (1-based) and pos (0-based) only those in `keep` stay."""
    n = F.row_number().over(Window.partitionBy("ticker").orderBy("date")).cast("long")
    df = df.withColumns({"nbars": n, "pos": n - 1}).withColumn("_part", block_number())
    df = apply_layers(df, *families) if families else df
    return df.drop("_part", *[c for c in ("nbars", "pos") if c not in keep])


def _lag(c: str, n: int = 1) -> Column:
    return F.lag(c, n).over(by_ticker())


def _counts(*cols: str) -> dict[str, Column]:
    """_n_<col>: running count of non-null values, so a frame's count is one subtraction."""
    w = by_ticker().rowsBetween(Window.unboundedPreceding, 0)
    return {f"_n_{c}": F.count(c).over(w) for c in cols}


def _between(x: str, a: int, b: int) -> Column:
    """Non-null values from b-1 to a bars ago."""
    upto = lambda k: F.coalesce(_lag(f"_n_{x}", k), F.lit(0)) if k else F.col(f"_n_{x}")
    return upto(a) - upto(b)


def _full(agg, x: str, n: int, need: int | None = None) -> Column:
    """Aggregate of the last n bars, null below `need` non-null values."""
    return F.when(_between(x, 0, n) >= (need or n), agg(x).over(by_ticker().rowsBetween(-(n - 1), 0)))


# ---- families ----
def returns(spans=(1, 5, 20, 60)) -> Layers:
    return [{f"ret{n}": change(F.col("close"), _lag("close", n)) for n in spans}]


def trend(cfg: Config) -> Layers:
    """Distances to the 20/50/200-session averages, their spread and slope."""
    ema = smooth_layers([(f"ema{n}", "close", 2.0 / (n + 1), n) for n in (20, 50, 200)])
    return [seen("close"), *ema, {
        **{f"dist_ema{n}": change(F.col("close"), F.col(f"ema{n}")) for n in (20, 50, 200)},
        "ema20_50": change(F.col("ema20"), F.col("ema50")), "ema50_slope10": change(F.col("ema50"), _lag("ema50", 10))}]


def directional(cfg: Config) -> Layers:
    """True range, directional movement, ADX and RSI, all on Wilder averages."""
    c, h, l = F.col("close"), F.col("high"), F.col("low")
    up, dn, move = h - F.col("_ph"), F.col("_pl") - l, c - F.col("_pc")
    base = {"tr": F.greatest(h - l, F.abs(h - F.col("_pc")), F.abs(l - F.col("_pc"))),
            "_pdm": F.when((up > dn) & (up > 0), up).otherwise(F.lit(0.0)), "_mdm": F.when((dn > up) & (dn > 0), dn).otherwise(F.lit(0.0)),
            "_gain": F.when(move.isNotNull(), F.greatest(move, F.lit(0.0))), "_loss": F.when(move.isNotNull(), F.greatest(-move, F.lit(0.0)))}
    counts = {k: v for x, e in base.items() for k, v in seen(x, e).items()}
    avg = smooth_layers([("_atr", "tr", WILDER, 14), ("_p", "_pdm", WILDER, 14), ("_m", "_mdm", WILDER, 14), ("_g", "_gain", WILDER, 14),
                         ("_l", "_loss", WILDER, 14)])
    plus, minus = ratio(F.lit(100.0) * F.col("_p"), "_atr"), ratio(F.lit(100.0) * F.col("_m"), "_atr")
    dx = ratio(F.lit(100.0) * F.abs(plus - minus), plus + minus)
    g, ls = F.col("_g"), F.col("_l")
    rsi = F.when((ls == 0) & (g > 0), F.lit(100.0)).when(ls > 0, F.lit(100.0) - F.lit(100.0) / (F.lit(1.0) + g / ls))
    return [{"_pc": _lag("close"), "_ph": _lag("high"), "_pl": _lag("low")}, {**base, **counts}, *avg,
            {"plus_di": plus, "minus_di": minus, "dx": dx, **seen("dx", dx), "atr14_pct": ratio("_atr", "close"),
             "di_diff": ratio(plus - minus, plus + minus), "rsi14": rsi},
            *smooth_layers([("adx14", "dx", WILDER, 14)])]


def macd(cfg: Config) -> Layers:
    line = F.col("_e12") - F.col("_e26")
    return [seen("close"), *smooth_layers([("_e12", "close", 2.0 / 13, 12), ("_e26", "close", 2.0 / 27, 26)]),
            {"_macd": line, **seen("_macd", line)}, *smooth_layers([("_sig", "_macd", 2.0 / 10, 9)]),
            {"macd_hist": ratio(F.col("_macd") - F.col("_sig"), "close")}]


def volatility() -> Layers:
    """Needs ret1 from a layer before the second."""
    return [{}, _counts("ret1"), {f"volat{n}": _full(F.stddev_samp, "ret1", n) for n in (20, 60)}]


def activity() -> Layers:
    """Volume against its 20-session mean (today included) and mean turnover (missing counts as 0, 15 needed)."""
    return [{"_val": F.coalesce(F.col("turnover"), F.lit(0.0)), **_counts("volume"), "_n__val": F.row_number().over(by_ticker())},
            {"_mv": _full(F.avg, "volume", 20), "liq20": _full(F.avg, "_val", 20, 15)},
            {"vol_ratio20": ratio(F.col("volume"), "_mv"), "log_liq20": F.log1p("liq20")}]


def _longest(agg, x: str, lags: tuple[int, ...]) -> Column:
    """Extreme over the frames of x that end `lags` bars ago; together they cover one longer frame."""
    return agg(*[_lag(x, k) if k else F.col(x) for k in lags])


def range_position() -> Layers:
    """Place in the 20/60-session range, distance to the year's extremes, close location, swing structure.

    Extremes may overlap, so the frames of 20, 60 and 252 bars are put together from lagged shorter ones (10 bars, then
    20, then 60): seventeen values a row and side in place of 332.
    """
    c, h, l = F.col("close"), F.col("high"), F.col("low")
    sides = (("hi", "high", F.max, F.greatest), ("lo", "low", F.min, F.least))
    recent = by_ticker().rowsBetween(-9, 0)
    ten = {f"_{s}10": agg(x).over(recent) for s, x, agg, _ in sides}
    r20 = {f"_{s}20r": _longest(g, f"_{s}10", (0, 10)) for s, _, _, g in sides}
    r60 = {f"_{s}60r": _longest(g, f"_{s}20r", (0, 20, 40)) for s, _, _, g in sides}
    ext = {}
    for s, x, _, g in sides:
        ext |= {f"_{s}20": F.when(_between(x, 0, 20) >= 20, F.col(f"_{s}20r")), f"_{s}60": F.when(_between(x, 0, 60) >= 60, F.col(f"_{s}60r")),
                f"_{s}252": F.when(_between(x, 0, 252) >= 120, _longest(g, f"_{s}60r", (0, 60, 120, 180, 192))),
                f"_{s}10old": F.when(_between(x, 10, 20) == 10, _lag(f"_{s}10", 10))}
    out = {f"pos{n}": ratio(c - F.col(f"_lo{n}"), F.col(f"_hi{n}") - F.col(f"_lo{n}")) for n in (20, 60)}
    out |= {"dd252": change(c, F.col("_hi252")), "up252": change(c, F.col("_lo252")), "clv": ratio((c - l) - (h - c), h - l),
            "hh10": change(F.col("_hi10"), F.col("_hi10old")), "hl10": change(F.col("_lo10"), F.col("_lo10old"))}
    return [{**_counts("high", "low"), **ten}, r20, r60, ext, out]


# ---- frames ----
def add_position(df: DataFrame) -> DataFrame:
    """nbars (1-based) and pos (0-based) bar number of the ticker."""
    return derive(df, keep=("nbars", "pos"))


def add_returns(df: DataFrame, spans=(1, 5, 20, 60)) -> DataFrame:
    return derive(df, returns(spans))


def add_trend(df: DataFrame, cfg: Config) -> DataFrame:
    return derive(df, trend(cfg), keep=("nbars", "pos"))


def add_directional(df: DataFrame, cfg: Config) -> DataFrame:
    return derive(df, directional(cfg), keep=("nbars", "pos"))


def add_macd(df: DataFrame, cfg: Config) -> DataFrame:
    return derive(df, macd(cfg), keep=("nbars", "pos"))


def add_volatility(df: DataFrame) -> DataFrame:
    return derive(df, returns((1,)), volatility())


def add_activity(df: DataFrame) -> DataFrame:
    return derive(df, activity())


def add_range_position(df: DataFrame) -> DataFrame:
    return derive(df, range_position())


def add_features(bars: DataFrame, cfg: Config, *more: Layers) -> DataFrame:
    """All families side by side over one row order; `more` families ride along."""
    df = derive(bars, returns(), trend(cfg), directional(cfg), macd(cfg), volatility(), activity(), range_position(), *more, keep=("nbars",))
    return df.drop("ema20", "ema50", "ema200", "tr", "plus_di", "minus_di", "dx")


def index_features(index: DataFrame, cfg: Config) -> DataFrame:
    """vni_ret5, vni_ret20, vni_dist_ema50 per date (index series: one row per date)."""
    ema = smooth_layers([("_e", "close", 2.0 / 51, 50)])
    df = derive(index, returns((5, 20)), [seen("close"), *ema, {"vni_dist_ema50": change(F.col("close"), F.col("_e"))}])
    return df.select("date", F.col("ret5").alias("vni_ret5"), F.col("ret20").alias("vni_ret20"), "vni_dist_ema50")


def add_index_features(df: DataFrame, index: DataFrame, cfg: Config) -> DataFrame:
    """Broadcast is safe: one row per session of the calendar."""
    return df.join(F.broadcast(index_features(index, cfg)), "date", "left")


def index_outlook(index: DataFrame, cfg: Config) -> DataFrame:
    """Per date: close, change over 1/5/20 sessions, distance to EMA50 and EMA200 without a minimum history."""
    ema = smooth_layers([("_e50", "close", 2.0 / 51, 1), ("_e200", "close", 2.0 / 201, 1)])
    df = derive(index, returns((1, 5, 20)), [seen("close"), *ema, {
        "dist_ema50": change(F.col("close"), F.col("_e50")), "dist_ema200": change(F.col("close"), F.col("_e200"))}])
    return df.select("date", "close", F.col("ret1").alias("chg1"), F.col("ret5").alias("chg5"), F.col("ret20").alias("chg20"), "dist_ema50", "dist_ema200")
