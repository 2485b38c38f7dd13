"""Quality checks, quarantine, audits, source comparison."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.config import Config
from tidemark.functions.expr import change, ratio, truth
from tidemark.functions.ranks import add_row_number
from tidemark.operators.ingest import clean_counts


def _ret(c: str = "close") -> Column:
    return change(F.col(c), F.lag(c).over(Window.partitionBy("ticker").orderBy("date")))


def qc(panel: DataFrame, today: str, cfg: Config) -> DataFrame:
    """One row of panel checks; blocking when keys repeat or prices are not positive."""
    last = panel.select(F.max("date")).scalar()
    on_last = panel.where(F.col("date") == last).select(F.count(F.lit(1))).scalar()
    out = clean_counts(panel).withColumns({"last_date": last, "n_tickers_last_day": on_last})
    out = out.withColumnRenamed("nonpositive", "nonpositive_price").withColumn("stale_days", F.datediff(F.lit(today).cast("date"), "last_date"))
    return out.withColumns({"stale": F.col("stale_days") > cfg.max_stale_days, "blocking": (F.col("dups") > 0) | (F.col("nonpositive_price") > 0)})


def jumps(panel: DataFrame, limit: float = 0.16, days: int = 90) -> DataFrame:
    """Tickers with a one-bar move beyond the limit in the last calendar days."""
    last = panel.select(F.max("date")).scalar()
    r = panel.select("ticker", "date", F.abs(_ret()).alias("r"))
    return r.where((F.col("date") > F.date_sub(last, days)) & (F.col("r") > limit)).select("ticker").distinct()


def quarantine(jumped: DataFrame, batch: DataFrame, old: DataFrame, replaced: DataFrame, revalidated: DataFrame) -> DataFrame:
    """((jumps | batch | old) - replaced - revalidated) | jumps, on ticker columns."""
    t = lambda d: d.select("ticker")
    cleared = t(replaced).union(t(revalidated))
    return t(jumped).union(t(batch)).union(t(old)).distinct().join(cleared, "ticker", "left_anti").union(t(jumped)).distinct()


def visible(panel: DataFrame, now_utc: str, asof: str | None = None, close_hour: float = 15.5, zone: str = "Asia/Ho_Chi_Minh") -> DataFrame:
    """Rows known as of a date; without one, today's unfinished session is hidden until the local close."""
    if asof:
        return panel.where(F.col("date") <= F.lit(asof).cast("date"))
    local = F.convert_timezone(F.lit("UTC"), F.lit(zone), F.lit(now_utc).cast("timestamp_ntz"))
    before = F.hour(local) + F.minute(local) / 60 < close_hour
    return panel.where(~before | (F.col("date") < F.to_date(local)))


def audit(panel: DataFrame, since: str, pattern: str) -> DataFrame:
    """One row: long gaps, closes outside the bar, large moves; all codes and plain codes apart."""
    w = Window.partitionBy("ticker").orderBy("date")
    d = panel.select("ticker", "date", "high", "low", "close", _ret().alias("r"), F.datediff("date", F.lag("date").over(w)).alias("gap"))
    late = F.col("date") >= F.lit(since).cast("date")
    plain = late & F.col("ticker").rlike(f"^(?:{pattern})$")
    big = F.abs(F.col("r")) > 0.155
    return d.agg(
        F.count_if(late & (F.col("gap") > 10)).alias("gaps_over_10d"),
        F.count_if((F.col("close") > F.col("high") * 1.001) | (F.col("close") < F.col("low") * 0.999)).alias("close_outside"),
        F.count_if(late & big).alias("big_moves"), F.count_distinct(F.when(late & big, F.col("ticker"))).alias("big_move_tickers"),
        F.count_if(plain & big).alias("big_moves_plain"), F.count_if(plain & (F.col("r") < -0.30)).alias("falls_over_30pct"))


def liquid_by_median(panel: DataFrame, since: str, threshold: float) -> DataFrame:
    """(ticker, median_turnover) at or above the threshold; at most one value per session."""
    m = panel.where(F.col("date") >= F.lit(since).cast("date")).groupBy("ticker").agg(F.median("turnover").alias("median_turnover"))
    return m.where(F.col("median_turnover") >= threshold)


def tickers_per_date(panel: DataFrame, n: int = 10) -> DataFrame:
    """Last n dates with their ticker counts."""
    return panel.groupBy("date").agg(F.count("ticker").alias("n_tickers")).orderBy(F.desc("date")).limit(n)


def business_days_between(start: Column, end: Column) -> Column:
    """Weekdays in (start, end]: whole weeks plus the weekdays of the remainder, without listing the days."""
    n = F.datediff(end, start)
    rest = F.filter(F.sequence(F.lit(1), F.lit(6)), lambda i: (i <= n % 7) & ~F.dayofweek(F.date_add(end, -(i - 1))).isin(1, 7))
    return F.when(n > 0, F.floor(n / 7) * 5 + F.size(rest)).otherwise(F.lit(0))


def health_checks(log: DataFrame, runs: DataFrame, now_utc: str, cfg: Config, zone: str = "Asia/Ho_Chi_Minh") -> DataFrame:
    """Business days since the last run, upper-median volume ratio of that date, and rows open for over 11 days."""
    today = F.to_date(F.convert_timezone(F.lit("UTC"), F.lit(zone), F.lit(now_utc).cast("timestamp_ntz")))
    d = runs.select(F.max("data_date")).scalar()
    one = add_row_number(log.where(F.col("data_date") == d), ["data_date"], "vol_ratio20", "ticker", "_r", "_n", cfg.split)
    med = one.where(F.col("_r") == F.floor(F.col("_n") / 2) + 1).select(F.max("vol_ratio20")).scalar()
    stuck = log.where((F.col("status") == "open") & (F.col("data_date") < F.date_sub(d, 11))).select(F.count(F.lit(1))).scalar()
    out = runs.select(F.max("data_date").alias("last_date")).withColumns({"median_vol_ratio": med, "n_stuck": stuck})
    out = out.withColumn("business_days_late", business_days_between(F.col("last_date"), today))
    return out.withColumns({"freshness": F.when(F.col("business_days_late") > 3, "fail").when(F.col("business_days_late") > 1, "warn").otherwise("ok"),
                            "partial_bar": truth(F.col("median_vol_ratio") < 0.5)})


def coverage(panel: DataFrame) -> DataFrame:
    """Rows, first and last date per ticker."""
    return panel.groupBy("ticker").agg(F.count(F.lit(1)).alias("rows"), F.min("date").alias("first"), F.max("date").alias("last"))


def coverage_summary(panel: DataFrame, start: str, end: str) -> DataFrame:
    """Extremes over tickers and the weekdays of the range as an upper bound of sessions."""
    c = coverage(panel).agg(F.count(F.lit(1)).alias("tickers"), F.sum("rows").alias("rows"), F.min("rows").alias("min_rows"),
                            F.max("rows").alias("max_rows"), F.min("first").alias("first_min"), F.max("first").alias("first_max"))
    return c.withColumn("expected_weekdays", business_days_between(F.date_sub(F.lit(start).cast("date"), 1), F.lit(end).cast("date")))


def overlap_diff(a: DataFrame, b: DataFrame) -> DataFrame:
    """(ticker, date, diff): absolute relative deviation of closes present in both."""
    j = a.select("ticker", "date", F.col("close").alias("_a")).join(b.select("ticker", "date", F.col("close").alias("_b")), ["ticker", "date"])
    return j.select("ticker", "date", F.abs(change(F.col("_b"), F.col("_a"))).alias("diff"))


def event_counts(actions: DataFrame) -> DataFrame:
    return actions.agg(F.count_if(F.col("dividend") > 0).alias("n_dividends"), F.count_if(F.col("split") > 0).alias("n_splits"))


def event_attribution(panel: DataFrame, other: DataFrame, actions: DataFrame, overlap_end: str, cfg: Config) -> DataFrame:
    """Tickers beyond tolerance in the overlap, with and without a corporate action after it."""
    end = F.lit(overlap_end).cast("date")
    per = overlap_diff(panel, other).where(F.col("date") <= end).groupBy("ticker").agg(F.max("diff").alias("worst"))
    later = (actions.where((F.col("date") > end) & ((F.col("dividend") > 0) | (F.col("split") > 0))).groupBy("ticker").agg(F.count(F.lit(1)).alias("n_after")))
    j = per.join(later, "ticker", "left")
    over = F.col("worst") > cfg.adjust_tol
    return j.agg(F.count_if(over & F.col("n_after").isNotNull()).alias("over_with_event"), F.count_if(over & F.col("n_after").isNull()).alias("over_without_event"),
                 F.count_if(~over).alias("within"))


def compare_sources(a: DataFrame, b: DataFrame, tol: float = 0.005) -> DataFrame:
    """Per ticker: common dates, median close ratio, share within tolerance as is and times 1000."""
    j = a.select("ticker", "date", F.col("close").alias("_a")).join(b.select("ticker", "date", F.col("close").alias("_b")), ["ticker", "date"])
    r = j.select("ticker", ratio("_b", "_a").alias("r"))
    within = lambda x: F.avg((F.abs(x - 1) <= tol).cast("double"))
    return r.groupBy("ticker").agg(F.count(F.lit(1)).alias("n"), F.median("r").alias("median_ratio"), within(F.col("r")).alias("share_raw"),
                                   within(F.col("r") * 1000).alias("share_x1000"))


def deviation(a: DataFrame, refs: dict[str, DataFrame], tol: float = 0.005) -> DataFrame:
    """(ticker, ref): common dates, share within tolerance, largest deviation in percent; several references in one pass."""
    u = None
    for name, r in refs.items():
        d = r.select(F.lit(name).alias("ref"), "ticker", "date", F.col("close").alias("_r"))
        u = d if u is None else u.unionByName(d)
    j = u.join(a.select("ticker", "date", "close"), ["ticker", "date"]).withColumn("d", F.abs(change(F.col("close"), F.col("_r"))))
    return j.groupBy("ticker", "ref").agg(F.count(F.lit(1)).alias("n"), F.avg((F.col("d") <= tol).cast("double")).alias("within"), (F.max("d") * 100).alias("max_pct"))


def overlap_stats(a: DataFrame, b: DataFrame) -> DataFrame:
    return overlap_diff(a, b).groupBy("ticker").agg(F.avg("diff").alias("mean_diff"), F.max("diff").alias("max_diff"), F.count(F.lit(1)).alias("n"))


def worst_overlap(a: DataFrame, b: DataFrame, n: int = 10) -> DataFrame:
    """The n tickers with the largest deviation."""
    return overlap_stats(a, b).orderBy(F.desc("max_diff"), "ticker").limit(n)


def overlap_totals(a: DataFrame, b: DataFrame, cfg: Config) -> DataFrame:
    s = overlap_diff(a, b).groupBy("ticker").agg(F.sum("diff").alias("s"), F.max("diff").alias("m"), F.count(F.lit(1)).alias("n"))
    return s.agg(F.sum("n").alias("overlap_rows"), (F.sum("s") / F.sum("n") * 100).alias("mean_pct"), (F.max("m") * 100).alias("max_pct"),
                 F.count_if(F.col("m") > cfg.adjust_tol).alias("tickers_over_tol"))


def ratio_counts(a: DataFrame, b: DataFrame, day: str, index_ticker: str, tol: float = 0.005) -> DataFrame:
    """Close ratios of one day: tickers inside and outside tolerance, the index ratio apart."""
    d = F.lit(day).cast("date")
    j = a.where(F.col("date") == d).select("ticker", F.col("close").alias("_a")).join(b.where(F.col("date") == d).select("ticker", F.col("close").alias("_b")), "ticker")
    r, idx = ratio("_a", "_b"), F.col("ticker") == index_ticker
    j = j.select("ticker", r.alias("r"))
    return j.agg(F.count_if(~idx & (F.abs(F.col("r") - 1) <= tol)).alias("inside"), F.count_if(~idx & (F.abs(F.col("r") - 1) > tol)).alias("outside"),
                 F.max(F.when(idx, F.col("r"))).alias("index_ratio"))


def availability(sources: dict[str, DataFrame]) -> DataFrame:
    """(source, ticker): rows, last date, last close."""
    u = None
    for name, s in sources.items():
        d = s.select(F.lit(name).alias("source"), "ticker", "date", "close")
        u = d if u is None else u.unionByName(d)
    return u.groupBy("source", "ticker").agg(F.count(F.lit(1)).alias("rows"), F.max("date").alias("last_date"), F.max_by("close", "date").alias("last_close"))
