"""Cross-sectional ranks and quantiles.

Two plans for the same numbers. `split=False`: one window per date, right while a date's names fit a
task (the caller measures that bound). `split=True`: every date is cut into value ranges by a fixed
monotone function of the value, ranges are counted first and ranked separately, so no task ever holds
a whole date; equal values are counted before the shuffle, so a value shared by a third of the rows
costs one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import materialise

RANGES = 64           # value ranges per group


def add_range(counted: DataFrame, by: list[str], value: str, out: str) -> DataFrame:
    """Order-preserving range number of every row, by cut points measured in its group.

    counted holds every value of a group once, so the ranges of a group are about equal however narrow its values are;
    infinities and NaN (largest) are values like others. A sketch per group gives the cuts; no group meets in one task.
    """
    cuts = counted.groupBy(*by).agg(F.percentile_approx(value, [i / RANGES for i in range(1, RANGES)], 2000).alias("_cuts"))
    return counted.join(cuts, by).withColumn(out, F.size(F.filter("_cuts", lambda c: c < F.col(value))).cast("long")).drop("_cuts")


def _direct(df: DataFrame, by: list[str], specs: dict, kind: str) -> DataFrame:
    n_w = Window.partitionBy(*by)
    out = {}
    for name, (col, asc) in specs.items():
        x = F.col(col)
        w = Window.partitionBy(*by).orderBy(x.asc_nulls_last() if asc else x.desc_nulls_last())
        peers = F.count(x).over(w.rangeBetween(Window.currentRow, Window.currentRow))
        first = F.rank().over(w)
        if kind == "min":
            out[name] = F.when(x.isNotNull(), first.cast("long"))
            continue
        out[name] = F.when(x.isNotNull(), (first + (peers - 1) / F.lit(2.0)) / F.count(x).over(n_w))
    return df.withColumns(out)


def _split(df: DataFrame, by: list[str], key: list[str], specs: dict, kind: str) -> DataFrame:
    names = list(specs)
    entries = F.array(*[
        F.struct(F.lit(i).alias("m"), F.col(specs[n][0]).alias("v")) for i, n in enumerate(names)])
    falling = [i for i, n in enumerate(names) if not specs[n][1]]
    df = materialise(df, "rank_in")
    long = (df.select(*dict.fromkeys([*by, *key]), F.explode(entries).alias("e"))
              .select(*dict.fromkeys([*by, *key]), "e.m", (F.col("e.v") + 0.0).alias("v")).where("v is not null"))
    cnt = materialise(add_range(long.groupBy(*by, "m", "v").agg(F.count(F.lit(1)).alias("n")), [*by, "m"], "v", "b"), "rank_counts")
    run = Window.partitionBy(*by, "m").orderBy("b").rowsBetween(Window.unboundedPreceding, 0)
    ranges = (cnt.groupBy(*by, "m", "b").agg(F.sum("n").alias("bn"))
                 .withColumn("before", F.sum("bn").over(run) - F.col("bn"))
                 .withColumn("total", F.sum("bn").over(Window.partitionBy(*by, "m"))))
    inner = Window.partitionBy(*by, "m", "b").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    below = F.col("before") + F.col("upto") - F.col("n")
    # ranges always rise; a falling rank counts the rows above, so NaN (largest) and infinities stand where one window puts them
    ahead = F.when(F.col("m").isin(falling), F.col("total") - F.col("n") - below).otherwise(below) if falling else below
    rank = ahead + 1 if kind == "min" else (ahead + (F.col("n") + 1) / F.lit(2.0)) / F.col("total")
    ranked = (cnt.withColumn("upto", F.sum("n").over(inner)).join(ranges, [*by, "m", "b"])
                 .select(*by, "m", "v", rank.alias("pr")))
    wide = (long.join(ranked, [*by, "m", "v"]).groupBy(*dict.fromkeys([*by, *key]))
                .agg(*[F.max(F.when(F.col("m") == i, F.col("pr"))).alias(n) for i, n in enumerate(names)]))
    return df.join(wide, list(dict.fromkeys([*by, *key])), "left")


def add_pct_ranks(df: DataFrame, by: list[str], specs: dict[str, tuple[str, bool]], split: bool = False,
                  key: tuple[str, ...] = ("ticker", "date")) -> DataFrame:
    """Average-tie rank over the number of non-null values. specs: output -> (column, ascending)."""
    return _split(df, by, list(key), specs, "pct") if split else _direct(df, by, specs, "pct")


def add_min_ranks(df: DataFrame, by: list[str], specs: dict[str, tuple[str, bool]], split: bool = False,
                  key: tuple[str, ...] = ("ticker", "date")) -> DataFrame:
    """Competition rank (ties share the smallest place) among non-null values."""
    return _split(df, by, list(key), specs, "min") if split else _direct(df, by, specs, "min")


def add_row_number(df: DataFrame, by: list[str], value: str, tie: str, out: str, total: str,
                   split: bool = False) -> DataFrame:
    """1-based position by (value, tie) among non-null values, and their count; tie is a string column.

    split: equal values are cut again by the first characters of the tie column (all but the last two of its longest
    text), so a value shared by many rows is not numbered in one task either.
    """
    df = df.where(F.col(value).isNotNull())
    if not split:
        w = Window.partitionBy(*by)
        return df.withColumns({out: F.row_number().over(w.orderBy(value, tie)).cast("long"),
                               total: F.count(F.lit(1)).over(w)})
    df = materialise(df.withColumn("_v", F.col(value) + 0.0), "row_number_in")
    longest = df.agg(F.max(F.length(F.col(tie).cast("string")))).first()[0] or 0
    df = df.withColumn("_t", F.substring(F.col(tie).cast("string"), 1, max(1, longest - 2)))
    ties = materialise(df.groupBy(*by, "_v", "_t").agg(F.count(F.lit(1)).alias("_cnt")), "tie_counts")
    vals = materialise(add_range(ties.groupBy(*by, "_v").agg(F.sum("_cnt").alias("_cnt")), by, "_v", "_b"), "value_counts")
    run = Window.partitionBy(*by).orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)
    ranges = (vals.groupBy(*by, "_b").agg(F.sum("_cnt").alias("_in_range"))
                  .select(*by, "_b", (F.sum("_in_range").over(run) - F.col("_in_range")).alias("_before"),
                          F.sum("_in_range").over(Window.partitionBy(*by)).alias(total)))
    inner = Window.partitionBy(*by, "_b").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    below = (vals.withColumn("_upto", F.sum("_cnt").over(inner)).join(ranges, [*by, "_b"])
                 .select(*by, "_v", total, (F.col("_before") + F.col("_upto") - F.col("_cnt")).alias("_below")))
    prefix = Window.partitionBy(*by, "_v").orderBy("_t").rowsBetween(Window.unboundedPreceding, 0)     # prefixes of equal values
    start = (ties.withColumn("_up", F.sum("_cnt").over(prefix) - F.col("_cnt")).join(below, [*by, "_v"])
                 .select(*by, "_v", "_t", total, (F.col("_below") + F.col("_up")).alias("_start")))
    w = Window.partitionBy(*by, "_v", "_t").orderBy(tie)
    return (df.withColumn("_within", F.row_number().over(w)).join(start, [*by, "_v", "_t"])
              .withColumn(out, F.col("_start") + F.col("_within")).drop("_v", "_t", "_within", "_start"))


def group_quantile(df: DataFrame, by: list[str], value: str, q: float, out: str, split: bool = False) -> DataFrame:
    """Exact linear-interpolated quantile per group: one row per group.

    split: value ranges are counted, then only the one or two ranges that hold the wanted positions are read.
    """
    df = df.where(F.col(value).isNotNull())
    if not split:
        return df.groupBy(*by).agg(F.percentile(value, q).alias(out))
    one = by or ["_g"]
    base = df.select(*by, F.col(value).alias("_v")) if by else df.select(F.lit(1).alias("_g"), F.col(value).alias("_v"))
    cnt = materialise(add_range(base.groupBy(*one, "_v").agg(F.count(F.lit(1)).alias("_n")), one, "_v", "_b"), "quantile_counts")
    run = Window.partitionBy(*one).orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)
    pos = (F.col("_t") - 1) * F.lit(q)
    ranges = (cnt.groupBy(*one, "_b").agg(F.sum("_n").alias("_bn"))
                 .withColumn("_upto", F.sum("_bn").over(run)).withColumn("_before", F.col("_upto") - F.col("_bn"))
                 .withColumn("_t", F.sum("_bn").over(Window.partitionBy(*one)))
                 .withColumns({"_lo": F.floor(pos) + 1, "_hi": F.ceil(pos) + 1, "_f": pos - F.floor(pos)})
                 .where("(_lo > _before and _lo <= _upto) or (_hi > _before and _hi <= _upto)"))
    inner = Window.partitionBy(*one, "_b").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    hit = (cnt.join(ranges, [*one, "_b"]).withColumn("_c", F.sum("_n").over(inner) + F.col("_before"))
              .where("(_lo > _c - _n and _lo <= _c) or (_hi > _c - _n and _hi <= _c)"))
    lo = F.max(F.when((F.col("_lo") > F.col("_c") - F.col("_n")) & (F.col("_lo") <= F.col("_c")), F.col("_v")))
    hi = F.max(F.when((F.col("_hi") > F.col("_c") - F.col("_n")) & (F.col("_hi") <= F.col("_c")), F.col("_v")))
    res = hit.groupBy(*one).agg((lo + (hi - lo) * F.max("_f")).alias(out))
    return res if by else res.drop("_g")
