"""Running totals and next-value lookups that never hold a whole group in one task.

Rows carry a chunk key that sorts before the row order; chunks are summarised first, the few summaries of a group
are scanned, and the rows of each chunk are finished on their own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.ranks import add_range
from tidemark.session import materialise


def running_total(df: DataFrame, by: list[str], chunk: list[str], order: list[str], value: str, out: str, low: str | None = None) -> DataFrame:
    """Running sum of `value` by (chunk, order); `low` adds the smallest sum (at most 0) before the row."""
    o = Window.partitionBy(*by, *chunk).orderBy(*order)
    c = o.rowsBetween(Window.unboundedPreceding, 0)
    df = materialise(df.withColumn("_loc", F.sum(value).over(c)), "running_in")
    before = Window.partitionBy(*by).orderBy(*chunk).rowsBetween(Window.unboundedPreceding, -1)
    t = (df.groupBy(*by, *chunk).agg(F.sum(value).alias("_tot"), F.min("_loc").alias("_min"))
           .withColumn("_off", F.coalesce(F.sum("_tot").over(before), F.lit(0))))
    t = t.withColumn("_lowest", F.coalesce(F.min(F.col("_off") + F.col("_min")).over(before), F.lit(0)))
    j = df.join(t.select(*by, *chunk, "_off", "_lowest"), [*by, *chunk]).withColumn(out, F.col("_loc") + F.col("_off"))
    if low:
        j = j.withColumn(low, F.least(F.lit(0), F.col("_lowest"), F.col("_off") + F.min("_loc").over(o.rowsBetween(Window.unboundedPreceding, -1))))
    return j.drop("_loc", "_off", "_lowest")


def match_intervals(left: DataFrame, right: DataFrame, by: list[str], l_cols: list[str], r_cols: list[str]) -> DataFrame:
    """Overlaps of two interval families that each tile (0, total]: rows carry their upper end `upto`.

    Both families are merged on one axis; the piece ending at a point belongs to the next end of either family.
    Linear in the rows: no pairs are formed. Columns of each side come back with the overlap `qty`.
    """
    a = left.select(*by, "upto", F.struct(*l_cols).alias("_l"), F.lit(None).alias("_r"))
    b = right.select(*by, "upto", F.lit(None).alias("_l"), F.struct(*r_cols).alias("_r"))
    e = materialise(a.unionByName(b).groupBy(*by, "upto").agg(F.max("_l").alias("_l"), F.max("_r").alias("_r")), "ends")
    e = materialise(add_range(e, by, "upto", "_b"), "merged_ends")
    w = Window.partitionBy(*by, "_b").orderBy("upto")
    ahead, later = w.rowsBetween(0, Window.unboundedFollowing), Window.partitionBy(*by).orderBy("_b")
    after = later.rowsBetween(1, Window.unboundedFollowing)
    s = e.groupBy(*by, "_b").agg(F.max("upto").alias("_top"), F.min_by("_l", F.when(F.col("_l").isNotNull(), F.col("upto"))).alias("_fl"),
                                 F.min_by("_r", F.when(F.col("_r").isNotNull(), F.col("upto"))).alias("_fr"))
    s = s.select(*by, "_b", F.lag("_top").over(later).alias("_below"), F.first("_fl", ignorenulls=True).over(after).alias("_nl"),
                 F.first("_fr", ignorenulls=True).over(after).alias("_nr"))
    e = e.withColumns({"_prev": F.lag("upto").over(w), "_l": F.first("_l", ignorenulls=True).over(ahead), "_r": F.first("_r", ignorenulls=True).over(ahead)})
    j = e.join(s, [*by, "_b"]).withColumns({"_l": F.coalesce("_l", "_nl"), "_r": F.coalesce("_r", "_nr")}).where("_l is not null and _r is not null")
    qty = F.col("upto") - F.coalesce("_prev", "_below", F.lit(0))
    return j.select(*by, *[F.col(f"_l.{c}") for c in l_cols], *[F.col(f"_r.{c}") for c in r_cols], qty.alias("qty"))
