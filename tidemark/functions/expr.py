"""Small column expressions used across operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.config import Config


NOISE = 1e-12      # equal figures averaged in another order are neither above nor below each other


def ratio(a: Column | str, b: Column | str) -> Column:
    return F.try_divide(F.col(a) if isinstance(a, str) else a, F.col(b) if isinstance(b, str) else b)


def change(a, b) -> Column:
    return ratio(a, b) - F.lit(1.0)


def truth(cond: Column) -> Column:
    """Null comparisons count as false."""
    return F.coalesce(cond, F.lit(False))


def net(gross: Column, cfg: Config) -> Column:
    """After-cost return of a round trip: fee on both sides, tax on the sale."""
    return F.lit(1.0 - cfg.fee) * (F.lit(1.0) + gross) * F.lit(1.0 - cfg.fee - cfg.tax) - F.lit(1.0)


def break_even(cfg: Config) -> float:
    return (1.0 + cfg.fee) / (1.0 - cfg.fee - cfg.tax) - 1.0


def clean_nonfinite(df: DataFrame) -> DataFrame:
    """NaN and infinities become null in every floating column."""
    def fix(f):
        if not isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            return F.col(f.name)
        c = F.col(f.name)
        bad = F.isnan(c) | (F.abs(c) == F.lit(float("inf")))
        return F.when(~bad, c).alias(f.name)
    return df.select(*[fix(f) for f in df.schema.fields])


def tidy(df: DataFrame, digits: int = 6, **per: int) -> DataFrame:
    """Report form: doubles rounded (no negative zero), integers as long."""
    def fix(f):
        c = F.col(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            d = per.get(f.name, digits)
            return F.when(F.abs(c) < F.lit(0.5 * 10.0 ** -d), F.lit(0.0)).otherwise(F.round(c, d)).alias(f.name)
        if isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            return c.cast("long").alias(f.name)
        return c
    return df.select(*[fix(f) for f in df.schema.fields])


def last_rows(df: DataFrame, date: str = "date") -> DataFrame:
    """Rows of the latest date; the date becomes a pushed-down literal."""
    return df.where(F.col(date) == df.select(F.max(date)).scalar())
