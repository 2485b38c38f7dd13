"""Published tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.config import Config
from tidemark.functions.expr import last_rows, truth
from tidemark.functions.ranks import add_min_ranks


def publish_slice(log: DataFrame, run_date: str, full: bool = False, days: int = 15) -> DataFrame:
    """Rows of the newest prediction dates plus rows settled on the run date; everything on a full push."""
    if full:
        return log
    recent = log.select("data_date").distinct().orderBy(F.desc("data_date")).limit(days).withColumn("_r", F.lit(True))
    j = log.join(F.broadcast(recent), "data_date", "left")        # `days` rows
    return j.where(truth(F.col("_r")) | truth(F.col("settled_on") == F.lit(run_date).cast("date"))).select(*log.columns)


def replace_snapshot(df: DataFrame, path: str) -> None:
    """Overwrite exactly the data_date partitions present in df."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("data_date").parquet(path))


def drop_older(df: DataFrame) -> DataFrame:
    """Only the newest data_date remains visible."""
    return last_rows(df, "data_date")


def merge_columns(detail: DataFrame, outcome: DataFrame, keys: tuple[str, ...] = ("data_date", "ticker")) -> DataFrame:
    """Columns written at different times under one key; the later write wins where both hold a value."""
    both = [c for c in detail.columns if c in outcome.columns and c not in keys]
    o = outcome.withColumnsRenamed({c: f"_o_{c}" for c in both})
    j = detail.join(o, list(keys), "full_outer")
    return j.withColumns({c: F.coalesce(f"_o_{c}", c) for c in both}).drop(*[f"_o_{c}" for c in both])


# Columns of the daily score table.
SCORE_COLUMNS = ["date", "ticker", "industry", "close", "p_up_5", "p_lr", "rank_all", "value_score", "value_mode", "value_top30",
                 "trend_score", "regime", "atr14_pct", "liq20", "near_ceiling", "near_floor", "exch", "exch_src"]


def scores_daily(scored: DataFrame, cfg: Config) -> DataFrame:
    """Score table of the last date."""
    d = add_min_ranks(last_rows(scored), ["date"], {"rank_all": ("p_up_5", False)}, cfg.split)
    return d.select(*SCORE_COLUMNS)
