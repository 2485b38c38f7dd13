"""Upsert, adjustment detection, merge of provider updates, dimension upkeep."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.config import Config
from tidemark.functions.expr import change


def upsert(base: DataFrame, new: DataFrame, keys: tuple[str, ...] = ("ticker", "date"), seq: str | None = None) -> DataFrame:
    """Last write wins. `seq` (any orderable column) orders repeated keys inside the batch; what it leaves equal, the values order.

    So the answer never depends on how the batch is partitioned. max_by combines on the map side, so a key repeated in a third of
    the rows never meets in one task.
    """
    cols = [c for c in base.columns if c not in keys]
    kind = new.schema[seq].dataType if seq else "long"
    order = F.col(seq) if seq else F.lit(None).cast("long")
    row = F.struct(*cols)
    b = base.select(*keys, row.alias("_row"), F.struct(F.lit(0).alias("s"), F.lit(None).cast(kind).alias("q"), row.alias("r")).alias("_at"))
    n = new.select(*keys, row.alias("_row"), F.struct(F.lit(1).alias("s"), order.alias("q"), row.alias("r")).alias("_at"))
    m = b.unionByName(n).groupBy(*keys).agg(F.max_by("_row", "_at").alias("_row"))
    return m.select(*keys, "_row.*").select(*base.columns)


def batch_status(base: DataFrame, new: DataFrame, cfg: Config) -> DataFrame:
    """(ticker, status): replaced, quarantine or revalidated; other tickers of the batch have no row."""
    ov = base.select("ticker", "date", F.col("close").alias("_old")).join(new.select("ticker", "date", F.col("close").alias("_new")), ["ticker", "date"])
    bad = ov.groupBy("ticker").agg(F.max(F.abs(change(F.col("_new"), F.col("_old")))).alias("worst"))
    cnt = new.groupBy("ticker").agg(F.count(F.lit(1)).alias("n"))
    full, off = F.col("n") >= cfg.full_history, F.coalesce(F.col("worst") > cfg.adjust_tol, F.lit(False))
    s = F.when(off & full, "replaced").when(off, "quarantine").when(full, "revalidated")
    return cnt.join(bad, "ticker", "left").select("ticker", s.alias("status"), "n").where("status is not null")


def reconcile(base: DataFrame, new: DataFrame, cfg: Config, seq: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(merged, status). Deviating full histories replace the old one; deviating short batches are set aside."""
    status = batch_status(base, new, cfg)
    kept = base.join(status.where("status = 'replaced'").select("ticker"), "ticker", "left_anti")
    good = new.join(status.where("status = 'quarantine'").select("ticker"), "ticker", "left_anti")
    return upsert(kept.select(*base.columns), good, seq=seq), status


def ingest_report(base: DataFrame, merged: DataFrame, status: DataFrame) -> DataFrame:
    """rows_new counted after replaced histories were removed, and tickers per status."""
    kept = base.join(status.where("status = 'replaced'").select("ticker"), "ticker", "left_anti")
    n_kept, n_all = kept.select(F.count(F.lit(1))).scalar(), merged.select(F.count(F.lit(1))).scalar()
    return status.agg(*[F.count_if(F.col("status") == s).alias(s) for s in ("replaced", "quarantine", "revalidated")]) \
                 .withColumn("rows_new", n_all - n_kept)


def cdc_merge(base: DataFrame, recent: DataFrame, full: DataFrame, cfg: Config, n: int = 5) -> tuple[DataFrame, DataFrame]:
    """(merged, replaced tickers). Overlap older than the n newest fetched sessions decides: deviation replaces the
    ticker's history, otherwise the n newest sessions are overwritten and newer ones appended. A deviating ticker
    without a full history stops the merge before anything is written."""
    w = Window.partitionBy("ticker").orderBy(F.desc("date"))
    r = recent.withColumn("_k", F.dense_rank().over(w))
    old = r.where(F.col("_k") > n).select("ticker", "date", F.col("close").alias("_new"))
    m = old.join(base.select("ticker", "date", "close"), ["ticker", "date"])
    replaced = (m.groupBy("ticker").agg(F.max(F.abs(change(F.col("_new"), F.col("close")))).alias("worst"))
                 .where(F.col("worst") > cfg.adjust_tol).select("ticker"))
    missing = replaced.join(full.select("ticker"), "ticker", "left_anti").agg(F.count(F.lit(1)).alias("n"), F.min("ticker").alias("first")).first()
    if missing["n"]:
        raise ValueError(f"no full history for {missing['n']} deviating tickers, first {missing['first']}")
    turnover = F.col("close") * F.col("volume") * 1000
    cols = base.columns
    add = r.where(F.col("_k") <= n).join(replaced, "ticker", "left_anti").withColumn("turnover", turnover).select(*cols)
    whole = full.join(replaced, "ticker", "left_semi").withColumn("turnover", turnover).select(*cols)
    rest = base.join(replaced, "ticker", "left_anti").join(add.select("ticker", "date"), ["ticker", "date"], "left_anti")
    return rest.select(*cols).unionByName(add).unionByName(whole), replaced


def clean_counts(df: DataFrame) -> DataFrame:
    """One row: duplicate keys, non-positive prices, high below low."""
    bad = F.lit(False)
    for c in ("open", "high", "low", "close"):
        bad = bad | (F.col(c) <= 0)
    per = df.groupBy("ticker", "date").agg(F.count(F.lit(1)).alias("n"), F.count_if(bad).alias("np"), F.count_if(F.col("high") < F.col("low")).alias("hl"))
    z = lambda c: F.coalesce(F.sum(c), F.lit(0))
    return per.agg(z(F.col("n") - 1).alias("dups"), z("np").alias("nonpositive"), z("hl").alias("high_lt_low"))


def assert_clean(df: DataFrame) -> DataFrame:
    """Stop before a write when any hard check fails."""
    row = clean_counts(df).first().asDict()
    if any(row.values()):
        raise ValueError(f"panel not clean: {row}")
    return df


def upsert_dim(current: DataFrame, new: DataFrame, value: str = "industry", key: str = "ticker", seq: str | None = None) -> DataFrame:
    """Last non-null value per key."""
    n = new.where(F.col(value).isNotNull())
    return upsert(current.select(key, value), n, (key,), seq)


def liquid_tickers(panel: DataFrame, days: int, threshold: float) -> DataFrame:
    """Tickers whose mean turnover over the last calendar days reaches the threshold."""
    last = panel.select(F.max("date")).scalar()
    r = panel.where(F.col("date") > F.date_sub(last, days))
    return r.groupBy("ticker").agg(F.avg("turnover").alias("mean_turnover")).where(F.col("mean_turnover") >= threshold)
