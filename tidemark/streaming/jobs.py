"""Streaming forms of ingest, session closing, settlement and cooldown.

The daily batch re-run becomes file streams that process what is available and stop. Keyed state is typed and small: the
last bars of a ticker, or its last kept event, and whatever still waits for older rows. Rows that come too late, or again,
are not dropped: they leave by the side partition `late = true` of the output.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from tidemark.config import Config
from tidemark.operators.ingest import batch_status, reconcile, upsert
from tidemark.session import materialise
from tidemark.sources.bars import file_order, normalise

BAR_SCHEMA = "ticker string, date date, open double, high double, low double, close double, volume double, turnover double"


TASKS_PER_MONTH = 4


def write_panel(df: DataFrame, table: str, mode: str = "error") -> None:
    """Panel stored by month, so a batch rewrites the months it touches and nothing else."""
    d = df.withColumn("month", F.date_format("date", "yyyy-MM"))
    d.repartition("month", F.pmod(F.xxhash64("ticker"), F.lit(TASKS_PER_MONTH))).write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy("month").parquet(table)


def read_panel(spark: SparkSession, table: str) -> DataFrame:
    return spark.read.schema(BAR_SCHEMA + ", month string").parquet(table)


def merge_batch(table: str, new: DataFrame, cfg: Config) -> None:
    """Reconcile a batch into the stored panel. Only months of the batch are read and rewritten, plus the months of
    histories the batch replaces. Running it again with the same batch changes nothing. `seq` in the batch orders repeated keys."""
    spark = new.sparkSession
    base, new = read_panel(spark, table), materialise(new, "batch")
    seq = "seq" if "seq" in new.columns else None
    cols = [c for c in new.columns if c != "seq"]

    def months_of(df: DataFrame) -> list[str]:            # months of the calendar: a literal list prunes the partitions
        return sorted(r[0] for r in df.select("month").distinct().collect())
    months = months_of(new.select(F.date_format("date", "yyyy-MM").alias("month")))
    status = materialise(batch_status(base.where(F.col("month").isin(months)), new, cfg), "status")
    replaced = status.where("status = 'replaced'").select("ticker")
    touched = months
    if not replaced.isEmpty():
        touched = sorted({*months, *months_of(base.join(replaced, "ticker", "left_semi"))})
    merged, _ = reconcile(base.where(F.col("month").isin(touched)).select(*cols), new, cfg, seq)
    merged = materialise(merged, "merged")
    write_panel(merged, table, "overwrite")
    left = months_of(merged.select(F.date_format("date", "yyyy-MM").alias("month")))
    for month in set(touched) - set(left):                  # months a replaced history emptied
        p = spark._jvm.org.apache.hadoop.fs.Path(f"{table}/month={month}")
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def ingest_stream(spark: SparkSession, inbox: str, table: str, checkpoint: str, cfg: Config, archive: str | None = None,
                  files_per_batch: int = 1, schema: str = BAR_SCHEMA) -> StreamingQuery:
    """Inbox folder to reconciled panel, one merge per micro-batch."""
    r = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    if archive:
        r = r.option("cleanSource", "archive").option("sourceArchiveDir", archive)

    def step(batch: DataFrame, k: int) -> None:
        merge_batch(table, normalise(batch).select(*[c.split()[0] for c in BAR_SCHEMA.split(", ")], "seq"), cfg)
    return (r.parquet(inbox).withColumn("seq", file_order()).writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def session_stream(ticks: DataFrame, table: str, checkpoint: str, session: str = "1 day", late: str = "5 days") -> StreamingQuery:
    """Ticks (event_id, ticker, ts, price, qty) to closed bars: a session is emitted once the watermark passes its end,
    so no unfinished bar is ever written; ticks up to `late` behind still count. Equal times are ordered by event_id."""
    bars = (ticks.withWatermark("ts", late).groupBy(F.window("ts", session).alias("w"), "ticker")
                 .agg(F.min_by("price", F.struct("ts", "event_id")).alias("open"), F.max("price").alias("high"), F.min("price").alias("low"),
                      F.max_by("price", F.struct("ts", "event_id")).alias("close"), F.sum("qty").alias("volume"), F.count(F.lit(1)).alias("n_ticks")))
    out = bars.select("ticker", F.to_date("w.start").alias("date"), "open", "high", "low", "close", "volume", "n_ticks")
    return (out.writeStream.outputMode("append").format("parquet").option("path", table).option("checkpointLocation", checkpoint)
               .trigger(availableNow=True).start())


def correct_sessions(table: DataFrame, corrections: DataFrame, n: int = 5) -> DataFrame:
    """Overwrite the newest n sessions of each corrected ticker and append newer ones."""
    from pyspark.sql import Window
    w = Window.partitionBy("ticker").orderBy(F.desc("date"))
    newest = corrections.withColumn("_k", F.dense_rank().over(w)).where(F.col("_k") <= n).drop("_k")
    return upsert(table, newest.select(*table.columns))


SETTLE_OUT = "ticker string, data_date date, real double, net double, settled_on date, status string, late boolean"
BAR_STATE = "day int, open double, close double, limit double, signal boolean"


def settle_stream(bars: DataFrame, cfg: Config, late_days: int = 0) -> DataFrame:
    """Bars (ticker, date, open, close, limit, signal) in any order to settled predictions.

    A bar with signal = true opens a prediction; it settles on the fifth later bar, or on the sixth when the fifth is
    locked at the floor. A bar waits until its ticker has shown one `late_days` newer, so files up to that much out of
    order give what sorted ones give; the newest bars of a ticker stay in state until then. State is typed: the last six
    bars taken in and the waiting ones, and the day up to which bars were taken in. A bar of a day already known or passed
    by leaves with status `late_bar` and late = true, its day as data_date; of equal days in one batch the smallest values count.
    Null prices give null results, a null signal is none.
    """
    h, edge, fee, tax = cfg.horizon, cfg.near, cfg.fee, cfg.tax
    cols, out_cols = [c.split()[0] for c in BAR_STATE.split(", ")], [c.split()[0] for c in SETTLE_OUT.split(", ")]

    class Settle(StatefulProcessor):
        def init(self, handle) -> None:
            self.bars = handle.getListState("bars", BAR_STATE)
            self.upto = handle.getValueState("upto", "day int")

        def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
            new = pd.concat(list(rows), ignore_index=True)
            new["day"] = pd.to_datetime(new["date"]).to_numpy("datetime64[D]").astype(np.int64)
            new["signal"] = new["signal"].eq(True)
            new = new[cols].sort_values(cols, ignore_index=True)
            held = list(self.bars.get())
            upto = self.upto.get()[0] if self.upto.exists() else -2**31
            again = new["day"].duplicated() | new["day"].isin([b[0] for b in held]) | (new["day"] <= upto)
            fresh = new[~again]
            every = pd.concat([pd.DataFrame(held, columns=cols), fresh]) if held else fresh
            every = every.sort_values("day", ignore_index=True)
            day, done = every["day"].to_numpy(np.int64), int((every["day"] <= upto).sum())
            m = max(done, int((day <= day[-1] - late_days).sum())) if len(day) else 0
            o, c, lim = (every[x].to_numpy(float)[:m] for x in ("open", "close", "limit"))
            at = np.flatnonzero(every["signal"].to_numpy(bool)[:m])
            at = at[at + h < m]
            with np.errstate(all="ignore"):
                end = at + h + (c[at + h] / c[at + h - 1] - 1 <= -(lim[at + h] - edge))
                now = (end >= done) & (end < m)
                at, end = at[now], end[now]
                g = c[end] / o[at + 1] - 1
                full = o[at + 1] / c[at] - 1 >= lim[at + 1] - edge
            if m > done:
                self.upto.update((int(day[m - 1]),))
            kept = every.iloc[max(0, m - h - 1):]
            self.bars.put([(int(d), float(a), float(b), float(x), bool(s)) for d, a, b, x, s in kept.itertuples(index=False)])
            aside = new.loc[again, "day"].to_numpy(np.int64)
            as_date = lambda d: pd.Series(np.asarray(d, "datetime64[D]").astype(object), dtype=object)
            for days, real, on, status, late in ((day[at], g, as_date(day[end]), np.where(full, "unfilled_ceiling", "settled"), False),
                                                 (aside, np.nan, None, "late_bar", True)):
                if len(days):
                    part = pd.DataFrame({"ticker": key[0], "data_date": as_date(days), "real": real})
                    part["net"] = (1 - fee) * (1 + part["real"]) * (1 - fee - tax) - 1
                    part["settled_on"], part["status"], part["late"] = on, status, late
                    yield part[out_cols]

        def close(self) -> None:
            pass
    return bars.groupBy("ticker").transformWithStateInPandas(Settle(), SETTLE_OUT, "Append", "None")


COOL_OUT = "ticker string, date date, di bigint, late boolean"


def cooldown_stream(events: DataFrame, cfg: Config, late_sessions: int = 0) -> DataFrame:
    """Events (ticker, date, di) in any order to the kept ones.

    An event waits until its ticker has shown one `late_sessions` newer, then is decided in session order. State is typed:
    the last kept session, the session up to which events were decided, and the waiting events. An event of a session
    already known or decided leaves with late = true. Events without a session number leave so too.
    """
    h = cfg.horizon

    class Cool(StatefulProcessor):
        def init(self, handle) -> None:
            self.last = handle.getValueState("last", "kept bigint, upto bigint")
            self.waiting = handle.getListState("waiting", "di bigint, day int")

        def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
            new = pd.concat(list(rows), ignore_index=True).sort_values(["di", "date"], ignore_index=True)
            held = list(self.waiting.get())
            kept, upto = self.last.get() if self.last.exists() else (None, None)
            again = new["di"].isna() | new["di"].duplicated() | new["di"].isin([e[0] for e in held])
            if upto is not None:
                again |= new["di"] <= upto
            fresh = new[~again]
            days = pd.to_datetime(fresh["date"]).to_numpy("datetime64[D]").astype(np.int64)
            todo = sorted([*held, *zip(fresh["di"].astype(int).tolist(), days.tolist())])
            di = np.array([e[0] for e in todo], np.int64)
            m = int((di <= di[-1] - late_sessions).sum()) if len(di) else 0
            take, i = [], 0 if kept is None else int(np.searchsorted(di[:m], kept + h, "right"))
            while i < m:                                   # one step per kept event, jumping over its cooldown
                take.append(i)
                kept = int(di[i])
                i = int(np.searchsorted(di[:m], kept + h, "right"))
            if m:
                self.last.update((kept, int(di[m - 1])))
            if todo[m:]:
                self.waiting.put(todo[m:])
            else:                                          # an empty list cannot be put
                self.waiting.clear()
            if take:
                when = np.array([todo[i][1] for i in take], "datetime64[D]").astype(object)
                yield pd.DataFrame({"ticker": key[0], "date": pd.Series(when, dtype=object), "di": di[take], "late": False})
            if again.any():
                aside = new[again]
                yield pd.DataFrame({"ticker": key[0], "date": aside["date"], "di": aside["di"], "late": True})

        def close(self) -> None:
            pass
    return events.groupBy("ticker").transformWithStateInPandas(Cool(), COOL_OUT, "Append", "None")


def first_delivery(bars: DataFrame, ts: str = "ts", late: str = "5 days") -> DataFrame:
    """Each (ticker, date) passes once, however often its file is delivered within the watermark."""
    return bars.withWatermark(ts, late).dropDuplicatesWithinWatermark(["ticker", "date"])


STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"     # typed state needs this store


def run_to_table(df: DataFrame, path: str, checkpoint: str, by: tuple[str, ...] = ()) -> StreamingQuery:
    """Append to a Parquet table, once per row; by: partition columns (`late` keeps the side rows apart)."""
    conf = df.sparkSession.conf
    before = conf.get(STORE, None)
    conf.set(STORE, ROCKS)                                 # a query copies the settings when it starts
    try:
        return (df.writeStream.outputMode("append").format("parquet").option("path", path).option("checkpointLocation", checkpoint)
                  .partitionBy(*by).trigger(availableNow=True).start())
    finally:
        conf.set(STORE, before) if before else conf.unset(STORE)


def read_output(spark: SparkSession, path: str, schema: str, late: bool = False) -> DataFrame:
    """Rows of a keyed job's table, or those of its side partition; an absent partition is empty."""
    return spark.read.schema(schema).parquet(path).where(F.col("late") == F.lit(late)).drop("late")
