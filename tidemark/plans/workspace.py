"""Derived tables of one data directory: bar panel, index, dimensions, feature frame, scored frame.

Each table is built once per application and stored in the shared folder; every query reads it from there.
"""

from __future__ import annotations

import threading
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.config import Config
from tidemark.functions.draws import draw32
from tidemark.operators import features, labels, universe
from tidemark.session import materialise, materialise_by

# Parameters for the generated panel (weekly sessions 1995-2001).
PANEL_CONFIG = Config(
    train_start="1999-01-01", train_end="2001-03-31", test_start="2001-04-01",
    folds=(("2000-04-01", "2000-06-30"), ("2000-07-01", "2000-09-30"), ("2000-10-01", "2000-12-31"), ("2001-01-01", "2001-03-31")),
    ticker_pattern="[A-Z0-9]{6}", first_date="1995-01-01", exch_since="1995-01-01", liq_min=90_000.0, boot=2000, rsi_max=42.0, vol_min=1.05,
)

_store: dict[tuple, DataFrame] = {}
_lock = threading.RLock()


def _stored(fn):
    @wraps(fn)
    def get(self, *a):
        key = (self.spark.sparkContext.applicationId, self.sf, fn.__name__, a)
        with _lock:
            if key not in _store:
                _store[key] = fn(self, *a)
            return _store[key]
    return get


class Workspace:
    def __init__(self, spark: SparkSession, sf: str):
        self.spark, self.sf = spark, str(sf).rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf}/{name}.parquet")

    @property
    def cfg(self) -> Config:
        return self._cfg()

    @_stored
    def _cfg(self) -> Config:
        """Names per date are bounded by the number of suppliers, read from the file footers."""
        return PANEL_CONFIG.but(names_bound=self.table("supplier").count())

    @staticmethod
    def code(s: Column) -> Column:
        """Six-character code; every 50th name becomes a seven-character warrant."""
        c = F.lpad(F.conv(s.cast("string"), 10, 36), 6, "0")
        return F.when(s % 50 == 49, F.concat(F.lit("W"), c)).otherwise(c)

    def raw_panel(self) -> DataFrame:
        """Bounded walk per supplier from integer column sums of lineitem, one bar per ISO week."""
        li = self.table("lineitem")
        a = (li.groupBy(F.col("l_suppkey").alias("s"), F.date_trunc("week", "l_shipdate").cast("date").alias("date"))
               .agg(F.sum(F.col("l_orderkey") * 7 + F.col("l_partkey") * 13).alias("k"), F.sum("l_partkey").alias("kp"),
                    F.sum("l_orderkey").alias("ko"), F.sum("l_linenumber").alias("kl"),
                    F.sum("l_quantity").alias("volume"), F.sum("l_extendedprice").alias("turnover"))
               .withColumn("ticker", self.code(F.col("s"))))
        w = Window.partitionBy("ticker").orderBy("date")
        run = w.rowsBetween(Window.unboundedPreceding, 0)
        lim = F.when(F.col("s") % 3 == 0, 0.07).when(F.col("s") % 3 == 1, 0.10).otherwise(0.15)
        step = F.ln(1 + ((F.col("k") % 997) / F.lit(996.0) - 0.5) * 2 * lim)
        b = a.withColumn("close", 20.0 * F.exp(F.sum(step).over(run)))
        reach = F.when(F.col("kp") % 23 == 0, 0.11).otherwise(0.01)
        b = b.withColumn("open", F.coalesce(F.lag("close").over(w), F.lit(20.0)) * (1 + ((F.col("kp") % 201) / F.lit(100.0) - 1) * reach))
        return b.select("ticker", "date", "open",
                        (F.greatest("open", "close") * (1 + (F.col("kl") % 11) / F.lit(1000.0))).alias("high"),
                        (F.least("open", "close") * (1 - (F.col("ko") % 11) / F.lit(1000.0))).alias("low"),
                        "close", "volume", "turnover", F.col("s").alias("sid"))

    @_stored
    def panel(self) -> DataFrame:
        return materialise_by(self.raw_panel(), "ticker", "panel", clustered=True, buckets=max(8, self.cfg.names_bound // 500))

    @_stored
    def index(self) -> DataFrame:
        """One row per date: 1000 * exp(running sum of the mean return)."""
        w = Window.partitionBy("ticker").orderBy("date")
        r = self.panel().select("date", "volume", (F.col("close") / F.coalesce(F.lag("close").over(w), F.lit(20.0)) - 1).alias("r"))
        d = r.groupBy("date").agg(F.avg("r").alias("m"), F.sum("volume").alias("volume"))
        g = Window.orderBy("date")     # one row per session
        d = d.withColumn("close", 1000.0 * F.exp(F.sum("m").over(g)))
        d = d.withColumn("open", F.coalesce(F.lag("close").over(g), F.lit(1000.0)))
        out = d.select(F.lit("VNINDEX").alias("ticker"), "date", "open", (F.greatest("open", "close") * 1.002).alias("high"),
                       (F.least("open", "close") * 0.998).alias("low"), "close", "volume")
        return materialise(out.coalesce(1), "index")

    def industry(self) -> DataFrame:
        s = self.table("supplier").select(F.col("s_suppkey").alias("s"), F.col("s_nationkey").alias("n_nationkey"))
        n = F.broadcast(self.table("nation").select("n_nationkey", "n_name"))      # fixed dimension
        return s.join(n, "n_nationkey").select(self.code(F.col("s")).alias("ticker"),
                                               F.when(F.col("s") % 17 != 0, F.col("n_name")).alias("industry"))

    def symbols(self) -> DataFrame:
        return universe.select_symbols(self.panel(), self.cfg)

    def exchanges(self) -> DataFrame:
        return universe.infer_exchange(self.symbols(), self.cfg)

    def _built(self, name: str) -> bool:
        return (self.spark.sparkContext.applicationId, self.sf, name, ()) in _store

    def features(self) -> DataFrame:
        """The frame where it is stored, else its plan: select few columns, and Spark leaves out the windows of all others."""
        if self._built("frame"):
            return self.frame()
        cfg = self.cfg
        # the small dimensions join the narrow bars: joined after the windows they would share one oversized code stage
        bars = features.add_index_features(universe.add_exchange(self.symbols(), self.exchanges()), self.index(), cfg)
        return universe.add_flags(labels.add_labels(features.add_features(bars, cfg), cfg), cfg)

    @_stored
    def frame(self) -> DataFrame:
        """All bars of the symbols with features, index features, labels, exchange and flags."""
        return materialise(self.features(), "frame")

    def _cross_section(self, bars: DataFrame) -> DataFrame:
        cfg = self.cfg
        e = universe.add_industry(bars.where("eligible"), self.industry())
        if cfg.split:
            e = universe.add_breadth_joined(materialise(e, "eligible"))
        else:
            e = universe.add_breadth(e)
        e = universe.add_cross_ranks(universe.add_regime(universe.add_value(e, cfg)), cfg)
        day = F.date_format("date", "yyyy-MM-dd")
        return e.withColumns({n: draw32(n, F.col("ticker"), day) / F.lit(4294967296.0) for n in ("p_up_5", "p_lr")})

    @_stored
    def scored(self, *cols: str) -> DataFrame:
        """Eligible rows with cross-section columns and two reproducible scores in [0, 1); with columns named, those alone, straight from the panel."""
        if not cols:
            return materialise(self._cross_section(self.frame()), "scored")
        if self._built("scored"):
            return self.scored().select(*cols)
        return materialise(self._cross_section(self.features()).select(*cols), "scored_part")

    def scored_plan(self, *cols: str) -> DataFrame:
        """Named columns of the scored rows for a query that reads them once: from the stored table where there is one, else not stored at all."""
        return self.scored().select(*cols) if self._built("scored") else self._cross_section(self.features()).select(*cols)

    @_stored
    def outcomes(self, *cols: str) -> DataFrame:
        """Scored rows with a known forward return, plus real, net, buyable; with columns named, those alone, straight from the panel."""
        if not cols:
            return materialise(labels.add_outcome(self.scored().where("fwd_ret_5 is not null"), self.cfg), "outcomes")
        if self._built("outcomes"):
            return self.outcomes().select(*cols)
        e = self.scored() if self._built("scored") else self._cross_section(self.features())
        return materialise(labels.add_outcome(e.where("fwd_ret_5 is not null"), self.cfg).select(*cols), "outcomes_part")

    def calendar(self) -> DataFrame:
        return labels.session_index(self.panel())
