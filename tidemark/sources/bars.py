"""Reading and shaping price bars and text items."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Accepted header spellings and required columns.
ALIASES = {"time": "date", "tradingdate": "date", "symbol": "ticker", "code": "ticker", "value": "turnover", "gt_khop": "turnover",
           "gtgd": "turnover", "trading_value": "turnover"}
REQUIRED = ["ticker", "date", "open", "high", "low", "close", "volume"]
OPTIONAL = ["gt_thoathuan", "kl_khop", "kl_thoathuan", "industry"]
INDEX_NAMES = ["VNINDEX", "VN-INDEX"]
CSV_SCHEMA = "ticker string, date string, open double, high double, low double, close double, volume double, turnover double"


def read_bars(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Parquet, or CSV with a header (explicit schema avoids a second pass over the file)."""
    if path.rstrip("/").endswith(".csv"):
        r = spark.read.option("header", True)
        return (r.schema(schema) if schema else r.option("inferSchema", True)).csv(path)
    return spark.read.parquet(path)


def file_order() -> Column:
    """Place of a row in a set of files: file time, file name, row position. Add it where the files are read."""
    return F.struct(F.col("_metadata.file_modification_time").alias("time"), F.col("_metadata.file_name").alias("file"),
                    F.col("_metadata.row_index").alias("row"))


def normalise(df: DataFrame) -> DataFrame:
    """Canonical headers, upper-case trimmed ticker, plain date; unknown columns but `seq` (write order) are dropped."""
    names = {c: ALIASES.get(c.lower().strip(), c.lower().strip()) for c in df.columns}
    df = df.withColumnsRenamed(names)
    missing = [c for c in REQUIRED if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}")
    if "turnover" not in df.columns:
        df = df.withColumn("turnover", F.lit(None).cast("double"))
    df = df.withColumns({"ticker": F.upper(F.trim("ticker")), "date": F.to_date("date")})
    return fill_turnover(df.select(*REQUIRED, "turnover", *[c for c in [*OPTIONAL, "seq"] if c in df.columns]))


def fill_turnover(df: DataFrame) -> DataFrame:
    """Missing turnover is close (thousands) * volume * 1000."""
    return df.withColumn("turnover", F.coalesce("turnover", F.col("close") * F.col("volume") * 1000))


def split_index(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(stock rows, index rows under one name)."""
    is_idx = F.col("ticker").isin(INDEX_NAMES)
    idx = df.where(is_idx).withColumn("ticker", F.lit(INDEX_NAMES[0])).select(*REQUIRED, *[c for c in ["seq"] if c in df.columns])
    return df.where(~is_idx), idx


def clean_bars(df: DataFrame) -> DataFrame:
    """Numeric coercion; complete rows only; `valid` tells rows with positive prices and high >= low."""
    num = ["open", "high", "low", "close", "volume"]
    df = df.withColumns({"date": F.to_date(F.try_to_timestamp("date")), **{c: F.col(c).try_cast("double") for c in num}}).dropna(subset=["date", *num])
    ok = (F.col("high") >= F.col("low"))
    for c in num[:4]:
        ok = ok & (F.col(c) > 0)
    return df.withColumn("valid", ok)


def valid_bars(cleaned: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(kept bars, one row with the number dropped)."""
    return cleaned.where("valid").drop("valid"), cleaned.agg(F.count_if(~F.col("valid")).alias("n_dropped"))


PAYLOAD = "t array<bigint>, o array<double>, h array<double>, l array<double>, c array<double>, v array<double>"


def explode_payload(df: DataFrame, start: str) -> DataFrame:
    """Provider rows (ticker, payload JSON of parallel arrays) to bars from `start` on; epoch seconds count UTC days."""
    p = F.from_json("payload", PAYLOAD)
    z = df.select("ticker", p.alias("p")).select("ticker", F.inline(F.arrays_zip("p.t", "p.o", "p.h", "p.l", "p.c", "p.v")))
    return (z.select("ticker", F.date_add(F.lit("1970-01-01").cast("date"), F.floor(F.col("t") / 86400).cast("int")).alias("date"), F.col("o").alias("open"), F.col("h").alias("high"),
                     F.col("l").alias("low"), F.col("c").alias("close"), F.col("v").alias("volume"))
             .where(F.col("date") >= F.lit(start).cast("date")))


def rescale_stocks(df: DataFrame) -> DataFrame:
    """Stocks from units to thousands, index points as they are."""
    k = F.when(F.col("ticker").isin(INDEX_NAMES), 1.0).otherwise(1000.0)
    return df.withColumns({c: F.col(c) / k for c in ("open", "high", "low", "close")})


def rescale_by_median(df: DataFrame) -> DataFrame:
    """Tickers whose median close exceeds 1000 are quoted in units; a ticker has one bar per session at most."""
    m = df.groupBy("ticker").agg(F.median("close").alias("_m"))
    k = F.when(F.col("_m") > 1000, 1000.0).otherwise(1.0)
    return df.join(m, "ticker").withColumns({c: F.col(c) / k for c in ("open", "high", "low", "close")}).drop("_m")


# Entities decoded before tags are stripped; the ampersand comes last so nothing is decoded twice.
ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")]


def plain_text(x: Column) -> Column:
    for k, v in ENTITIES:
        x = F.replace(x, F.lit(k), F.lit(v))
    x = F.regexp_replace(x, "<[^>]+>", " ")
    return F.trim(F.regexp_replace(x, "[\\s\\x{0B}\\x{A0}]+", " "))


def clean_items(df: DataFrame, now: str, hours: int = 36, per_feed: int = 25, chars: int = 220) -> DataFrame:
    """Items (feed, seq, published, body) of the last hours: tag-free text, summary, first `per_feed` per feed in order.

    Items without a time stay. The per-feed limit is the report's own; the whole body is cleaned.
    """
    age = F.unix_timestamp(F.lit(now).cast("timestamp")) - F.unix_timestamp("published")
    d = df.where(F.coalesce(age <= hours * 3600, F.lit(True)))
    d = d.withColumn("_i", F.row_number().over(Window.partitionBy("feed").orderBy("seq"))).where(F.col("_i") <= per_feed)
    text = plain_text(F.col("body"))
    return d.select("feed", "seq", "published", F.substring(text, 1, chars).alias("summary"), F.length(text).alias("n_chars"))
