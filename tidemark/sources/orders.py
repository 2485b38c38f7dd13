"""Order books: nested JSON to one row per order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BOOK_SCHEMA = """agent string, for_session date, decided_at string, committed_at timestamp, market_view string, risk_plan string,
orders array<struct<side: string, ticker: string, type: string, `limit`: double, value_vnd: double, qty: string, stop_loss: double,
take_profit: double, horizon_sessions: bigint, confidence: string, `condition`: string, reason: string, sources: array<string>>>"""


def read_books(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Books as stored: JSON lines, or one JSON document per file with multi_line."""
    return spark.read.schema(BOOK_SCHEMA).option("multiLine", multi_line).json(path)


def explode_orders(books: DataFrame) -> DataFrame:
    """One row per order with its position in the book and the header columns."""
    head = ["agent", F.col("for_session").alias("session"), "decided_at", "committed_at", "market_view", "risk_plan"]
    o = books.select(*head, F.posexplode("orders").alias("idx", "o"))
    return o.select("agent", "session", F.col("idx").cast("long").alias("idx"), "decided_at", "committed_at", "o.side", F.upper("o.ticker").alias("ticker"), "o.type",
                    "o.limit", "o.value_vnd", "o.qty", "o.stop_loss", "o.take_profit", "o.horizon_sessions", "o.confidence", "o.condition",
                    "o.reason", F.to_json("o.sources").alias("sources"), "market_view", "risk_plan")


def read_orders(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    return explode_orders(read_books(spark, path, multi_line))
