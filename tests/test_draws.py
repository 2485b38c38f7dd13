"""Drawn subsets in linear time, and draws spread over tasks however small the rows are that stand for them."""

import time

from pyspark.sql import functions as F

from tidemark.config import Config
from tidemark.functions.draws import draw_subset, explode_subset
from tidemark.operators.backtest import block_draws, random_benchmark, random_mean


def test_exploded_subset_is_floyds_subset(spark):
    df = spark.range(60).select("id", (F.col("id") + 3).alias("size"), F.least(F.col("id"), F.lit(25)).alias("k"))
    want = df.select("id", F.explode(draw_subset(F.col("size"), F.col("k"), "7", "t", F.col("id"))).alias("pos"))
    got = explode_subset(df, "size", "k", "7", "t", F.col("id"), at_once=10)
    assert got.columns == ["id", "pos"] and got.exceptAll(want).count() == want.exceptAll(got).count() == 0 < want.count()


def test_large_subsets_take_linear_time(spark):
    df = spark.range(4).select("id", F.lit(400_000).alias("size"), F.lit(200_000).alias("k"))
    t = time.time()
    assert explode_subset(df, "size", "k", "7", F.col("id")).distinct().count() == 4 * 200_000
    assert time.time() - t < 60         # the fold over an array needs 2e10 comparisons a row


def test_mean_over_repeats_equals_the_repeats(spark):
    d = spark.range(300).select(F.lpad(F.col("id").cast("string"), 4, "0").alias("ticker"), (F.col("id") % 3).cast("string").alias("date"), F.sin("id").alias("net"),
                                (F.col("id") % 7 > 0).alias("buyable"), F.lit(True).alias("every"))
    basket = spark.createDataFrame([("0", 20, 20), ("0", 500, 500), ("1", 7, 7)], "date string, cnt long, n long")
    got = {(r["cnt"], r["date"]): r["random"] for r in random_mean(d, basket, Config(), 9, ("cnt", "date"), "every", "event", ("date",)).collect()}
    many = random_benchmark(d.join(basket.select("date", "cnt"), "date"), basket, Config(), 9, ("cnt", "date"), "every", "event")
    want = {(r["cnt"], r["date"]): r["m"] for r in many.groupBy("cnt", "date").agg(F.avg("rand_net").alias("m")).collect()}
    assert got.keys() == want.keys() == {(20, "0"), (500, "0"), (7, "1")} and all(abs(got[k] - want[k]) < 1e-12 for k in want)


def test_bootstrap_draws_are_made_in_all_tasks(spark):
    """Two thousand small rows are one partition to AQE, but each stands for thousands of draws."""
    usable = spark.createDataFrame([("a", 50_000, 10_000, 5)], "g string, n long, nb long, tail long")
    draws = block_draws(usable.repartition(4), Config(boot=200))
    assert draws.select(F.spark_partition_id()).distinct().count() == int(spark.conf.get("spark.sql.shuffle.partitions"))
