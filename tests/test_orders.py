"""One row order in the feature frame; ranks of special values in both plans."""

import math
import re

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.config import Config
from tidemark.functions import ranks
from tidemark.operators import features

BAR = "ticker string, date date, open double, high double, low double, close double, volume double, turnover double"


def _bars(n: int, seed: int = 3) -> pd.DataFrame:
    rng = np.random.default_rng(seed)
    out = []
    for t in ("AAA", "BBB", "CCC"):
        m = n if t != "CCC" else 7
        close = 10 * np.exp(np.cumsum(rng.normal(0, 0.02, m)))
        high, low = close * (1 + rng.random(m) * 0.02), close * (1 - rng.random(m) * 0.02)
        if t == "BBB":
            high[5:30:6] = np.nan
        out.append(pd.DataFrame({"ticker": t, "date": pd.date_range("2001-01-01", periods=m).date, "open": close, "high": high, "low": low,
                                 "close": close, "volume": 1000.0, "turnover": 1e6}))
    return pd.concat(out, ignore_index=True)


def test_feature_frame_sorts_twice(spark):
    df = features.add_features(spark.createDataFrame([], BAR), Config())
    plan = df._jdf.queryExecution().executedPlan().toString()
    plan = plan.split("Initial Plan")[-1]
    assert len(re.findall(r"\bSort \[", plan)) == 2
    assert len(re.findall(r"\bExchange ", plan)) <= 1


def test_composed_extremes_equal_plain_frames(spark):
    """Frames of 20, 60 and 252 bars put together from shorter ones, with missing highs and a short history."""
    pdf = _bars(330)
    rows = [tuple(None if isinstance(v, float) and math.isnan(v) else v for v in r) for r in pdf.itertuples(index=False)]
    got = features.add_range_position(spark.createDataFrame(rows, BAR)).orderBy("ticker", "date").toPandas()
    g = pdf.groupby("ticker")
    for n, need, cols in ((20, 20, "pos20"), (60, 60, "pos60"), (252, 120, None)):
        hi = g["high"].transform(lambda s: s.rolling(n, min_periods=need).max())
        lo = g["low"].transform(lambda s: s.rolling(n, min_periods=need).min())
        if cols:
            np.testing.assert_allclose(got[cols].astype(float), (pdf["close"] - lo) / (hi - lo), rtol=1e-12)
        else:
            np.testing.assert_allclose(got["dd252"].astype(float), pdf["close"] / hi - 1, rtol=1e-12, atol=1e-15)
            np.testing.assert_allclose(got["up252"].astype(float), pdf["close"] / lo - 1, rtol=1e-12, atol=1e-15)
    old = g["high"].transform(lambda s: s.shift(10).rolling(10, min_periods=10).max())
    new = g["high"].transform(lambda s: s.rolling(10, min_periods=1).max())
    np.testing.assert_allclose(got["hh10"].astype(float), new / old - 1, rtol=1e-12, atol=1e-15)


@pytest.mark.parametrize("kind", ["pct", "min"])
def test_special_values_rank_alike_in_both_plans(spark, kind):
    vals = [1.0, math.nan, 3.0, math.inf, -math.inf, 0.0, -0.0, None, 3.0, math.nan, -2.5]
    df = spark.createDataFrame([(str(i), d, v) for d in ("a", "b") for i, v in enumerate(vals)] + [("x", "c", None), ("y", "d", math.nan)],
                               "ticker string, date string, v double")
    rank = ranks.add_pct_ranks if kind == "pct" else ranks.add_min_ranks
    spec = {"up": ("v", True), "down": ("v", False)}
    one, two = [{(r.date, r.ticker): (r.up, r.down) for r in rank(df, ["date"], spec, split).collect()} for split in (False, True)]
    assert one == two
    top = min(r[1] for k, r in one.items() if k[0] == "a" and r[1] is not None)
    assert one["a", "1"][1] == one["a", "9"][1] == top          # NaN is the largest value: first when falling


def test_features_of_no_rows(spark):
    assert features.add_features(spark.createDataFrame([], BAR), Config()).count() == 0
