"""Run parameters. Defaults are the production values; fixtures override a few."""

from __future__ import annotations

import hashlib
import json
from dataclasses import asdict, dataclass, replace


@dataclass(frozen=True)
class Config:
    # ledger
    horizon: int = 5
    train_start: str = "2025-01-01"
    train_end: str = "2026-06-30"
    test_start: str = "2026-07-01"
    topk: int = 10
    value_top_pct: float = 0.30
    max_per_industry: int = 3
    label_atr_mult: float = 0.5
    folds: tuple = (
        ("2025-07-01", "2025-09-30"),
        ("2025-10-01", "2025-12-31"),
        ("2026-01-01", "2026-03-31"),
        ("2026-04-01", "2026-06-30"),
    )
    # costs
    fee: float = 0.0015
    tax: float = 0.001
    # universe
    ticker_pattern: str = "[A-Z0-9]{3}"
    first_date: str = "2022-01-01"
    exch_since: str = "2024-01-01"
    liq_min: float = 5.0e9
    min_bars: int = 200
    near: float = 0.005
    # gate and statistics
    min_test_days: int = 60
    boot: int = 2000
    block: int = 5
    seed: str = "7"
    # quality
    adjust_tol: float = 0.005
    max_stale_days: int = 5
    full_history: int = 260
    # event rule
    rsi_max: float = 30.0
    vol_min: float = 1.5
    slots: int = 10
    model_version: str = "base"
    # scale switches
    names_bound: int = 100_000      # upper bound of bars per date, measured by the caller
    split_above: int = 2_000_000    # beyond this many names per date, ranks are split by value range

    @property
    def split(self) -> bool:
        return self.names_bound > self.split_above

    def but(self, **kw) -> "Config":
        return replace(self, **kw)

    def ledger_key(self) -> str:
        """Ten hex digits that change whenever a label- or universe-defining value changes."""
        d = asdict(self)
        keep = ("horizon", "train_start", "train_end", "test_start", "topk", "value_top_pct",
                "max_per_industry", "label_atr_mult", "folds", "ticker_pattern", "liq_min", "min_bars")
        text = json.dumps({k: d[k] for k in keep}, sort_keys=True)
        return hashlib.sha1(text.encode()).hexdigest()[:10]


# Price limit per exchange, in the order of their inference bands.
LIMITS = {"HOSE": 0.07, "HNX": 0.10, "UPCOM": 0.15}

# Model input columns.
FEATURES = [
    "ret1", "ret5", "ret20", "ret60", "dist_ema20", "dist_ema50", "dist_ema200", "ema20_50",
    "ema50_slope10", "atr14_pct", "adx14", "di_diff", "rsi14", "macd_hist", "volat20", "volat60",
    "vol_ratio20", "log_liq20", "pos20", "pos60", "dd252", "up252", "clv", "hh10", "hl10",
    "vni_ret5", "vni_ret20", "vni_dist_ema50", "breadth_ema50",
    "ret5_xr", "ret20_xr", "vol_ratio20_xr", "volat20_xr", "rsi14_xr", "value_score", "trend_score",
]

# Inputs that are the same for every ticker of a date.
MARKET_FEATURES = ["vni_ret5", "vni_ret20", "vni_dist_ema50", "breadth_ema50"]
