"""Registered queries with their SQL twins."""

from __future__ import annotations

from tidemark.plans.catalogue import (  # noqa: F401  importing a module registers its queries
    backtest, brief, daily, events, features, ingest, labels, learning, ledger, livelog, quality, selection, streams, universe)
from tidemark.plans.catalogue.registry import ORACLES, QUERIES

__all__ = ["QUERIES", "ORACLES"]
