"""Headline timings: one JSON line. Shared tables (panel, frame, scored, ...) are timed as their own entries."""

from __future__ import annotations

import json
import os
import time
from importlib import import_module

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

BUILDS = ["panel", "index", "frame", "scored", "outcomes"]
STORED = {"book": "ledger", "fills": "ledger", "admitted": "ledger", "results": "ledger", "trades": "ledger", "navs": "ledger"}
QUERIES = ["F_all_features", "U07_pct_rank", "U07_pct_rank_by_value_range", "U08_value_score", "U12_cross_ranks", "S05_upsert", "S06_reconcile", "S08_cdc_merge",
           "Q01_qc_summary", "Q09_compare_sources", "P01_capped_topk", "P05_risk_flags", "B01_daily_basket", "B04_daily_ic", "B08_deciles", "B09_block_bootstrap",
           "B11_random_benchmark", "B17_simple_rules", "E03_cooldown", "E06_event_stats", "V01_record", "V05_settle", "V09_live_evaluation", "T01_fill_price",
           "T06_fifo_lots", "T09_nav", "D11_ticker_overview", "daily_run_log"]


def main() -> None:
    from tidemark.plans.catalogue import QUERIES as ALL
    from tidemark.plans.workspace import Workspace
    from tidemark.session import build_session
    spark = build_session("bench", CPUS, int(CPUS) if CPUS.isdigit() else 8)
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()
    ws, times = Workspace(spark, SF_DIR), {}
    for b in BUILDS:
        t = time.time()
        getattr(ws, b)()
        times[f"build_{b}"] = round(time.time() - t, 3)
    for name, module in STORED.items():                     # stored tables are timed apart from the queries that read them
        t = time.time()
        getattr(import_module(f"tidemark.plans.catalogue.{module}"), name)(ws)
        times[f"store_{name}"] = round(time.time() - t, 3)
    for q in QUERIES:
        t = time.time()
        ALL[q](spark, SF_DIR).write.format("noop").mode("overwrite").save()
        times[q] = round(time.time() - t, 3)
    print(json.dumps({"metric": "headline_seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
                      "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
