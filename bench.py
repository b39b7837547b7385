"""Time the headline queries on the tables of ``BENCH_SF_DIR`` and print one JSON line.

Every query runs to completion into the no-op sink after one warm-up of the session. ``BENCH_QUERIES``
(comma-separated) selects others; ``BENCH_CPUS`` sets the local cores.
"""

from __future__ import annotations

import json
import os
import sys
import time

from kalends import catalog
from kalends.session import build_session

HEADLINE = (
    "normalize_prices", "select_best_price", "monthly_indices", "fixed_universe_pilot", "vertical_series", "fx_separation",
    "complete_price_grid", "leave_one_out_validation", "headline_backtest", "holdout_evaluation", "first_published_panel",
    "forecast_metrics", "hybrid_matrix", "impute_grid", "bridge_components", "dedupe_ranked_rows", "error_metrics",
    "weighted_quantile", "duplicate_keys", "normalize_name", "marker_audit",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or list(HEADLINE)
    catalog.load()
    spark = build_session("bench", f"local[{cpus}]", int(cpus) if cpus.isdigit() else 8)
    spark.sparkContext.setLogLevel("ERROR")
    run = lambda name: catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    run("evidence_rank")
    seconds: dict[str, float] = {}
    for name in names:
        start = time.time()
        run(name)
        seconds[name] = round(time.time() - start, 3)
        print(f"{name} {seconds[name]}", file=sys.stderr)
    total = round(sum(seconds.values()), 3)
    scale = os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf")
    print(json.dumps({"metric": "total_seconds_headline_queries", "value": total, "unit": "sec", "queries": seconds, "sf": scale}))
    spark.stop()


if __name__ == "__main__":
    main()
