"""Headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import argparse
import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from barline import catalog  # noqa: E402
from barline.session import build_session  # noqa: E402

HEADLINE = [
    "stock_features", "feat_ema", "feat_rsi", "feat_bollinger", "validate_rows", "raw_observations",
    "dq_reconciliation", "upsert_prices", "coalesce_merge_predictions", "minmax_scale",
    "training_sequences", "fit_linear_forecaster", "holdout_metrics", "predict_next_day",
    "prediction_gaps", "maintenance_metrics", "directional_accuracy_7d", "model_leaderboard",
    "latest_close", "latest_n_per_ticker", "error_histogram", "run_state_counts",
    "incremental_features",
]


def main() -> None:
    parser = argparse.ArgumentParser()
    parser.add_argument("--all", action="store_true", help="every query instead of the headline ones")
    parser.add_argument("--runs", type=int, default=2, help="runs per query; the best one counts")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "barline-bench", f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus, spark__driver__memory="16g",
        spark__ui__enabled="false", spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = catalog.queries()
    queries["latest_close"](spark, folder).write.format("noop").mode("overwrite").save()  # warm-up
    seconds: dict[str, float] = {}
    for name in args.names or (list(queries) if args.all else HEADLINE):
        best = None
        for _ in range(args.runs):
            start = time.perf_counter()
            queries[name](spark, folder).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - start
            best = took if best is None else min(best, took)
        seconds[name] = round(best, 3)
        print(f"{name}: {best:.2f}s", file=sys.stderr, flush=True)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
                "queries": seconds, "sf": os.path.basename(folder.rstrip("/")),
            }
        )
    )


if __name__ == "__main__":
    main()
