"""Time the headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS]; print one JSON line.

``queries`` has the median of three runs, ``build`` the part of it before the first row is
asked for, ``cold`` the first run.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tallyspan.catalog import QUERIES
from tallyspan.session import build_session

HEADLINE = (
    "customer_features",
    "customer_features_hot",
    "customer_features_gaps",
    "order_features",
    "customer_features_wide",
    "feature_matrix",
    "rolling13_features",
    "features_labeled",
    "statement_rank",
    "month_diff",
    "tail_3",
    "missing_pct",
    "hash_split_train",
    "stratified_folds",
    "balanced_sample",
    "sampled_statements",
    "statement_describe",
    "default_rate_by_cat",
    "box_by_class",
    "oof_report",
    "fold_metrics",
    "roc_points",
    "importance_cumulative",
    "selected_features",
    "quantile_edges",
    "drift_report",
    "windowed_drift",
    "refreshed_features",
    "upsert_features",
    "tiered_lookup",
    "batch_scores",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    wanted = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench", f"local[{cpus}]", int(cpus) if cpus.isdigit() else 8,
        **{"spark.ui.enabled": "false", "spark.driver.memory": "12g", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")

    def once(name: str) -> tuple[float, float]:
        """Seconds to build the plan (with jobs that run meanwhile), and in all."""
        start = time.perf_counter()
        df = QUERIES[name](spark, sf_dir)
        built = time.perf_counter() - start
        df.write.format("noop").mode("overwrite").save()
        return round(built, 3), round(time.perf_counter() - start, 3)

    once("statement_counts")  # start the engine
    times, build, cold = {}, {}, {}
    for name in wanted:
        runs = [once(name) for _ in range(3)]
        cold[name] = runs[0][1]
        build[name], times[name] = sorted(runs, key=lambda r: r[1])[1]
    print(
        json.dumps(
            {
                "metric": "total time of headline queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "build": build,
                "cold": cold,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
