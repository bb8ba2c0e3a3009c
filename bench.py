"""Times headline queries on local[$BENCH_CPUS] at $BENCH_SF_DIR and prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from riskframe.plans.queries import QUERIES
from riskframe.session import build_session

HEADLINE = (
    "threshold_sweep", "all_metrics", "roc_curve", "roc_auc", "numeric_summary", "categorical_summary",
    "histogram30", "correlation", "missing_report", "duplicate_count", "stratified_split", "orders_split",
    "kfold_assignment", "scale_numeric", "onehot_long", "reliability_curve", "calibration_compare",
    "isotonic", "cv_metrics", "shap_global", "score_batch", "shap_local_topn",
)
RUNS = 3
SINGLE_RUN_SECONDS = 15.0


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.sql.shuffle.partitions": cpus,
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g")})
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    # One warm-up over all queries, then timed runs; slow queries are timed once.
    warm = {name: run(name) for name in HEADLINE}
    seconds = {}
    for name in HEADLINE:
        times = [run(name) for _ in range(1 if warm[name] > SINGLE_RUN_SECONDS else RUNS)]
        seconds[name] = round(statistics.median(times), 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(folder).removeprefix("sf"), "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
