"""Wall time of the headline queries; prints one JSON line.

BENCH_SF_DIR (default sf0.1) and BENCH_CPUS choose data and cores. Every query is run
once on the smallest data first, so compilation is not measured. Single runs of short queries
swing by half, so those under SHORT seconds are run three times and give their median.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

ROOT = Path(__file__).resolve().parent
sys.path.insert(0, str(ROOT))

from riskframe.queries import all_queries  # noqa: E402
from riskframe.session import local_session  # noqa: E402

SHORT = 8.0

HEADLINES = [
    "customer_features",
    "rfm",
    "features_and_rfm",
    "describe_numeric",
    "describe_categorical",
    "value_counts",
    "missing_report",
    "correlation_matrix",
    "quantiles",
    "boxplot_stats",
    "histogram",
    "kde",
    "winsorize",
    "assign_bin",
    "woe_fit",
    "woe_transform",
    "model_features",
    "high_risk_pick_fixed",
    "high_risk_target",
    "stratified_split",
    "stratified_folds",
    "roc_auc",
    "model_comparison",
    "payload_explode",
    "logistic_baseline",
    "score_transactions_batch",
]


def run(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    result = all_queries()[name](spark, sf_dir)
    result.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINES
    spark = local_session(cpus, "riskframe-bench")
    warm = str(Path(sf_dir).parent / "sf0.001")
    times = {}
    for name in names:
        if os.path.isdir(warm):
            run(spark, name, warm)
        runs = [run(spark, name, sf_dir)]
        if runs[0] < SHORT:
            runs += [run(spark, name, sf_dir) for _ in range(2)]
        times[name] = round(statistics.median(runs), 3)
    spark.stop()
    total = round(sum(times.values()), 3)
    print(
        json.dumps(
            {
                "metric": "total wall time of the headline queries",
                "value": total,
                "unit": "sec",
                "queries": times,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
