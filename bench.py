"""Times the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tillwork.plans import QUERIES  # noqa: E402
from tillwork.session import local_session  # noqa: E402

# Relational queries are timed warm, best of two; model and neighbour queries once.
QUICK = (
    "category_sales", "describe_numeric", "duplicate_count", "product_analysis", "daily_growth",
    "monthly_revenue", "label_encode", "quantile_label", "standardize", "iqr_filter",
    "covariance_matrix", "stratified_split", "classification_report", "roc_auc", "ols_fit",
    "frequent_itemsets_orders", "association_rules", "gaussian_nb_grid",
)
ONCE = (
    "kmeans_sweep", "k_distance_transactions", "dbscan_transactions", "decision_tree_grid",
    "alpha_path", "model_comparison",
)


def timed(spark, name: str, directory: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, directory).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    directory = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "tillwork-bench")
    seconds: dict[str, float] = {}
    for name in QUICK:
        seconds[name] = round(min(timed(spark, name, directory) for _ in range(2)), 3)
    for name in ONCE:
        seconds[name] = round(timed(spark, name, directory), 3)
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(directory.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
