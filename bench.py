"""Time the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query runs once, in a warm session, into a sink that computes every column of every row.
Shared inputs (the ready tables and the stored samples) are built first and reported as queries of their own.
"""

from __future__ import annotations

import json
import os
import time

from wearline.bindings import QUERIES
from wearline.bindings.ready import ready_tables
from wearline.session import build_session

HEADLINE = (
    "label_rul_train", "label_rul_test", "rul_band_filter", "last_row_per_unit", "rolling_mean", "delta",
    "setting_sensor_products", "create_features", "row_prefix_fraction", "entity_prefix_fraction", "recent_entities",
    "accuracy_summary", "regression_metrics", "psi_per_feature", "ks_per_feature", "drift_baseline", "drift_check",
    "rank_features_spearman_delta", "trailing_window_rmse", "trailing_window_entities", "prediction_rate_by_version",
    "retrain_trigger", "read_feedback_lenient", "classify_requests", "fit_rul_forest", "score")


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", max(8, int(cpus)), os.environ.get("BENCH_MEMORY", "16g"))
    spark.sparkContext.setLogLevel("ERROR")
    names = os.environ.get("BENCH_QUERIES", "").split() or HEADLINE
    QUERIES["entity_counts"](spark, sf_dir).collect()  # start the workers
    took: dict[str, float] = {}
    started = time.time()
    ready_tables(spark, sf_dir)
    took["prepare_ready"] = round(time.time() - started, 3)
    for name in names:
        t = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        took[name] = round(time.time() - t, 3)
    print(json.dumps({"metric": "headline_total", "value": round(sum(took.values()), 3), "unit": "sec",
                      "queries": took, "sf": float(sf_dir.rstrip("/").rsplit("sf", 1)[-1]), "cpus": int(cpus)}))
    spark.stop()


if __name__ == "__main__":
    main()
