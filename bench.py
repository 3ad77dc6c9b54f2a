"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the data folder, ``BENCH_CPUS`` the number of local cores.
The builds of the order table and the feature store run from the given tables.
Reports and models read those two as stored tables, as they would in
daily use; storing them is timed on its own as ``store_tables``.
"""

from __future__ import annotations

import json
import os
import time

from bindings import load
from bindings.check import local_session
from bindings.tables import Tables

BUILDS = (
    "csv_enforced_read", "payments_per_order", "items_per_order", "items_by_category", "order_wide", "dedup_latest",
    "transform_orders", "user_features",
)
FROM_STORED = (
    "rfm", "behavioral_features", "spend_trend", "cohort_retention", "revenue_by_month", "category_performance",
    "state_stats", "top_churners", "numeric_summary", "null_fill", "correlation_pairs", "class_balance", "row_lineage",
    "train_gbt", "train_lr", "batch_score", "stream_score",
)
FROM_RAW = (
    "visitor_signals", "winsorize", "key_skew", "salted_join", "salted_aggregate", "broadcast_join", "drift_psi",
    "drift_quantile_gap", "drift_ks", "drift_categorical", "drift_report", "retrain_decision", "table_health",
    "version_write", "time_travel", "upsert", "version_diff", "compact", "cluster_by",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench")
    queries = load()[0]
    spark.range(1_000_000).selectExpr("sum(id)").collect()  # start the executor threads
    seconds = {}

    def timed(name, run):
        start = time.time()
        run()
        seconds[name] = round(time.time() - start, 3)

    def run_query(name):
        queries[name](spark, folder).write.format("noop").mode("overwrite").save()

    for name in BUILDS:
        timed(name, lambda: run_query(name))
    tables = Tables(spark, folder)
    Tables.forget()
    timed("store_tables", lambda: (tables.wide, tables.transformed, tables.features))
    for name in FROM_STORED + FROM_RAW:
        timed(name, lambda: run_query(name))
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": folder.rsplit("sf", 1)[-1]}))
    spark.stop()


if __name__ == "__main__":
    main()
