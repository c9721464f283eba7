"""Times the headline queries and prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from riskspark.plans.queries import QUERIES

HEADLINE = [
    "remediation_actions_top50",
    "priority_score_levels",
    "cluster_final_score",
    "quality_summary",
    "master_left_joins",
    "snapshot_asof",
    "dedupe_latest",
    "upsert_partitions",
    "nested_flatten",
    "cpe_fields",
    "select_top_priority",
    "select_group_quota",
    "select_hybrid",
    "strategy_ranking",
    "strategy_comparison",
    "backlog_projection",
    "cluster_risk_summary",
    "top_values_per_group",
    "top_n_filtered",
    "text_clean",
    "kmeans_clusters",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("riskspark-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", os.environ.get("BENCH_WORK_DIR", os.path.abspath("spark-warehouse/_bench")))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1_000_000).selectExpr("sum(id)").collect()  # start the executors
    seconds = {}
    for name in HEADLINE:
        started = time.perf_counter()
        # every row and column is computed and none is kept
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
