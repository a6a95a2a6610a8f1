"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession

from quarry.plans import all_queries

HEADLINE = [
    "a1_summary",
    "a2_covariance",
    "a4_histogram",
    "a8_boxplot_by_class",
    "t4_one_hot_many",
    "f1_kfold",
    "f2_kfold_shuffled",
    "f8_weighted_bootstrap",
    "l4_least_squares_two",
    "l7_forward_selection",
    "l9_ridge_path",
    "l13_leave_one_out_knn",
    "l14_naive_bayes_sweep",
    "l17_network_regression",
    "d3_projection",
    "e4_class_report",
    "e5_auc",
    "m4_cosine",
    "m9_nearest_neighbours",
    "m9_neighbours_of_parts",
    "o2_bandwidth",
    "o5_relative_density",
    "n6_bag_of_words",
    "n8_rank_by_query",
    "r2_frequent_itemsets",
    "r3_association_rules",
    "c1_kmeans",
    "c3_cluster_validity",
    "c10_component_selection",
    "c5_single_linkage",
    "d6_component_sweep",
    "l20_adaboost",
    "n4_stemmed_bag",
    "m9_neighbours_in_cells",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("quarry-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = all_queries()
    only = sys.argv[1:] or HEADLINE
    # one untimed query starts the Python workers and the code generator
    queries["a2_covariance"](spark, folder).write.format("noop").mode("overwrite").save()
    times = {}
    for name in only:
        start = time.perf_counter()
        queries[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
