"""Time headline queries on ``$BENCH_SF_DIR`` with ``local[$BENCH_CPUS]``; one JSON line."""

import json
import os
import time

from pyspark.sql import SparkSession

from dunlin.plans import QUERIES

HEADLINE = [
    "feature_table",
    "row_number_index",
    "join_inner",
    "group_sum_many",
    "describe",
    "correlation_matrix",
    "quantile_bins",
    "top_k_per_group",
    "pivot_mean",
    "nunique_columns",
    "eps_range_join",
    "kfold",
    "sorted_run_length",
    "parse_incident",
    "forecast_horizon",
    "array_remove_first",
    "standard_scale",
    "ordinal_encode",
    "tfidf",
    "token_frequency",
    "multinomial_nb",
    "nearest_join",
    "knn_k_sweep",
    "similar_items",
    "recommend_user",
    "content_predict",
    "cluster_report",
    "multiclass_report",
    "train_per_group",
    "balanced_bags",
    "kmeans",
    "birch",
    "dbscan",
    "anderson_darling",
    "spectral",
]


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("dunlin-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["head"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    only = os.environ.get("BENCH_QUERIES")
    for name in only.split(",") if only else HEADLINE:
        began = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - began, 3)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
