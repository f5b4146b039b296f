"""Time the headline queries on one machine and print one line of JSON."""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from quipu.plans import load

HEADLINE = [
    "sales_summary", "agg_global", "group_multi_agg", "group_size2", "pivot_table", "value_counts", "hours_groups",
    "filter_derived", "clean_sentinels", "derive_arith", "share_of_total", "fill_mean", "dup_count", "drop_dups",
    "find_duplicate", "nunique", "describe", "join_inner", "join_large", "sql_join_group", "set_intersect",
    "membership", "sort_values_list", "actor_ranking", "enumerate_rows", "row_slice", "histogram", "exact_kde",
    "box_stats", "corr_matrix", "quantile", "iqr_outliers", "bins_2d", "word_freq", "top_k", "cron_expand",
    "json_normalize", "scan_csv", "in_degree_top", "math_ufuncs", "str_title", "arr_sets", "map_put", "matmul",
    "mat_sort_axis",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    registered = load()
    names = sys.argv[1:] or HEADLINE
    if names == ["all"]:
        names = list(registered)
    registered["agg_global"](spark, folder).collect()  # start the engine before the clock
    seconds = {}
    for name in names:
        start = time.perf_counter()
        registered[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    sf = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": seconds, "sf": sf}))


if __name__ == "__main__":
    main()
