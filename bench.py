"""Times registered queries and prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores.  Every query
runs once to warm up and then three times; the median counts.  All rows and
columns of a result are produced (sink without output).  Query names given as
arguments replace the headline list, ``all`` runs every registered query.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from millrace.catalog import REGISTRY
from millrace.session import local_session
from millrace.storage import scope

HEADLINE = [
    # trips: scan, joins in two roles, day dimension, categories, aggregates
    "trip_metrics", "trip_peak_hours", "weather_analysis", "distance_analysis",
    "location_analysis", "trip_reports",
    # fares
    "fare_day_types", "fare_temperatures", "fare_revenue", "fare_daily",
    # relational
    "filter_like", "join_role_playing", "join_day_dim", "join_three", "semi_exists", "semi_in",
    "anti_join", "reconcile", "group_after_join", "group_having", "crosstab", "rollup_total",
    "upsert_rows", "snapshot_latest",
    # ranking, statistics, samples
    "topn_group_mean", "remaining_target", "stratified_sample", "corr_matrix",
    "describe_numeric", "histogram_density", "kde_grid",
    # text and pages
    "wordcount_lower", "wordcount_raw", "text_clean", "tokens_clean", "term_freq_by_class",
    "tfidf_top_terms", "html_cells", "html_links",
    # line jobs and planning
    "rating_avg", "rating_count_avg", "label_count", "daily_metrics", "greedy_allocation",
    "greedy_schedule", "rolling_replan", "plan_vs_actual",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 1))
    names = sys.argv[1:] or HEADLINE
    if names == ["all"]:
        names = list(REGISTRY)
    spark = local_session("bench", cpus)
    seconds: dict[str, float] = {}
    for name in names:
        runs = []
        for _ in range(4):
            with scope(spark):
                start = time.perf_counter()
                df = REGISTRY[name].run(spark, folder)
                df.write.format("noop").mode("overwrite").save()
                runs.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(runs[1:]), 4)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries, warm, median of 3",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "cpus": cpus,
            }
        )
    )


if __name__ == "__main__":
    main()
