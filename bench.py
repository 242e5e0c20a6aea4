"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the table folder, BENCH_CPUS the number of local cores and
BENCH_RUNS how often each query runs; the fastest run counts, as the first one
also compiles.  Every result is written out in full to a sink that drops it.
"""

import json
import os
import time

from skyloom.plans.suite import QUERIES
from skyloom.session import get_session

HEADLINE = [
    "flagship_daily_mean_in_box",
    "s1_grid_store_scan",
    "s1_many_requests_at_once",
    "s2_scan_many_assets",
    "s4_urls_from_fields",
    "s7_classify_headers",
    "f6_all_filters_together",
    "f9_box_with_longitude_wrap",
    "f16_embargo",
    "j1_intersect_constraints",
    "j2_intersect_date_ranges",
    "j3_nearest_points",
    "j4_points_in_boxes",
    "j5_features_in_box",
    "j7_delivered_or_missing",
    "j9_conditional_tags",
    "h1_intersection_and_differences",
    "h3_unfold_cubes",
    "h5_merge_keeps_fields",
    "h7_split_to_size",
    "h8_chunk_over_requests",
    "a1_daily_mean",
    "a1_daily_median",
    "a2_monthly_std",
    "a3_daily_statistics_for_utc_offset",
    "a5_count_granules",
    "a10_cost_report",
    "a13_form_state_mixed",
    "w1_compress_dates_of_requests",
    "w2_clumps_of_mask",
    "w6_validity_axis",
    "v1_enforce_good_requests",
    "x1_daily_reduction_of_closed_days",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_session(f"local[{cpus}]", int(cpus) if cpus.isdigit() else 8, spark__driver__memory="16g")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    timings = {}
    for name in HEADLINE:
        seconds = []
        for _ in range(runs):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            seconds.append(time.perf_counter() - start)
        timings[name] = round(min(seconds), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
