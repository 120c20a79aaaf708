"""Time headline queries on the provided tables and print one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_RUNS (default 3).
Each query is written to the no-op sink once to warm up, then the median of the runs counts.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

HEADLINES = (
    "m01_insert_update", "m01_insert_update_small_batch", "m02_insert_update_delete", "m07_scd_mart", "m09_mart_fact",
    "m10_key_lookup", "m10_key_lookup_large_dim", "m12_change_history", "m16_consolidated_history", "w06_changed_keys",
    "q01_duplicate_keys", "q06_metric_reconciliation", "j10_effective_range", "j12_nearest_in_time",
    "j15_co_occurrence", "a01_group_by", "a05_count_distinct", "a09_median_percentile", "n09_running_total",
    "t18_datediff", "d01_cohort_waterfall", "d04_bop_eop_counts", "d05_lifetime_monthly", "d10_action_periods",
    "d13_breakage", "d16_clamped_balance", "d17_last_channel", "d22_click_attribution", "d26_platform_spend",
    "d28_repaired_increments", "d30_tiered_ranking", "d36_product_conversion", "d40_trailing_windows",
    "d41_purchase_costs", "d46_restated", "d47_lead_times", "d53_customer_segments", "d58_event_tables",
    "d61_order_fact", "u08_visit_count",
)


def main() -> None:
    from tidemart.session import clear_scratch, get_session
    from tidemart.workload import registry

    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = get_session(
        "bench", f"local[{cpus}]", **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    entries = registry()
    chosen = sys.argv[1:] or HEADLINES

    def once(name: str) -> float:
        start = time.perf_counter()
        entries[name](spark, folder).write.format("noop").mode("overwrite").save()
        took = time.perf_counter() - start
        clear_scratch(spark)  # the result has been read
        return took

    seconds = {}
    for name in chosen:
        once(name)
        seconds[name] = round(statistics.median(once(name) for _ in range(runs)), 3)
    scale = re.search(r"sf([0-9.]+)", folder)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else None,
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
