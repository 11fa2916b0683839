"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_RUNS (default 3):
seconds per query, median of the runs after one warm-up.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from burnish.dirty import table  # noqa: E402
from burnish.registry import QUERIES  # noqa: E402
from burnish.session import local_session  # noqa: E402

HEADLINE = [
    "a13_load_summary",
    "n1_clean_orders",
    "n2_clean_telemetry",
    "n3_clean_workforce",
    "n4_clean_ledger",
    "n5_clean_catalog",
    "g2_overall_score_orders",
    "g2_overall_score_ledger",
    "c1_profile_columns_ledger",
    "c7_col_median",
    "d14_orphan_fk_lineitem",
    "d21_group_imbalance",
    "d28_wrong_language",
    "d32_detect_issues",
    "e1_dedupe_first",
    "e31_flag_group",
    "e40_impute_group_median",
    "h1_audit",
    "h5_cell_diff",
    "k2_dedupe_batches",
    "k4_windowed_quality",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(cpus, shuffle_partitions=8)
    seconds = {}
    for name in HEADLINE:
        times = []
        for _ in range(runs + 1):
            started = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - started)
        seconds[name] = round(statistics.median(times[1:]), 3)
    rows = table(spark, sf_dir, "lineitem").count()
    pipeline = seconds["n4_clean_ledger"] + seconds["c1_profile_columns_ledger"] + seconds["g2_overall_score_ledger"]
    print(
        json.dumps(
            {
                "metric": "headline queries, total seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")),
                "ledger_rows_per_second": round(rows / pipeline),
            }
        )
    )


if __name__ == "__main__":
    main()
