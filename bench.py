"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR   folder of the tables      (default /root/testdata/sf0.1)
BENCH_CPUS     cores of the local master (default 8)
BENCH_QUERIES  comma-separated names, or "all" (default: the headline queries)
BENCH_RUNS     timed runs per query after one warm-up (default 2; the mean of two, the median of more)
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).parent))

from abacarium.plans.library import QUERIES  # noqa: E402
from abacarium.session import build_session  # noqa: E402

HEADLINE = [
    "order_summary", "q03_like", "q12a_not_in", "q15_monthly", "q18_category_rev", "q22_order_detail",
    "q23_anti_customers", "q28_customer_category", "q29_basket_pairs", "q30_full_outer", "q31_top5_revenue",
    "q38_all_customers", "q42_state_rank", "q43_clv", "q50_division", "star_join", "agg_monthly_category",
    "q_range_vs_func", "w1_three_ranks", "w2_top2_category", "w3_top3_share", "w4_quartiles", "m1_mom_report",
    "r1_time_rollup", "r2_geo_rollup", "dedupe_latest", "insert_if_absent", "merge_dim", "assign_keys", "load_fact",
    "dq_catalog", "ledger_by_account", "ledger_balance", "ledger_replay", "json_clean", "report_card",
]


def run(spark, name: str, folder: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if chosen == "all" else [n for n in chosen.split(",") if n] or HEADLINE
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = build_session(
        "abacarium-bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__driver__memory="16g",
        spark__ui__showConsoleProgress="false", spark__checkpoint__dir=tempfile.mkdtemp(prefix="abacarium-bench-"),
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in names:
        run(spark, name, folder)
        times[name] = round(statistics.median(run(spark, name, folder) for _ in range(runs)), 3)
    spark.stop()
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": Path(folder).name.removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
