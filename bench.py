"""Time the headline queries: one JSON line with seconds per query.

Reads $BENCH_SF_DIR (default /root/testdata/sf0.1) on local[$BENCH_CPUS]. Each
query runs once, and once more before that when $BENCH_WARM is set; results go
to a no-op sink, so every row and column is computed.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "head_to_head_scores",
    "head_to_head_advancement",
    "co_occurrence_by_breakout",
    "mixed_tests_in_one_table",
    "specific_then_default_config",
    "regional_aggregates",
    "regional_scores_against_checks",
    "ranks_by_environment",
    "refined_testers_and_pools",
    "weighted_group_evidence",
    "similarity_to_benchmark",
    "column_profile",
    "accuracy_over_all_combinations",
    "precision_recall_area",
    "repaired_stage_history",
    "least_squares_adjustment",
    "massey_ranking",
    "product_lifecycle",
    "all_pareto_fronts",
    "driver_explanations",
)


def main() -> None:
    from trialspark.plans import load_all
    from trialspark.session import build_session

    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(f"local[{cpus}]", int(cpus) if cpus.isdigit() else 8, "trialspark-bench")
    spark.sparkContext.setLogLevel("ERROR")
    plans = load_all()
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    if names == ["all"]:
        names = list(plans)
    seconds = {}
    for name in names:
        for _ in range(2 if os.environ.get("BENCH_WARM") else 1):
            start = time.perf_counter()
            plans[name](spark, folder).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    total = round(sum(seconds.values()), 3)
    sf = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "total_seconds_headline_queries", "value": total, "unit": "sec", "queries": seconds, "sf": sf}), flush=True)


if __name__ == "__main__":
    main()
