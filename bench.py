"""Benchmark of the headline queries: one JSON line.

Each query runs once to warm up and then ``BENCH_RUNS`` times; the figure is
the median.  ``noop`` consumes every row without collecting any.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

ROOT = Path(__file__).resolve().parent
sys.path.insert(0, str(ROOT))

from wardflow.plans import REGISTRY, run  # noqa: E402
from wardflow.session import local_session  # noqa: E402

HEADLINE = [
    "encounter_report", "first_row_per_key", "nearest_to_target_times", "mean_of_top_values", "asof_state_at_event", "asof_with_validity", "last_value_before_event",
    "point_in_interval_join", "interval_overlap_join", "readmissions", "wide_assembly", "summary_bundle", "time_beyond_threshold", "area_under_curve", "rank_sum_test",
    "unit_stays", "gap_sessions", "paired_events", "rolling_maximum", "first_sustained_control", "dose_courses", "infusion_summary", "series_day_summary", "diagnosis_flags",
    "cohort_by_code", "exclusion_attrition", "baseline_values", "timed_snapshots", "fluid_balance_by_shift", "prior_therapy_before_index", "multi_value_pivot", "frequency_table",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    names = list(REGISTRY) if names == ["all"] else names
    spark = local_session(cpus)
    times = {}
    for name in names:
        taken = []
        for i in range(runs + 1):
            begin = time.perf_counter()
            run(name, spark, folder).write.format("noop").mode("overwrite").save()
            if i:
                taken.append(time.perf_counter() - begin)
        times[name] = round(statistics.median(taken), 4)
    total = round(sum(times.values()), 4)
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": times, "sf": Path(folder).name.removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
