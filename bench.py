"""Benchmark: wall-clock seconds per headline query (warm session, median of
3 runs after one warm-up), forced with the ``noop`` sink so the whole plan
runs without collecting.  Prints one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py [names...]
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "top_leads", "threshold_sweep_101", "optimal_threshold", "roc_auc", "pr_auc",
    "roc_points", "classification_report", "lead_scores", "rank_leads", "stratified_split",
    "fold_metric_avg", "validation_status", "columns_to_drop", "profile_table",
    "missing_report", "value_counts_all", "describe_numeric", "box_summary",
    "spearman_matrix", "dedupe_first", "duplicates_report", "clean_rows",
    "impute_mean_mode", "impute_probabilistic", "standardize", "one_hot_all",
    "ordinal_encode", "stream_score", "train_gbt", "batch_score",
]

# whole 100-tree fits: one timed run after the warm-up
FITS = {"train_gbt", "batch_score"}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "*")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    from propensity.plans.catalog import queries
    from propensity.session import local_session
    n = os.cpu_count() if cpus == "*" else int(cpus)
    spark = local_session(cpus, shuffle_partitions=max(8, n))
    qs = queries()
    names = sys.argv[1:] or HEADLINE

    def run(name: str) -> float:
        t0 = time.perf_counter()
        qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    out: dict[str, float] = {}
    for name in names:
        try:
            run(name)                       # warm-up
            times = 1 if name in FITS else runs
            out[name] = round(statistics.median(run(name) for _ in range(times)), 3)
        except Exception as e:              # keep the line parseable
            print(f"{name} failed: {type(e).__name__}: {str(e)[:300]}", file=sys.stderr)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "sum_of_median_query_seconds",
                      "value": round(sum(out.values()), 3), "unit": "sec",
                      "queries": out, "sf": sf, "runs": runs, "cpus": cpus}))


if __name__ == "__main__":
    main()
