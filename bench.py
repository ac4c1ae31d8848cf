"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS] and print one
JSON line.  Each query is executed completely through the no-op sink (nothing is
collected to the driver); the reported time per query is the median of the warm runs."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "evaluate_all", "hits_at_k", "auc_roc", "confusion_counts", "plate_ppv",
    "tanimoto_pairs", "leader_pick", "screen_cluster_best",
    "balance_multi", "stratified_folds", "calibration_split",
    "fp_ngram_r2", "fp_key_presence", "rule_filters",
    "fusion_metrics", "conformal_sets", "scores_pivot",
    "ledger_dedupe", "select_top_models",
    "knn_vote", "cv_mean_metrics", "train_nb", "train_dt",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    from screenlake.plans.catalog import queries
    from screenlake.session import get_spark

    spark = get_spark()
    qs = queries()
    names = only or HEADLINE
    timings: dict[str, float] = {}
    for name in names:
        samples = []
        for _ in range(runs):
            t0 = time.perf_counter()
            qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            samples.append(time.perf_counter() - t0)
        warm = samples[1:] or samples
        timings[name] = round(statistics.median(warm), 3)
        print(f"# {name}: {samples}", file=sys.stderr, flush=True)
    sf = sf_dir.rstrip("/").rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "sum_of_query_seconds", "value": round(sum(timings.values()), 3),
                      "unit": "sec", "queries": timings, "sf": sf,
                      "cpus": os.environ.get("BENCH_CPUS", "8"), "runs": runs}))


if __name__ == "__main__":
    main()
