"""Time the headline queries; prints one JSON line.

Environment: BENCH_SF_DIR (folder of the tables), BENCH_CPUS (local cores).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "b4_null_ratio", "b5_describe", "b7_distinct_counts", "c8_quantile_cut", "c10_category_codes",
    "d3_rate_by_each", "d7_boxplot", "e1_correlation_matrix", "e3_rank_hypotheses",
    "g1_kfold", "g3_time_blocks", "g4_seeded_folds", "h4_median_baseline", "h11_ridge_cv", "i2_roc_auc",
    "j1_cross_validated_scores", "j2_delta_vs_best", "j4_convergence",
    "k6_permutation", "k8_bootstrap_lift_ci", "k11_gates", "l2_poisson_bootstrap", "l6_third_slices",
    "l9_permutation_importance", "l11_gates_and_verdict",
    "m13_script_flags", "m14_method_audit", "n9_report_audit", "n3_contradictions", "n4_missing_sections",
    "o2_grounded_numeric", "o3_number_comparison", "o17_qa_verdict", "o22_registry_upsert", "o26_stage_status",
]


def main() -> None:
    from sparkaudit import plans
    from sparkaudit.session import local_session

    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, int(cpus))
    catalogue = plans.queries()
    catalogue["b1_shape"](spark, folder).collect()  # start-up is not a query
    times = {}
    for name in names:
        start = time.time()
        catalogue[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - start, 3)
        print(f"{times[name]:8.2f}  {name}", file=sys.stderr, flush=True)
    line = {
        "metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(line))


if __name__ == "__main__":
    main()
