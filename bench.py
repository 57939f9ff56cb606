"""Wall time per query at $BENCH_SF_DIR on local[$BENCH_CPUS]; one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from textcheck.plans.catalog import REGISTRY  # noqa: E402
from textcheck.session import build_session  # noqa: E402


HEADLINE = (
    "clean_text", "clean_html", "prepare_and_split", "sample_rows", "column_profile_lineitem",
    "exact_duplicate_count", "duplicate_rows", "class_balance", "score_identity", "bias_summary",
    "embedding_pairs", "tfidf_pairs", "leakage_pairs", "tfidf_features", "classification_report",
    "trained_report", "tag_protected", "fairness_gaps", "attribute_fairness", "perturb_typo_swap",
    "perturb_typo_keyboard", "robustness_summary", "linear_importance", "token_occlusion", "psi",
    "ks_two_sample_embedding", "target_drift", "repair_plan", "apply_rebalance", "audit_report",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session("bench", f"local[{cpus}]", int(cpus), **{
        "spark.driver.memory": "16g", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    # One small job, so that starting the engine is not charged to the first query.
    REGISTRY["class_balance"](spark, sf_dir).collect()
    times = {}
    for name in names:
        start = time.time()
        REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - start, 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    spark.stop()
    print(json.dumps({"metric": "total_wall_time", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times,
                      "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
