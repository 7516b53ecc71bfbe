"""Times the headline queries and prints one JSON line.

Each query is run to the end into a sink that keeps nothing, twice, and the faster run counts: the
first pays for compiling its code. The long jobs at the end are run once.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemark.catalog.queries import QUERIES  # noqa: E402
from tidemark.session import build_session  # noqa: E402

HEADLINE = [
    "stg_accounts",
    "stg_partner_transactions",
    "stg_accounts_current",
    "int_accounts_enriched",
    "int_transactions_unified",
    "int_customer_activity_summary",
    "int_merchant_risk_summary",
    "mart_daily_transaction_kpi",
    "metric_customers",
    "test_relationships",
    "clean_split",
    "null_key_count",
    "log_triage_summary",
    "validate_and_load_settlements",
    "stream_clean_quarantine",
    "stream_cdc_merge",
    "search_support_cases",
    "search_policy_docs",
    "vector_topk",
    "index_refresh_incremental",
    "auc_by_rank",
    "churn_outcome_counts",
    "fx_to_usd",
    "rolling_30_60_90",
    "activity_state_changes",
]
# Long jobs, run once.
LONG = ["materialize_models", "dq_results", "churn_train", "churn_score", "stream_index_refresh"]
RUNS = 2


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    spark = build_session("bench", os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or [*HEADLINE, *LONG]
    QUERIES["sum_check"](spark, sf_dir).collect()
    timings: dict[str, float] = {}
    for name in names:
        best = float("inf")
        for _ in range(1 if name in LONG else RUNS):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            best = min(best, time.perf_counter() - start)
        timings[name] = round(best, 3)
    scale = sf_dir.rsplit("sf", 1)[-1]
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": float(scale) if scale.replace(".", "").isdigit() else scale,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
