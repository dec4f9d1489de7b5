"""Time the headline queries: one JSON line with seconds per query (warm, best of three).

BENCH_SF_DIR names the test tables (default sf0.1), BENCH_CPUS the local cores (default 8),
BENCH_QUERIES an own comma-separated choice of queries.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from remitmatch.harness.registry import QUERIES  # noqa: E402
from remitmatch.session import build_session  # noqa: E402

HEADLINE = [
    "recon_results", "recon_scenarios", "recon_dashboard", "payment_invoice_links",
    "discrepancy_report", "high_risk_accounts", "mismatch_report", "sku_mismatch_detail",
    "aging_report", "aging_warehouse", "partial_payment_analysis", "partial_payment_running",
    "customer_risk_summary", "invoice_violations", "scan_invoices", "constraint_violations",
    "recon_results_crowded", "single_best", "greedy_running", "schema_violations", "run_summary",
]


def run(spark, name: str, sf_dir: str) -> float:
    started = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES")
    spark = build_session(
        "remitmatch-bench",
        f"local[{cpus}]",
        {"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "12g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in chosen.split(",") if chosen else HEADLINE:
        seconds[name] = round(min(run(spark, name, sf_dir) for _ in range(3)), 3)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
