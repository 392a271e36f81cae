"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR   tables to read      (default /root/testdata/sf0.1)
BENCH_CPUS     local cores         (default 8)
BENCH_QUERIES  comma-separated names, or "all"
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tally.plans.catalog import QUERIES
from tally.session import build_session

HEADLINE = (
    "raw_dedup_new_payloads", "latest_snapshot_per_source", "event_dedup_newest", "event_dedup_hot_key",
    "consolidate_events", "merge_dedup_raw", "period_columns", "normalize_currency", "consolidate_holdings",
    "portfolio_percentage", "aggregate_percentages", "dividend_income", "interest_income", "cash_flow_summary",
    "ledger_end_to_end", "allocation_by_broker", "cross_broker_tickers", "summary_by_broker", "cash_flow_grid",
    "cash_flow_outliers", "dq_required_nulls", "dq_reconciliation", "closed_position_fee_join",
    "workbook_header_detect", "json_tax_split", "trade_comment_extract", "crypto_roundtrip",
    "crypto_payload_roundtrip", "ibkr_trade_events", "trading212_order_events", "xtb_events",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    wanted = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if wanted == "all" else [n for n in wanted.split(",") if n] or list(HEADLINE)
    spark = build_session(
        "tally-bench",
        master=f"local[{cpus}]",
        **{
            "spark.ui.enabled": "false",
            "spark.driver.memory": "16g",
            "spark.sql.shuffle.partitions": cpus,
        },
    )
    spark.sparkContext.setLogLevel("OFF")

    def run(name: str) -> float:
        started = time.perf_counter()
        QUERIES[name].build(spark, sf_dir).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - started, 3)

    run("dq_status_counts")  # start the JVM's machinery outside the measurement
    times = {name: run(name) for name in names}
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
