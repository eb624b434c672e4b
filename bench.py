"""Benchmark: wall-clock seconds per query, printed as one JSON line.

BENCH_SF_DIR names the table folder, BENCH_CPUS the local cores. All queries are
run once to warm code paths, then once more and timed; every result row is
computed and discarded through the no-op sink.
"""

from __future__ import annotations

import json
import os
import sys
import time

from ledgerloom.plans.catalog import QUERIES
from ledgerloom.session import local_session

# The five load-test tasks come first, then warehouse, cleansing, privacy and feeds.
HEADLINE = (
    "product_search",
    "stock_reserve",
    "order_tracking",
    "credit_adjust_versioned",
    "high_frequency_customers",
    "net_revenue_fact",
    "tax_revenue_by_quarter",
    "scd2_as_of_join",
    "scd2_apply_changes",
    "retail_visits",
    "corrected_basket_size",
    "commission_backpay",
    "inventory_turnover",
    "inventory_turnover_asis",
    "plan_default_rate",
    "fact_source_reconcile",
    "text_to_json_or_wrap",
    "json_normalize_numeric",
    "json_schema_validate",
    "constraint_report",
    "pan_remediation_report",
    "audit_change_log",
    "order_inventory_join",
    "place_orders_atomic",
    "latency_sla_report",
    "list_partition_read",
    "cdc_upsert_sync",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    names = sys.argv[1:] or [*HEADLINE, *sorted(set(QUERIES) - set(HEADLINE))]
    spark = local_session(cpus, "ledgerloom-bench", shuffle_partitions=int(cpus) if cpus.isdigit() else 8)
    seconds: dict[str, float] = {}
    for _ in ("warm-up", "timed"):
        for name in names:
            started = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - started, 3)
    spark.stop()
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {"metric": "total_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": float(sf) if sf.replace(".", "").isdigit() else sf}
        )
    )


if __name__ == "__main__":
    main()
