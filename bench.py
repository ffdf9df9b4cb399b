"""Time the headline queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query runs to completion through the ``noop`` sink (every row is
produced, nothing is collected to the driver). A warm-up pass on the
smallest data set compiles the code paths first; each query then runs
twice and the faster run counts (the host is shared). Prints one JSON line.
With ``BENCH_EVENT_LOG=DIR`` Spark's event log (stage and task times) is
written to DIR.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ledgerline.plans.queries import QUERIES  # noqa: E402
from ledgerline.session import local_session  # noqa: E402

HEADLINE = [
    "opening_balance", "opening_balance_as_of", "dedupe_rates", "date_spine", "daily_turnover",
    "turnover_fx",
    "daily_balance", "ledger_assign", "orphan_balances", "form101", "run_log_status",
    "parse_dates", "dedupe_rows", "ingest_row_counts", "report_roundtrip", "mart_day_refresh",
]
#: Timed too, once each, and reported beside the headline queries, whose total stays comparable.
MORE = ["turnover_fx_long_rates", "account_versions_disjoint", "overlapping_versions_balance", "balance_restated",
        "balance_two_months", "account_versions_balance", "form101_versions", "form101_from_marts", "run_lookup",
        "csv_typed_scan", "csv_string_scan", "ingest_rejects", "ingest_reordered", "landing_redelivered"]
WARMUP_DIR = "/root/testdata/sf0.001"


def run(spark, name: str, sf_dir: str) -> float:
    t0 = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE
    extra = {}
    if os.environ.get("BENCH_EVENT_LOG"):
        extra = {"spark.eventLog.enabled": "true", "spark.eventLog.dir": os.environ["BENCH_EVENT_LOG"]}
    spark = local_session(cpus, shuffle_partitions=max(8, 2 * cpus), app="ledgerline-bench",
                          extra=extra)
    if os.path.isdir(WARMUP_DIR):
        for name in names:
            run(spark, name, WARMUP_DIR)
    times = {name: round(min(run(spark, name, sf_dir) for _ in range(2)), 3) for name in names}
    more = {name: round(run(spark, name, sf_dir), 3) for name in ([] if sys.argv[1:] else MORE)}
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "more": more, "sf": float(m.group(1)) if m else sf_dir, "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
