"""Time the headline queries: one JSON line on stdout.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and cores.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

HEADLINE = [
    "flow_rate", "flow_history", "flow_detail", "rolled_per_shop", "flow_matrix", "daily_roll", "kpi_status",
    "alert_base", "tab_overview", "alert_report", "response_days", "overdue_written_off", "cash_count_check",
    "over_active_limit", "over_title_limit", "liquidation_backlog", "cash_count_window", "processing_time",
    "quick_close", "overdue_close", "compliance_features", "scorecard", "audit_sample",
    "reminders_risk_recommendation", "previous_contracts",
]


def main() -> None:
    from checks import registry
    from loantide.session import build_session

    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", cores, int(cores) if cores.isdigit() else 8)
    queries = registry.spark_queries()
    wanted = sys.argv[1:] or HEADLINE
    spark.read.parquet(f"{sf}/nation.parquet").count()
    seconds = {}
    for name in wanted:
        start = time.perf_counter()
        # The noop sink runs the whole plan without collecting rows to the driver.
        queries[name](spark, sf).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    spark.stop()
    print(json.dumps({"metric": "headline queries, total wall time", "value": round(sum(seconds.values()), 3),
                      "unit": "sec", "queries": seconds, "sf": sf}))


if __name__ == "__main__":
    main()
