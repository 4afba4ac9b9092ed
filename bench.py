"""Benchmark the headline queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query's full plan is executed with the ``noop`` sink (every row is
produced, nothing is collected to the driver).  The headline queries run
twice in one session: a first (cold) pass, whose total is reported as
``cold_value``, warms the JVM's JIT and Spark's code generation; the second
pass is the measurement (``value``, per query in ``queries``), as a
long-running cluster would see it.  Prints one JSON line:
{"metric": "total_query_seconds_warm", "value": N, "unit": "sec", "queries": {...},
 "cold_value": M, "sf": ...}
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

HEADLINE = [
    "fct_sales",
    "monthly_revenue",
    "sales_performance_row",
    "sales_performance_calendar",
    "dim_customers",
    "rfm_quantile",
    "base_measures",
    "period_to_date",
    "time_intelligence_month",
    "new_returning",
    "budget_attainment",
    "top_products_ties",
    "kpi_summary",
    "quality_report",
    "upsert_latest",
    "latest_per_customer",
]


def main() -> int:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    only = [a for a in sys.argv[1:]]
    from ledgerlens.queries import queries
    from ledgerlens.session import build_session
    spark = build_session(f"local[{cpus}]", max(cpus, 8), app_name="ledgerlens-bench",
                          extra={"spark.driver.memory": "16g"})
    qs = queries()
    # Warm up the JVM and the Parquet reader once (not timed).
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").write.format("noop").mode("overwrite").save()
    names = [n for n in HEADLINE if not only or n in only]

    def one_pass() -> dict:
        times = {}
        for name in names:
            t0 = time.perf_counter()
            qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - t0, 3)
        return times

    cold = one_pass()
    warm = one_pass()
    spark.stop()
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {"metric": "total_query_seconds_warm", "value": round(sum(warm.values()), 3), "unit": "sec",
           "queries": warm, "cold_value": round(sum(cold.values()), 3),
           "sf": float(m.group(1)) if m else sf_dir}
    print(json.dumps(out))
    return 0


if __name__ == "__main__":
    sys.exit(main())
