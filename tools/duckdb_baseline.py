"""Time the oracle SQL of the bench's headline queries in DuckDB (single
process, same parquet files) for comparison with bench.py.

    python tools/duckdb_baseline.py [sf_dir]
"""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

import duckdb  # noqa: E402

from bench import HEADLINE  # noqa: E402
from ledgerlens.oracle_sql import oracle_sql  # noqa: E402
from tools.oracle_check import TABLES  # noqa: E402


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    sqls = oracle_sql()
    times = {}
    for name in HEADLINE:
        if name not in sqls:
            continue
        con.execute(sqls[name]).fetchall()            # warm
        t0 = time.perf_counter()
        con.execute(sqls[name]).fetchall()
        times[name] = round(time.perf_counter() - t0, 3)
    print(json.dumps({"engine": "duckdb", "value": round(sum(times.values()), 3), "queries": times,
                      "sf_dir": sf_dir}))


if __name__ == "__main__":
    main(sys.argv)
