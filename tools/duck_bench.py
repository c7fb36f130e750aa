"""Time the oracle SQL of the headline queries in DuckDB (single node), as
a comparison point for bench.py. Prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    from bench import HEADLINE
    from goldvein.plans.oracle import ORACLE
    from tools.oracle_check import duck
    con = duck(sf_dir)
    times = {}
    for n in HEADLINE:
        t0 = time.time()
        con.execute(ORACLE[n]).fetchall()
        times[n] = round(time.time() - t0, 3)
    print(json.dumps({"metric": "duckdb_oracle_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times}))


if __name__ == "__main__":
    main()
