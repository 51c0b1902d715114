"""

The source system runs its SQL on DuckDB, so the oracle SQL on DuckDB is the
closest single-node figure for the same work.  Each query runs twice and the
faster run is kept, as in bench.py.  Prints one JSON line.
"""

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tools"))

from oracle_check import duck  # noqa: E402

import bench  # noqa: E402
from ledgerline.plans.oracle import QUERIES  # noqa: E402


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    con = duck(sf_dir)
    con.execute("SET threads TO 8")
    times = {}
    for name in bench.HEADLINE:
        if name not in QUERIES:
            continue
        runs = []
        for _ in range(2):
            t = time.perf_counter()
            con.execute(QUERIES[name]).fetchall()
            runs.append(time.perf_counter() - t)
        times[name] = round(min(runs), 3)
    print(json.dumps({"engine": "duckdb", "sf_dir": sf_dir, "total": round(sum(times.values()), 3),
                      "queries": times}))


if __name__ == "__main__":
    main()
