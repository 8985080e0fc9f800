"""Time the oracle SQL of the analytic queries in DuckDB on the same machine.

Usage: python tools/duckdb_baseline.py [sf_dir] [repeat]
Prints one JSON line {name: median seconds}. DuckDB rebuilds the proxy fact
(orders LEFT JOIN lineitem) inside every query; results are fetched as Arrow.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from clinistar import oracle  # noqa: E402

KEYS = [
    "trending_diagnoses_star", "medication_trends_star", "symptom_diagnosis_star",
    "rolling_cancellations_star", "top_doctors_star", "appointment_summary",
    "diagnosis_treatment_summary_star", "treatment_priority",
]


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    repeat = int(sys.argv[2]) if len(sys.argv) > 2 else 3
    con = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events".split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    sql = oracle.all_sql()
    out = {}
    for k in KEYS:
        runs = []
        for _ in range(repeat):
            t0 = time.perf_counter()
            con.execute(sql[k]).to_arrow_table()
            runs.append(time.perf_counter() - t0)
        out[k] = round(statistics.median(runs), 3)
    print(json.dumps({"engine": "duckdb", "threads": con.execute("select current_setting('threads')").fetchone()[0],
                      "sf_dir": sf_dir, "queries": out, "total": round(sum(out.values()), 3)}))


if __name__ == "__main__":
    main()
