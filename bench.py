"""Benchmark: build the warehouse once, then time every analytic operator.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS
(default 8), BENCH_REPEAT (default 5; median reported). Prints ONE JSON
line: {"metric", "value", "unit", "queries", "sf", ...}.

Shape of the run (the production shape): the star warehouse is built from
the OLTP tables and written as Parquet with the fact laid out by year
(timed as ``build_star``); the snowflake dimensions are written next to it
and share the fact (``build_snowflake_dims``). Each query then runs on the
written warehouse and is executed to completion into Spark's ``noop`` sink,
so no result is pulled to the driver. One untimed pass over all queries
warms the JVM first (BENCH_WARMUP=0 skips it).
"""

from __future__ import annotations

import datetime as dt
import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from clinistar.operators import analytics as A  # noqa: E402
from clinistar.plans import builders as B  # noqa: E402
from clinistar.session import get_spark  # noqa: E402
from clinistar.sources import files, proxy  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
REPEAT = int(os.environ.get("BENCH_REPEAT", "5"))
START, END, TOP_N = dt.date(1996, 1, 1), dt.date(1998, 12, 31), 10


def _sf_of(path: str) -> float | str:
    base = os.path.basename(path.rstrip("/"))
    try:
        return float(base.removeprefix("sf"))
    except ValueError:
        return base


def _run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def _time(fn, repeat: int) -> float:
    runs = []
    for _ in range(repeat):
        t0 = time.perf_counter()
        fn()
        runs.append(time.perf_counter() - t0)
    return round(statistics.median(runs), 3)


def main() -> None:
    spark = get_spark(
        f"local[{CPUS}]", app_name="clinistar-bench", shuffle_partitions=CPUS,
        extra_conf={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")},
    )
    times: dict[str, float] = {}
    root = files.scratch_path(spark, "bench-warehouse")

    oltp = proxy.oltp_tables(spark, SF_DIR)
    t0 = time.perf_counter()
    star = B.materialize(proxy.star(spark, SF_DIR), f"{root}/star")
    times["build_star"] = round(time.perf_counter() - t0, 3)
    t0 = time.perf_counter()
    snow = B.materialize(
        B.build_snowflake(oltp, fact=star.fact()), f"{root}/snowflake",
        tables=("Dim_Patients", "Dim_PatientContactInfo", "Dim_Doctors", "Dim_Departments",
                "Dim_DepartmentSpecialty", "Dim_Diagnoses", "Dim_ICD10Codes"),
    )
    times["build_snowflake_dims"] = round(time.perf_counter() - t0, 3)

    plans = {}
    for kind, wh in (("star", star), ("snowflake", snow)):
        plans[f"trending_diagnoses_{kind}"] = lambda wh=wh: A.trending_diagnoses(wh, START, END)
        plans[f"medication_trends_{kind}"] = lambda wh=wh: A.medication_trends(wh, START, END)
        plans[f"symptom_diagnosis_{kind}"] = lambda wh=wh: A.symptom_diagnosis(wh, START, END)
        plans[f"rolling_cancellations_{kind}"] = lambda wh=wh: A.rolling_cancellations(wh, None, None)
        plans[f"top_doctors_{kind}"] = lambda wh=wh: A.top_doctors(wh, START, END, TOP_N)
        plans[f"appointment_summary_{kind}"] = lambda wh=wh: A.appointment_summary(wh)
        plans[f"diagnosis_treatment_summary_{kind}"] = lambda wh=wh: A.diagnosis_treatment_summary(wh)
        plans[f"treatment_priority_{kind}"] = lambda wh=wh: A.treatment_priority(wh)

    if os.environ.get("BENCH_WARMUP", "1") != "0":
        for build in plans.values():  # one untimed pass: JIT and code generation
            _run(build())
    for name, build in plans.items():
        times[name] = _time(lambda build=build: _run(build()), REPEAT)

    query_total = round(sum(v for k, v in times.items() if not k.startswith("build_")), 3)
    print(json.dumps({
        "metric": "analytic_queries_total",
        "value": query_total,
        "unit": "sec",
        "queries": times,
        "sf": _sf_of(SF_DIR),
        "cpus": CPUS,
        "repeat": REPEAT,
        "build_total": round(times["build_star"] + times["build_snowflake_dims"], 3),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
