"""Command-line jobs (for ``spark-submit`` or ``python -m clinistar.jobs``).

    build     OLTP tables (CSV or Parquet) -> quality report -> star/snowflake warehouse
    run       one analysis on a written warehouse -> Parquet (or its first rows printed)
    priority  the treatment-priority update as a new fact version or a priority table

Examples:

    python -m clinistar.jobs build --oltp /data/oltp --format csv --out /wh/star --model star
    python -m clinistar.jobs run --warehouse /wh/star --model star \\
        --query GetTrendingDiagnoses --start 2022-01-01 --end 2024-12-31 --out /reports/trending
    python -m clinistar.jobs priority --warehouse /wh/star --model star --table /wh/priority
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys

from pyspark.sql import DataFrame, SparkSession

from clinistar.operators import analytics as A
from clinistar.operators import quality as Q
from clinistar.plans import builders as B
from clinistar.plans.model import SNOWFLAKE_TABLES, STAR_TABLES, Warehouse
from clinistar.session import get_spark
from clinistar.sources import files

QUERIES = {
    "GetTrendingDiagnoses": lambda wh, a: A.trending_diagnoses(wh, a.start, a.end, strict_year=a.strict_year),
    "GetMedicationPrescriptionTrends": lambda wh, a: A.medication_trends(wh, a.start, a.end),
    "GetSymptomDiagnosisCorrelation": lambda wh, a: A.symptom_diagnosis(
        wh, a.start, a.end, symptom_mode=a.symptom_mode),
    "GetRollingAvgCancellations": lambda wh, a: A.rolling_cancellations(
        wh, a.start, a.end, calendar=a.calendar),
    "GetTopDoctorsByGrowthRate": lambda wh, a: A.top_doctors(wh, a.start, a.end, a.top_n, per=a.per),
    "AppointmentSummary": lambda wh, a: A.appointment_summary(wh),
    "DiagnosisTreatmentSummary": lambda wh, a: A.diagnosis_treatment_summary(wh),
}


#: Counts from which a treatment's priority is high or medium (fixed values of the model).
PRIORITY_THRESHOLDS = {"high_appointments": 5, "high_treatments": 3, "medium_appointments": 3, "medium_treatments": 2}


def read_warehouse(spark: SparkSession, path: str, kind: str) -> Warehouse:
    names = STAR_TABLES if kind == "star" else SNOWFLAKE_TABLES
    return Warehouse(kind, {n: spark.read.parquet(f"{path.rstrip('/')}/{n}") for n in names})


def _date(s: str) -> dt.date:
    return dt.date.fromisoformat(s)


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="clinistar.jobs")
    sub = p.add_subparsers(dest="cmd", required=True)

    b = sub.add_parser("build", help="build and write a warehouse from OLTP tables")
    b.add_argument("--oltp", required=True)
    b.add_argument("--format", choices=("csv", "parquet"), default="csv")
    b.add_argument("--out", required=True)
    b.add_argument("--model", choices=("star", "snowflake"), default="star")
    b.add_argument("--quality-report", help="where to write the rule violation counts")
    b.add_argument("--key-maps", help="folder that keeps the snowflake's surrogate keys from load to load")

    r = sub.add_parser("run", help="run one analysis on a written warehouse")
    r.add_argument("--warehouse", required=True)
    r.add_argument("--model", choices=("star", "snowflake"), default="star")
    r.add_argument("--query", choices=sorted(QUERIES), required=True)
    r.add_argument("--start", type=_date)
    r.add_argument("--end", type=_date)
    r.add_argument("--top-n", type=int, default=10)
    r.add_argument("--per", choices=("row", "doctor"), default="row")
    r.add_argument("--strict-year", action="store_true")
    r.add_argument("--calendar", action="store_true")
    r.add_argument("--symptom-mode", choices=A.SYMPTOM_MODES, default="raw")
    o = r.add_mutually_exclusive_group(required=True)
    o.add_argument("--out", help="Parquet output folder")
    o.add_argument("--show", type=int, metavar="N", help="print the first N rows instead")

    u = sub.add_parser("priority", help="the treatment-priority update")
    u.add_argument("--warehouse", required=True)
    u.add_argument("--model", choices=("star", "snowflake"), default="star")
    g = u.add_mutually_exclusive_group(required=True)
    g.add_argument("--new-version", help="rewrite the fact with TreatmentPriority into this folder")
    g.add_argument("--table", help="write the (PatientID, DiagnosisID) priority table here")
    for name, default in PRIORITY_THRESHOLDS.items():
        u.add_argument("--" + name.replace("_", "-"), type=int, default=default)
    u.add_argument("--distinct-appointments", action="store_true")
    u.add_argument("--unmatched", choices=("keep", "low"), default="keep", help="priority of fact rows the update doesn't reach")
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> DataFrame | None:
    args = _parser().parse_args(argv)
    spark = spark or get_spark()
    if args.cmd == "build":
        oltp = files.read_oltp(spark, args.oltp, args.format)
        if args.quality_report:
            Q.model_report(oltp).write.mode("overwrite").parquet(args.quality_report)
        wh = B.build_star(oltp) if args.model == "star" else B.build_snowflake(oltp, key_maps=args.key_maps)
        B.materialize(wh, args.out)
        return None
    wh = read_warehouse(spark, args.warehouse, args.model)
    if args.cmd == "priority":
        options = {n: getattr(args, n) for n in (*PRIORITY_THRESHOLDS, "distinct_appointments")}
        if args.table:
            A.write_priority_table(wh, args.table, **options)
        else:
            A.write_treatment_priority(wh, args.new_version, unmatched=args.unmatched, **options)
        return None
    ranged = args.query.startswith("Get")
    if ranged and (args.start is None or args.end is None):
        raise SystemExit(f"{args.query} needs --start and --end")
    if not ranged and (args.start is not None or args.end is not None):
        raise SystemExit(f"{args.query} has no date range")
    result = QUERIES[args.query](wh, args)
    if args.out:
        result.write.mode("overwrite").parquet(args.out)
        return None
    result.show(args.show, truncate=False)
    return result


if __name__ == "__main__":
    main(sys.argv[1:])
