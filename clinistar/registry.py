"""Registered queries: one per operator of the survey's inventory.

Each entry takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the
driver tables in ``sf_dir`` (through the proxy binding), whole tables, no
sampling. ``clinistar.oracle`` holds the matching DuckDB SQL.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clinistar import oracle
from clinistar.functions.keys import KeyMap
from clinistar.functions.scalar import ts_range
from clinistar.functions.sql import register_sql
from clinistar.operators import analytics as A
from clinistar.operators import derive as E
from clinistar.operators import generic as G
from clinistar.operators import quality as Q
from clinistar.operators.incremental import SummaryState
from clinistar.plans import builders as B
from clinistar.plans.model import Warehouse
from clinistar.sources import proxy
from clinistar.sources.files import csv_roundtrip, scratch_path

Query = Callable[[SparkSession, str], DataFrame]

START = dt.date.fromisoformat(oracle.START)
END = dt.date.fromisoformat(oracle.END)
TOP_N = oracle.TOP_N
MANY = oracle.MANY


def _on(kind: str, fn: Callable, *args, **kwargs) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(proxy.model(spark, sf_dir, kind), *args, **kwargs)

    run.__name__ = f"{fn.__name__}_{kind}"
    return run


def _on_records(fn: Callable, *args, **kwargs) -> Query:
    """On the star whose fact is built from records and prescriptions."""
    return lambda spark, sf_dir: fn(B.build_star(proxy.oltp_tables(spark, sf_dir)), *args, **kwargs)


def _state_of_loads(spark: SparkSession, sf_dir: str) -> tuple[SummaryState, Warehouse]:
    """The whole fact, added in three loads by year."""
    wh = proxy.star(spark, sf_dir)
    state, year = SummaryState(spark, scratch_path(spark, "summaries")), F.year("AppointmentDateTime")
    for load, years in enumerate((year < 1995, year.between(1995, 1996), (year > 1996) | year.isNull())):
        state.add(load, wh.fact().where(years))
        state.update_priorities(load, wh)
    return state, wh


def _incremental_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    state, wh = _state_of_loads(spark, sf_dir)
    return state.appointment_summary(wh)


def _priority(kind: str, **kwargs) -> Query:
    cols = ["AppointmentID", "PatientID", "DoctorID", "DiagnosisID", "MedicationID", "Status",
            "TreatmentPriority"]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return A.treatment_priority(proxy.model(spark, sf_dir, kind), **kwargs).select(*cols)

    return run


def analytic_queries() -> dict[str, Query]:
    q: dict[str, Query] = {}
    for kind in ("star", "snowflake"):
        q[f"trending_diagnoses_{kind}"] = _on(kind, A.trending_diagnoses, START, END)
        q[f"medication_trends_{kind}"] = _on(kind, A.medication_trends, START, END)
        q[f"symptom_diagnosis_{kind}"] = _on(kind, A.symptom_diagnosis, START, END)
        q[f"rolling_cancellations_{kind}"] = _on(kind, A.rolling_cancellations, None, None)
        q[f"top_doctors_{kind}"] = _on(kind, A.top_doctors, START, END, TOP_N)
        q[f"diagnosis_treatment_summary_{kind}"] = _on(kind, A.diagnosis_treatment_summary)
    # the options that resolve the reference's ambiguities
    q["trending_diagnoses_strict_year"] = _on("star", A.trending_diagnoses, START, END, strict_year=True)
    q["medication_trends_top3"] = _on("star", A.medication_trends, START, END, top_k=3)
    q["rolling_cancellations_calendar"] = _on("star", A.rolling_cancellations, None, None, calendar=True)
    q["top_doctors_per_doctor"] = _on("star", A.top_doctors, START, END, TOP_N, per="doctor")
    q["top_doctors_all"] = _on("star", A.top_doctors, START, END, MANY)
    for mode in ("set", "exploded"):  # on the fact whose records list their symptoms
        q[f"symptom_diagnosis_{mode}"] = _on_records(A.symptom_diagnosis, START, END, symptom_mode=mode)
    q["diagnosis_treatment_summary_distinct"] = _on_records(A.diagnosis_treatment_summary, distinct_appointments=True)
    q["treatment_priority_low"] = _priority("star", unmatched="low")
    q["incremental_priorities"] = lambda spark, sf_dir: _state_of_loads(spark, sf_dir)[0].priorities()
    q["incremental_appointment_summary"] = _incremental_summary
    q["appointment_summary"] = _on("star", A.appointment_summary)
    q["appointment_summary_snowflake"] = _on("snowflake", A.appointment_summary)
    q["treatment_priority"] = _priority("star")
    q["treatment_priority_snowflake"] = _priority("snowflake")
    q["treatment_priority_distinct"] = _priority(
        "star", high_appointments=14, medium_appointments=8, distinct_appointments=True
    )
    return q


# ---------------------------------------------------------------------------
# M: model builders on the proxy OLTP tables
# ---------------------------------------------------------------------------
def _oltp(fn: Callable[[dict], DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(proxy.oltp_tables(spark, sf_dir))

    return run


def _second_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The key map of diagnosis codes after a first load with the brands and a
    second one with all diagnosis names as well."""
    part = proxy.read_table(spark, sf_dir, "part")
    brands = part.select(F.col("p_brand").alias("Code"))
    names = part.select(F.concat_ws(" ", "p_type", "p_name", "p_brand").alias("Code"))
    codes = KeyMap(spark, scratch_path(spark, "key-map"), "Code", "CodeID")
    codes.update(brands)
    return codes.update(names.unionByName(brands))


def builder_queries() -> dict[str, Query]:
    q: dict[str, Query] = {
        "build_fact": proxy.visit_fact,
        "build_fact_from_children": _oltp(B.fact_from_oltp),
        "dim_patients_star": _oltp(lambda o: B.dim_patients_star(o["Patients"], o["PatientContactInfo"])),
        "dim_doctors_star": _oltp(
            lambda o: B.dim_doctors_star(o["Doctors"], o["Departments"], o["DepartmentSpecialty"])
        ),
        "dim_diagnoses_star": _oltp(lambda o: B.dim_diagnoses_star(o["Diagnoses"])),
        "dim_medications": _oltp(lambda o: B.dim_medications(o["Medications"])),
        "dim_insurance": _oltp(lambda o: B.dim_insurance(o["Insurance"])),
        "dim_patient_allergies": _oltp(
            lambda o: B.dim_patient_allergies(o["PatientAllergies"], o["Allergies"])
        ),
        "dim_patients_snowflake": _oltp(
            lambda o: B.dim_patients_snowflake(o["Patients"], o["PatientContactInfo"])
        ),
        "dim_patient_contact_info": _oltp(lambda o: B.dim_patient_contact_info(o["PatientContactInfo"])),
        "dim_doctors_snowflake": _oltp(lambda o: B.dim_doctors_snowflake(o["Doctors"])),
        "dim_department_specialty": _oltp(lambda o: B.dim_department_specialty(o["DepartmentSpecialty"])),
        "dim_departments": _oltp(
            lambda o: B.dim_departments(
                o["Departments"], o["DepartmentSpecialty"],
                B.dim_department_specialty(o["DepartmentSpecialty"]),
            )
        ),
        "dim_icd10_codes": _oltp(lambda o: B.dim_icd10_codes(o["Diagnoses"], o["ICD10Codes"])),
        "dim_diagnoses_snowflake": _oltp(
            lambda o: B.dim_diagnoses_snowflake(
                o["Diagnoses"], B.dim_icd10_codes(o["Diagnoses"], o["ICD10Codes"])
            )
        ),
        "stable_keys": _second_load,
    }
    for dim in ("Patients", "Doctors", "Diagnoses"):
        q[f"snowflake_to_star_{dim.lower()}"] = (
            lambda spark, sf_dir, dim=dim: B.snowflake_to_star(proxy.snowflake(spark, sf_dir)).table(
                f"Dim_{dim}"
            )
        )
    return q


# ---------------------------------------------------------------------------
# D: quality rules on the proxy tables
# ---------------------------------------------------------------------------
def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return proxy.read_table(spark, sf_dir, name)


def quality_checks(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    orders, lineitem = _t(spark, sf_dir, "orders"), _t(spark, sf_dir, "lineitem")
    lo = lineitem.join(orders, lineitem.l_orderkey == orders.o_orderkey)
    return {
        "unique_order_key": Q.check_unique(orders, ["o_orderkey"]),
        "unique_line_key": Q.check_unique(lineitem, ["l_orderkey", "l_linenumber"]),
        "fk_line_order": Q.check_foreign_key(lineitem, ["l_orderkey"], orders, ["o_orderkey"]),
        "fk_order_line": Q.check_foreign_key(orders, ["o_orderkey"], lineitem, ["l_orderkey"]),
        "temporal_ship_after_order": Q.check_temporal(
            lo.select("l_orderkey", "l_linenumber", "o_orderdate", "l_shipdate"), "o_orderdate", "l_shipdate"
        ),
        "domain_order_status": Q.check_domain(orders, "o_orderstatus", ["F", "O"]),
        "max_three_lines": Q.check_max_children(lineitem, "l_orderkey", 3),
        "lines_only_when_completed": Q.check_children_only_when(
            orders, "o_orderkey", F.col("o_orderstatus") == "P", lineitem, "l_orderkey"
        ),
    }


def quality_queries() -> dict[str, Query]:
    def pick(rule: str) -> Query:
        return lambda spark, sf_dir: quality_checks(spark, sf_dir)[rule]

    return {
        "check_unique": pick("unique_line_key"),
        "check_unique_clean": pick("unique_order_key"),
        "check_foreign_key": pick("fk_line_order"),
        "check_foreign_key_reverse": pick("fk_order_line"),
        "check_temporal": pick("temporal_ship_after_order"),
        "check_domain": pick("domain_order_status"),
        "check_business": pick("max_three_lines"),
        "check_business_status": pick("lines_only_when_completed"),
        "quality_report": lambda spark, sf_dir: Q.quality_report(quality_checks(spark, sf_dir)),
        "model_report": lambda spark, sf_dir: Q.model_report(proxy.clinic_tables(spark, sf_dir)),
    }


# ---------------------------------------------------------------------------
# E: seeded derivation steps on the proxy tables
# ---------------------------------------------------------------------------
#: Shares finer than a percent.
FINE_WEIGHTS = (("Rare", 0.004), ("Some", 0.125), ("Most", 0.871))


def derive_queries() -> dict[str, Query]:
    def orders(spark, sf_dir):
        return _t(spark, sf_dir, "orders")

    def shares(spark, sf_dir):
        # one item for every order, apportioned by each priority's share of them
        per = orders(spark, sf_dir).groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
        per = per.withColumn("Total", F.sum("n").over(Window.partitionBy()))
        per = per.withColumn("Share", F.col("n").cast("double") / F.col("Total").cast("double"))
        return E.apportion(per, F.col("Total"), "o_orderpriority", "Share").select("o_orderpriority", "ItemIndex")

    def shared_items(spark, sf_dir):
        # many suppliers draw from the same parts, none to three each
        lines = _t(spark, sf_dir, "lineitem").select("l_suppkey", "l_partkey").distinct()
        return E.sample_k_per_key(lines, "l_suppkey", "l_partkey", F.pmod("l_suppkey", F.lit(4)), "allergy")

    def clamp(spark, sf_dir):
        lo = _t(spark, sf_dir, "lineitem").join(
            orders(spark, sf_dir), F.col("l_orderkey") == F.col("o_orderkey")
        )
        out = E.clamp_range(
            lo,
            [F.date_add(F.to_date("o_orderdate"), 30), F.to_date("l_shipdate")],
            F.date_add(F.to_date("o_orderdate"), 120),
        )
        return out.select("l_orderkey", "l_linenumber", "RangeStart")

    return {
        "weighted_bucket": lambda s, d: orders(s, d).select(
            "o_orderkey", E.weighted_bucket("o_orderkey", E.STATUS_WEIGHTS, "status").alias("DrawnStatus")
        ),
        "sample_k_per_key": lambda s, d: E.sample_k_per_key(
            orders(s, d).select("o_custkey", "o_orderkey"), "o_custkey", "o_orderkey", 2, "sample"
        ),
        "weighted_bucket_fine": lambda s, d: orders(s, d).select(
            "o_orderkey", E.weighted_bucket("o_orderkey", FINE_WEIGHTS, "fine").alias("Drawn")
        ),
        "sample_k_per_key_column": shared_items,
        "fan_out": lambda s, d: E.fan_out(
            orders(s, d).select("o_orderkey"), F.pmod("o_orderkey", F.lit(4))
        ),
        "assign_foreign_key": lambda s, d: E.assign_foreign_key(
            orders(s, d).select("o_orderkey"), "o_orderkey",
            _t(s, d, "supplier").select("s_suppkey"), "s_suppkey", "AssignedDoctorID", "doctor",
        ),
        "null_out_fraction": lambda s, d: orders(s, d).select(
            "o_orderkey", E.null_out_fraction("o_orderpriority", 0.3, "o_orderkey", "notes").alias("Notes")
        ),
        "null_out_fraction_fine": lambda s, d: orders(s, d).select(
            "o_orderkey", E.null_out_fraction("o_orderpriority", 0.004, "o_orderkey", "fine").alias("Notes")
        ),
        "lookup_default": lambda s, d: E.lookup_default(
            _t(s, d, "customer").select("c_custkey", "c_nationkey"), "c_nationkey",
            _t(s, d, "nation"), "Unknown", "NationName", "n_nationkey", "n_name",
        ).select("c_custkey", "NationName"),
        "status_lookup": lambda s, d: E.lookup_default(
            orders(s, d).select("o_orderkey", "o_orderstatus"), "o_orderstatus",
            proxy.STATUS_MAP, "Unknown", "Status",
        ).select("o_orderkey", "Status"),
        "capitalize_names": lambda s, d: _t(s, d, "part").select(
            "p_partkey", E.capitalize("p_name").alias("MedicationName")
        ),
        "format_code": lambda s, d: _t(s, d, "supplier").select(
            "s_suppkey", E.format_code("MD%06d", "s_suppkey").alias("License")
        ),
        "apportion": shares,
        "clamp_range": clamp,
        "derive_period": lambda s, d: E.derive_period(
            orders(s, d).select("o_orderkey", "o_orderdate"), "o_orderdate", "o_orderkey", seed="period"
        ).select("o_orderkey", "StartDate", "EndDate"),
    }


# ---------------------------------------------------------------------------
# P: the generic operators on their own, over `events` by day
# ---------------------------------------------------------------------------
def generic_queries() -> dict[str, Query]:
    def daily(spark, sf_dir):
        ev = _t(spark, sf_dir, "events")
        return ev.groupBy("event_type", F.to_date("ts").alias("EventDay")).agg(
            F.count(F.lit(1)).alias("EventCount")
        )

    def per_minute(spark, sf_dir):
        ev = _t(spark, sf_dir, "events")
        return ev.groupBy("event_type", F.date_format("ts", "yyyy-MM-dd HH:mm").alias("EventMinute")).agg(
            F.count(F.lit(1)).alias("EventCount")
        )

    def spent(spark, sf_dir):
        ev = _t(spark, sf_dir, "events")
        return ev.groupBy(F.to_date("ts").alias("EventDay"), "user_id").agg(
            F.sum(F.col("value").cast("decimal(12,2)")).alias("Spent")
        )

    def per_user(spark, sf_dir):
        ev = _t(spark, sf_dir, "events")
        return G.conditional_counts(
            ev, ["user_id"],
            {"Clicks": F.col("event_type") == "click", "Errors": F.col("event_type") == "error"},
            total_col="Events",
        )

    return {
        "period_change": lambda s, d: G.period_change(
            daily(s, d), ["event_type"], "EventDay", "EventCount", "PreviousCount", "ChangePercentage"
        ),
        "rank_in_period": lambda s, d: G.rank_in_period(daily(s, d), "EventDay", "EventCount", "RankInDay"),
        "share_of_total": lambda s, d: G.share_of_total(
            daily(s, d), "EventCount", ["EventDay"], "DayTotal", "SharePercentage"
        ),
        "rolling_rate": lambda s, d: G.rolling_rate(
            _t(s, d, "events"), F.date_format("ts", "yyyy-MM-dd"), "EventDay",
            F.col("event_type") == "error", "ErrorRate", "RollingErrorRate", n=3,
        ),
        # short periods, long spans, measures that are no counts: by ranges
        "period_change_minute": lambda s, d: G.period_change(
            per_minute(s, d), ["event_type"], "EventMinute", "EventCount", "PreviousCount", "ChangePercentage", spread=True
        ),
        "rank_in_period_value": lambda s, d: G.rank_in_period(
            _t(s, d, "orders").select("o_orderkey", F.year("o_orderdate").alias("OrderYear"), "o_totalprice"),
            "OrderYear", "o_totalprice", "RankInYear",
        ),
        "rank_in_period_decimal": lambda s, d: G.rank_in_period(spent(s, d), "EventDay", "Spent", "RankInDay").select(
            "EventDay", "user_id", F.col("Spent").cast("double").alias("Spent"), "RankInDay"
        ),
        "rolling_rate_minute": lambda s, d: G.rolling_rate(
            _t(s, d, "events"), F.date_format("ts", "yyyy-MM-dd HH:mm"), "EventMinute",
            F.col("event_type") == "error", "ErrorRate", "RollingErrorRate", n=60, many_periods=True,
        ),
        "rolling_rate_minute_calendar": lambda s, d: G.rolling_rate(
            _t(s, d, "events"), F.date_format("ts", "yyyy-MM-dd HH:mm"), "EventMinute",
            F.col("event_type") == "error", "ErrorRate", "RollingErrorRate", n=60, many_periods=True,
            calendar_index=F.unix_date(F.to_date("ts")).cast("long") * 1440 + F.hour("ts") * 60 + F.minute("ts"),
        ),
        "conditional_counts": per_user,
        "tiered_label": lambda s, d: per_user(s, d).select(
            "user_id", "Events", "Errors",
            G.tiered_label(
                [(F.col("Errors") >= 20, "High"), (F.col("Events") >= 100, "Medium")], "Low"
            ).alias("Tier"),
        ),
    }


# ---------------------------------------------------------------------------
# single primitives worth their own key
# ---------------------------------------------------------------------------
def primitive_queries() -> dict[str, Query]:
    def boundary(inclusive: bool) -> Query:
        def run(spark, sf_dir):
            ev = _t(spark, sf_dir, "events")
            cond = ts_range("ts", dt.date(2024, 1, 1), dt.date(2024, 1, 2), end_inclusive_day=inclusive)
            return ev.where(cond).select("event_id", "ts")

        return run

    def roundtrip(spark, sf_dir):
        o = proxy.oltp_tables(spark, sf_dir)
        dim = B.dim_patients_star(o["Patients"], o["PatientContactInfo"])
        return csv_roundtrip(dim, "Dim_Patients")

    def symptom_counts(spark, sf_dir):
        part = _t(spark, sf_dir, "part")
        words = part.select(F.explode(F.split("p_name", " ")).alias("Symptom"))
        return words.groupBy("Symptom").agg(F.count(F.lit(1)).alias("Visits"))

    return {
        "between_date_boundary": boundary(False),
        "between_date_boundary_inclusive": boundary(True),
        "csv_roundtrip": roundtrip,
        "symptom_counts": symptom_counts,
    }


# ---------------------------------------------------------------------------
# SQL surface: the procedures as SQL table functions, the views as temp views
# ---------------------------------------------------------------------------
def sql_queries() -> dict[str, Query]:
    rng = f"DATE'{oracle.START}', DATE'{oracle.END}'"

    def via_sql(kind: str, text: str) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            register_sql(spark, proxy.model(spark, sf_dir, kind))
            return spark.sql(text)

        return run

    return {
        "sql_trending_diagnoses": via_sql("star", f"SELECT * FROM GetTrendingDiagnoses({rng})"),
        "sql_trending_diagnoses_snowflake": via_sql("snowflake", f"SELECT * FROM GetTrendingDiagnoses({rng})"),
        "sql_medication_trends": via_sql("star", f"SELECT * FROM GetMedicationPrescriptionTrends({rng})"),
        "sql_symptom_diagnosis": via_sql("star", f"SELECT * FROM GetSymptomDiagnosisCorrelation({rng})"),
        "sql_rolling_cancellations": via_sql("star", f"SELECT * FROM GetRollingAvgCancellations({rng})"),
        "sql_top_doctors": via_sql("star", f"SELECT * FROM GetTopDoctorsByGrowthRate({rng}, {TOP_N})"),
        "sql_medication_trends_snowflake": via_sql("snowflake", f"SELECT * FROM GetMedicationPrescriptionTrends({rng})"),
        "sql_symptom_diagnosis_snowflake": via_sql("snowflake", f"SELECT * FROM GetSymptomDiagnosisCorrelation({rng})"),
        "sql_rolling_cancellations_snowflake": via_sql("snowflake", f"SELECT * FROM GetRollingAvgCancellations({rng})"),
        "sql_top_doctors_snowflake": via_sql("snowflake", f"SELECT * FROM GetTopDoctorsByGrowthRate({rng}, {TOP_N})"),
        "sql_top_doctors_all": via_sql("star", f"SELECT * FROM GetTopDoctorsByGrowthRate({rng}, {MANY})"),
        "sql_trending_diagnoses_top": _parameterized_top_diagnoses,
        "sql_appointment_summary": via_sql("star", "SELECT * FROM AppointmentSummary"),
        "sql_diagnosis_treatment_summary": via_sql("snowflake", "SELECT * FROM DiagnosisTreatmentSummary"),
    }


def _parameterized_top_diagnoses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Named parameter markers, including ``LIMIT :n`` (a bound parameter is
    foldable, so the top-n plan is TakeOrderedAndProject)."""
    register_sql(spark, proxy.star(spark, sf_dir))
    return spark.sql(
        "SELECT * FROM GetTrendingDiagnoses(:start_date, :end_date) "
        "ORDER BY YoYChangePercentage DESC, DiagnosisName, ICD10Code, DiagnosisYear LIMIT :n",
        args={"start_date": START, "end_date": END, "n": TOP_N},
    )


def queries() -> dict[str, Query]:
    q: dict[str, Query] = {}
    for group in (analytic_queries, builder_queries, quality_queries, derive_queries,
                  generic_queries, primitive_queries, sql_queries):
        q.update(group())
    return q


def oracle_sql() -> dict[str, str]:
    return oracle.all_sql()
