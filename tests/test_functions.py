"""Unit tests of the helpers: exact rounding, dense keys, skew-safe joins,
fan-out, quality checks, CSV round trip, materialized layout."""

from __future__ import annotations

import datetime as dt
from decimal import ROUND_HALF_UP, Decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from clinistar.functions.joins import full_outer_join, left_outer_join, left_outer_joins
from clinistar.functions.keys import KeyMap, dense_keys
from clinistar.functions.scalar import pct_round2
from clinistar.operators import derive as E
from clinistar.operators import quality as Q
from clinistar.plans import builders as B
from clinistar.sources import files, proxy
from conftest import SF0001


def _reference_round(num: int, den: int) -> float:
    """MySQL: num*100.0/den exact to 5 places (half up), then ROUND(.., 2)."""
    q5 = (Decimal(num) * 100 / Decimal(den)).quantize(Decimal("0.00001"), rounding=ROUND_HALF_UP)
    return float(q5.quantize(Decimal("0.01"), rounding=ROUND_HALF_UP))


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(-10**9, 10**9), st.integers(1, 10**7)), min_size=1, max_size=300))
def test_pct_round2_matches_exact_decimal(spark, pairs):
    pairs = pairs + [(1, 8), (-1, 8), (5, 3), (2, 3), (123456, 4000), (1, 1)]
    df = spark.createDataFrame(pairs, "n long, d long")
    got = [r.p for r in df.select(pct_round2("n", "d").alias("p")).collect()]
    assert got == [_reference_round(n, d) for n, d in pairs]


def test_pct_round2_zero_denominator_is_null(spark):
    df = spark.createDataFrame([(5, 0)], "n long, d long")
    assert df.select(pct_round2("n", "d").alias("p")).first().p is None


def test_dense_keys_equal_dense_rank(spark):
    words = ["pear", "apple", "fig", "apple", None, "kiwi", "banana", "fig", "zucchini", "date"] * 7
    df = spark.createDataFrame([(w,) for w in words], "v string")
    got = {r.v: r.k for r in dense_keys(df, "v", "k", ranges=3).collect()}
    expected = {w: i + 1 for i, w in enumerate(sorted({w for w in words if w is not None}))}
    assert got == expected


def test_skew_safe_outer_joins_equal_native(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n"), (3, "c")], "k long, lv string")
    right = spark.createDataFrame([(1, "x"), (1, "y"), (4, "z"), (None, "q")], "k long, rv string")

    def bag(df):
        return sorted((tuple(r) for r in df.collect()), key=repr)

    assert bag(left_outer_join(left, right, ["k"])) == bag(
        left.join(right, "k", "left").select("k", "lv", "rv"))
    assert bag(full_outer_join(left, right, ["k"])) == bag(
        left.join(right, "k", "full").select("k", "lv", "rv"))


def test_joins_with_two_children_equal_native(spark):
    parent = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n"), (3, "c"), (3, "d"), (5, None)], "k long, pv string")
    one = spark.createDataFrame([(1, "x"), (1, "y"), (4, "z"), (None, "q"), (3, None)], "k long, ov string")
    two = spark.createDataFrame([(2, 1), (1, 2), (1, 3), (None, 4), (9, 5)], "k long, tv int")
    bag = lambda df: sorted((tuple(r) for r in df.collect()), key=repr)
    got = left_outer_joins(parent, [one, two], ["k"])
    assert got.columns == ["k", "pv", "ov", "tv"]
    assert bag(got) == bag(parent.join(one, "k", "left").join(two, "k", "left"))
    assert bag(left_outer_joins(parent, [one.limit(0), two], ["k"])) == bag(parent.join(one.limit(0), "k", "left").join(two, "k", "left"))
    assert left_outer_joins(parent.limit(0), [one, two], ["k"]).count() == 0
    wide = parent.withColumn("j", F.col("k") % 2)
    right = one.withColumn("j", F.lit(1).cast("long"))
    assert bag(left_outer_join(wide, right, ["k", "j"])) == bag(wide.join(right, ["k", "j"], "left").select("k", "j", "pv", "ov"))


def scans(df, table):
    """How often a plan reads a table, reused shuffles counted once."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    return plan.count(f"/{table}.parquet")


def test_fact_reads_each_table_twice_at_most(spark):
    fact = B.fact_from_oltp(proxy.oltp_tables(spark, SF0001))
    assert scans(fact, "orders") <= 2
    assert scans(fact, "lineitem") <= 4  # records and prescriptions


def test_dense_keys_over_many_ranges(spark):
    df = spark.range(5000).select(F.md5((F.col("id") % 3000).cast("string")).alias("v"))
    got = [tuple(r) for r in dense_keys(df, "v", "k", ranges=64).collect()]
    assert sorted(got) == [(v, i + 1) for i, v in enumerate(sorted({r.v for r in df.collect()}))]
    assert dense_keys(df.limit(0), "v", "k").count() == 0


def jobs_while(spark, group, build):
    """Spark jobs that ``build`` starts."""
    sc = spark.sparkContext
    sc.setJobGroup(group, group)
    try:
        build()
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    return len(sc.statusTracker().getJobIdsForGroup(group))


def test_no_job_runs_while_keys_are_planned(spark):
    parts = spark.read.parquet(f"{SF0001}/part.parquet")
    children = spark.read.parquet(f"{SF0001}/orders.parquet")

    def plan():
        dense_keys(parts, "p_brand", "k")
        E.assign_foreign_key(children, "o_orderkey", parts, "p_partkey", "out")

    assert jobs_while(spark, "planning-keys", plan) == 0
    assert jobs_while(spark, "using-keys", lambda: dense_keys(parts, "p_brand", "k").collect()) > 0
    assert E.assign_foreign_key(children, "o_orderkey", parts.limit(0), "p_partkey", "out").where("out is not null").count() == 0


def test_key_map_keeps_keys_across_loads(spark, tmp_path):
    codes = KeyMap(spark, f"{tmp_path}/codes", "v", "k")
    frame = lambda *values: spark.createDataFrame([(v,) for v in values], "v string")
    rows = lambda df: {r.v: r.k for r in df.collect()}
    assert codes.table() is None
    assert rows(codes.update(frame("pear", "fig", None, "fig"))) == {"fig": 1, "pear": 2}
    assert rows(codes.update(frame("apple", "pear", "zucchini", "apple"))) == {"fig": 1, "pear": 2, "apple": 3, "zucchini": 4}
    assert rows(codes.update(frame("pear"))) == rows(codes.table())  # nothing new
    failed = tmp_path / "codes" / "load-000000004"  # a load that didn't end has no _SUCCESS
    failed.mkdir()
    frame("ghost").select("v", F.lit(99).cast("long").alias("k")).write.parquet(str(failed / "x"))
    assert rows(codes.update(frame("quince"))) == {"fig": 1, "pear": 2, "apple": 3, "zucchini": 4, "quince": 5}
    assert rows(codes.update(frame())) == rows(codes.table())


def test_snowflake_keys_are_kept_across_loads(spark, make_oltp, tmp_path):
    first = B.build_snowflake(make_oltp(), key_maps=f"{tmp_path}/keys")
    was = {r.Specialty: r.SpecialtyID for r in first.table("Dim_DepartmentSpecialty").collect()}
    again = B.build_snowflake(make_oltp(DepartmentSpecialty=[(1, "Acupuncture"), (2, "Cancer Treatment")]), key_maps=f"{tmp_path}/keys")
    now = {r.Specialty: r.SpecialtyID for r in again.table("Dim_DepartmentSpecialty").collect()}
    assert was == {"Cancer Treatment": 1, "Cardiac Care": 2} and now == was | {"Acupuncture": 3}
    assert {r.DepartmentID: r.SpecialtyID for r in again.table("Dim_Departments").collect()} == {1: 3, 2: 1}


def test_fan_out_guards_zero_and_null(spark):
    df = spark.createDataFrame([(1, 3), (2, 0), (3, None), (4, -2)], "id long, n long")
    out = E.fan_out(df, "n").collect()
    assert sorted((r.id, r.ChildIndex) for r in out) == [(1, 1), (1, 2), (1, 3)]


def test_weighted_bucket_shares(spark):
    df = spark.range(20000).select(E.weighted_bucket("id", E.STATUS_WEIGHTS, "s").alias("c"))
    counts = {r.c: r["count"] for r in df.groupBy("c").count().collect()}
    assert abs(counts["Completed"] / 20000 - 0.8) < 0.02
    assert abs(counts["Cancelled"] / 20000 - 0.1) < 0.02
    sev = spark.range(20000).select(E.weighted_bucket("id", E.SEVERITY_WEIGHTS, "sev").alias("c"))
    shares = {r.c: r["count"] / 20000 for r in sev.groupBy("c").count().collect()}
    assert all(abs(shares[label] - w) < 0.02 for label, w in E.SEVERITY_WEIGHTS)


def test_quality_checks_on_fixture(spark, make_oltp):
    clean = make_oltp()
    assert Q.check_unique(clean["Patients"], ["SSN"]).count() == 0
    assert Q.check_foreign_key(clean["Doctors"], ["DepartmentID"], clean["Departments"], ["DepartmentID"]).count() == 0
    bad_docs = spark.createDataFrame([(9, "A", "B", "MD000009", None, 77)], clean["Doctors"].schema)
    assert Q.check_foreign_key(bad_docs, ["DepartmentID"], clean["Departments"], ["DepartmentID"]).count() == 1
    ins = clean["Insurance"]
    assert Q.check_temporal(ins, "EffectiveDate", "ExpiryDate", min_days=0, strict=True).count() == 0
    assert Q.check_domain(clean["Patients"], "Gender", ["Male", "Female", "Other"]).count() == 0
    rx = spark.createDataFrame(
        [(i, 1, 1, "1mg", "QD", dt.date(2021, 1, 1), dt.date(2021, 1, 5)) for i in range(4)],
        clean["Prescriptions"].schema)
    assert Q.check_max_children(rx, "AppointmentID", 3).count() == 1
    assert Q.check_temporal(rx, "StartDate", "EndDate", min_days=7, max_days=30).count() == 4
    report = {r.rule: r.violations for r in Q.quality_report({"a": rx, "b": rx.limit(0)}).collect()}
    assert report == {"a": 4, "b": 0}


def test_csv_roundtrip_keeps_leading_zeros(spark, make_oltp):
    contacts = make_oltp()["PatientContactInfo"]
    back = files.csv_roundtrip(contacts, "contacts")
    assert sorted(r.ZipCode for r in back.collect()) == ["02131", "02132", "02133", "02134"]


def test_materialized_fact_prunes_year_partitions(spark, tmp_path):
    wh = proxy.star(spark, SF0001)
    mat = B.materialize(wh, str(tmp_path / "wh"))
    assert mat.fact().count() == wh.fact().count()
    q = mat.fact_in_range(dt.date(1997, 1, 1), dt.date(1997, 12, 31))
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(AppointmentYear" in plan
    assert q.count() == wh.fact_in_range(dt.date(1997, 1, 1), dt.date(1997, 12, 31)).count()


def test_write_treatment_priority_new_version(spark, tmp_path):
    import pytest

    from clinistar.operators import analytics as A

    wh = B.materialize(proxy.star(spark, SF0001), str(tmp_path / "v1"))
    with pytest.raises(ValueError):
        A.write_treatment_priority(wh, str(tmp_path / "v1" / "Fact_PatientInteractions"))
    path = A.write_treatment_priority(wh, str(tmp_path / "v2"))
    back = spark.read.parquet(path)
    assert back.count() == wh.fact().count()
    assert "TreatmentPriority" in back.columns


def test_oltp_csv_files_to_star_end_to_end(spark, make_oltp, tmp_path):
    """OLTP tables as headered CSV files -> declared-schema read -> star -> Q1."""
    from clinistar.operators import analytics as A
    from conftest import visits

    vis = [(i, 1, 1, "2020-03-01 10:00:00", "Completed", "Fever", 1) for i in range(1, 3)] + \
          [(i, 1, 1, "2021-03-01 10:00:00", "Completed", "Fever", 1) for i in range(10, 13)]
    appts, recs = visits(vis)
    files.write_oltp(make_oltp(Appointments=appts, MedicalRecords=recs), str(tmp_path / "oltp"))
    oltp = files.read_oltp(spark, str(tmp_path / "oltp"))
    assert oltp["PatientContactInfo"].schema["ZipCode"].dataType.simpleString() == "string"
    out = A.trending_diagnoses(B.build_star(oltp), dt.date(2020, 1, 1), dt.date(2021, 12, 31)).collect()
    assert [(r.DiagnosisYear, r.DiagnosisCount, r.PreviousYearCount, r.YoYChangePercentage) for r in out] == [
        (2021, 3, 2, 50.0)
    ]


def test_priority_table_joined_back_equals_rewrite(spark, tmp_path):
    from clinistar.operators import analytics as A

    wh = proxy.star(spark, SF0001)
    path = A.write_priority_table(wh, str(tmp_path / "prio"))
    prio = spark.read.parquet(path)
    joined = wh.fact().join(prio, ["PatientID", "DiagnosisID"], "left").select(
        "AppointmentID", "PatientID", "DiagnosisID", "MedicationID", "TreatmentPriority")
    direct = A.treatment_priority(wh).select(
        "AppointmentID", "PatientID", "DiagnosisID", "MedicationID", "TreatmentPriority")
    assert sorted(map(tuple, joined.collect()), key=repr) == sorted(map(tuple, direct.collect()), key=repr)


def test_capitalize_is_python_capitalize(spark):
    words = ["small ring", "BLUE bolt", "x", "", "éclair pie"]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    assert [r.c for r in df.select(E.capitalize("w").alias("c")).collect()] == [w.capitalize() for w in words]


def test_hot_key_on_detail_side_is_split(spark):
    """A key holding most detail rows: AQE splits it in the inner part of our
    left join (it cannot split the non-preserved side of a native LEFT JOIN)."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB",
    }
    saved = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        appts = spark.range(1, 2001).select(F.col("id").alias("AppointmentID"))
        hot = spark.range(0, 60000).select(F.lit(1).cast("long").alias("AppointmentID"), F.col("id").alias("m"))
        rest = spark.range(2, 1500).select(F.col("id").alias("AppointmentID"), F.col("id").alias("m"))
        details = hot.unionByName(rest)
        ours = left_outer_join(appts, details, ["AppointmentID"])
        got = ours.groupBy("AppointmentID").count().collect()
        native = appts.join(details, "AppointmentID", "left").groupBy("AppointmentID").count().collect()
        assert sorted(map(tuple, got)) == sorted(map(tuple, native))
        ours.collect()
        assert "SortMergeJoin(skew=true)" in ours._jdf.queryExecution().executedPlan().toString()
        # two children of one parent, each hot on a key of its own
        other = spark.range(0, 60000).select(F.lit(7).cast("long").alias("AppointmentID"), F.col("id").alias("x"))
        other = other.unionByName(spark.range(900, 2500).select(F.col("id").alias("AppointmentID"), F.col("id").alias("x")))
        both = left_outer_joins(appts, [details, other], ["AppointmentID"])
        native = appts.join(details, "AppointmentID", "left").join(other, "AppointmentID", "left")
        count = lambda df: sorted(map(tuple, df.groupBy("AppointmentID").agg(F.count(F.lit(1)), F.sum("m"), F.sum("x")).collect()), key=repr)
        assert count(both) == count(native)
        spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        both.collect()
        assert both._jdf.queryExecution().executedPlan().toString().count("SortMergeJoin(skew=true)") == 2
    finally:
        spark.conf.unset("spark.sql.adaptive.forceOptimizeSkewedJoin")
        for k, v in saved.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_model_rule_set_clean_and_violations(spark, make_oltp):
    from conftest import ts

    appts = [(1, 1, 1, ts("2021-01-01 09:00:00"), "Completed"), (2, 2, 2, ts("2021-02-01 09:00:00"), "Completed")]
    recs = [(1, 1, "Fever", 1, "Rest"), (2, 2, "Cough", 3, "Rest")]
    rx = [(1, 1, 1, "5mg", "QD", dt.date(2021, 1, 1), dt.date(2021, 1, 10))]
    clean = make_oltp(Appointments=appts, MedicalRecords=recs, Prescriptions=rx)
    report = {r.rule: r.violations for r in Q.quality_report(Q.model_checks(clean)).collect()}
    assert len(report) == len(Q.UNIQUE_KEYS) + len(Q.RELATIONSHIPS) + len(Q.DOMAINS) + 9
    assert {k: v for k, v in report.items() if v} == {}
    assert {r.rule: r.violations for r in Q.model_report(clean).collect()} == report

    bad = make_oltp(
        Appointments=appts + [(3, 9, 1, ts("2021-03-01 09:00:00"), "Cancelled"),
                              (4, 1, 1, ts("2000-01-10 09:00:00"), "Missed")],
        MedicalRecords=recs + [(3, 3, "Rash", 1, "Rest"), (4, 3, "Rash", 1, "Rest")],
        Prescriptions=rx + [(i, 3, 2, "1mg", "QD", dt.date(2021, 3, 1), dt.date(2021, 3, 3)) for i in (2, 3, 4, 5)],
    )
    report = {r.rule: r.violations for r in Q.quality_report(Q.model_checks(bad)).collect()}
    assert {r.rule: r.violations for r in Q.model_report(bad).collect()} == report
    flagged = {k: v for k, v in report.items() if v}
    assert flagged == {
        "fk:Appointments.PatientID->Patients": 1,        # patient 9 does not exist
        "domain:Appointments.Status": 1,                 # 'Missed'
        "temporal:appointment_after_hire": 1,            # 2000-01-10 < hire 2000-01-01 + 30 d
        "temporal:prescription_length": 4,               # 2-day prescriptions
        "business:prescription_needs_completed": 4,      # appointment 3 was cancelled
        "business:max_prescriptions": 1,                 # 4 on appointment 3
        "business:one_record_per_appointment": 1,        # 2 records on appointment 3
        "business:appointment_has_record": 1,            # appointment 4 has none
    }


def test_rule_report_counts_what_the_checks_return(spark, make_oltp):
    """Nulls, repeated parents and several parents a child, rule by rule."""
    from conftest import ts

    day = dt.date(2015, 1, 1)
    odd = make_oltp(
        Appointments=[(1, 1, 1, ts("2000-01-05 09:00:00"), "Completed"), (1, 2, None, ts("2021-01-05 09:00:00"), None),
                      (2, 7, 9, None, "Scheduled"), (None, None, 3, ts("2021-01-05 09:00:00"), "Cancelled"), (3, 1, 1, ts("2000-01-06 09:00:00"), "Cancelled")],
        MedicalRecords=[(1, 1, None, 1, ""), (1, 1, None, 99, ""), (2, None, None, None, ""), (3, None, None, 1, "")],
        Prescriptions=[(k, 1 + k % 4, k % 5, "1mg", "QD" if k % 2 else None, day, day + dt.timedelta(days=k)) for k in range(30)] + [(40, None, None, "", "X", None, day)],
        Patients=[(1, "A", "B", dt.date(1996, 1, 1), "Male", "1"), (1, "A", "B", dt.date(2020, 1, 1), None, "1"), (2, "A", "B", None, "Else", None), (None, "A", "B", day, "Male", None)],
        PatientAllergies=[(1, 1, dt.date(2000, 1, 1)), (1, 1, dt.date(2016, 1, 1)), (2, 1, dt.date(2009, 1, 1)), (None, None, None), (8, 3, day)],
        Insurance=[(1, 1, "", "P", "", day, day), (1, None, "", "P", "", day, None), (2, 5, "", None, "", dt.date(2016, 1, 1), day)],
    )
    want = {name: df.count() for name, df in Q.model_checks(odd).items()}
    assert {r.rule: r.violations for r in Q.model_report(odd).collect()} == want
    assert sum(v > 0 for v in want.values()) > 20
    empty = {name: df.limit(0) for name, df in odd.items()}
    assert {r.rule: r.violations for r in Q.model_report(empty).collect()} == dict.fromkeys(want, 0)


def test_model_report_reads_each_table_once(spark):
    report = Q.model_report(proxy.clinic_tables(spark, SF0001))
    # orders: appointments; lineitem: records, prescriptions, allergies' bridge; part: diagnoses,
    # codes, medications, allergies; customer: patients, contacts, insurance; supplier: doctors
    for table, n in {"orders": 1, "lineitem": 3, "part": 4, "customer": 3, "supplier": 1, "nation": 3, "region": 1}.items():
        assert scans(report, table) <= n, table


def test_rule_report_keeps_key_types_and_gathers_no_days(spark):
    """Whole numbers are grouped as such, other keys as text, and no list of
    the days of a key is made."""
    tables = {
        "P": spark.createDataFrame([(1, "7", dt.date(2020, 1, 1)), (2, "8", None), (2, None, dt.date(2020, 1, 5)), (None, "5", None)], "id long, code string, since date"),
        "C": spark.createDataFrame([(1, 7, dt.date(2020, 1, 10)), (2, 9, dt.date(2020, 1, 14)), (2, 8, dt.date(2020, 1, 15)), (3, None, dt.date(1999, 1, 1)), (None, 7, None)] * 3, "pid int, code int, day date"),
    }
    parent, child, code, coded = Q.Role("P", ("id",)), Q.Role("C", ("pid",)), Q.Role("P", ("code",)), Q.Role("C", ("code",))
    rules = [
        Q.Unique("id", parent), Q.Unique("both", Q.Role("C", ("pid", "code"))), Q.References("fk", child, parent),
        Q.References("code", coded, code), Q.References("unused", code, coded), Q.AtMost("many", child, 5),
        Q.NotBefore("days", child, lambda: F.col("day"), parent, lambda: F.col("since"), 10),
        Q.OnlyWhen("only", child, parent, lambda: F.col("since").isNotNull()), Q.Row("row", "C", lambda: F.col("code").isNull()),
    ]
    report = Q.rule_report(tables, rules)
    want = {"id": 1, "both": 5, "fk": 3, "code": 3, "unused": 1, "many": 1, "days": 6, "only": 6, "row": 3}
    assert {r.rule: r.violations for r in report.collect()} == want == {r.name: r.violations(tables).count() for r in rules}
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert "ObjectHashAggregate" not in plan and "collect_list" not in plan and "array<string>" not in plan


def test_treatments_are_grouped_by_numbers_not_names(spark):
    """V2, also of distinct appointments, and the priorities: as by the names
    themselves, whatever shares a name, has none or comes twice; no text is
    grouped or moved with the facts."""
    import re

    from clinistar.operators import analytics as A
    from clinistar.plans.model import STAR_TABLES, Warehouse

    def bag(df):
        return sorted((tuple(r) for r in df.collect()), key=repr)

    facts = [(a, p, d, m) for a in [*range(12), None] for p in (1, 2, None) for d in (1, 2, 3, 4, 5, 9, None) for m in (1, 2, 3, 9, None) if ((a or 0) + 2 * (p or 0) + (d or 5) * (m or 1)) % 3]
    t = {
        "Fact_PatientInteractions": spark.createDataFrame(facts * 2, "AppointmentID long, PatientID long, DiagnosisID long, MedicationID long").withColumn("Status", F.lit("Cancelled")),
        "Dim_Diagnoses": spark.createDataFrame([(1, "a", "x"), (2, "a", "x"), (2, "a", "x"), (3, None, "x"), (4, "a", None), (5, None, "x"), (5, "b", "x"), (None, "b", "x")], "DiagnosisID long, DiagnosisName string, ICD10Code string"),
        "Dim_Medications": spark.createDataFrame([(1, "m", "k"), (2, "m", "l"), (3, None, "k"), (3, None, "k"), (None, "m", "k")], "MedicationID long, MedicationName string, Manufacturer string"),
        "Dim_Patients": spark.createDataFrame([(1, "A", "B"), (2, "A", "B"), (2, "A", "B")], "PatientID long, FirstName string, LastName string"),
    }
    wh = Warehouse("star", {name: t.get(name, t["Dim_Patients"]) for name in STAR_TABLES})
    keys = ["PatientID", "DiagnosisName", "ICD10Code", "MedicationName"]
    joined = wh.fact().join(wh.diagnoses(), "DiagnosisID").join(wh.medications(), "MedicationID")
    plain, apart = (joined.groupBy(*keys).agg(f("AppointmentID").alias("TreatmentCount")) for f in (F.count, F.countDistinct))
    apart = apart.where("TreatmentCount > 0")
    assert bag(A.diagnosis_treatment_summary(wh)) == bag(plain)
    assert bag(A.diagnosis_treatment_summary(wh, distinct_appointments=True)) == bag(apart)

    limits = {"high_appointments": 10**6, "medium_appointments": 10**6, "high_treatments": 60, "medium_treatments": 20}
    most = plain.groupBy(*keys[:3]).agg(F.max("TreatmentCount").alias("n"))
    pairs = wh.fact().select("PatientID", "DiagnosisID").distinct().join(wh.diagnoses(), "DiagnosisID")
    label = F.when(F.max("n") > 60, "High").when(F.max("n") >= 20, "Medium").otherwise("Low")
    want = pairs.join(most, keys[:3]).groupBy("PatientID", "DiagnosisID").agg(label)
    assert bag(A.priority_by_key(wh, **limits)) == bag(want) and len({r[2] for r in bag(want)}) > 1

    for frame in (A.diagnosis_treatment_summary(wh), A.diagnosis_treatment_summary(wh, distinct_appointments=True), A.priority_by_key(wh)):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert not re.search(r"(keys=\[|hashpartitioning\()PatientID#\d+L, DiagnosisName", plan)


def test_scale_conf_sizes_partitions_by_input():
    from clinistar.session import scale_conf

    tb100 = scale_conf(100 * 1024**4)
    assert tb100["spark.sql.shuffle.partitions"] == "819200"          # no cap: partitions keep their size
    assert int(scale_conf(1024**4)["spark.sql.shuffle.partitions"]) == 8192
    assert scale_conf(10 * 1024**2)["spark.sql.shuffle.partitions"] == "8"   # floor for tiny inputs
    assert tb100["spark.sql.autoBroadcastJoinThreshold"] == str(64 * 1024**2)


def test_jobs_build_run_priority(spark, make_oltp, tmp_path):
    from clinistar import jobs
    from conftest import visits

    vis = [(i, 1 + i % 3, 1 + i % 2, f"{2020 + i % 2}-03-01 10:00:00", "Completed", "Fever", 1 + (i % 4 >= 2))
           for i in range(1, 13)]
    appts, recs = visits(vis)
    rx = [(i, i, 1 + i % 3, "5mg", "QD", dt.date(2020, 3, 1), dt.date(2020, 3, 9)) for i in range(1, 13)]
    files.write_oltp(make_oltp(Appointments=appts, MedicalRecords=recs, Prescriptions=rx), str(tmp_path / "oltp"))
    jobs.main(["build", "--oltp", str(tmp_path / "oltp"), "--out", str(tmp_path / "wh"),
               "--model", "snowflake", "--quality-report", str(tmp_path / "qr")], spark=spark)
    report = {r.rule: r.violations for r in spark.read.parquet(str(tmp_path / "qr")).collect()}
    assert report["fk:Appointments.PatientID->Patients"] == 0
    jobs.main(["run", "--warehouse", str(tmp_path / "wh"), "--model", "snowflake",
               "--query", "GetTrendingDiagnoses", "--start", "2020-01-01", "--end", "2021-12-31",
               "--out", str(tmp_path / "q1")], spark=spark)
    assert spark.read.parquet(str(tmp_path / "q1")).count() == 2
    jobs.main(["priority", "--warehouse", str(tmp_path / "wh"), "--model", "snowflake",
               "--table", str(tmp_path / "prio")], spark=spark)
    assert spark.read.parquet(str(tmp_path / "prio")).count() > 0


def test_strict_period_change_needs_integer_period(spark):
    import pytest

    from clinistar.operators import generic as G

    df = spark.createDataFrame([("a", "2021-01", 3)], "k string, p string, n long")
    with pytest.raises(ValueError):
        G.period_change(df, ["k"], "p", "n", strict=True)
    yearly = spark.createDataFrame([("a", 2020, 4), ("a", 2021, 6), ("a", 2023, 3)], "k string, y int, n long")
    out = G.period_change(yearly, ["k"], "y", "n", "prev", "chg", strict=True).orderBy("y").collect()
    assert [(r.y, r.prev, r.chg) for r in out] == [(2020, None, None), (2021, 4, 50.0), (2023, None, None)]
