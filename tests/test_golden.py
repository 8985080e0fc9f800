"""Hand-written golden cases, one per semantic rule of the model (tiny inputs)."""

from __future__ import annotations

import datetime as dt

import pytest

from clinistar.operators import analytics as A
from clinistar.plans import builders as B
from conftest import ts, visits

Y = dt.date


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def _star(make_oltp, vis, prescriptions=(), **extra):
    appts, recs = visits(vis)
    return B.build_star(make_oltp(Appointments=appts, MedicalRecords=recs,
                                  Prescriptions=list(prescriptions), **extra))


def _repeat(start_id, n, patient, doctor, when, dx, status="Completed", symptoms="Fever"):
    return [(start_id + i, patient, doctor, when, status, symptoms, dx) for i in range(n)]


def test_year_gap_uses_previous_row_and_strict_drops_it(make_oltp):
    vis = _repeat(1, 4, 1, 1, "2020-03-01 10:00:00", 1) + _repeat(10, 6, 1, 1, "2022-03-01 10:00:00", 1)
    wh = _star(make_oltp, vis)
    out = A.trending_diagnoses(wh, Y(2019, 1, 1), Y(2023, 12, 31))
    assert rows(out, "DiagnosisYear", "DiagnosisCount", "PreviousYearCount", "YoYChangePercentage") == [
        (2022, 6, 4, 50.0)
    ]
    strict = A.trending_diagnoses(wh, Y(2019, 1, 1), Y(2023, 12, 31), strict_year=True)
    assert strict.count() == 0


def test_single_year_dropped_by_q1_q5_kept_by_q2(make_oltp):
    vis = _repeat(1, 3, 2, 3, "2021-05-05 09:00:00", 2)
    rx = [(i, i, 2, "10mg", "QD", Y(2021, 5, 5), Y(2021, 5, 20)) for i in range(1, 4)]
    wh = _star(make_oltp, vis, rx)
    assert A.trending_diagnoses(wh, Y(2020, 1, 1), Y(2022, 1, 1)).count() == 0
    assert A.top_doctors(wh, Y(2020, 1, 1), Y(2022, 1, 1), 5).count() == 0
    q2 = A.medication_trends(wh, Y(2020, 1, 1), Y(2022, 1, 1))
    assert rows(q2, "MedicationName", "PrescriptionCount", "RankInYear", "PreviousYearCount",
                "YoYChangePercentage") == [("Med2cin", 3, 1, None, None)]


def test_shared_name_keeps_previous_per_code(make_oltp):
    dx = [(5, "A00-B99", "Same"), (6, "C00-D49", "Same")]
    vis = (_repeat(1, 2, 1, 1, "2020-01-10 08:00:00", 5) + _repeat(10, 4, 1, 1, "2021-01-10 08:00:00", 5)
           + _repeat(20, 5, 2, 1, "2020-02-10 08:00:00", 6) + _repeat(30, 5, 2, 1, "2021-02-10 08:00:00", 6))
    wh = _star(make_oltp, vis, Diagnoses=dx)
    out = A.trending_diagnoses(wh, Y(2020, 1, 1), Y(2021, 12, 31))
    assert rows(out, "ICD10Code", "DiagnosisCount", "PreviousYearCount", "YoYChangePercentage") == [
        ("A00-B99", 4, 2, 100.0), ("C00-D49", 5, 5, 0.0)
    ]


def test_end_boundary_counts_only_midnight(make_oltp):
    vis = [(1, 1, 1, "2021-01-31 00:00:00", "Cancelled", "Fever", 1),
           (2, 1, 1, "2021-01-31 00:00:01", "Completed", "Fever", 1)]
    wh = _star(make_oltp, vis)
    assert wh.fact_in_range(Y(2021, 1, 1), Y(2021, 1, 31)).count() == 1
    assert wh.fact_in_range(Y(2021, 1, 1), Y(2021, 1, 31), end_inclusive_day=True).count() == 2


def test_open_bounds(make_oltp):
    vis = [(1, 1, 1, "2019-06-01 00:00:00", "Completed", "Fever", 1),
           (2, 1, 1, "2021-06-01 00:00:00", "Completed", "Fever", 1)]
    wh = _star(make_oltp, vis)
    assert wh.fact_in_range(None, Y(2020, 1, 1)).count() == 1
    assert wh.fact_in_range(Y(2020, 1, 1), None).count() == 1
    assert wh.fact_in_range(None, None).count() == 2


def test_missing_month_rolling_rows_vs_calendar(make_oltp):
    def month(start, n, cancelled, when):
        return [(start + i, 1, 1, when, "Cancelled" if i < cancelled else "Completed", "Fever", 1)
                for i in range(n)]

    vis = month(1, 10, 1, "2021-01-15 10:00:00") + month(100, 5, 1, "2021-02-15 10:00:00") \
        + month(200, 5, 3, "2021-04-15 10:00:00")
    wh = _star(make_oltp, vis)
    out = A.rolling_cancellations(wh, Y(2021, 1, 1), Y(2021, 12, 31))
    assert [tuple(r) for r in out.collect()] == [
        ("2021-01", 10.0, 10.0), ("2021-02", 20.0, 15.0), ("2021-04", 60.0, 30.0)
    ]
    cal = A.rolling_cancellations(wh, Y(2021, 1, 1), Y(2021, 12, 31), calendar=True)
    assert [r.RollingAvgCancellationRate for r in cal.collect()] == [10.0, 15.0, 40.0]


def test_rank_ties(make_oltp):
    vis, rx, i = [], [], 0
    for med, n in ((1, 5), (2, 5), (3, 3)):
        for _ in range(n):
            i += 1
            vis.append((i, 1, 1, "2021-06-01 10:00:00", "Completed", "Fever", 1))
            rx.append((i, i, med, "5mg", "QD", Y(2021, 6, 1), Y(2021, 6, 9)))
    wh = _star(make_oltp, vis, rx)
    out = A.medication_trends(wh, Y(2021, 1, 1), Y(2021, 12, 31))
    assert rows(out, "MedicationName", "RankInYear") == [("Med1cin", 1), ("Med2cin", 1), ("Med3cin", 3)]
    top1 = A.medication_trends(wh, Y(2021, 1, 1), Y(2021, 12, 31), top_k=1)
    assert top1.count() == 2


def test_top_k_keeps_change_against_previous_year(make_oltp):
    # Med1: 2020 rank 1 (3), 2021 rank 2 (2); Med2: 2020 rank 2 (1), 2021 rank 1 (4)
    vis, rx, i = [], [], 0
    for med, year, n in ((1, 2020, 3), (2, 2020, 1), (1, 2021, 2), (2, 2021, 4)):
        for _ in range(n):
            i += 1
            vis.append((i, 1, 1, f"{year}-06-01 10:00:00", "Completed", "Fever", 1))
            rx.append((i, i, med, "5mg", "QD", Y(year, 6, 1), Y(year, 6, 9)))
    wh = _star(make_oltp, vis, rx)
    top1 = A.medication_trends(wh, Y(2020, 1, 1), Y(2021, 12, 31), top_k=1)
    assert rows(top1, "MedicationName", "PrescriptionYear", "RankInYear", "PreviousYearCount",
                "YoYChangePercentage") == [("Med1cin", 2020, 1, None, None), ("Med2cin", 2021, 1, 1, 300.0)]


def test_null_and_reordered_symptoms(make_oltp):
    vis = [(1, 1, 1, "2021-03-01 10:00:00", "Completed", "Fever, Cough", 1),
           (2, 1, 1, "2021-03-02 10:00:00", "Completed", "Cough, Fever", 1),
           (3, 1, 1, "2021-03-03 10:00:00", "Completed", None, 1)]
    wh = _star(make_oltp, vis)
    args = (wh, Y(2021, 1, 1), Y(2021, 12, 31))
    raw = A.symptom_diagnosis(*args)
    assert rows(raw, "Symptoms", "PairCount", "PercentageOfMonth") == [
        ("Cough, Fever", 1, 50.0), ("Fever, Cough", 1, 50.0)
    ]
    st = A.symptom_diagnosis(*args, symptom_mode="set")
    assert rows(st, "Symptoms", "PairCount", "TotalPairCount") == [("Cough, Fever", 2, 2)]
    ex = A.symptom_diagnosis(*args, symptom_mode="exploded")
    assert rows(ex, "Symptoms", "PairCount") == [("Cough", 2), ("Fever", 2)]


def test_fact_grain_and_distinct_option(make_oltp):
    appts = [(1, 1, 1, ts("2021-01-01 09:00:00"), "Completed"),
             (2, 2, 1, ts("2021-01-02 09:00:00"), "Completed"),
             (3, 3, 1, ts("2021-01-03 09:00:00"), "Scheduled")]
    recs = [(1, 1, "Fever", 1, "Rest"), (2, 1, "Cough", 2, "Rest")]
    rx = [(i, 1, i, "1mg", "QD", Y(2021, 1, 1), Y(2021, 1, 9)) for i in (1, 2, 3)] + \
         [(4, 2, 1, "1mg", "QD", Y(2021, 1, 2), Y(2021, 1, 9)), (5, 2, 2, "1mg", "QD", Y(2021, 1, 2), Y(2021, 1, 9))]
    wh = B.build_star(make_oltp(Appointments=appts, MedicalRecords=recs, Prescriptions=rx))
    fact = wh.fact()
    # 2 records x 3 prescriptions; 0 records x 2 prescriptions; nothing -> 1 row
    assert rows(fact.groupBy("AppointmentID").count(), "AppointmentID", "count") == [(1, 6), (2, 2), (3, 1)]
    v1 = A.appointment_summary(wh)
    assert rows(v1, "PatientID", "TotalAppointments") == [(1, 6), (2, 2), (3, 1)]
    v1d = A.appointment_summary(wh, distinct_appointments=True)
    assert rows(v1d, "PatientID", "TotalAppointments") == [(1, 1), (2, 1), (3, 1)]


def test_priority_many_medications_takes_highest(make_oltp):
    vis = _repeat(1, 5, 1, 1, "2021-02-01 10:00:00", 1)
    rx = [(1, 1, 1, "1mg", "QD", Y(2021, 2, 1), Y(2021, 2, 9))] + \
         [(i, i, 2, "1mg", "QD", Y(2021, 2, 1), Y(2021, 2, 9)) for i in range(2, 6)]
    # patient 2: a visit with no prescription -> not reached by the update
    vis += [(50, 2, 1, "2021-02-01 11:00:00", "Completed", "Rash", 3)]
    wh = _star(make_oltp, vis, rx)
    out = A.treatment_priority(wh)
    assert out.count() == 6
    assert rows(out, "PatientID", "TreatmentPriority") == [(1, "High")] * 5 + [(2, None)]
    low = A.treatment_priority(wh, unmatched="low")
    assert rows(low.where("PatientID = 2"), "TreatmentPriority") == [("Low",)]


def test_orphan_patient_dropped_by_summary(make_oltp):
    vis = [(1, 1, 1, "2021-01-01 10:00:00", "Cancelled", "Fever", 1),
           (2, 99, 1, "2021-01-01 11:00:00", "Completed", "Fever", 1)]
    wh = _star(make_oltp, vis)
    assert rows(A.appointment_summary(wh), "PatientID", "TotalAppointments", "CancelledAppointments") == [
        (1, 1, 1)
    ]


def test_top_n_tie_break(make_oltp):
    vis = []
    for doc, base in ((2, 100), (1, 200)):
        vis += _repeat(base, 1, 1, doc, "2020-01-01 10:00:00", 1)
        vis += _repeat(base + 10, 2, 1, doc, "2021-01-01 10:00:00", 1)
    wh = _star(make_oltp, vis)
    out = A.top_doctors(wh, Y(2020, 1, 1), Y(2021, 12, 31), 1)
    assert [(r.DoctorID, r.YoYGrowthPercentage) for r in out.collect()] == [(1, 100.0)]


def test_two_specialties_for_one_department_raise(make_oltp):
    oltp = make_oltp(DepartmentSpecialty=[(1, "Cardiac Care"), (1, "Vascular"), (2, "X")])
    # the check runs wherever the specialty is read (it is pruned with it otherwise)
    for df in (B.build_star(oltp).table("Dim_Doctors"), B.build_snowflake(oltp).doctors()):
        with pytest.raises(Exception, match="has several Specialty values"):
            df.collect()
    same_twice = make_oltp(DepartmentSpecialty=[(1, "Cardiac Care"), (1, "Cardiac Care"), (2, "X")])
    assert B.build_star(same_twice).table("Dim_Doctors").count() == 4


def test_star_and_snowflake_agree_on_fixture(make_oltp):
    vis = (_repeat(1, 3, 1, 1, "2020-01-05 10:00:00", 1) + _repeat(10, 5, 2, 3, "2021-01-05 10:00:00", 1)
           + _repeat(20, 2, 3, 3, "2020-07-05 10:00:00", 3, "Cancelled"))
    appts, recs = visits(vis)
    oltp = make_oltp(Appointments=appts, MedicalRecords=recs)
    star, snow = B.build_star(oltp), B.build_snowflake(oltp)
    for fn in (A.trending_diagnoses, A.rolling_cancellations, A.symptom_diagnosis):
        a = fn(star, Y(2019, 1, 1), Y(2022, 1, 1)).collect()
        b = fn(snow, Y(2019, 1, 1), Y(2022, 1, 1)).collect()
        assert sorted(map(tuple, a)) == sorted(map(tuple, b))
    s5 = A.top_doctors(snow, Y(2019, 1, 1), Y(2022, 1, 1), 5)
    assert rows(s5, "DoctorID", "Specialty") == [(3, "Cancer Treatment")]


def test_snowflake_collapses_back_to_star(make_oltp):
    vis = _repeat(1, 3, 1, 1, "2020-01-05 10:00:00", 1) + _repeat(10, 2, 2, 3, "2021-01-05 10:00:00", 3)
    appts, recs = visits(vis)
    oltp = make_oltp(Appointments=appts, MedicalRecords=recs)
    star, snow = B.build_star(oltp), B.build_snowflake(oltp)
    back = B.snowflake_to_star(snow)
    for name in ("Dim_Patients", "Dim_Doctors", "Dim_Diagnoses", "Dim_Medications",
                 "Dim_Insurance", "Dim_PatientAllergies"):
        cols = star.table(name).columns
        assert sorted(map(tuple, back.table(name).select(*cols).collect()), key=repr) == \
            sorted(map(tuple, star.table(name).collect()), key=repr), name
    # surrogate keys: dense, in natural order
    assert rows(snow.table("Dim_ICD10Codes"), "ICD10CodeID", "ICD10Code") == [(1, "A00-B99"), (2, "C00-D49")]
    assert rows(snow.table("Dim_DepartmentSpecialty"), "SpecialtyID", "Specialty") == [
        (1, "Cancer Treatment"), (2, "Cardiac Care")]
    assert rows(snow.table("Dim_Patients"), "PatientID", "ContactInfoID") == [(p, p) for p in range(1, 5)]
