"""State after any number of loads equals the full rebuild."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from clinistar.operators import analytics as A
from clinistar.operators.incremental import SummaryState
from clinistar.sources import proxy
from conftest import SF0001


def bag(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_state_equals_rebuild_after_each_load(spark, tmp_path):
    wh = proxy.star(spark, SF0001)
    year = F.year("AppointmentDateTime")
    state = SummaryState(spark, f"{tmp_path}/state")
    with pytest.raises(ValueError):
        state.patients()
    seen = wh.fact().limit(0)
    for load, batch in enumerate([wh.fact().where(year <= 1994), wh.fact().where(year.between(1995, 1996)), wh.fact().where(year > 1996)]):
        state.add(load, batch)
        state.update_priorities(load, wh)
        seen = seen.unionByName(batch)
        if load == 1:
            state.add(load, batch)  # repeated after a failure: replaced, not added
            state.compact()
            with pytest.raises(ValueError):
                state.add(0, batch)
        whole = proxy.builders.Warehouse("star", wh.tables | {"Fact_PatientInteractions": seen})
        assert bag(state.appointment_summary(whole)) == bag(A.appointment_summary(whole))
        assert bag(state.diagnosis_treatment_summary(whole)) == bag(A.diagnosis_treatment_summary(whole))
        assert bag(state.priorities()) == bag(A.priority_by_key(whole))


def test_a_load_touches_its_patients_only(spark, tmp_path):
    wh = proxy.star(spark, SF0001)
    state = SummaryState(spark, f"{tmp_path}/state")
    state.add(1, wh.fact())
    state.update_priorities(1, wh)
    one = wh.fact().where("PatientID = 7")
    state.add(2, one)
    state.update_priorities(2, wh)
    written = spark.read.parquet(f"{tmp_path}/state/priority-000000002/pairs")
    assert {r.PatientID for r in written.select("PatientID").distinct().collect()} == {7}
    assert state.priorities().count() == A.priority_by_key(wh).count()
    assert spark.read.parquet(f"{tmp_path}/state/load-000000002/patients").count() == 1


def test_an_unfinished_load_does_not_count(spark, tmp_path):
    wh = proxy.star(spark, SF0001)
    state = SummaryState(spark, f"{tmp_path}/state")
    state.add(1, wh.fact())
    A.appointments_per_patient(wh.fact()).write.parquet(f"{tmp_path}/state/load-000000002/patients")  # no treatments
    assert bag(state.patients()) == bag(A.appointments_per_patient(wh.fact()))


def test_a_load_reads_its_facts_once(spark, tmp_path):
    """Both tables of a load come from one pass, NULLs and appointments without lines included."""
    rows = [(1, 1, 1, 1, "Cancelled"), (1, 1, 1, 2, None), (None, 1, 2, 2, "Cancelled"), (2, None, 1, 1, "Scheduled"), (3, 2, None, None, "Cancelled"), (4, 2, 1, 1, "Cancelled")] * 2
    facts, read = spark.createDataFrame(rows, "AppointmentID long, PatientID long, DiagnosisID long, MedicationID long, Status string"), spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            read.add(len(b))
            yield b

    state = SummaryState(spark, f"{tmp_path}/state")
    state.add(0, facts.mapInPandas(counted, facts.schema))
    assert read.value == len(rows)
    assert bag(state.patients()) == bag(A.appointments_per_patient(facts))
    assert bag(state.treatments()) == bag(A.treatments_per_patient(facts))
