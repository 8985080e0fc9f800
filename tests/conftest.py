from __future__ import annotations

import datetime as dt
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from clinistar.schemas import OLTP_SCHEMAS  # noqa: E402
from clinistar.session import get_spark  # noqa: E402

SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = get_spark(
        "local[4]", app_name="clinistar-tests", shuffle_partitions=4,
        extra_conf={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="clinistar-test-ckpt-")},
    )
    yield s
    s.stop()


def ts(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)


# Default dimension rows of a tiny hospital: 2 departments, 4 doctors,
# 4 patients, diagnoses 1-4, medications 1-4.
DEFAULTS = {
    "Departments": [(1, "Cardiology", "Wing A"), (2, "Oncology", "Wing B")],
    "DepartmentSpecialty": [(1, "Cardiac Care"), (2, "Cancer Treatment")],
    "ICD10Codes": [("A00-B99", "Infectious"), ("C00-D49", "Neoplasms")],
    "Doctors": [
        (d, f"Doc{d}", f"Last{d}", f"MD{d:06d}", dt.date(2000, 1, 1), 1 if d <= 2 else 2)
        for d in range(1, 5)
    ],
    "Patients": [
        (p, f"Pat{p}", f"Fam{p}", dt.date(1980, 1, 1), "Female", f"{p:09d}") for p in range(1, 5)
    ],
    "PatientContactInfo": [
        (p, p, f"{p} Main St", "Town", "MA", f"0213{p}", "555-000-0000", f"p{p}@x.org") for p in range(1, 5)
    ],
    "Allergies": [(1, "Peanuts", "High"), (2, "Latex", "Low")],
    "PatientAllergies": [(1, 1, dt.date(2015, 5, 1)), (2, 2, dt.date(2016, 6, 1))],
    "Diagnoses": [
        (1, "A00-B99", "Cholera - A Type"),
        (2, "A00-B99", "Tuberculosis - B Type"),
        (3, "C00-D49", "Melanoma - C Type"),
        (4, "C00-D49", "Anemia - D Type"),
    ],
    "Medications": [(m, f"Med{m}cin", f"Maker{m}", "Prescription medication") for m in range(1, 5)],
    "Insurance": [
        (p, p, "Aetna", f"POL{p:06d}", "PPO", dt.date(2020, 1, 1), dt.date(2026, 1, 1)) for p in range(1, 5)
    ],
    "Appointments": [],
    "MedicalRecords": [],
    "Prescriptions": [],
}


@pytest.fixture
def make_oltp(spark):
    """Build the 14 OLTP tables from row lists (defaults for the rest)."""

    def build(**tables):
        out = {}
        for name, schema in OLTP_SCHEMAS.items():
            rows = tables.get(name, DEFAULTS[name])
            out[name] = spark.createDataFrame(rows, schema)
        return out

    return build


def visits(rows):
    """Appointments + one record each from compact tuples
    (appt_id, patient, doctor, ts, status, symptoms, diagnosis)."""
    appts = [(a, p, d, ts(t), st) for a, p, d, t, st, _, _ in rows]
    recs = [(a, a, sym, dx, "Rest") for a, _, _, _, _, sym, dx in rows]
    return appts, recs
