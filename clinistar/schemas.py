"""Explicit schemas of the OLTP inputs and the warehouse tables.

Always declared, never inferred: inference would turn zip codes such as
``02134`` into integers and drop the leading zero.
"""

from __future__ import annotations

from pyspark.sql.types import (
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

_TYPES = {
    "bigint": LongType(),
    "int": IntegerType(),
    "double": DoubleType(),
    "string": StringType(),
    "date": DateType(),
    "timestamp_ntz": TimestampNTZType(),
}


def _schema(ddl: str) -> StructType:
    """``"a bigint, b string"`` -> StructType (all nullable; no session needed)."""
    fields = []
    for part in ddl.split(","):
        name, typ = part.split()
        fields.append(StructField(name, _TYPES[typ], True))
    return StructType(fields)


OLTP_SCHEMAS: dict[str, StructType] = {
    "Departments": _schema("DepartmentID bigint, DepartmentName string, Location string"),
    "DepartmentSpecialty": _schema("DepartmentID bigint, Specialty string"),
    "ICD10Codes": _schema("ICD10Code string, DiagnosisCategory string"),
    "Doctors": _schema(
        "DoctorID bigint, FirstName string, LastName string, License string, HireDate date, "
        "DepartmentID bigint"
    ),
    "Patients": _schema(
        "PatientID bigint, FirstName string, LastName string, DateOfBirth date, Gender string, "
        "SSN string"
    ),
    "PatientContactInfo": _schema(
        "ContactID bigint, PatientID bigint, Address string, City string, State string, "
        "ZipCode string, Phone string, Email string"
    ),
    "Allergies": _schema("AllergyID bigint, AllergyName string, Severity string"),
    "PatientAllergies": _schema("PatientID bigint, AllergyID bigint, DateDiagnosed date"),
    "Diagnoses": _schema("DiagnosisID bigint, ICD10Code string, DiagnosisName string"),
    "Appointments": _schema(
        "AppointmentID bigint, PatientID bigint, DoctorID bigint, "
        "AppointmentDateTime timestamp_ntz, Status string"
    ),
    "MedicalRecords": _schema(
        "RecordID bigint, AppointmentID bigint, Symptoms string, DiagnosisID bigint, Treatment string"
    ),
    "Medications": _schema(
        "MedicationID bigint, MedicationName string, Manufacturer string, Description string"
    ),
    # AppointmentID is ours: the source table has no link to its appointment.
    "Prescriptions": _schema(
        "PrescriptionID bigint, AppointmentID bigint, MedicationID bigint, Dosage string, "
        "Frequency string, StartDate date, EndDate date"
    ),
    "Insurance": _schema(
        "InsuranceID bigint, PatientID bigint, CompanyName string, PolicyNumber string, "
        "CoverageDetails string, EffectiveDate date, ExpiryDate date"
    ),
}

FACT_SCHEMA = _schema(
    "AppointmentID bigint, PatientID bigint, DoctorID bigint, DiagnosisID bigint, "
    "MedicationID bigint, AppointmentDateTime timestamp_ntz, Status string, Notes string, "
    "RecordID bigint, Symptoms string, Dosage string, Frequency string, StartDate date, "
    "EndDate date"
)
