"""Star and snowflake warehouses behind one lookup interface.

The analytic operators never ask which model they run on: they call
``fact_in_range`` and the dimension lookups below, which return the same
star-shaped columns from either model (the snowflake walks its chains with
inner joins, exactly as the reference SQL does). So one operator gives the
same result on both models.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinistar.functions.scalar import ts_range

#: Name of the partition column of a materialized fact table.
YEAR_PARTITION = "AppointmentYear"

STAR_TABLES = (
    "Fact_PatientInteractions",
    "Dim_Patients",
    "Dim_Doctors",
    "Dim_Diagnoses",
    "Dim_Medications",
    "Dim_Insurance",
    "Dim_PatientAllergies",
)
SNOWFLAKE_TABLES = (
    "Fact_PatientInteractions",
    "Dim_Patients",
    "Dim_PatientContactInfo",
    "Dim_Doctors",
    "Dim_Departments",
    "Dim_DepartmentSpecialty",
    "Dim_Diagnoses",
    "Dim_ICD10Codes",
    "Dim_Medications",
    "Dim_Insurance",
    "Dim_PatientAllergies",
)


@dataclass(frozen=True)
class Warehouse:
    kind: str  # "star" or "snowflake"
    tables: dict[str, DataFrame] = field(default_factory=dict)

    def __post_init__(self):
        if self.kind not in ("star", "snowflake"):
            raise ValueError(f"unknown model kind {self.kind!r}")
        expected = STAR_TABLES if self.kind == "star" else SNOWFLAKE_TABLES
        missing = [t for t in expected if t not in self.tables]
        if missing:
            raise ValueError(f"{self.kind} warehouse lacks tables {missing}")

    def table(self, name: str) -> DataFrame:
        return self.tables[name]

    # -- fact ---------------------------------------------------------------
    def fact(self) -> DataFrame:
        return self.tables["Fact_PatientInteractions"]

    def fact_in_range(
        self, start: dt.date | None, end: dt.date | None, end_inclusive_day: bool = False
    ) -> DataFrame:
        """The fact rows with AppointmentDateTime BETWEEN start AND end.

        A ``None`` bound leaves that side open. When the fact is laid out by
        year we add the implied partition predicate, so the scan prunes
        whole directories; the timestamp predicate is pushed to Parquet.
        """
        f = self.fact()
        if start is None and end is None:
            return f
        cond = ts_range("AppointmentDateTime", start, end, end_inclusive_day)
        if YEAR_PARTITION in f.columns:
            if start is not None:
                cond = cond & (F.col(YEAR_PARTITION) >= start.year)
            if end is not None:
                cond = cond & (F.col(YEAR_PARTITION) <= end.year)
        return f.where(cond)

    # -- dimension lookups (star-shaped columns from either model) ------------
    def diagnoses(self) -> DataFrame:
        """DiagnosisID, DiagnosisName, ICD10Code."""
        d = self.tables["Dim_Diagnoses"]
        if self.kind == "star":
            return d.select("DiagnosisID", "DiagnosisName", "ICD10Code")
        icd = self.tables["Dim_ICD10Codes"]
        return d.join(icd, "ICD10CodeID").select("DiagnosisID", "DiagnosisName", "ICD10Code")

    def medications(self) -> DataFrame:
        return self.tables["Dim_Medications"].select(
            "MedicationID", "MedicationName", "Manufacturer"
        )

    def doctors(self) -> DataFrame:
        """DoctorID, FirstName, LastName, DepartmentName (+ Specialty on snowflake,
        which reaches it through Departments -> DepartmentSpecialty)."""
        d = self.tables["Dim_Doctors"]
        if self.kind == "star":
            return d.select("DoctorID", "FirstName", "LastName", "DepartmentName")
        dept = self.tables["Dim_Departments"]
        spec = self.tables["Dim_DepartmentSpecialty"]
        return (
            d.join(dept, "DepartmentID")
            .join(spec, "SpecialtyID")
            .select("DoctorID", "FirstName", "LastName", "DepartmentName", "Specialty")
        )

    # -- attach a dimension to an aggregate, one table at a time ---------------
    # The operators join a (small) fact aggregate to the dimension chain. The
    # inner joins are associative, so joining table by table gives the same
    # rows as joining the pre-joined lookup, but every join's other side is
    # then a plain table whose size Spark knows when it plans (a pre-joined
    # chain only gets a product-of-sizes estimate): small tables are
    # broadcast from the start instead of being discovered at runtime.
    def with_diagnoses(self, df: DataFrame) -> DataFrame:
        """``df`` + DiagnosisName, ICD10Code (inner join on DiagnosisID)."""
        d = self.tables["Dim_Diagnoses"]
        if self.kind == "star":
            return df.join(d.select("DiagnosisID", "DiagnosisName", "ICD10Code"), "DiagnosisID")
        icd = self.tables["Dim_ICD10Codes"].select("ICD10CodeID", "ICD10Code")
        return (
            df.join(d.select("DiagnosisID", "DiagnosisName", "ICD10CodeID"), "DiagnosisID")
            .join(icd, "ICD10CodeID")
            .drop("ICD10CodeID")
        )

    def with_medications(self, df: DataFrame) -> DataFrame:
        """``df`` + MedicationName, Manufacturer (inner join on MedicationID)."""
        return df.join(self.medications(), "MedicationID")

    def with_doctors(self, df: DataFrame) -> DataFrame:
        """``df`` + the doctor attributes (inner joins along the chain)."""
        d = self.tables["Dim_Doctors"]
        if self.kind == "star":
            return df.join(d.select("DoctorID", "FirstName", "LastName", "DepartmentName"), "DoctorID")
        dept = self.tables["Dim_Departments"].select("DepartmentID", "DepartmentName", "SpecialtyID")
        spec = self.tables["Dim_DepartmentSpecialty"].select("SpecialtyID", "Specialty")
        return (
            df.join(d.select("DoctorID", "FirstName", "LastName", "DepartmentID"), "DoctorID")
            .join(dept, "DepartmentID")
            .join(spec, "SpecialtyID")
            .drop("DepartmentID", "SpecialtyID")
        )

    def patients(self) -> DataFrame:
        return self.tables["Dim_Patients"].select("PatientID", "FirstName", "LastName")

    @property
    def doctor_attributes(self) -> list[str]:
        base = ["FirstName", "LastName", "DepartmentName"]
        return base + (["Specialty"] if self.kind == "snowflake" else [])


def write_fact(fact: DataFrame, target: str, mode: str = "overwrite") -> None:
    """Write a fact as Parquet by year.

    It is rebalanced by year: adaptive execution gathers small years and
    splits large ones to the advisory partition size, so a year becomes a few
    large files instead of one per task, and no year piles up in one task.
    Each task sorts by (year, timestamp), so row groups cover short stretches
    of a file's time and date-range filters skip them inside the year
    directories they prune. Files of one year overlap in time. The whole table
    is replaced, years it no longer has included.
    """
    if YEAR_PARTITION not in fact.columns:
        fact = fact.withColumn(YEAR_PARTITION, F.year("AppointmentDateTime"))
    laid = fact.hint("rebalance", YEAR_PARTITION).sortWithinPartitions(YEAR_PARTITION, "AppointmentDateTime")
    laid.write.mode(mode).option("partitionOverwriteMode", "static").partitionBy(YEAR_PARTITION).parquet(target)
