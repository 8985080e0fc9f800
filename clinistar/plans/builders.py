"""OLTP -> OLAP model builders (star and snowflake).

The reference states the transform but ships no code for it, so these are
our design, following the model description: one fact table at the grain
appointment x medical record x prescription, denormalized dimensions for the
star, normalized chains for the snowflake. All builders are lazy DataFrame
jobs over the OLTP tables; ``materialize`` writes them as Parquet with the
fact laid out by appointment year.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinistar.functions.joins import full_outer_join, left_outer_join, left_outer_joins
from clinistar.functions.keys import KeyMap, dense_keys
from clinistar.plans.model import Warehouse, write_fact
from clinistar.schemas import FACT_SCHEMA

#: Fact_PatientInteractions columns and types, in model order.
FACT_COLUMNS: tuple[tuple[str, str], ...] = tuple(
    (f.name, f.dataType.simpleString()) for f in FACT_SCHEMA.fields
)


# ---------------------------------------------------------------------------
# M1: fact table
# ---------------------------------------------------------------------------
#: What the fact takes from each child table besides the appointment's key.
RECORD_COLUMNS = ("RecordID", "Symptoms", "DiagnosisID", "LabResults")
PRESCRIPTION_COLUMNS = ("MedicationID", "Dosage", "Frequency", "StartDate", "EndDate")


def _children(df: DataFrame, wanted: tuple[str, ...], have: set[str]) -> DataFrame:
    return df.select("AppointmentID", *[c for c in df.columns if c in wanted and c not in have])


def _as_fact(joined: DataFrame) -> DataFrame:
    """Typed fact columns; what no source has is a typed NULL (e.g. Notes,
    which later versions of the source no longer carry)."""
    present = set(joined.columns)
    return joined.select(
        *[
            (F.col(name) if name in present else F.lit(None)).cast(typ).alias(name)
            for name, typ in FACT_COLUMNS
        ]
    )


def record_lines(records: DataFrame, prescriptions: DataFrame) -> DataFrame:
    """Detail lines of each appointment: records x prescriptions.

    An appointment with r records and p prescriptions yields
    max(1, r) * max(1, p) lines once joined to its appointment (grain C1);
    a full join keeps prescriptions of appointments without a record.
    """
    return full_outer_join(
        _children(records, RECORD_COLUMNS, set()), _children(prescriptions, PRESCRIPTION_COLUMNS, set()), ["AppointmentID"]
    )


def build_fact(appointments: DataFrame, details: DataFrame) -> DataFrame:
    """Fact_PatientInteractions = appointments LEFT JOIN details, for sources
    whose records and prescriptions are one table. A column that both have is
    taken from the appointment."""
    a_cols = set(appointments.columns)
    d_only = [c for c in details.columns if c not in a_cols]
    return _as_fact(left_outer_join(appointments, details.select("AppointmentID", *d_only), ["AppointmentID"]))


def build_fact_from_children(appointments: DataFrame, records: DataFrame, prescriptions: DataFrame) -> DataFrame:
    """Fact_PatientInteractions = appointments LEFT JOIN records LEFT JOIN
    prescriptions, all on the appointment: max(1, r) * max(1, p) rows each.

    Two inner joins over placeholders (``functions.joins``): each of the three
    tables is read for its rows and once more for its keys.
    """
    have = set(appointments.columns)
    rec = _children(records, RECORD_COLUMNS, have)
    rx = _children(prescriptions, PRESCRIPTION_COLUMNS, have | set(rec.columns))
    return _as_fact(left_outer_joins(appointments, [rec, rx], ["AppointmentID"]))


def fact_from_oltp(oltp: dict[str, DataFrame]) -> DataFrame:
    return build_fact_from_children(oltp["Appointments"], oltp["MedicalRecords"], oltp["Prescriptions"])


# ---------------------------------------------------------------------------
# checks the builders rely on
# ---------------------------------------------------------------------------
def one_per_key(df: DataFrame, key: str, value: str, what: str) -> DataFrame:
    """``(key, value)`` with one row per key; a key with several distinct
    values makes the job fail with a message naming it (C5).

    The check is part of the plan: a map-side combined aggregate (min, max
    and distinct count are all mergeable), no driver-side action, evaluated
    whenever the dimension is.
    """
    agg = df.groupBy(key).agg(
        F.min(value).alias("_v"), F.max(value).alias("_vmax"), F.count(F.lit(1)).alias("_n")
    )
    clash = (F.col("_v") != F.col("_vmax")) | (F.col("_v").isNull() & (F.col("_n") > 1))
    message = F.concat(
        F.lit(f"{what}: {key}="), F.col(key).cast("string"), F.lit(f" has several {value} values")
    )
    return agg.select(key, F.when(clash, F.raise_error(message)).otherwise(F.col("_v")).alias(value))


def _first_contact(contacts: DataFrame) -> DataFrame:
    """One contact per patient: the lowest ContactID (prose allows many).

    ``min`` over a struct is an ordinary aggregate, so it combines map-side
    and a patient with very many contacts never lands whole in one task.
    """
    fields = ["ContactID", "Address", "City", "State", "ZipCode", "Phone", "Email"]
    return (
        contacts.groupBy("PatientID")
        .agg(F.min(F.struct(*fields)).alias("c"))
        .select("PatientID", *[F.col(f"c.{f}").alias(f) for f in fields])
    )


# ---------------------------------------------------------------------------
# star dimensions (M2-M7)
# ---------------------------------------------------------------------------
def dim_patients_star(patients: DataFrame, contacts: DataFrame) -> DataFrame:
    c = _first_contact(contacts).drop("ContactID").withColumnRenamed("ZipCode", "Zipcode")
    # one contact row per patient: nothing on that side can be hot
    return patients.select("PatientID", "FirstName", "LastName", "DateOfBirth", "Gender", "SSN").join(c, "PatientID", "left")


def dim_doctors_star(doctors: DataFrame, departments: DataFrame, specialty: DataFrame) -> DataFrame:
    spec = one_per_key(specialty, "DepartmentID", "Specialty", "DepartmentSpecialty")
    dept = departments.select("DepartmentID", "DepartmentName", "Location").join(
        spec, "DepartmentID", "left"
    )
    return doctors.select("DoctorID", "FirstName", "LastName", "License", "DepartmentID").join(
        dept, "DepartmentID", "left"
    ).select("DoctorID", "FirstName", "LastName", "License", "DepartmentName", "Location", "Specialty")


def dim_diagnoses_star(diagnoses: DataFrame) -> DataFrame:
    return diagnoses.select("DiagnosisID", "DiagnosisName", "ICD10Code")


def dim_medications(medications: DataFrame) -> DataFrame:
    return medications.select("MedicationID", "MedicationName", "Manufacturer", "Description")


def dim_insurance(insurance: DataFrame) -> DataFrame:
    return insurance.select(
        "InsuranceID", "PatientID", "CompanyName", "PolicyNumber", "CoverageDetails",
        "EffectiveDate", "ExpiryDate",
    )


def dim_patient_allergies(bridge: DataFrame, allergies: DataFrame) -> DataFrame:
    return bridge.join(allergies, "AllergyID").select(
        "AllergyID", "PatientID", "AllergyName", "Severity", "DateDiagnosed"
    )


# ---------------------------------------------------------------------------
# snowflake dimensions (M8-M11)
# ---------------------------------------------------------------------------
def dim_patient_contact_info(contacts: DataFrame) -> DataFrame:
    return contacts.select(
        F.col("ContactID").alias("ContactInfoID"), "Address", "City", "State",
        F.col("ZipCode").alias("Zipcode"), "Phone", "Email",
    )


def dim_patients_snowflake(patients: DataFrame, contacts: DataFrame) -> DataFrame:
    first = _first_contact(contacts).select("PatientID", F.col("ContactID").alias("ContactInfoID"))
    return patients.select("PatientID", "FirstName", "LastName", "DateOfBirth", "Gender", "SSN").join(first, "PatientID", "left")


def dim_doctors_snowflake(doctors: DataFrame) -> DataFrame:
    return doctors.select("DoctorID", "FirstName", "LastName", "License", "DepartmentID")


def _keyed(values: DataFrame, value: str, key: str, key_maps: str | None) -> DataFrame:
    """``key, value`` of the distinct values: dense keys, or with a folder of
    key maps the keys they were given in the first load that had them."""
    keyed = dense_keys(values, value, key) if key_maps is None else KeyMap(values.sparkSession, f"{key_maps.rstrip('/')}/{key}", value, key).update(values)
    return keyed.select(key, value)


def dim_department_specialty(specialty: DataFrame, key_maps: str | None = None) -> DataFrame:
    """SpecialtyID, Specialty. Without ``key_maps`` the key is the name's place
    in sort order, which a later load can change."""
    return _keyed(specialty, "Specialty", "SpecialtyID", key_maps)


def dim_departments(
    departments: DataFrame, specialty: DataFrame, specialty_dim: DataFrame
) -> DataFrame:
    spec = one_per_key(specialty, "DepartmentID", "Specialty", "DepartmentSpecialty")
    keyed = spec.join(specialty_dim, "Specialty")
    return departments.select("DepartmentID", "DepartmentName", "Location").join(
        keyed.select("DepartmentID", "SpecialtyID"), "DepartmentID", "left"
    )


def dim_icd10_codes(diagnoses: DataFrame, icd10: DataFrame | None = None, key_maps: str | None = None) -> DataFrame:
    """ICD10CodeID, ICD10Code; codes of both the code list and the diagnoses,
    so no diagnosis loses its code. Keys as in ``dim_department_specialty``."""
    codes = diagnoses.select("ICD10Code")
    if icd10 is not None:
        codes = codes.unionByName(icd10.select("ICD10Code"))
    return _keyed(codes, "ICD10Code", "ICD10CodeID", key_maps)


def dim_diagnoses_snowflake(diagnoses: DataFrame, icd_dim: DataFrame) -> DataFrame:
    return diagnoses.select("DiagnosisID", "DiagnosisName", "ICD10Code").join(
        icd_dim, "ICD10Code", "left"
    ).select("DiagnosisID", "DiagnosisName", "ICD10CodeID")


# ---------------------------------------------------------------------------
# whole models
# ---------------------------------------------------------------------------
def build_star(oltp: dict[str, DataFrame], fact: DataFrame | None = None) -> Warehouse:
    return Warehouse(
        "star",
        {
            "Fact_PatientInteractions": fact if fact is not None else fact_from_oltp(oltp),
            "Dim_Patients": dim_patients_star(oltp["Patients"], oltp["PatientContactInfo"]),
            "Dim_Doctors": dim_doctors_star(
                oltp["Doctors"], oltp["Departments"], oltp["DepartmentSpecialty"]
            ),
            "Dim_Diagnoses": dim_diagnoses_star(oltp["Diagnoses"]),
            "Dim_Medications": dim_medications(oltp["Medications"]),
            "Dim_Insurance": dim_insurance(oltp["Insurance"]),
            "Dim_PatientAllergies": dim_patient_allergies(
                oltp["PatientAllergies"], oltp["Allergies"]
            ),
        },
    )


def build_snowflake(oltp: dict[str, DataFrame], fact: DataFrame | None = None, key_maps: str | None = None) -> Warehouse:
    """The snowflake model. With ``key_maps``, a folder, surrogate keys are
    kept from load to load; the new values' keys are written there at once."""
    spec_dim = dim_department_specialty(oltp["DepartmentSpecialty"], key_maps)
    icd_dim = dim_icd10_codes(oltp["Diagnoses"], oltp.get("ICD10Codes"), key_maps)
    return Warehouse(
        "snowflake",
        {
            "Fact_PatientInteractions": fact if fact is not None else fact_from_oltp(oltp),
            "Dim_Patients": dim_patients_snowflake(oltp["Patients"], oltp["PatientContactInfo"]),
            "Dim_PatientContactInfo": dim_patient_contact_info(oltp["PatientContactInfo"]),
            "Dim_Doctors": dim_doctors_snowflake(oltp["Doctors"]),
            "Dim_Departments": dim_departments(
                oltp["Departments"], oltp["DepartmentSpecialty"], spec_dim
            ),
            "Dim_DepartmentSpecialty": spec_dim,
            "Dim_Diagnoses": dim_diagnoses_snowflake(oltp["Diagnoses"], icd_dim),
            "Dim_ICD10Codes": icd_dim,
            "Dim_Medications": dim_medications(oltp["Medications"]),
            "Dim_Insurance": dim_insurance(oltp["Insurance"]),
            "Dim_PatientAllergies": dim_patient_allergies(
                oltp["PatientAllergies"], oltp["Allergies"]
            ),
        },
    )


def snowflake_to_star(snow: Warehouse) -> Warehouse:
    """M12: collapse the snowflake chains into the star dimensions."""
    if snow.kind != "snowflake":
        raise ValueError("snowflake_to_star needs a snowflake warehouse")
    t = snow.tables
    patients = t["Dim_Patients"].join(t["Dim_PatientContactInfo"], "ContactInfoID", "left").select(
        "PatientID", "FirstName", "LastName", "DateOfBirth", "Gender", "SSN",
        "Address", "City", "State", "Zipcode", "Phone", "Email",
    )
    dept = t["Dim_Departments"].join(t["Dim_DepartmentSpecialty"], "SpecialtyID", "left")
    doctors = t["Dim_Doctors"].join(dept, "DepartmentID", "left").select(
        "DoctorID", "FirstName", "LastName", "License", "DepartmentName", "Location", "Specialty"
    )
    diagnoses = t["Dim_Diagnoses"].join(t["Dim_ICD10Codes"], "ICD10CodeID", "left").select(
        "DiagnosisID", "DiagnosisName", "ICD10Code"
    )
    return Warehouse(
        "star",
        {
            "Fact_PatientInteractions": t["Fact_PatientInteractions"],
            "Dim_Patients": patients,
            "Dim_Doctors": doctors,
            "Dim_Diagnoses": diagnoses,
            "Dim_Medications": t["Dim_Medications"],
            "Dim_Insurance": t["Dim_Insurance"],
            "Dim_PatientAllergies": t["Dim_PatientAllergies"],
        },
    )


def materialize(
    wh: Warehouse, path: str, mode: str = "overwrite", tables: tuple[str, ...] | None = None
) -> Warehouse:
    """Write every table under ``path`` and return the warehouse read back.

    The fact is laid out by ``write_fact``. ``tables`` limits the write to those tables (the others pass through).
    """
    spark = wh.fact().sparkSession
    out: dict[str, DataFrame] = {}
    for name, df in wh.tables.items():
        if tables is not None and name not in tables:
            out[name] = df
            continue
        target = f"{path.rstrip('/')}/{name}"
        if name == "Fact_PatientInteractions":
            write_fact(df, target, mode)
        else:
            df.write.mode(mode).parquet(target)
        out[name] = spark.read.parquet(target)
    return Warehouse(wh.kind, out)
