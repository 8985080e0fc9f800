"""Bind the driver's TPC-H-style tables to the clinical OLTP model.

The reference ships no data, only a generator. Our test and benchmark
tables (``orders``, ``lineitem``, ``customer``, ...) play its roles:

==================  =================================================
model               driver table
==================  =================================================
Appointments        orders (status F/O/P -> Cancelled/Scheduled/Completed)
MedicalRecords      lineitem: each line is a record (DiagnosisID = l_partkey,
                    Symptoms = its return flag and line status)
Prescriptions       lineitem: a line that isn't 'N' (was returned or
                    accepted) carries a prescription
Patients, contacts  customer, customer x nation
Doctors -> Departments -> Specialty   supplier -> nation -> region
Diagnoses           part: name = p_type || ' ' || p_brand, code = p_brand
ICD10Codes          distinct p_brand
Medications         part: name = p_name, manufacturer = p_brand
Allergies / bridge  part / lineitem
Insurance           customer
==================  =================================================

The analyses run on a fact with one row per line (``star``, ``snowflake``):
there each line is a record and its prescription, seen by the doctor l_suppkey,
and the symptoms are o_orderpriority. ``clinic_tables`` adds the dates and codes that
the model's quality rules need, from the tables' numbers.

Everything is a lazy projection of the scans, so column pruning and
filter pushdown reach the Parquet readers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clinistar.plans import builders
from clinistar.plans.model import Warehouse

DRIVER_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
)

# How the driver's order status maps onto appointment status.
STATUS_MAP = {"F": "Cancelled", "O": "Scheduled", "P": "Completed"}
# Prescription frequencies of the reference model.
FREQUENCIES = ("QD", "BID", "TID", "QID")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _status(col: str) -> F.Column:
    expr = F.lit(None).cast("string")
    for code, status in reversed(list(STATUS_MAP.items())):
        expr = F.when(F.col(col) == code, status).otherwise(expr)
    return expr


def visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Appointments of the analyses: their symptoms are the order's priority,
    their doctors are on the lines."""
    return read_table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("AppointmentID"),
        F.col("o_custkey").alias("PatientID"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("AppointmentDateTime"),
        _status("o_orderstatus").alias("Status"),
        F.col("o_orderpriority").alias("Symptoms"),
    )


def _dosage() -> F.Column:
    return F.concat(F.col("l_quantity").cast("int").cast("string"), F.lit("mg"))


def _frequency() -> F.Column:
    return F.element_at(F.array(*[F.lit(f) for f in FREQUENCIES]), F.pmod("l_linenumber", F.lit(4)) + 1)


def visit_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of the analyses, each with its prescription."""
    ship_day = F.to_date("l_shipdate")
    return read_table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("AppointmentID"),
        F.col("l_orderkey").alias("RecordID"),
        F.col("l_suppkey").alias("DoctorID"),
        F.col("l_partkey").alias("DiagnosisID"),
        F.col("l_partkey").alias("MedicationID"),
        _dosage().alias("Dosage"),
        _frequency().alias("Frequency"),
        ship_day.alias("StartDate"),
        F.date_add(ship_day, 30).alias("EndDate"),
    )


def oltp_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The 14 OLTP tables over the driver tables."""
    t = {n: read_table(spark, sf_dir, n) for n in DRIVER_TABLES}
    orders, lineitem, customer = t["orders"], t["lineitem"], t["customer"]
    supplier, nation, region, part = t["supplier"], t["nation"], t["region"], t["part"]

    appointments = orders.select(
        F.col("o_orderkey").alias("AppointmentID"),
        F.col("o_custkey").alias("PatientID"),
        F.expr("cast(floor(o_totalprice) as bigint) % 100").alias("DoctorID"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("AppointmentDateTime"),
        _status("o_orderstatus").alias("Status"),
    )
    ship_day = F.to_date("l_shipdate")
    line_id = F.col("l_orderkey") * 16 + F.col("l_linenumber")
    records = lineitem.select(
        line_id.alias("RecordID"),
        F.col("l_orderkey").alias("AppointmentID"),
        F.concat_ws(", ", "l_returnflag", "l_linestatus").alias("Symptoms"),
        F.col("l_partkey").alias("DiagnosisID"),
        F.col("l_linestatus").alias("Treatment"),
    )
    prescriptions = lineitem.where("l_returnflag <> 'N'").select(
        line_id.alias("PrescriptionID"),
        F.col("l_orderkey").alias("AppointmentID"),
        F.col("l_partkey").alias("MedicationID"),
        _dosage().alias("Dosage"),
        _frequency().alias("Frequency"),
        ship_day.alias("StartDate"),
        F.date_add(ship_day, F.col("l_quantity").cast("int")).alias("EndDate"),
    )
    patients = customer.select(
        F.col("c_custkey").alias("PatientID"),
        F.col("c_name").alias("FirstName"),
        F.col("c_mktsegment").alias("LastName"),
        F.lit(None).cast("date").alias("DateOfBirth"),
        F.lit(None).cast("string").alias("Gender"),
        F.format_string("%09d", F.col("c_custkey")).alias("SSN"),
    )
    contacts = customer.join(nation, customer.c_nationkey == nation.n_nationkey).select(
        F.col("c_custkey").alias("ContactID"),
        F.col("c_custkey").alias("PatientID"),
        F.col("n_name").alias("Address"),
        F.col("n_name").alias("City"),
        F.col("c_nationkey").cast("string").alias("State"),
        F.lpad(F.col("c_nationkey").cast("string"), 5, "0").alias("ZipCode"),
        F.lit(None).cast("string").alias("Phone"),
        F.lit(None).cast("string").alias("Email"),
    )
    doctors = supplier.select(
        F.col("s_suppkey").alias("DoctorID"),
        F.col("s_name").alias("FirstName"),
        F.substring_index("s_name", "#", 1).alias("LastName"),
        F.format_string("MD%06d", F.col("s_suppkey")).alias("License"),
        F.lit(None).cast("date").alias("HireDate"),
        F.col("s_nationkey").cast("bigint").alias("DepartmentID"),
    )
    departments = nation.select(
        F.col("n_nationkey").cast("bigint").alias("DepartmentID"),
        F.col("n_name").alias("DepartmentName"),
        F.concat(F.lit("Region "), F.col("n_regionkey").cast("string")).alias("Location"),
    )
    specialty = nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_nationkey").cast("bigint").alias("DepartmentID"),
        F.col("r_name").alias("Specialty"),
    )
    diagnoses = part.select(
        F.col("p_partkey").alias("DiagnosisID"),
        F.col("p_brand").alias("ICD10Code"),
        F.concat_ws(" ", "p_type", "p_brand").alias("DiagnosisName"),
    )
    icd10 = part.select(
        F.col("p_brand").alias("ICD10Code"), F.lit(None).cast("string").alias("DiagnosisCategory")
    ).distinct()
    medications = part.select(
        F.col("p_partkey").alias("MedicationID"),
        F.col("p_name").alias("MedicationName"),
        F.col("p_brand").alias("Manufacturer"),
        F.col("p_type").alias("Description"),
    )
    allergies = part.select(
        F.col("p_partkey").alias("AllergyID"),
        F.col("p_name").alias("AllergyName"),
        F.col("p_type").alias("Severity"),
    )
    patient_allergies = lineitem.select(
        F.col("l_orderkey").alias("PatientID"),
        F.col("l_partkey").alias("AllergyID"),
        ship_day.alias("DateDiagnosed"),
    )
    insurance = customer.select(
        F.col("c_custkey").alias("InsuranceID"),
        F.col("c_custkey").alias("PatientID"),
        F.col("c_mktsegment").alias("CompanyName"),
        F.format_string("POL%06d", F.col("c_custkey")).alias("PolicyNumber"),
        F.lit(None).cast("string").alias("CoverageDetails"),
        F.lit(None).cast("date").alias("EffectiveDate"),
        F.lit(None).cast("date").alias("ExpiryDate"),
    )
    return {
        "Appointments": appointments,
        "MedicalRecords": records,
        "Prescriptions": prescriptions,
        "Patients": patients,
        "PatientContactInfo": contacts,
        "Doctors": doctors,
        "Departments": departments,
        "DepartmentSpecialty": specialty,
        "Diagnoses": diagnoses,
        "ICD10Codes": icd10,
        "Medications": medications,
        "Allergies": allergies,
        "PatientAllergies": patient_allergies,
        "Insurance": insurance,
    }


def clinic_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The 14 tables with dates and codes for the quality rules: births, hires
    and insurance periods from account balances, genders from segments,
    severities from part types. Some rows break the rules, as they come."""
    t = oltp_tables(spark, sf_dir)
    customer, supplier, part = (read_table(spark, sf_dir, n) for n in ("customer", "supplier", "part"))
    born = F.expr("date_add(DATE'1935-01-01', cast(floor(abs(c_acctbal) * 2) as int))")
    gender = F.expr("CASE c_mktsegment WHEN 'BUILDING' THEN 'Male' WHEN 'MACHINERY' THEN 'Female' WHEN 'HOUSEHOLD' THEN 'Other' END")
    severity = F.expr("CASE p_type WHEN 'ECONOMY' THEN 'Low' WHEN 'STANDARD' THEN 'Medium' WHEN 'PROMO' THEN 'High' ELSE p_type END")
    return t | {
        "Patients": customer.select(
            F.col("c_custkey").alias("PatientID"), F.col("c_name").alias("FirstName"), F.col("c_mktsegment").alias("LastName"),
            born.alias("DateOfBirth"), gender.alias("Gender"), F.format_string("%09d", F.col("c_custkey")).alias("SSN"),
        ),
        "Doctors": supplier.select(
            F.col("s_suppkey").alias("DoctorID"), F.format_string("MD%06d", F.col("s_suppkey")).alias("License"),
            F.expr("date_add(DATE'1992-01-01', cast(floor(abs(s_acctbal) / 5) as int))").alias("HireDate"),
            F.col("s_nationkey").cast("bigint").alias("DepartmentID"),
        ),
        "Allergies": part.select(F.col("p_partkey").alias("AllergyID"), F.col("p_name").alias("AllergyName"), severity.alias("Severity")),
        "Insurance": customer.select(
            F.col("c_custkey").alias("InsuranceID"), F.col("c_custkey").alias("PatientID"),
            F.format_string("POL%06d", F.col("c_custkey")).alias("PolicyNumber"),
            F.expr("date_add(DATE'1995-01-01', cast(floor(abs(c_acctbal)) as int) % 100)").alias("EffectiveDate"),
            F.expr("date_add(DATE'1995-01-01', c_nationkey * 10)").alias("ExpiryDate"),
        ),
    }


def visit_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return builders.build_fact(visits(spark, sf_dir), visit_lines(spark, sf_dir))


def star(spark: SparkSession, sf_dir: str) -> Warehouse:
    return builders.build_star(oltp_tables(spark, sf_dir), visit_fact(spark, sf_dir))


def snowflake(spark: SparkSession, sf_dir: str) -> Warehouse:
    return builders.build_snowflake(oltp_tables(spark, sf_dir), visit_fact(spark, sf_dir))


def model(spark: SparkSession, sf_dir: str, kind: str) -> Warehouse:
    return star(spark, sf_dir) if kind == "star" else snowflake(spark, sf_dir)
