"""SQL access: the warehouse as temp views, the reference's views, and its
five procedures as SQL table functions.

``register_sql(spark, wh)`` makes a session answer the reference's calls in
SQL, for either model:

    SELECT * FROM GetTrendingDiagnoses(DATE'1996-01-01', DATE'1998-12-31')
    SELECT * FROM GetTopDoctorsByGrowthRate(DATE'1996-01-01', DATE'1998-12-31', 10)
    SELECT * FROM AppointmentSummary

The procedures are SQL bodies (no Python in the plan). They read the fact
view and four lookup views with the star-shaped columns, so the same text
runs on a star or a snowflake warehouse. The fact view always carries
``AppointmentYear``; the bodies filter on it next to the timestamp, which
prunes partitions of a year-laid-out fact. Defects of the original text are
fixed as in the Python operators: the window value is filtered in an outer
query, LAG partitions by the whole entity key, ranks go through a histogram
of counts, top-n counts rows by ranges of the order and numbers them inside a
range (a LIMIT cannot take a parameter, and one numbering of all rows is one
task), and rounding is exact.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from clinistar.functions.ranges import RANGES, SAMPLE
from clinistar.functions.scalar import pct_round2_sql, percent_units_sql
from clinistar.operators import analytics as A
from clinistar.operators.generic import rolling_mean_sql
from clinistar.plans.model import YEAR_PARTITION, Warehouse

IN_RANGE = (
    "f.AppointmentDateTime BETWEEN start_date AND end_date "
    f"AND f.{YEAR_PARTITION} BETWEEN year(start_date) AND year(end_date)"
)


def _pct(num: str, den: str) -> str:
    return pct_round2_sql(num, den, "spark")


PROCEDURES = {
    "GetTrendingDiagnoses": f"""
CREATE OR REPLACE TEMPORARY FUNCTION GetTrendingDiagnoses(start_date DATE, end_date DATE)
RETURNS TABLE (DiagnosisName STRING, ICD10Code STRING, DiagnosisYear INT, DiagnosisCount BIGINT,
               PreviousYearCount BIGINT, YoYChangePercentage DOUBLE)
RETURN
WITH PerKey AS (
  SELECT f.DiagnosisID, year(f.AppointmentDateTime) AS DiagnosisYear, count(*) AS n
  FROM Fact_PatientInteractions f WHERE {IN_RANGE}
  GROUP BY f.DiagnosisID, year(f.AppointmentDateTime)
), Yearly AS (
  SELECT d.DiagnosisName, d.ICD10Code, k.DiagnosisYear, sum(k.n) AS DiagnosisCount
  FROM PerKey k JOIN DiagnosisLookup d ON k.DiagnosisID = d.DiagnosisID
  GROUP BY d.DiagnosisName, d.ICD10Code, k.DiagnosisYear
), WithPrevious AS (
  SELECT *, lag(DiagnosisCount) OVER (PARTITION BY DiagnosisName, ICD10Code ORDER BY DiagnosisYear)
            AS PreviousYearCount
  FROM Yearly
)
SELECT DiagnosisName, ICD10Code, DiagnosisYear, DiagnosisCount, PreviousYearCount,
       {_pct('DiagnosisCount - PreviousYearCount', 'PreviousYearCount')} AS YoYChangePercentage
FROM WithPrevious WHERE PreviousYearCount IS NOT NULL""",
    "GetMedicationPrescriptionTrends": f"""
CREATE OR REPLACE TEMPORARY FUNCTION GetMedicationPrescriptionTrends(start_date DATE, end_date DATE)
RETURNS TABLE (MedicationName STRING, Manufacturer STRING, PrescriptionYear INT, PrescriptionCount BIGINT,
               RankInYear INT, PreviousYearCount BIGINT, YoYChangePercentage DOUBLE)
RETURN
WITH PerKey AS (
  SELECT f.MedicationID, year(f.AppointmentDateTime) AS PrescriptionYear, count(*) AS n
  FROM Fact_PatientInteractions f WHERE {IN_RANGE}
  GROUP BY f.MedicationID, year(f.AppointmentDateTime)
), Yearly AS (
  SELECT m.MedicationName, m.Manufacturer, k.PrescriptionYear, sum(k.n) AS PrescriptionCount
  FROM PerKey k JOIN MedicationLookup m ON k.MedicationID = m.MedicationID
  GROUP BY m.MedicationName, m.Manufacturer, k.PrescriptionYear
), Hist AS (
  SELECT PrescriptionYear, PrescriptionCount, count(*) AS rows_with_count
  FROM Yearly GROUP BY PrescriptionYear, PrescriptionCount
), Ranks AS (
  SELECT PrescriptionYear, PrescriptionCount,
         CAST(coalesce(sum(rows_with_count) OVER (PARTITION BY PrescriptionYear ORDER BY PrescriptionCount DESC
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + 1 AS INT) AS RankInYear
  FROM Hist
), WithPrevious AS (
  SELECT y.*, r.RankInYear,
         lag(y.PrescriptionCount) OVER (PARTITION BY y.MedicationName, y.Manufacturer
                                        ORDER BY y.PrescriptionYear) AS PreviousYearCount
  FROM Yearly y JOIN Ranks r
    ON y.PrescriptionYear = r.PrescriptionYear AND y.PrescriptionCount = r.PrescriptionCount
)
SELECT MedicationName, Manufacturer, PrescriptionYear, PrescriptionCount, RankInYear, PreviousYearCount,
       {_pct('PrescriptionCount - PreviousYearCount', 'PreviousYearCount')} AS YoYChangePercentage
FROM WithPrevious""",
    "GetSymptomDiagnosisCorrelation": f"""
CREATE OR REPLACE TEMPORARY FUNCTION GetSymptomDiagnosisCorrelation(start_date DATE, end_date DATE)
RETURNS TABLE (DiagnosisMonth STRING, Symptoms STRING, DiagnosisName STRING, PairCount BIGINT,
               TotalPairCount BIGINT, PercentageOfMonth DOUBLE)
RETURN
WITH PerKey AS (
  SELECT date_format(f.AppointmentDateTime, 'yyyy-MM') AS DiagnosisMonth, f.Symptoms, f.DiagnosisID,
         count(*) AS n
  FROM Fact_PatientInteractions f WHERE {IN_RANGE} AND f.Symptoms IS NOT NULL
  GROUP BY 1, 2, 3
), Pairs AS (
  SELECT k.DiagnosisMonth, k.Symptoms, d.DiagnosisName, sum(k.n) AS PairCount
  FROM PerKey k JOIN DiagnosisLookup d ON k.DiagnosisID = d.DiagnosisID
  GROUP BY k.DiagnosisMonth, k.Symptoms, d.DiagnosisName
), PairTotals AS (
  SELECT Symptoms, DiagnosisName, sum(PairCount) AS TotalPairCount FROM Pairs GROUP BY Symptoms, DiagnosisName
), MonthTotals AS (
  SELECT DiagnosisMonth, sum(PairCount) AS MonthTotal FROM Pairs GROUP BY DiagnosisMonth
)
SELECT p.DiagnosisMonth, p.Symptoms, p.DiagnosisName, p.PairCount, t.TotalPairCount,
       {_pct('p.PairCount', 'm.MonthTotal')} AS PercentageOfMonth
FROM Pairs p
JOIN PairTotals t ON p.Symptoms <=> t.Symptoms AND p.DiagnosisName <=> t.DiagnosisName
JOIN MonthTotals m ON p.DiagnosisMonth <=> m.DiagnosisMonth""",
    "GetRollingAvgCancellations": f"""
CREATE OR REPLACE TEMPORARY FUNCTION GetRollingAvgCancellations(start_date DATE, end_date DATE)
RETURNS TABLE (AppointmentMonth STRING, CancellationRate DOUBLE, RollingAvgCancellationRate DOUBLE)
RETURN
WITH Monthly AS (
  SELECT date_format(f.AppointmentDateTime, 'yyyy-MM') AS AppointmentMonth,
         count_if(f.Status = 'Cancelled') AS c, count(*) AS t
  FROM Fact_PatientInteractions f WHERE {IN_RANGE}
  GROUP BY 1
), Rates AS (
  SELECT AppointmentMonth, {percent_units_sql('c', 't', 5, 'spark')} AS rate5 FROM Monthly
), Rolling AS (
  SELECT AppointmentMonth, rate5,
         sum(rate5) OVER (ORDER BY AppointmentMonth ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS s,
         count(rate5) OVER (ORDER BY AppointmentMonth ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS k
  FROM Rates
)
SELECT AppointmentMonth, CAST(rate5 AS DOUBLE) / 100000 AS CancellationRate,
       CAST({rolling_mean_sql('s', 'k', 'spark')} AS DOUBLE) / 1000000 AS RollingAvgCancellationRate
FROM Rolling""",
}


def top_doctors_ddl(attributes: list[str]) -> str:
    """The doctors' report with these attributes of a doctor besides the name."""
    typed, names = ", ".join(f"{a} STRING" for a in attributes), ", ".join(attributes)
    of_d = ", ".join(f"d.{a}" for a in attributes)
    return f"""
CREATE OR REPLACE TEMPORARY FUNCTION GetTopDoctorsByGrowthRate(start_date DATE, end_date DATE, top_n INT)
RETURNS TABLE (DoctorID BIGINT, FirstName STRING, LastName STRING, {typed},
               AppointmentYear INT, AppointmentCount BIGINT, PreviousYearCount BIGINT,
               YoYGrowthPercentage DOUBLE)
RETURN
WITH PerKey AS (
  SELECT f.DoctorID, year(f.AppointmentDateTime) AS AppointmentYear, count(*) AS n
  FROM Fact_PatientInteractions f WHERE {IN_RANGE}
  GROUP BY f.DoctorID, year(f.AppointmentDateTime)
), Yearly AS (
  SELECT d.DoctorID, d.FirstName, d.LastName, {of_d}, k.AppointmentYear, sum(k.n) AS AppointmentCount
  FROM PerKey k JOIN DoctorLookup d ON k.DoctorID = d.DoctorID
  GROUP BY d.DoctorID, d.FirstName, d.LastName, {of_d}, k.AppointmentYear
), WithPrevious AS (
  SELECT *, lag(AppointmentCount) OVER (PARTITION BY DoctorID, FirstName, LastName, {names}
                                        ORDER BY AppointmentYear) AS PreviousYearCount
  FROM Yearly
), Growth AS (
  SELECT *, {_pct('AppointmentCount - PreviousYearCount', 'PreviousYearCount')} AS YoYGrowthPercentage
  FROM WithPrevious WHERE PreviousYearCount IS NOT NULL
), Placed AS (
  SELECT *, struct(YoYGrowthPercentage IS NULL, -YoYGrowthPercentage, DoctorID, AppointmentYear, FirstName, LastName,
                   {names}) AS place FROM Growth
), Bounds AS (
  SELECT array_sort(collect_list(place)) AS every
  FROM (SELECT place FROM Placed ORDER BY xxhash64(place), place LIMIT {SAMPLE})
), Bounded AS (
  SELECT *, (SELECT filter(every, (b, i) -> i > 0 AND i % greatest(1, int(ceil(size(every) / {RANGES}))) = 0) FROM Bounds) AS bounds
  FROM Placed
), Ranged AS (
  SELECT *, size(filter(bounds, b -> b <= place)) AS part FROM Bounded
), Sizes AS (
  SELECT part, count(*) AS n FROM Ranged GROUP BY part
), Starts AS (
  SELECT part, coalesce(sum(n) OVER (ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM Sizes
), Ranked AS (
  SELECT r.*, s.before + row_number() OVER (PARTITION BY r.part ORDER BY r.place) AS rn
  FROM Ranged r JOIN Starts s ON r.part = s.part WHERE s.before < top_n
)
SELECT DoctorID, FirstName, LastName, {names}, AppointmentYear, AppointmentCount,
       PreviousYearCount, YoYGrowthPercentage
FROM Ranked WHERE rn <= top_n"""


def procedures(kind: str) -> dict[str, str]:
    """The procedures of a model. On the snowflake, the doctors' report also
    returns the specialty."""
    return PROCEDURES | {"GetTopDoctorsByGrowthRate": top_doctors_ddl(["DepartmentName", *["Specialty"] * (kind == "snowflake")])}


def register_sql(spark: SparkSession, wh: Warehouse) -> None:
    """Register the warehouse, lookups, views and procedures in ``spark``.

    A table function's rows have no order; say ``SELECT * FROM
    GetTrendingDiagnoses(...) ORDER BY ...`` for the reference's order.
    """
    for name, df in wh.tables.items():
        if name == "Fact_PatientInteractions" and YEAR_PARTITION not in df.columns:
            df = df.withColumn(YEAR_PARTITION, F.year("AppointmentDateTime"))
        df.createOrReplaceTempView(name)
    wh.diagnoses().createOrReplaceTempView("DiagnosisLookup")
    wh.medications().createOrReplaceTempView("MedicationLookup")
    wh.doctors().createOrReplaceTempView("DoctorLookup")
    wh.patients().createOrReplaceTempView("PatientLookup")
    A.appointment_summary(wh).createOrReplaceTempView("AppointmentSummary")
    A.diagnosis_treatment_summary(wh).createOrReplaceTempView("DiagnosisTreatmentSummary")
    for ddl in procedures(wh.kind).values():
        spark.sql(ddl)
