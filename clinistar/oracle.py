"""Independent DuckDB SQL for every registered query (the correctness oracle).

The driver registers the raw tables (``orders``, ``lineitem``, ...) as views
and runs these strings next to our Spark queries at sf0.01. Each string
rebuilds the proxy binding (see ``clinistar.sources.proxy``) in plain SQL and
states the query the way the reference writes it - window functions in the
same SELECT, ``DENSE_RANK`` for surrogate keys, ``LAG``/``RANK``/``SUM OVER``
- so it shares no plan and no rounding formula with the Spark side.
"""

from __future__ import annotations

# Parameters of the registered proxy queries.
START = "1996-01-01"
END = "1998-12-31"
TOP_N = 10
MANY = 5000  # a report longer than a merged top-n should be


def pct(num: str, den: str) -> str:
    """num * 100 / den, rounded once to 2 places, half away from zero."""
    return (
        f"(CASE WHEN ({den}) <> 0 THEN CAST(sign({num}) * sign({den}) AS DOUBLE) * "
        f"CAST((abs({num})::HUGEINT * 20000 + abs({den})::HUGEINT) // (abs({den})::HUGEINT * 2) AS DOUBLE) / 100.0 END)"
    )


#: c * 100 / t of two counts in units of 1e-5, rounded half up.
RATE5 = "(CASE WHEN t <> 0 THEN (c::HUGEINT * 20000000 + t) // (t::HUGEINT * 2) END)"

#: Mean of k such rates whose sum is s, in units of 1e-6, rounded half up.
MEAN6 = "((s::HUGEINT * 10) // k + CASE WHEN 2 * ((s::HUGEINT * 10) % k) >= k THEN 1 ELSE 0 END)"


RANGE = f"f.AppointmentDateTime BETWEEN DATE '{START}' AND DATE '{END}'"

FACT = """
fact AS (
  SELECT o.o_orderkey AS AppointmentID, o.o_custkey AS PatientID,
         l.l_suppkey AS DoctorID, l.l_partkey AS DiagnosisID, l.l_partkey AS MedicationID,
         o.o_orderdate AS AppointmentDateTime,
         CASE o.o_orderstatus WHEN 'F' THEN 'Cancelled' WHEN 'O' THEN 'Scheduled'
                              WHEN 'P' THEN 'Completed' END AS Status,
         o.o_orderpriority AS Symptoms
  FROM orders o LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey
)"""

STAR_DIMS = """
dim_diag AS (
  SELECT p_partkey AS DiagnosisID, concat_ws(' ', p_type, p_brand) AS DiagnosisName,
         p_brand AS ICD10Code FROM part
),
dim_med AS (
  SELECT p_partkey AS MedicationID, p_name AS MedicationName, p_brand AS Manufacturer FROM part
),
dim_doc AS (
  SELECT s.s_suppkey AS DoctorID, s.s_name AS FirstName, split_part(s.s_name, '#', 1) AS LastName,
         n.n_name AS DepartmentName
  FROM supplier s LEFT JOIN nation n ON CAST(s.s_nationkey AS BIGINT) = CAST(n.n_nationkey AS BIGINT)
),
dim_pat AS (
  SELECT c_custkey AS PatientID, c_name AS FirstName, c_mktsegment AS LastName FROM customer
)"""

SNOW_DIMS = """
icd AS (
  SELECT ICD10Code, DENSE_RANK() OVER (ORDER BY ICD10Code) AS ICD10CodeID
  FROM (SELECT DISTINCT p_brand AS ICD10Code FROM part WHERE p_brand IS NOT NULL)
),
snow_diag AS (
  SELECT p.p_partkey AS DiagnosisID, concat_ws(' ', p.p_type, p.p_brand) AS DiagnosisName,
         icd.ICD10CodeID
  FROM part p LEFT JOIN icd ON icd.ICD10Code = p.p_brand
),
dim_diag AS (
  SELECT d.DiagnosisID, d.DiagnosisName, icd.ICD10Code
  FROM snow_diag d JOIN icd ON d.ICD10CodeID = icd.ICD10CodeID
),
dim_med AS (
  SELECT p_partkey AS MedicationID, p_name AS MedicationName, p_brand AS Manufacturer FROM part
),
spec AS (
  SELECT Specialty, DENSE_RANK() OVER (ORDER BY Specialty) AS SpecialtyID
  FROM (SELECT DISTINCT r.r_name AS Specialty FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
        WHERE r.r_name IS NOT NULL)
),
dept AS (
  SELECT CAST(n.n_nationkey AS BIGINT) AS DepartmentID, n.n_name AS DepartmentName, spec.SpecialtyID
  FROM nation n LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
                LEFT JOIN spec ON spec.Specialty = r.r_name
),
dim_doc AS (
  SELECT s.s_suppkey AS DoctorID, s.s_name AS FirstName, split_part(s.s_name, '#', 1) AS LastName,
         dept.DepartmentName, spec.Specialty
  FROM supplier s JOIN dept ON CAST(s.s_nationkey AS BIGINT) = dept.DepartmentID
                  JOIN spec ON dept.SpecialtyID = spec.SpecialtyID
),
dim_pat AS (
  SELECT c_custkey AS PatientID, c_name AS FirstName, c_mktsegment AS LastName FROM customer
)"""


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts)


def q1(dims: str) -> str:
    return _with(FACT, dims, f"""
yearly AS (
  SELECT d.DiagnosisName, d.ICD10Code, CAST(year(f.AppointmentDateTime) AS INTEGER) AS DiagnosisYear,
         COUNT(*) AS DiagnosisCount
  FROM fact f JOIN dim_diag d ON f.DiagnosisID = d.DiagnosisID
  WHERE {RANGE}
  GROUP BY d.DiagnosisName, d.ICD10Code, year(f.AppointmentDateTime)
),
w AS (
  SELECT *, LAG(DiagnosisCount) OVER (PARTITION BY DiagnosisName, ICD10Code ORDER BY DiagnosisYear)
            AS PreviousYearCount
  FROM yearly
)""") + f"""
SELECT DiagnosisName, ICD10Code, DiagnosisYear, DiagnosisCount, PreviousYearCount,
       {pct('DiagnosisCount - PreviousYearCount', 'PreviousYearCount')} AS YoYChangePercentage
FROM w WHERE PreviousYearCount IS NOT NULL
ORDER BY YoYChangePercentage DESC"""


def q2(dims: str) -> str:
    return _with(FACT, dims, f"""
yearly AS (
  SELECT m.MedicationName, m.Manufacturer,
         CAST(year(f.AppointmentDateTime) AS INTEGER) AS PrescriptionYear,
         COUNT(*) AS PrescriptionCount,
         CAST(RANK() OVER (PARTITION BY year(f.AppointmentDateTime) ORDER BY COUNT(*) DESC) AS INTEGER)
           AS RankInYear
  FROM fact f JOIN dim_med m ON f.MedicationID = m.MedicationID
  WHERE {RANGE}
  GROUP BY m.MedicationName, m.Manufacturer, year(f.AppointmentDateTime)
),
w AS (
  SELECT *, LAG(PrescriptionCount) OVER (PARTITION BY MedicationName, Manufacturer
                                         ORDER BY PrescriptionYear) AS PreviousYearCount
  FROM yearly
)""") + f"""
SELECT MedicationName, Manufacturer, PrescriptionYear, PrescriptionCount, RankInYear, PreviousYearCount,
       {pct('PrescriptionCount - PreviousYearCount', 'PreviousYearCount')} AS YoYChangePercentage
FROM w ORDER BY PrescriptionYear, RankInYear"""


def q3(dims: str) -> str:
    return _with(FACT, dims, f"""
pairs AS (
  SELECT strftime(f.AppointmentDateTime, '%Y-%m') AS DiagnosisMonth, f.Symptoms, d.DiagnosisName,
         COUNT(*) AS PairCount
  FROM fact f JOIN dim_diag d ON f.DiagnosisID = d.DiagnosisID
  WHERE {RANGE} AND f.Symptoms IS NOT NULL
  GROUP BY 1, 2, 3
),
w AS (
  SELECT *, CAST(SUM(PairCount) OVER (PARTITION BY Symptoms, DiagnosisName) AS BIGINT) AS TotalPairCount,
            SUM(PairCount) OVER (PARTITION BY DiagnosisMonth) AS MonthTotal
  FROM pairs
)""") + f"""
SELECT DiagnosisMonth, Symptoms, DiagnosisName, PairCount, TotalPairCount,
       {pct('PairCount', 'MonthTotal')} AS PercentageOfMonth
FROM w ORDER BY DiagnosisMonth, PairCount DESC"""


def q3_records(symptoms: str) -> str:
    """Q3 on the fact of records and prescriptions, by ``symptoms`` of a record."""
    return _with(MODEL, STAR_DIMS, f"""
seen AS (
  SELECT strftime(a.AppointmentDateTime, '%Y-%m') AS DiagnosisMonth, {symptoms} AS Symptoms, r.DiagnosisID
  FROM appointments a JOIN records r ON r.AppointmentID = a.AppointmentID
                      LEFT JOIN prescriptions x ON x.AppointmentID = a.AppointmentID
  WHERE a.AppointmentDateTime BETWEEN DATE '{START}' AND DATE '{END}' AND r.Symptoms IS NOT NULL
),
pairs AS (
  SELECT DiagnosisMonth, Symptoms, DiagnosisName, COUNT(*) AS PairCount
  FROM seen JOIN dim_diag USING (DiagnosisID) GROUP BY 1, 2, 3
),
w AS (
  SELECT *, CAST(SUM(PairCount) OVER (PARTITION BY Symptoms, DiagnosisName) AS BIGINT) AS TotalPairCount,
            SUM(PairCount) OVER (PARTITION BY DiagnosisMonth) AS MonthTotal
  FROM pairs
)""") + f"""
SELECT DiagnosisMonth, Symptoms, DiagnosisName, PairCount, TotalPairCount,
       {pct('PairCount', 'MonthTotal')} AS PercentageOfMonth FROM w"""


def q4(in_range: bool = False) -> str:
    rate5 = RATE5
    where = f"WHERE {RANGE}" if in_range else ""
    return _with(FACT, f"""
m AS (
  SELECT strftime(AppointmentDateTime, '%Y-%m') AS AppointmentMonth,
         SUM(CASE WHEN Status = 'Cancelled' THEN 1 ELSE 0 END) AS c, COUNT(*) AS t
  FROM fact f {where} GROUP BY 1
),
r AS (SELECT AppointmentMonth, {rate5} AS rate5 FROM m),
w AS (
  SELECT AppointmentMonth, rate5,
         SUM(rate5) OVER (ORDER BY AppointmentMonth ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS s,
         COUNT(rate5) OVER (ORDER BY AppointmentMonth ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS k
  FROM r
)""") + f"""
SELECT AppointmentMonth, CAST(rate5 AS DOUBLE) / 100000 AS CancellationRate,
       CAST({MEAN6} AS DOUBLE) / 1000000 AS RollingAvgCancellationRate
FROM w ORDER BY AppointmentMonth"""


def q5(dims: str, with_specialty: bool, top_n: int = TOP_N) -> str:
    attrs = "DoctorID, FirstName, LastName, DepartmentName" + (", Specialty" if with_specialty else "")
    d_attrs = ", ".join(f"d.{a.strip()}" for a in attrs.split(","))
    return _with(FACT, dims, f"""
yearly AS (
  SELECT {d_attrs}, CAST(year(f.AppointmentDateTime) AS INTEGER) AS AppointmentYear,
         COUNT(*) AS AppointmentCount
  FROM fact f JOIN dim_doc d ON f.DoctorID = d.DoctorID
  WHERE {RANGE}
  GROUP BY {d_attrs}, year(f.AppointmentDateTime)
),
w AS (
  SELECT *, LAG(AppointmentCount) OVER (PARTITION BY {attrs} ORDER BY AppointmentYear) AS PreviousYearCount
  FROM yearly
)""") + f"""
SELECT {attrs}, AppointmentYear, AppointmentCount, PreviousYearCount,
       {pct('AppointmentCount - PreviousYearCount', 'PreviousYearCount')} AS YoYGrowthPercentage
FROM w WHERE PreviousYearCount IS NOT NULL
ORDER BY YoYGrowthPercentage DESC, DoctorID, AppointmentYear
LIMIT {top_n}"""


def _v1_body(distinct: bool) -> str:
    total = "COUNT(DISTINCT f.AppointmentID)" if distinct else "COUNT(f.AppointmentID)"
    return f"""
  SELECT p.PatientID, p.FirstName, p.LastName, {total} AS TotalAppointments,
         CAST(SUM(CASE WHEN f.Status = 'Cancelled' THEN 1 ELSE 0 END) AS BIGINT) AS CancelledAppointments
  FROM fact f JOIN dim_pat p ON f.PatientID = p.PatientID
  GROUP BY p.PatientID, p.FirstName, p.LastName"""


def _v2_body(distinct: bool) -> str:
    total = "COUNT(DISTINCT f.AppointmentID)" if distinct else "COUNT(f.AppointmentID)"
    return f"""
  SELECT f.PatientID, d.DiagnosisName, d.ICD10Code, m.MedicationName, {total} AS TreatmentCount
  FROM fact f JOIN dim_diag d ON f.DiagnosisID = d.DiagnosisID
              JOIN dim_med m ON f.MedicationID = m.MedicationID
  GROUP BY f.PatientID, d.DiagnosisName, d.ICD10Code, m.MedicationName"""


def v1(dims: str) -> str:
    return _with(FACT, dims, f"v1 AS ({_v1_body(False)})") + " SELECT * FROM v1"


def v2(dims: str) -> str:
    return _with(FACT, dims, f"v2 AS ({_v2_body(False)})") + " SELECT * FROM v2"


def u1(dims: str, high_appts: int = 5, med_appts: int = 3, distinct: bool = False) -> str:
    return _with(FACT, dims, f"""
a AS ({_v1_body(distinct)}),
dts AS ({_v2_body(False)}),
hit AS (
  SELECT pr.PatientID, pr.DiagnosisID,
         MAX(CASE WHEN a.TotalAppointments > {high_appts} OR dts.TreatmentCount > 3 THEN 3
                  WHEN a.TotalAppointments >= {med_appts} OR dts.TreatmentCount >= 2 THEN 2
                  ELSE 1 END) AS lvl
  FROM (SELECT DISTINCT PatientID, DiagnosisID FROM fact) pr
  JOIN dim_diag d ON pr.DiagnosisID = d.DiagnosisID
  JOIN dts ON dts.PatientID = pr.PatientID AND dts.DiagnosisName = d.DiagnosisName
          AND dts.ICD10Code = d.ICD10Code
  JOIN a ON a.PatientID = pr.PatientID
  GROUP BY pr.PatientID, pr.DiagnosisID
)""") + """
SELECT f.AppointmentID, f.PatientID, f.DoctorID, f.DiagnosisID, f.MedicationID, f.Status,
       CASE hit.lvl WHEN 3 THEN 'High' WHEN 2 THEN 'Medium' WHEN 1 THEN 'Low' END AS TreatmentPriority
FROM fact f LEFT JOIN hit ON f.PatientID = hit.PatientID AND f.DiagnosisID = hit.DiagnosisID"""


def q1_strict(dims: str) -> str:
    """Q1 where the previous count only counts if it is from the year before."""
    return _with(FACT, dims, f"""
yearly AS (
  SELECT d.DiagnosisName, d.ICD10Code, CAST(year(f.AppointmentDateTime) AS INTEGER) AS DiagnosisYear,
         COUNT(*) AS DiagnosisCount
  FROM fact f JOIN dim_diag d ON f.DiagnosisID = d.DiagnosisID
  WHERE {RANGE}
  GROUP BY d.DiagnosisName, d.ICD10Code, year(f.AppointmentDateTime)
),
w AS (
  SELECT *, LAG(DiagnosisCount) OVER (PARTITION BY DiagnosisName, ICD10Code ORDER BY DiagnosisYear) AS lag_count,
            LAG(DiagnosisYear) OVER (PARTITION BY DiagnosisName, ICD10Code ORDER BY DiagnosisYear) AS lag_year
  FROM yearly
),
w2 AS (
  SELECT *, CASE WHEN lag_year = DiagnosisYear - 1 THEN lag_count END AS PreviousYearCount FROM w
)""") + f"""
SELECT DiagnosisName, ICD10Code, DiagnosisYear, DiagnosisCount, PreviousYearCount,
       {pct('DiagnosisCount - PreviousYearCount', 'PreviousYearCount')} AS YoYChangePercentage
FROM w2 WHERE PreviousYearCount IS NOT NULL"""


def q4_calendar() -> str:
    """Q4 with a calendar frame: this month and the two calendar months before."""
    rate5 = RATE5
    return _with(FACT, f"""
m AS (
  SELECT strftime(AppointmentDateTime, '%Y-%m') AS AppointmentMonth,
         year(AppointmentDateTime) * 12 + month(AppointmentDateTime) AS idx,
         SUM(CASE WHEN Status = 'Cancelled' THEN 1 ELSE 0 END) AS c, COUNT(*) AS t
  FROM fact GROUP BY 1, 2
),
r AS (SELECT AppointmentMonth, idx, {rate5} AS rate5 FROM m),
w AS (
  SELECT AppointmentMonth, rate5,
         SUM(rate5) OVER (ORDER BY idx RANGE BETWEEN 2 PRECEDING AND CURRENT ROW) AS s,
         COUNT(rate5) OVER (ORDER BY idx RANGE BETWEEN 2 PRECEDING AND CURRENT ROW) AS k
  FROM r
)""") + f"""
SELECT AppointmentMonth, CAST(rate5 AS DOUBLE) / 100000 AS CancellationRate,
       CAST({MEAN6} AS DOUBLE) / 1000000 AS RollingAvgCancellationRate
FROM w"""


def q5_per_doctor(dims: str) -> str:
    """Q5 keeping each doctor's best year (ties: earlier year) before the top-n."""
    return _with(FACT, dims, f"""
yearly AS (
  SELECT d.DoctorID, d.FirstName, d.LastName, d.DepartmentName,
         CAST(year(f.AppointmentDateTime) AS INTEGER) AS AppointmentYear, COUNT(*) AS AppointmentCount
  FROM fact f JOIN dim_doc d ON f.DoctorID = d.DoctorID
  WHERE {RANGE}
  GROUP BY d.DoctorID, d.FirstName, d.LastName, d.DepartmentName, year(f.AppointmentDateTime)
),
w AS (
  SELECT *, LAG(AppointmentCount) OVER (PARTITION BY DoctorID, FirstName, LastName, DepartmentName
                                        ORDER BY AppointmentYear) AS PreviousYearCount
  FROM yearly
),
g AS (
  SELECT *, {pct('AppointmentCount - PreviousYearCount', 'PreviousYearCount')} AS YoYGrowthPercentage
  FROM w WHERE PreviousYearCount IS NOT NULL
),
best AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY DoctorID, FirstName, LastName, DepartmentName
                               ORDER BY YoYGrowthPercentage DESC, AppointmentYear) AS rn
  FROM g
)""") + f"""
SELECT DoctorID, FirstName, LastName, DepartmentName, AppointmentYear, AppointmentCount, PreviousYearCount,
       YoYGrowthPercentage
FROM best WHERE rn = 1
ORDER BY YoYGrowthPercentage DESC, DoctorID, AppointmentYear
LIMIT {TOP_N}"""


def analytic_sql() -> dict[str, str]:
    return {
        "trending_diagnoses_star": q1(STAR_DIMS),
        "trending_diagnoses_snowflake": q1(SNOW_DIMS),
        "medication_trends_star": q2(STAR_DIMS),
        "medication_trends_snowflake": q2(SNOW_DIMS),
        "symptom_diagnosis_star": q3(STAR_DIMS),
        "symptom_diagnosis_snowflake": q3(SNOW_DIMS),
        "rolling_cancellations_star": q4(),
        "rolling_cancellations_snowflake": q4(),
        "top_doctors_star": q5(STAR_DIMS, False),
        "top_doctors_snowflake": q5(SNOW_DIMS, True),
        "trending_diagnoses_strict_year": q1_strict(STAR_DIMS),
        "medication_trends_top3": f"SELECT * FROM ({q2(STAR_DIMS)}) WHERE RankInYear <= 3",
        "rolling_cancellations_calendar": q4_calendar(),
        "top_doctors_per_doctor": q5_per_doctor(STAR_DIMS),
        "appointment_summary": v1(STAR_DIMS),
        "appointment_summary_snowflake": v1(SNOW_DIMS),
        "diagnosis_treatment_summary_star": v2(STAR_DIMS),
        "diagnosis_treatment_summary_snowflake": v2(SNOW_DIMS),
        "treatment_priority": u1(STAR_DIMS),
        "treatment_priority_snowflake": u1(SNOW_DIMS),
        "treatment_priority_distinct": u1(STAR_DIMS, 14, 8, True),
        "treatment_priority_low": f"SELECT * REPLACE (coalesce(TreatmentPriority, 'Low') AS TreatmentPriority) FROM ({u1(STAR_DIMS)})",
        "incremental_appointment_summary": v1(STAR_DIMS),
        "incremental_priorities": f"""
SELECT DISTINCT PatientID, DiagnosisID, TreatmentPriority FROM ({u1(STAR_DIMS)}) WHERE TreatmentPriority IS NOT NULL""",
        "top_doctors_all": q5(STAR_DIMS, False, MANY),
        "symptom_diagnosis_set": q3_records("array_to_string(list_sort(string_split(r.Symptoms, ', ')), ', ')"),
        "symptom_diagnosis_exploded": q3_records("unnest(string_split(r.Symptoms, ', '))"),
        "diagnosis_treatment_summary_distinct": _with(MODEL, STAR_DIMS) + """
SELECT a.PatientID, d.DiagnosisName, d.ICD10Code, m.MedicationName, COUNT(DISTINCT a.AppointmentID) AS TreatmentCount
FROM appointments a JOIN records r ON r.AppointmentID = a.AppointmentID JOIN dim_diag d ON d.DiagnosisID = r.DiagnosisID
JOIN prescriptions x ON x.AppointmentID = a.AppointmentID JOIN dim_med m ON m.MedicationID = x.MedicationID
GROUP BY ALL""",
    }


# ---------------------------------------------------------------------------
# model builders
# ---------------------------------------------------------------------------
FIRST_CONTACT = """
contact AS (
  SELECT c.c_custkey AS ContactID, c.c_custkey AS PatientID, n.n_name AS Address, n.n_name AS City,
         CAST(c.c_nationkey AS VARCHAR) AS State, lpad(CAST(c.c_nationkey AS VARCHAR), 5, '0') AS ZipCode,
         CAST(NULL AS VARCHAR) AS Phone, CAST(NULL AS VARCHAR) AS Email
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
),
first_contact AS (
  SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY PatientID ORDER BY ContactID) AS rn FROM contact)
  WHERE rn = 1
),
patients AS (
  SELECT c_custkey AS PatientID, c_name AS FirstName, c_mktsegment AS LastName,
         CAST(NULL AS DATE) AS DateOfBirth, CAST(NULL AS VARCHAR) AS Gender, printf('%09d', c_custkey) AS SSN
  FROM customer
)"""

SPEC_KEYS = """
spec AS (
  SELECT Specialty, DENSE_RANK() OVER (ORDER BY Specialty) AS SpecialtyID
  FROM (SELECT DISTINCT r.r_name AS Specialty FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
        WHERE r.r_name IS NOT NULL)
)"""

ICD_KEYS = """
icd AS (
  SELECT ICD10Code, DENSE_RANK() OVER (ORDER BY ICD10Code) AS ICD10CodeID
  FROM (SELECT DISTINCT p_brand AS ICD10Code FROM part WHERE p_brand IS NOT NULL)
)"""

DIM_PATIENTS_STAR = _with(FIRST_CONTACT) + """
SELECT p.PatientID, p.FirstName, p.LastName, p.DateOfBirth, p.Gender, p.SSN, fc.Address, fc.City,
       fc.State, fc.ZipCode AS Zipcode, fc.Phone, fc.Email
FROM patients p LEFT JOIN first_contact fc ON p.PatientID = fc.PatientID"""

DIM_DOCTORS_STAR = """
SELECT s.s_suppkey AS DoctorID, s.s_name AS FirstName, split_part(s.s_name, '#', 1) AS LastName,
       printf('MD%06d', s.s_suppkey) AS License, n.n_name AS DepartmentName,
       'Region ' || CAST(n.n_regionkey AS VARCHAR) AS Location, r.r_name AS Specialty
FROM supplier s
LEFT JOIN nation n ON CAST(s.s_nationkey AS BIGINT) = CAST(n.n_nationkey AS BIGINT)
LEFT JOIN region r ON n.n_regionkey = r.r_regionkey"""

DIM_DIAGNOSES_STAR = """
SELECT p_partkey AS DiagnosisID, concat_ws(' ', p_type, p_brand) AS DiagnosisName, p_brand AS ICD10Code
FROM part"""


#: The 14 tables of the model with all that its quality rules need.
MODEL = """
appointments AS (
  SELECT o_orderkey AS AppointmentID, o_custkey AS PatientID, floor(o_totalprice)::BIGINT % 100 AS DoctorID,
         o_orderdate AS AppointmentDateTime, CAST(o_orderdate AS DATE) AS Day,
         CASE o_orderstatus WHEN 'F' THEN 'Cancelled' WHEN 'O' THEN 'Scheduled' WHEN 'P' THEN 'Completed' END AS Status
  FROM orders),
records AS (
  SELECT l_orderkey * 16 + l_linenumber AS RecordID, l_orderkey AS AppointmentID,
         concat_ws(', ', l_returnflag, l_linestatus) AS Symptoms, l_partkey AS DiagnosisID FROM lineitem),
prescriptions AS (
  SELECT l_orderkey * 16 + l_linenumber AS PrescriptionID, l_orderkey AS AppointmentID, l_partkey AS MedicationID,
         CAST(trunc(l_quantity) AS INTEGER)::VARCHAR || 'mg' AS Dosage,
         (['QD', 'BID', 'TID', 'QID'])[((l_linenumber % 4) + 4) % 4 + 1] AS Frequency,
         CAST(l_shipdate AS DATE) AS StartDate, CAST(l_shipdate AS DATE) + CAST(trunc(l_quantity) AS INTEGER) AS EndDate
  FROM lineitem WHERE l_returnflag <> 'N'),
patients AS (
  SELECT c_custkey AS PatientID, printf('%09d', c_custkey) AS SSN,
         DATE '1935-01-01' + CAST(floor(abs(c_acctbal) * 2) AS INTEGER) AS DateOfBirth,
         CASE c_mktsegment WHEN 'BUILDING' THEN 'Male' WHEN 'MACHINERY' THEN 'Female' WHEN 'HOUSEHOLD' THEN 'Other' END AS Gender
  FROM customer),
contacts AS (
  SELECT c.c_custkey AS ContactID, c.c_custkey AS PatientID FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey),
doctors AS (
  SELECT s_suppkey AS DoctorID, printf('MD%06d', s_suppkey) AS License, s_nationkey AS DepartmentID,
         DATE '1992-01-01' + CAST(floor(abs(s_acctbal) / 5) AS INTEGER) AS HireDate FROM supplier),
departments AS (SELECT n_nationkey AS DepartmentID FROM nation),
specialties AS (SELECT n.n_nationkey AS DepartmentID, r.r_name AS Specialty FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey),
diagnoses AS (SELECT p_partkey AS DiagnosisID, p_brand AS ICD10Code FROM part),
codes AS (SELECT DISTINCT p_brand AS ICD10Code FROM part),
medications AS (SELECT p_partkey AS MedicationID FROM part),
allergies AS (
  SELECT p_partkey AS AllergyID,
         CASE p_type WHEN 'ECONOMY' THEN 'Low' WHEN 'STANDARD' THEN 'Medium' WHEN 'PROMO' THEN 'High' ELSE p_type END AS Severity
  FROM part),
bridge AS (SELECT l_orderkey AS PatientID, l_partkey AS AllergyID, CAST(l_shipdate AS DATE) AS DateDiagnosed FROM lineitem),
insurance AS (
  SELECT c_custkey AS InsuranceID, c_custkey AS PatientID, printf('POL%06d', c_custkey) AS PolicyNumber,
         DATE '1995-01-01' + CAST(floor(abs(c_acctbal)) AS INTEGER) % 100 AS EffectiveDate,
         DATE '1995-01-01' + c_nationkey * 10 AS ExpiryDate FROM customer)"""

_TABLES = {  # model table -> name in MODEL
    "Departments": "departments", "DepartmentSpecialty": "specialties", "ICD10Codes": "codes", "Doctors": "doctors",
    "Patients": "patients", "PatientContactInfo": "contacts", "Allergies": "allergies", "PatientAllergies": "bridge",
    "Diagnoses": "diagnoses", "Appointments": "appointments", "MedicalRecords": "records", "Medications": "medications",
    "Prescriptions": "prescriptions", "Insurance": "insurance",
}


def model_report_sql() -> str:
    """Each rule on its own, as the model states it."""
    unique = """Departments.DepartmentID Doctors.DoctorID Doctors.License Patients.PatientID Patients.SSN
        PatientContactInfo.ContactID Allergies.AllergyID PatientAllergies.PatientID+AllergyID Diagnoses.DiagnosisID
        ICD10Codes.ICD10Code Appointments.AppointmentID MedicalRecords.RecordID Medications.MedicationID
        Prescriptions.PrescriptionID Insurance.InsuranceID Insurance.PolicyNumber"""
    references = """DepartmentSpecialty.DepartmentID->Departments Doctors.DepartmentID->Departments
        PatientContactInfo.PatientID->Patients Appointments.PatientID->Patients Appointments.DoctorID->Doctors
        MedicalRecords.AppointmentID->Appointments MedicalRecords.DiagnosisID->Diagnoses Diagnoses.ICD10Code->ICD10Codes
        Prescriptions.MedicationID->Medications PatientAllergies.PatientID->Patients Insurance.PatientID->Patients
        PatientAllergies.AllergyID->Allergies Prescriptions.AppointmentID->Appointments"""
    domains = {
        "Appointments.Status": "'Scheduled', 'Completed', 'Cancelled'", "Patients.Gender": "'Male', 'Female', 'Other'",
        "Allergies.Severity": "'Low', 'Medium', 'High'", "Prescriptions.Frequency": "'QD', 'BID', 'TID', 'QID'",
        "ICD10Codes.ICD10Code": "'A00-B99', 'C00-D49', 'D50-D89', 'E00-E89', 'F01-F99', 'G00-G99', 'H00-H59', 'H60-H95', 'I00-I99', 'J00-J99'",
    }
    out: dict[str, str] = {}
    for rule in unique.split():
        table, keys = rule.split(".")
        cols = keys.replace("+", ", ")
        out[f"unique:{rule}"] = f"SELECT {cols} FROM {_TABLES[table]} GROUP BY {cols} HAVING COUNT(*) > 1"
    for rule in references.split():
        table, rest = rule.split(".")
        col, parent = rest.split("->")
        out[f"fk:{rule}"] = (
            f"SELECT 1 FROM {_TABLES[table]} c WHERE c.{col} IS NOT NULL AND NOT EXISTS "
            f"(SELECT 1 FROM {_TABLES[parent]} p WHERE p.{col} = c.{col})"
        )
    for rule, allowed in domains.items():
        table, col = rule.split(".")
        out[f"domain:{rule}"] = f"SELECT 1 FROM {_TABLES[table]} WHERE {col} IS NULL OR {col} NOT IN ({allowed})"
    out |= {
        "temporal:appointment_after_hire": "SELECT 1 FROM appointments a JOIN doctors d USING (DoctorID) WHERE a.Day - d.HireDate < 30",
        "temporal:appointment_after_birth": "SELECT 1 FROM appointments a JOIN patients p USING (PatientID) WHERE a.Day - p.DateOfBirth < 1825",
        "temporal:allergy_dates": """SELECT 1 FROM bridge b JOIN patients p USING (PatientID)
            WHERE b.DateDiagnosed < p.DateOfBirth + 1825 OR b.DateDiagnosed < DATE '2010-01-01'""",
        "temporal:prescription_length": "SELECT 1 FROM prescriptions WHERE EndDate - StartDate NOT BETWEEN 7 AND 30",
        "temporal:insurance_period": "SELECT 1 FROM insurance WHERE ExpiryDate <= EffectiveDate",
        "business:prescription_needs_completed": """SELECT 1 FROM prescriptions x WHERE EXISTS (SELECT 1 FROM appointments a
            WHERE a.AppointmentID = x.AppointmentID AND coalesce(a.Status, '') <> 'Completed')""",
        "business:max_prescriptions": "SELECT 1 FROM prescriptions GROUP BY AppointmentID HAVING COUNT(*) > 3",
        "business:one_record_per_appointment": "SELECT 1 FROM records GROUP BY AppointmentID HAVING COUNT(*) > 1",
        "business:appointment_has_record": """SELECT 1 FROM appointments a WHERE a.AppointmentID IS NOT NULL
            AND NOT EXISTS (SELECT 1 FROM records r WHERE r.AppointmentID = a.AppointmentID)""",
    }
    return _with(MODEL) + " UNION ALL ".join(f"\nSELECT '{name}' AS rule, COUNT(*) AS violations FROM ({sql})" for name, sql in out.items())


def builder_sql() -> dict[str, str]:
    fact = _with(FACT.replace(
        "o.o_orderpriority AS Symptoms",
        """o.o_orderpriority AS Symptoms, CAST(NULL AS VARCHAR) AS Notes, l.l_orderkey AS RecordID,
         CAST(trunc(l.l_quantity) AS INTEGER)::VARCHAR || 'mg' AS Dosage,
         (['QD', 'BID', 'TID', 'QID'])[((l.l_linenumber % 4) + 4) % 4 + 1] AS Frequency,
         CAST(l.l_shipdate AS DATE) AS StartDate, CAST(l.l_shipdate AS DATE) + 30 AS EndDate""",
    )) + " SELECT * FROM fact"
    return {
        "build_fact": fact,
        "build_fact_from_children": _with(MODEL) + """
SELECT a.AppointmentID, a.PatientID, a.DoctorID, r.DiagnosisID, x.MedicationID, a.AppointmentDateTime, a.Status,
       CAST(NULL AS VARCHAR) AS Notes, r.RecordID, r.Symptoms, x.Dosage, x.Frequency, x.StartDate, x.EndDate
FROM appointments a LEFT JOIN records r ON r.AppointmentID = a.AppointmentID
                    LEFT JOIN prescriptions x ON x.AppointmentID = a.AppointmentID""",
        "stable_keys": """
WITH first_load AS (SELECT Code, DENSE_RANK() OVER (ORDER BY Code) AS CodeID
                    FROM (SELECT DISTINCT p_brand AS Code FROM part WHERE p_brand IS NOT NULL)),
added AS (SELECT DISTINCT concat_ws(' ', p_type, p_name, p_brand) AS Code FROM part
          EXCEPT SELECT Code FROM first_load),
second_load AS (SELECT Code, DENSE_RANK() OVER (ORDER BY Code) + (SELECT max(CodeID) FROM first_load) AS CodeID FROM added)
SELECT Code, CodeID::BIGINT AS CodeID FROM first_load UNION ALL SELECT Code, CodeID::BIGINT FROM second_load""",
        "dim_patients_star": DIM_PATIENTS_STAR,
        "dim_doctors_star": DIM_DOCTORS_STAR,
        "dim_diagnoses_star": DIM_DIAGNOSES_STAR,
        "dim_medications": """
SELECT p_partkey AS MedicationID, p_name AS MedicationName, p_brand AS Manufacturer, p_type AS Description
FROM part""",
        "dim_insurance": """
SELECT c_custkey AS InsuranceID, c_custkey AS PatientID, c_mktsegment AS CompanyName,
       printf('POL%06d', c_custkey) AS PolicyNumber, CAST(NULL AS VARCHAR) AS CoverageDetails,
       CAST(NULL AS DATE) AS EffectiveDate, CAST(NULL AS DATE) AS ExpiryDate
FROM customer""",
        "dim_patient_allergies": """
SELECT l.l_partkey AS AllergyID, l.l_orderkey AS PatientID, p.p_name AS AllergyName, p.p_type AS Severity,
       CAST(l.l_shipdate AS DATE) AS DateDiagnosed
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey""",
        "dim_patients_snowflake": _with(FIRST_CONTACT) + """
SELECT p.PatientID, p.FirstName, p.LastName, p.DateOfBirth, p.Gender, p.SSN, fc.ContactID AS ContactInfoID
FROM patients p LEFT JOIN first_contact fc ON p.PatientID = fc.PatientID""",
        "dim_patient_contact_info": _with(FIRST_CONTACT) + """
SELECT ContactID AS ContactInfoID, Address, City, State, ZipCode AS Zipcode, Phone, Email FROM contact""",
        "dim_doctors_snowflake": """
SELECT s_suppkey AS DoctorID, s_name AS FirstName, split_part(s_name, '#', 1) AS LastName,
       printf('MD%06d', s_suppkey) AS License, CAST(s_nationkey AS BIGINT) AS DepartmentID
FROM supplier""",
        "dim_department_specialty": _with(SPEC_KEYS) + " SELECT SpecialtyID, Specialty FROM spec",
        "dim_departments": _with(SPEC_KEYS) + """
SELECT CAST(n.n_nationkey AS BIGINT) AS DepartmentID, n.n_name AS DepartmentName,
       'Region ' || CAST(n.n_regionkey AS VARCHAR) AS Location, spec.SpecialtyID
FROM nation n LEFT JOIN (SELECT n2.n_nationkey, spec.SpecialtyID
                         FROM nation n2 JOIN region r ON n2.n_regionkey = r.r_regionkey
                         JOIN spec ON spec.Specialty = r.r_name) spec
  ON n.n_nationkey = spec.n_nationkey""",
        "dim_icd10_codes": _with(ICD_KEYS) + " SELECT ICD10CodeID, ICD10Code FROM icd",
        "dim_diagnoses_snowflake": _with(ICD_KEYS) + """
SELECT p.p_partkey AS DiagnosisID, concat_ws(' ', p.p_type, p.p_brand) AS DiagnosisName, icd.ICD10CodeID
FROM part p LEFT JOIN icd ON icd.ICD10Code = p.p_brand""",
        "snowflake_to_star_patients": DIM_PATIENTS_STAR,
        "snowflake_to_star_doctors": DIM_DOCTORS_STAR,
        "snowflake_to_star_diagnoses": DIM_DIAGNOSES_STAR,
    }


# ---------------------------------------------------------------------------
# quality rules
# ---------------------------------------------------------------------------
QUALITY_RULES = {
    "unique_order_key": "SELECT o_orderkey, COUNT(*) AS n FROM orders GROUP BY o_orderkey HAVING COUNT(*) > 1",
    "unique_line_key": """
SELECT l_orderkey, l_linenumber, COUNT(*) AS n FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1""",
    "fk_line_order": """
SELECT * FROM lineitem l WHERE l.l_orderkey IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = l.l_orderkey)""",
    "fk_order_line": """
SELECT * FROM orders o WHERE o.o_orderkey IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)""",
    "temporal_ship_after_order": """
SELECT l.l_orderkey, l.l_linenumber, o.o_orderdate, l.l_shipdate
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
WHERE o.o_orderdate IS NOT NULL AND l.l_shipdate IS NOT NULL
  AND date_diff('day', CAST(o.o_orderdate AS DATE), CAST(l.l_shipdate AS DATE)) < 0""",
    "domain_order_status": """
SELECT * FROM orders WHERE NOT coalesce(o_orderstatus IN ('F', 'O'), false)""",
    "max_three_lines": """
SELECT l_orderkey, COUNT(*) AS n FROM lineitem GROUP BY l_orderkey HAVING COUNT(*) > 3""",
    "lines_only_when_completed": """
SELECT * FROM lineitem l
WHERE l.l_orderkey IN (SELECT o_orderkey FROM orders WHERE NOT coalesce(o_orderstatus = 'P', false))""",
}


def quality_sql() -> dict[str, str]:
    report = " UNION ALL ".join(
        f"SELECT '{rule}' AS rule, COUNT(*) AS violations FROM ({sql})" for rule, sql in QUALITY_RULES.items()
    )
    return {
        "check_unique": QUALITY_RULES["unique_line_key"],
        "check_unique_clean": QUALITY_RULES["unique_order_key"],
        "check_foreign_key": QUALITY_RULES["fk_line_order"],
        "check_foreign_key_reverse": QUALITY_RULES["fk_order_line"],
        "check_temporal": QUALITY_RULES["temporal_ship_after_order"],
        "check_domain": QUALITY_RULES["domain_order_status"],
        "check_business": QUALITY_RULES["max_three_lines"],
        "check_business_status": QUALITY_RULES["lines_only_when_completed"],
        "quality_report": report,
        "model_report": model_report_sql(),
    }


# ---------------------------------------------------------------------------
# seeded derivations
# ---------------------------------------------------------------------------
def bucket(key: str, n: int | str, seed: str = "") -> str:
    """md5(seed || key) -> first 60 bits -> mod n."""
    return f"({draw(key, seed)} % {n})"


def draw(key: str, seed: str = "") -> str:
    return f"('0x' || substr(md5('{seed}' || CAST({key} AS VARCHAR)), 1, 15))::BIGINT"


def derive_sql() -> dict[str, str]:
    d, fine, whole = draw("o_orderkey", "status"), draw("o_orderkey", "fine"), 2**60
    return {
        "weighted_bucket": f"""
SELECT o_orderkey, CASE WHEN {d} < {whole // 10} THEN 'Scheduled' WHEN {d} < {whole * 9 // 10} THEN 'Completed'
       ELSE 'Cancelled' END AS DrawnStatus
FROM orders""",
        "weighted_bucket_fine": f"""
SELECT o_orderkey, CASE WHEN {fine} < {whole * 4 // 1000} THEN 'Rare' WHEN {fine} < {whole * 129 // 1000} THEN 'Some'
       ELSE 'Most' END AS Drawn
FROM orders""",
        "sample_k_per_key": """
SELECT * FROM (
  SELECT o_custkey, o_orderkey,
         CAST(ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY md5('sample|' || o_custkey || '|' || o_orderkey),
                                 o_orderkey) AS INTEGER) AS SampleRank
  FROM orders) WHERE SampleRank <= 2""",
        "sample_k_per_key_column": """
SELECT * FROM (
  SELECT l_suppkey, l_partkey,
         CAST(ROW_NUMBER() OVER (PARTITION BY l_suppkey ORDER BY md5('allergy|' || l_suppkey || '|' || l_partkey),
                                 l_partkey) AS INTEGER) AS SampleRank
  FROM (SELECT DISTINCT l_suppkey, l_partkey FROM lineitem)) WHERE SampleRank <= l_suppkey % 4""",
        "fan_out": """
SELECT o_orderkey, CAST(i AS BIGINT) AS ChildIndex
FROM orders, LATERAL (SELECT unnest(range(1, ((o_orderkey % 4) + 4) % 4 + 1)) AS i)""",
        "assign_foreign_key": f"""
WITH s AS (SELECT s_suppkey, DENSE_RANK() OVER (ORDER BY s_suppkey) AS no FROM (SELECT DISTINCT s_suppkey
           FROM supplier WHERE s_suppkey IS NOT NULL)),
     n AS (SELECT COUNT(*) AS cnt FROM s)
SELECT o.o_orderkey, s.s_suppkey AS AssignedDoctorID
FROM orders o, n LEFT JOIN s ON s.no = {bucket('o.o_orderkey', 'n.cnt', 'doctor')} + 1""",
        "null_out_fraction": f"""
SELECT o_orderkey, CASE WHEN {draw('o_orderkey', 'notes')} < {whole * 3 // 10} THEN NULL ELSE o_orderpriority END
       AS Notes
FROM orders""",
        "null_out_fraction_fine": f"""
SELECT o_orderkey, CASE WHEN {fine} < {whole * 4 // 1000} THEN NULL ELSE o_orderpriority END AS Notes
FROM orders""",
        "lookup_default": """
SELECT c.c_custkey, coalesce(n.n_name, 'Unknown') AS NationName
FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey""",
        "status_lookup": """
SELECT o_orderkey, coalesce(CASE o_orderstatus WHEN 'F' THEN 'Cancelled' WHEN 'O' THEN 'Scheduled'
                                               WHEN 'P' THEN 'Completed' END, 'Unknown') AS Status
FROM orders""",
        "capitalize_names": """
SELECT p_partkey, upper(substr(p_name, 1, 1)) || lower(substr(p_name, 2)) AS MedicationName FROM part""",
        "format_code": "SELECT s_suppkey, printf('MD%06d', s_suppkey) AS License FROM supplier",
        "apportion": """
WITH per AS (SELECT o_orderpriority, COUNT(*) AS n FROM orders GROUP BY 1),
t AS (SELECT SUM(n)::DOUBLE AS total FROM per)
SELECT o_orderpriority, CAST(i AS BIGINT) AS ItemIndex
FROM per, t, LATERAL (SELECT unnest(range(1, CAST(floor(t.total * (n::DOUBLE / t.total)) AS BIGINT) + 1)) AS i)""",
        "clamp_range": """
SELECT * FROM (
  SELECT l.l_orderkey, l.l_linenumber,
         greatest(CAST(o.o_orderdate AS DATE) + 30, CAST(l.l_shipdate AS DATE)) AS RangeStart,
         CAST(o.o_orderdate AS DATE) + 120 AS e
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)
WHERE RangeStart < e""".replace("SELECT * FROM (", "SELECT l_orderkey, l_linenumber, RangeStart FROM ("),
        "derive_period": f"""
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS StartDate,
       CAST(o_orderdate AS DATE) + CAST({bucket('o_orderkey', 24, 'period')} + 7 AS INTEGER) AS EndDate
FROM orders""",
    }


# ---------------------------------------------------------------------------
# generic operators over events by day
# ---------------------------------------------------------------------------
def minute_rates(frame: str) -> str:
    """Error rate by minute and its mean over a frame of minutes."""
    return f"""
WITH m AS (SELECT date_trunc('minute', ts) AS slot, COUNT(*) FILTER (WHERE event_type = 'error') AS c, COUNT(*) AS t
           FROM events GROUP BY 1),
r AS (SELECT slot, {RATE5} AS rate5 FROM m),
w AS (SELECT slot, rate5, SUM(rate5) OVER (ORDER BY slot {frame}) AS s, COUNT(rate5) OVER (ORDER BY slot {frame}) AS k FROM r)
SELECT strftime(slot, '%Y-%m-%d %H:%M') AS EventMinute, CAST(rate5 AS DOUBLE) / 100000 AS ErrorRate,
       CAST({MEAN6} AS DOUBLE) / 1000000 AS RollingErrorRate
FROM w"""


DAILY = """
daily AS (
  SELECT event_type, CAST(ts AS DATE) AS EventDay, COUNT(*) AS EventCount FROM events GROUP BY 1, 2
)"""

PER_USER = """
per_user AS (
  SELECT user_id, COUNT(*) AS Events,
         COUNT(*) FILTER (WHERE event_type = 'click') AS Clicks,
         COUNT(*) FILTER (WHERE event_type = 'error') AS Errors
  FROM events GROUP BY user_id
)"""


def generic_sql() -> dict[str, str]:
    rate5 = RATE5
    return {
        "period_change": _with(DAILY) + f"""
SELECT event_type, EventDay, EventCount, PreviousCount,
       {pct('EventCount - PreviousCount', 'PreviousCount')} AS ChangePercentage
FROM (SELECT *, LAG(EventCount) OVER (PARTITION BY event_type ORDER BY EventDay) AS PreviousCount FROM daily)""",
        "rank_in_period": _with(DAILY) + """
SELECT event_type, EventDay, EventCount,
       CAST(RANK() OVER (PARTITION BY EventDay ORDER BY EventCount DESC) AS INTEGER) AS RankInDay
FROM daily""",
        "share_of_total": _with(DAILY) + f"""
SELECT event_type, EventDay, EventCount, DayTotal, {pct('EventCount', 'DayTotal')} AS SharePercentage
FROM (SELECT *, CAST(SUM(EventCount) OVER (PARTITION BY EventDay) AS BIGINT) AS DayTotal FROM daily)""",
        "rolling_rate": f"""
WITH d AS (
  SELECT strftime(ts, '%Y-%m-%d') AS EventDay, COUNT(*) FILTER (WHERE event_type = 'error') AS c,
         COUNT(*) AS t
  FROM events GROUP BY 1),
r AS (SELECT EventDay, {rate5} AS rate5 FROM d),
w AS (SELECT EventDay, rate5,
             SUM(rate5) OVER (ORDER BY EventDay ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS s,
             COUNT(rate5) OVER (ORDER BY EventDay ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS k
      FROM r)
SELECT EventDay, CAST(rate5 AS DOUBLE) / 100000 AS ErrorRate,
       CAST({MEAN6} AS DOUBLE) / 1000000 AS RollingErrorRate
FROM w""",
        "rolling_rate_minute": minute_rates("ROWS BETWEEN 59 PRECEDING AND CURRENT ROW"),
        "rolling_rate_minute_calendar": minute_rates("RANGE BETWEEN INTERVAL 59 MINUTE PRECEDING AND CURRENT ROW"),
        "period_change_minute": f"""
WITH per AS (SELECT event_type, strftime(ts, '%Y-%m-%d %H:%M') AS EventMinute, COUNT(*) AS EventCount FROM events GROUP BY 1, 2),
w AS (SELECT *, LAG(EventCount) OVER (PARTITION BY event_type ORDER BY EventMinute) AS PreviousCount FROM per)
SELECT *, {pct('EventCount - PreviousCount', 'PreviousCount')} AS ChangePercentage FROM w""",
        "rank_in_period_value": """
SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS OrderYear, o_totalprice,
       CAST(RANK() OVER (PARTITION BY year(o_orderdate) ORDER BY o_totalprice DESC) AS INTEGER) AS RankInYear
FROM orders""",
        "rank_in_period_decimal": """
WITH spent AS (SELECT CAST(ts AS DATE) AS EventDay, user_id, SUM(CAST(value AS DECIMAL(12,2))) AS Spent FROM events GROUP BY 1, 2)
SELECT EventDay, user_id, CAST(Spent AS DOUBLE) AS Spent,
       CAST(RANK() OVER (PARTITION BY EventDay ORDER BY Spent DESC) AS INTEGER) AS RankInDay
FROM spent""",
        "conditional_counts": _with(PER_USER) + " SELECT * FROM per_user",
        "tiered_label": _with(PER_USER) + """
SELECT user_id, Events, Errors,
       CASE WHEN Errors >= 20 THEN 'High' WHEN Events >= 100 THEN 'Medium' ELSE 'Low' END AS Tier
FROM per_user""",
    }


def primitive_sql() -> dict[str, str]:
    return {
        "between_date_boundary": """
SELECT event_id, ts FROM events WHERE ts BETWEEN DATE '2024-01-01' AND DATE '2024-01-02'""",
        "between_date_boundary_inclusive": """
SELECT event_id, ts FROM events WHERE ts >= DATE '2024-01-01' AND ts < DATE '2024-01-03'""",
        "csv_roundtrip": DIM_PATIENTS_STAR,
        "symptom_counts": """
SELECT Symptom, COUNT(*) AS Visits
FROM (SELECT unnest(string_split(p_name, ' ')) AS Symptom FROM part) GROUP BY Symptom""",
    }


def sql_surface_sql() -> dict[str, str]:
    return {
        "sql_trending_diagnoses": q1(STAR_DIMS),
        "sql_trending_diagnoses_snowflake": q1(SNOW_DIMS),
        "sql_medication_trends": q2(STAR_DIMS),
        "sql_symptom_diagnosis": q3(STAR_DIMS),
        "sql_rolling_cancellations": q4(in_range=True),
        "sql_top_doctors": q5(STAR_DIMS, False),
        "sql_top_doctors_all": q5(STAR_DIMS, False, MANY),
        "sql_medication_trends_snowflake": q2(SNOW_DIMS),
        "sql_symptom_diagnosis_snowflake": q3(SNOW_DIMS),
        "sql_rolling_cancellations_snowflake": q4(in_range=True),
        "sql_top_doctors_snowflake": q5(SNOW_DIMS, True),
        "sql_trending_diagnoses_top": q1(STAR_DIMS).replace(
            "ORDER BY YoYChangePercentage DESC",
            f"ORDER BY YoYChangePercentage DESC, DiagnosisName, ICD10Code, DiagnosisYear LIMIT {TOP_N}",
        ),
        "sql_appointment_summary": v1(STAR_DIMS),
        "sql_diagnosis_treatment_summary": v2(SNOW_DIMS),
    }


def all_sql() -> dict[str, str]:
    out: dict[str, str] = {}
    for group in (analytic_sql, builder_sql, quality_sql, derive_sql, generic_sql, primitive_sql,
                  sql_surface_sql):
        out.update(group())
    return out
