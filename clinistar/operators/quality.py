"""Data-quality rules of the generator's validation, as distributed checks (D1-D6).

Each ``check_*`` returns the *violating* rows as a lazy DataFrame (empty on
clean data), so a caller can count, sample or store them; nothing is
collected. ``quality_report`` turns a set of checks into one row per rule
with its violation count - a union of global counts, still lazy.

A rule set is better stated as ``Rule`` objects: ``rule_report`` compiles them
into one plan that reads every table once, whatever the number of rules.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType


# D1 -----------------------------------------------------------------------
def check_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once: keys..., ``n``."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


# D2 -----------------------------------------------------------------------
def check_foreign_key(
    child: DataFrame, child_keys: Sequence[str], parent: DataFrame, parent_keys: Sequence[str],
) -> DataFrame:
    """Child rows whose (non-NULL) foreign key has no parent row."""
    pk = parent.select(*[F.col(p).alias(c) for p, c in zip(parent_keys, child_keys)]).distinct()
    present = F.lit(True)
    for c in child_keys:
        present = present & F.col(c).isNotNull()
    return child.where(present).join(pk, list(child_keys), "left_anti")


# D3 -----------------------------------------------------------------------
def check_temporal(
    df: DataFrame, earlier: str | Column, later: str | Column,
    min_days: int | None = 0, max_days: int | None = None, strict: bool = False,
) -> DataFrame:
    """Rows where ``later`` is not within [min_days, max_days] days after
    ``earlier`` (``strict``: more than ``min_days``). NULL dates are not
    judged. Covers: appointment >= hire + 30 d, allergy >= birth + 5*365 d,
    prescription end 7..30 d after start, effective < expiry."""
    e = F.col(earlier) if isinstance(earlier, str) else earlier
    l = F.col(later) if isinstance(later, str) else later
    gap = F.datediff(l, e)
    bad = F.lit(False)
    if min_days is not None:
        bad = bad | ((gap <= min_days) if strict else (gap < min_days))
    if max_days is not None:
        bad = bad | (gap > max_days)
    return df.where(e.isNotNull() & l.isNotNull() & bad)


# D4 -----------------------------------------------------------------------
def check_domain(df: DataFrame, col: str, allowed: Iterable, allow_null: bool = False) -> DataFrame:
    """Rows whose ``col`` is outside ``allowed`` (NULL is a violation unless
    ``allow_null``)."""
    inside = F.col(col).isin(list(allowed))
    if allow_null:
        return df.where(F.col(col).isNotNull() & ~inside)
    return df.where(~F.coalesce(inside, F.lit(False)))


# D5 -----------------------------------------------------------------------
def check_max_children(child: DataFrame, key: str, max_n: int) -> DataFrame:
    """Parents with more than ``max_n`` children: key, ``n``. (At most 3
    prescriptions per appointment; exactly one record per appointment.)"""
    return child.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > max_n)


def check_children_only_when(
    parent: DataFrame, key: str, allowed: Column, child: DataFrame, child_key: str | None = None,
) -> DataFrame:
    """Children whose parent fails ``allowed`` (only completed appointments
    have prescriptions)."""
    ck = child_key or key
    bad_parents = parent.where(~F.coalesce(allowed, F.lit(False))).select(F.col(key).alias(ck)).distinct()
    return child.join(bad_parents, ck, "left_semi")


# D6 -----------------------------------------------------------------------
def quality_report(checks: Mapping[str, DataFrame]) -> DataFrame:
    """One row per rule: ``rule``, ``violations`` (bigint)."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("violations")).select(F.lit(name).alias("rule"), "violations")
        for name, df in checks.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ---------------------------------------------------------------------------
# Rules, and their compilation into one pass
# ---------------------------------------------------------------------------
@dataclass(frozen=True)
class Role:
    """Columns of a table that name an entity, e.g. Prescriptions.AppointmentID."""

    table: str
    columns: tuple[str, ...]


Expression = Callable[[], Column]  # columns need a session, rules don't


@dataclass(frozen=True)
class Unique:
    """No key twice; counts the keys that are."""

    name: str
    role: Role

    def violations(self, t: Mapping[str, DataFrame]) -> DataFrame:
        return check_unique(t[self.role.table], self.role.columns)


@dataclass(frozen=True)
class References:
    """Every key of ``child`` is one of ``parent``; counts child rows."""

    name: str
    child: Role
    parent: Role

    def violations(self, t):
        return check_foreign_key(t[self.child.table], self.child.columns, t[self.parent.table], self.parent.columns)


@dataclass(frozen=True)
class AtMost:
    """At most ``n`` rows a key; counts keys."""

    name: str
    child: Role
    n: int

    def violations(self, t):
        (key,) = self.child.columns
        return check_max_children(t[self.child.table], key, self.n)


@dataclass(frozen=True)
class OnlyWhen:
    """Children only of parents that are ``allowed``; counts child rows that
    have a parent which isn't."""

    name: str
    child: Role
    parent: Role
    allowed: Expression

    def violations(self, t):
        (key,), (fk,) = self.parent.columns, self.child.columns
        return check_children_only_when(t[self.parent.table], key, self.allowed(), t[self.child.table], fk)


@dataclass(frozen=True)
class NotBefore:
    """``day`` of a child is at least ``min_days`` after ``since`` of its
    parent; counts pairs of a child and a parent. NULL days aren't judged."""

    name: str
    child: Role
    day: Expression
    parent: Role
    since: Expression
    min_days: int

    def violations(self, t):
        parent = t[self.parent.table].select(*[F.col(p).alias(c) for p, c in zip(self.parent.columns, self.child.columns)], self.since().alias("_since"))
        child = t[self.child.table].withColumn("_day", self.day())
        return check_temporal(child.join(parent, list(self.child.columns)), "_since", "_day", min_days=self.min_days).drop("_since", "_day")


@dataclass(frozen=True)
class Row:
    """No row is ``bad``; counts rows. ``bad`` is never NULL."""

    name: str
    table: str
    bad: Expression

    def violations(self, t):
        return t[self.table].where(self.bad())


Rule = Unique | References | AtMost | OnlyWhen | NotBefore | Row


def _entities(rules: Sequence[Rule]) -> dict[Role, int]:
    """A number for each role; roles that a rule compares have the same."""
    up: dict[Role, Role] = {}

    def top(r: Role) -> Role:
        while up.setdefault(r, r) != r:
            r = up[r]
        return r

    for rule in rules:
        roles = [getattr(rule, x) for x in ("role", "parent", "child") if hasattr(rule, x)]
        for r in roles:
            up[top(r)] = top(roles[0])
    tops = sorted({top(r) for r in up}, key=lambda r: (r.table, r.columns))
    return {r: tops.index(top(r)) for r in up}


def rule_report(tables: Mapping[str, DataFrame], rules: Sequence[Rule]) -> DataFrame:
    """One row per rule: ``rule``, ``violations``; one lazy plan.

    Every table is read once. A row gives one small record per role it plays,
    the entity and the key's value; one per day that a rule compares; and one
    per row rule it breaks. Keys keep their types: whole numbers are not
    made text. Three aggregates follow:

    1. records by key (and day): how often each role names it, and whether it
       is barred. They are counted before they move, so a key with a third of
       all rows is one record a task, or as many as it has distinct days;
    2. what each rule finds at a key, added up per entity before it moves; only
       days stay apart;
    3. behind a window over the days of a key, which adds up the children
       before each parent's day, a row per entity with the sums of all rules.
    """
    entity = _entities(rules)
    roles: dict[int, list[Role]] = {}
    for role, no in entity.items():
        roles.setdefault(no, []).append(role)
    slot = {role: i for of in roles.values() for i, role in enumerate(of)}
    flags: dict[Role, Expression] = {}
    for r in rules:
        if isinstance(r, OnlyWhen) and flags.setdefault(r.parent, r.allowed) is not r.allowed:
            raise ValueError(f"two conditions on {r.parent}")

    # columns of a key: whole numbers in n0, n1, ..., all others as text in s0, s1, ...
    columns: dict[int, list[str]] = {}
    for no, of in roles.items():
        whole = [all(isinstance(tables[r.table].schema[c].dataType, IntegralType) for r, c in zip(of, same)) for same in zip(*(r.columns for r in of))]
        columns[no] = [f"n{sum(whole[:k])}" if w else f"s{k - sum(whole[:k])}" for k, w in enumerate(whole)]
    keys = sorted({c for of in columns.values() for c in of})
    kind = {c: "long" if c[0] == "n" else "string" for c in keys}

    first = max(entity.values(), default=-1) + 1  # compared days have numbers of their own, row rules those below 0
    own = {i: first + i if isinstance(r, NotBefore) else -1 - i for i, r in enumerate(rules) if isinstance(r, NotBefore | Row)}

    def record(no: int, place: int, role: Role | None = None, day: Column | None = None, barred: Column | None = None) -> Column:
        key = dict(zip(columns[entity[role]], role.columns)) if role else {}
        return F.struct(
            F.lit(no).alias("entity"), *[(F.col(key[c]) if c in key else F.lit(None)).cast(kind[c]).alias(c) for c in keys],
            (F.lit(None).cast("int") if day is None else day).alias("day"), F.lit(place).alias("slot"),
            (F.lit(False) if barred is None else barred).alias("barred"),
        )

    def dated(i: int, place: int, role: Role, day: Column, days: int) -> Column:
        day = F.unix_date(day.cast("date")) + days
        judged = reduce(Column.__and__, (F.col(c).isNotNull() for c in role.columns), day.isNotNull())
        return F.when(judged, record(own[i], place, role, day))

    parts = []
    for name in dict.fromkeys([*(role.table for role in entity), *(r.table for r in rules if isinstance(r, Row))]):
        records = [
            record(no, slot[role], role, barred=~F.coalesce(flags[role](), F.lit(False)) if role in flags else None)
            for role, no in entity.items() if role.table == name
        ]
        for i, r in enumerate(rules):
            if isinstance(r, Row) and r.table == name:
                records.append(F.when(r.bad(), record(own[i], 0)))
            if isinstance(r, NotBefore) and r.child.table == name:
                records.append(dated(i, 0, r.child, r.day(), 0))
            if isinstance(r, NotBefore) and r.parent.table == name:
                records.append(dated(i, 1, r.parent, r.since(), r.min_days))
        parts.append(tables[name].select(F.explode(F.array(*records)).alias("r")).where("r is not null").select("r.*"))
    every = reduce(DataFrame.unionAll, parts)
    slots = range(max(2, *map(len, roles.values())))
    counts = every.groupBy("entity", *keys, "day").agg(
        *[F.count_if(F.col("slot") == k).alias(f"_{k}") for k in slots], F.max("barred").alias("barred")
    )

    # what rules ask of a key: the same question has the same column, whatever the entity
    lacks = [F.col("entity").isin([no for no, of in columns.items() if c in of]) & F.col(c).isNull() for c in keys]
    counts = counts.withColumn("whole", ~reduce(Column.__or__, lacks))
    asked: dict[str, Column] = {"rows": F.col("_0"), "pairs": F.lit(0).cast("long")}
    answer: list[tuple[int, str]] = []
    for i, r in enumerate(rules):
        if isinstance(r, Row | NotBefore):
            answer.append((own[i], "rows" if isinstance(r, Row) else "pairs"))
            continue
        child = slot[r.role if isinstance(r, Unique) else r.child]
        n = F.col(f"_{child}")
        if isinstance(r, Unique | AtMost):
            most = 1 if isinstance(r, Unique) else r.n
            question, found = f"over {most}: {child}", (n > most).cast("long")
        elif isinstance(r, References):
            question, found = f"{child} without {slot[r.parent]}", F.when(F.col("whole") & (F.col(f"_{slot[r.parent]}") == 0), n)
        else:
            question, found = f"{child} barred", F.when(F.col("whole") & F.col("barred"), n)
        asked[question] = found
        answer.append((entity[r.role if isinstance(r, Unique) else r.child], question))
    number = {question: k for k, question in enumerate(asked)}
    has_day = F.col("entity") >= first
    sums = counts.groupBy("entity", *[F.when(has_day, F.col(c)).alias(c) for c in keys], "day").agg(
        *[F.sum(found).alias(f"q{k}") for k, found in enumerate(asked.values())], F.sum("_0").alias("children"), F.sum("_1").alias("parents")
    )
    before = Window.partitionBy(*keys, "entity").orderBy("day").rangeBetween(Window.unboundedPreceding, -1)
    pairs = F.when(has_day, F.col("parents") * F.sum("children").over(before))
    found = sums.withColumn(f"q{number['pairs']}", pairs).groupBy("entity").agg(F.array(*[F.sum(f"q{k}") for k in number.values()]).alias("found"))

    spark = next(iter(tables.values())).sparkSession
    names = spark.createDataFrame([(r.name, no, number[question]) for r, (no, question) in zip(rules, answer)], "rule string, entity int, question int")
    n = F.get("found", F.col("question"))
    return names.join(found, "entity", "left").select("rule", F.coalesce(n, F.lit(0)).cast("long").alias("violations"))


# ---------------------------------------------------------------------------
# The reference model's rule set over the 14 OLTP tables
# ---------------------------------------------------------------------------
# Fixed values of the reference model.
# 1:N relationships as (parent, key, child, foreign key), in the model's order;
# the last two are links of the generator's tables (allergy master, and the
# appointment link we require on prescriptions).
RELATIONSHIPS = (
    ("Departments", "DepartmentID", "DepartmentSpecialty", "DepartmentID"),
    ("Departments", "DepartmentID", "Doctors", "DepartmentID"),
    ("Patients", "PatientID", "PatientContactInfo", "PatientID"),
    ("Patients", "PatientID", "Appointments", "PatientID"),
    ("Doctors", "DoctorID", "Appointments", "DoctorID"),
    ("Appointments", "AppointmentID", "MedicalRecords", "AppointmentID"),
    ("Diagnoses", "DiagnosisID", "MedicalRecords", "DiagnosisID"),
    ("ICD10Codes", "ICD10Code", "Diagnoses", "ICD10Code"),
    ("Medications", "MedicationID", "Prescriptions", "MedicationID"),
    ("Patients", "PatientID", "PatientAllergies", "PatientID"),
    ("Patients", "PatientID", "Insurance", "PatientID"),
    ("Allergies", "AllergyID", "PatientAllergies", "AllergyID"),
    ("Appointments", "AppointmentID", "Prescriptions", "AppointmentID"),
)
# Keys that must be unique: primary keys and the generator's asserted ones.
UNIQUE_KEYS = (
    ("Departments", ("DepartmentID",)), ("Doctors", ("DoctorID",)), ("Doctors", ("License",)),
    ("Patients", ("PatientID",)), ("Patients", ("SSN",)), ("PatientContactInfo", ("ContactID",)),
    ("Allergies", ("AllergyID",)), ("PatientAllergies", ("PatientID", "AllergyID")),
    ("Diagnoses", ("DiagnosisID",)), ("ICD10Codes", ("ICD10Code",)),
    ("Appointments", ("AppointmentID",)), ("MedicalRecords", ("RecordID",)),
    ("Medications", ("MedicationID",)), ("Prescriptions", ("PrescriptionID",)),
    ("Insurance", ("InsuranceID",)), ("Insurance", ("PolicyNumber",)),
)
# Value domains.
DOMAINS = (
    ("Appointments", "Status", ("Scheduled", "Completed", "Cancelled")),
    ("Patients", "Gender", ("Male", "Female", "Other")),
    ("Allergies", "Severity", ("Low", "Medium", "High")),
    ("Prescriptions", "Frequency", ("QD", "BID", "TID", "QID")),
    ("ICD10Codes", "ICD10Code", (
        "A00-B99", "C00-D49", "D50-D89", "E00-E89", "F01-F99",
        "G00-G99", "H00-H59", "H60-H95", "I00-I99", "J00-J99",
    )),
)
# Temporal rules of the generator: appointments start 30 days after hire and
# 5*365 days after birth; allergies are diagnosed no earlier than 5*365 days
# after birth nor before 2010-01-01; prescriptions last 7 to 30 days.
MIN_DAYS_AFTER_HIRE = 30
MIN_DAYS_AFTER_BIRTH = 5 * 365
ALLERGY_RECORDS_START = "2010-01-01"
PRESCRIPTION_DAYS = (7, 30)
MAX_PRESCRIPTIONS = 3


def _outside(col: str, allowed: tuple[str, ...]) -> Expression:
    return lambda: ~F.coalesce(F.col(col).isin(list(allowed)), F.lit(False))


def _gap(earlier: str, later: str, bad: Callable[[Column], Column]) -> Expression:
    return lambda: F.coalesce(bad(F.datediff(F.col(later), F.col(earlier))), F.lit(False))


def _appointment_day() -> Column:
    return F.to_date("AppointmentDateTime")


def _earliest_allergy() -> Column:
    return F.greatest(F.date_add("DateOfBirth", MIN_DAYS_AFTER_BIRTH), F.lit(ALLERGY_RECORDS_START).cast("date"))


def model_rules() -> list[Rule]:
    """Every rule of the reference model."""
    lo, hi = PRESCRIPTION_DAYS
    appointment, record, prescription = (Role(t, ("AppointmentID",)) for t in ("Appointments", "MedicalRecords", "Prescriptions"))
    doctor, patient = Role("Doctors", ("DoctorID",)), Role("Patients", ("PatientID",))
    rules: list[Rule] = [Unique(f"unique:{t}.{'+'.join(keys)}", Role(t, keys)) for t, keys in UNIQUE_KEYS]
    rules += [
        References(f"fk:{child}.{fk}->{parent}", Role(child, (fk,)), Role(parent, (pk,)))
        for parent, pk, child, fk in RELATIONSHIPS
    ]
    rules += [Row(f"domain:{t}.{col}", t, _outside(col, allowed)) for t, col, allowed in DOMAINS]
    return rules + [
        NotBefore("temporal:appointment_after_hire", Role("Appointments", ("DoctorID",)), _appointment_day,
                  doctor, lambda: F.col("HireDate"), MIN_DAYS_AFTER_HIRE),
        NotBefore("temporal:appointment_after_birth", Role("Appointments", ("PatientID",)), _appointment_day,
                  patient, lambda: F.col("DateOfBirth"), MIN_DAYS_AFTER_BIRTH),
        NotBefore("temporal:allergy_dates", Role("PatientAllergies", ("PatientID",)), lambda: F.col("DateDiagnosed"),
                  patient, _earliest_allergy, 0),
        Row("temporal:prescription_length", "Prescriptions", _gap("StartDate", "EndDate", lambda d: (d < lo) | (d > hi))),
        Row("temporal:insurance_period", "Insurance", _gap("EffectiveDate", "ExpiryDate", lambda d: d <= 0)),
        OnlyWhen("business:prescription_needs_completed", prescription, appointment, lambda: F.col("Status") == "Completed"),
        AtMost("business:max_prescriptions", prescription, MAX_PRESCRIPTIONS),
        AtMost("business:one_record_per_appointment", record, 1),
        References("business:appointment_has_record", appointment, record),
    ]


def model_checks(oltp: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The violating rows of every rule of the reference model (empty on clean
    data). For their numbers alone, ``model_report`` reads each table once."""
    return {rule.name: rule.violations(oltp) for rule in model_rules()}


def model_report(oltp: Mapping[str, DataFrame]) -> DataFrame:
    """``rule``, ``violations`` of every rule of the reference model."""
    return rule_report(oltp, model_rules())
