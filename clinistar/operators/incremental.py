"""Summaries and treatment priorities of a fact that grows by loads.

V1's counts per patient and V2's counts per (patient, diagnosis, medication)
are sums, so those of the loads add up. ``SummaryState`` keeps the counts of
each load as its own small table: a load reads only its new facts and writes
only their counts. Whoever reads the state adds them up; ``compact`` does so
for good.

A load changes the priorities of its patients only: all pairs of a patient,
since the patient's number of appointments is part of the rule. Those are
computed again from the state, and every other pair keeps its row.

A load has a number. The tables of a load are complete when all have been
written, so one that failed leaves no trace and can be repeated; repeating one
that ended replaces it by the same. Distinct appointments don't add up, so
their variants aren't kept here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clinistar.operators import analytics as A
from clinistar.plans.model import Warehouse

PATIENT, TREATMENT = ("PatientID",), ("PatientID", "DiagnosisID", "MedicationID")


class SummaryState:
    """The counts of all loads, in a folder that all executors share."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    # --- parts on disk ---------------------------------------------------
    def _parts(self, kind: str, tables: tuple[str, ...]) -> list[int]:
        """Numbers of the ``kind`` parts whose tables are all complete."""
        jvm = self.spark._jvm.org.apache.hadoop.fs
        root = jvm.Path(self.path)
        fs = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        names = [s.getPath().getName() for s in fs.listStatus(root)] if fs.exists(root) else []
        done = lambda name: all(fs.exists(jvm.Path(f"{self.path}/{name}/{t}/_SUCCESS")) for t in tables)
        return sorted(int(n.split("-")[1]) for n in names if n.startswith(f"{kind}-") and done(n))

    def _folder(self, kind: str, number: int, table: str) -> str:
        return f"{self.path}/{kind}-{number:09d}/{table}"

    def _counts(self, table: str) -> DataFrame | None:
        """All rows of the newest base and of the loads after it."""
        tables = ("patients", "treatments")
        bases = self._parts("base", tables)
        base = bases[-1] if bases else -1
        folders = [self._folder("base", base, table)] if bases else []
        folders += [self._folder("load", n, table) for n in self._parts("load", tables) if n > base]
        return self.spark.read.parquet(*folders) if folders else None

    # --- state -------------------------------------------------------------
    def add(self, load: int, facts: DataFrame) -> None:
        """Add the new facts of a load. Loads are numbered upwards."""
        bases = self._parts("base", ("patients", "treatments"))
        if bases and load <= bases[-1]:
            raise ValueError(f"load {load} is part of base {bases[-1]}")
        # one pass over the facts: the counts per patient are sums of those per treatment
        treatments = self._folder("load", load, "treatments")
        A.treatments_per_patient(facts, cancelled=True).write.mode("overwrite").parquet(treatments)
        patients = self.spark.read.parquet(treatments).groupBy(*PATIENT).agg(F.sum("_n").alias("_total"), F.sum("_cancelled").alias("_cancelled"))
        patients.write.mode("overwrite").parquet(self._folder("load", load, "patients"))

    def patients(self, only: DataFrame | None = None) -> DataFrame:
        """PatientID, ``_total``, ``_cancelled`` of all loads (``only``: of these patients)."""
        return self._summed("patients", PATIENT, ("_total", "_cancelled"), only)

    def treatments(self, only: DataFrame | None = None) -> DataFrame:
        """PatientID, DiagnosisID, MedicationID, ``_n`` of all loads."""
        return self._summed("treatments", TREATMENT, ("_n",), only)

    def _summed(self, table: str, keys: tuple[str, ...], sums: tuple[str, ...], only: DataFrame | None) -> DataFrame:
        rows = self._counts(table)
        if rows is None:
            raise ValueError(f"no load in {self.path}")
        if only is not None:
            rows = rows.join(only, "PatientID", "left_semi")
        return rows.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums])

    def compact(self) -> None:
        """Add up all loads into a base that later reads start from."""
        number = self._parts("load", ("patients", "treatments"))[-1]
        self.patients().write.mode("overwrite").parquet(self._folder("base", number, "patients"))
        self.treatments().write.mode("overwrite").parquet(self._folder("base", number, "treatments"))

    # --- results -----------------------------------------------------------
    def appointment_summary(self, wh: Warehouse) -> DataFrame:
        """V1 over all loads; ``wh`` gives the dimensions."""
        return A.appointment_summary(wh, per_patient=self.patients())

    def diagnosis_treatment_summary(self, wh: Warehouse) -> DataFrame:
        """V2 over all loads."""
        return A.diagnosis_treatment_summary(wh, per_key=self.treatments())

    def update_priorities(self, load: int, wh: Warehouse, **thresholds) -> None:
        """Compute the priorities of the load's patients again."""
        touched = self.spark.read.parquet(self._folder("load", load, "patients")).select("PatientID")
        fresh = A.priority_by_key(wh, per_patient=self.patients(touched), per_treatment=self.treatments(touched), **thresholds)
        fresh.withColumn("_load", F.lit(load)).write.mode("overwrite").parquet(self._folder("priority", load, "pairs"))

    def priorities(self) -> DataFrame:
        """PatientID, DiagnosisID, TreatmentPriority: each pair as its latest load left it."""
        loads = self._parts("priority", ("pairs",))
        if not loads:
            raise ValueError(f"no priorities in {self.path}")
        every = self.spark.read.parquet(*[self._folder("priority", n, "pairs") for n in loads])
        return every.groupBy("PatientID", "DiagnosisID").agg(F.max_by("TreatmentPriority", "_load").alias("TreatmentPriority"))
