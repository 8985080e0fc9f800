"""Scale guards on the physical plans of every registered query.

* No cartesian product and no nested-loop join anywhere.
* A single-partition exchange (all rows into one task) appears only where its
  input has a proven bound, listed below with the reason.
* The k-per-key sample is limited inside each map task (WindowGroupLimit) and
  top-n reports use TakeOrderedAndProject.
* Date-range analytics push both bounds into the Parquet scan and read only
  the columns they use.
"""

from __future__ import annotations

import re

import pytest

from clinistar import registry
from conftest import SF0001

QUERIES = registry.queries()

# why the single-partition input of a key is bounded
MONTHLY = "window over the monthly aggregate: one row per calendar month"
KEYS = "dense keys: prefix sums over one row per range, a bottom-k sample of the values for the bounds"
RANGED = "bounds of the ranges from a bottom-k sample, prefix sums over one row per range"
SINGLE_PARTITION_OK = {
    "rolling_cancellations_star": MONTHLY, "rolling_cancellations_snowflake": MONTHLY,
    "rolling_cancellations_calendar": MONTHLY, "sql_rolling_cancellations": MONTHLY,
    "sql_rolling_cancellations_snowflake": MONTHLY,
    "rolling_rate": "window over the daily aggregate: one row per day",
    "apportion": "window over the categories: one row each",
    "quality_report": "global counts: one partial row per task",
    "assign_foreign_key": KEYS, "stable_keys": KEYS, "rolling_rate_minute": KEYS,
    "dim_department_specialty": KEYS, "dim_departments": KEYS, "dim_icd10_codes": KEYS, "dim_diagnoses_snowflake": KEYS,
    "snowflake_to_star_doctors": KEYS, "snowflake_to_star_diagnoses": KEYS,
    "trending_diagnoses_snowflake": KEYS, "symptom_diagnosis_snowflake": KEYS, "top_doctors_snowflake": KEYS,
    "diagnosis_treatment_summary_snowflake": KEYS, "treatment_priority_snowflake": KEYS,
    "sql_trending_diagnoses_snowflake": KEYS, "sql_symptom_diagnosis_snowflake": KEYS,
    "sql_diagnosis_treatment_summary": KEYS,
    "sql_top_doctors": RANGED, "sql_top_doctors_snowflake": RANGED, "sql_top_doctors_all": RANGED,
    "top_doctors_all": RANGED, "period_change_minute": RANGED, "rank_in_period_value": RANGED,
    "rank_in_period_decimal": RANGED,
}


def _plan(spark, name):
    return QUERIES[name](spark, SF0001)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_guards(spark, name):
    plan = _plan(spark, name)
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    if "SinglePartition" in plan:
        assert name in SINGLE_PARTITION_OK, f"{name} moves all rows into one task"


def test_limits_are_pushed(spark):
    assert "WindowGroupLimit" in _plan(spark, "sample_k_per_key")
    for name in ("top_doctors_star", "top_doctors_snowflake", "sql_trending_diagnoses_top"):
        assert "TakeOrderedAndProject" in _plan(spark, name)


def test_no_task_numbers_all_rows(spark):
    """What a window without keys sees is one row per range, month, day or
    category, never the rows that are ranked, rolled or cut."""
    for name in ("sql_top_doctors_all", "top_doctors_all", "rank_in_period_value", "rank_in_period_decimal",
                 "rolling_rate_minute", "rolling_rate_minute_calendar", "period_change_minute"):
        frame = QUERIES[name](spark, SF0001)
        frame.collect()
        plan = frame._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        for line in plan.splitlines():
            if "Window [" in line:
                assert not re.search(r"windowspecdefinition\((?!_range|part#|Start)[\w.]+#\d+L? (ASC|DESC)", line), (name, line)


def test_range_pushdown_and_pruning(spark):
    plan = _plan(spark, "trending_diagnoses_star")
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate,1996-01-01T00:00)" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint>" in plan
    # the fact's "appointments without lines" branch cannot reach a diagnosis
    # join (its DiagnosisID is NULL), so Catalyst drops it: one orders scan
    assert plan.count("orders.parquet") == 1
