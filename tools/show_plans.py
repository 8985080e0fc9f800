"""Write the final (post-AQE) physical plans of the headline queries.

Usage: python tools/show_plans.py [sf_dir] > docs/PLANS.md

Builds and writes the star warehouse from ``sf_dir`` (default sf0.1) into
the session's checkpoint folder, runs each query once, and prints its final
adaptive plan - the joins Spark chose from measured sizes, reused
exchanges, pushed filters and pruned partitions.
"""

from __future__ import annotations

import datetime as dt
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from clinistar.operators import analytics as A  # noqa: E402
from clinistar.plans import builders as B  # noqa: E402
from clinistar.session import get_spark  # noqa: E402
from clinistar.sources import files, proxy  # noqa: E402

S, E = dt.date(1996, 1, 1), dt.date(1998, 12, 31)


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = get_spark("local[8]", app_name="clinistar-plans", shuffle_partitions=8)
    star = B.materialize(proxy.star(spark, sf_dir), files.scratch_path(spark, "plans-warehouse"))
    shown = {
        "Q1 trending_diagnoses": A.trending_diagnoses(star, S, E),
        "Q2 medication_trends": A.medication_trends(star, S, E),
        "Q3 symptom_diagnosis": A.symptom_diagnosis(star, S, E),
        "Q4 rolling_cancellations": A.rolling_cancellations(star, S, E),
        "Q5 top_doctors": A.top_doctors(star, S, E, 10),
        "V1 appointment_summary": A.appointment_summary(star),
        "U1 treatment_priority": A.treatment_priority(star),
    }
    print("# Final physical plans (star warehouse written from "
          f"`{sf_dir}`, local[8], 8 shuffle partitions, AQE on)\n")
    print("Generated by `python tools/show_plans.py`. Scan paths are scratch folders.\n")
    for title, df in shown.items():
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        plan = plan.split("+- == Initial Plan ==")[0]  # keep the final, adaptive plan
        print(f"## {title}\n\n```\n{plan.rstrip()}\n```\n")
    spark.stop()


if __name__ == "__main__":
    main()
