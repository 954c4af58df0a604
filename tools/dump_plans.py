"""Write the executed (final, post-AQE) physical plans of the headline queries.

Usage: python tools/dump_plans.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pluvia.plans import catalog  # noqa: E402
from pluvia.session import build_session  # noqa: E402

HEADLINE = ["silver_clean", "dq_all_checks", "quality_report", "mart_city_stats",
            "top_groups_share", "headline_kpis", "last_n_per_key", "coverage_gap",
            "coverage_gap_bucketed", "period_kpis_ranges", "duplicate_members", "raw_payload_split"]


def shorten(plan: str) -> str:
    plan = plan.split("\n+- == Initial Plan ==")[0]            # keep the final plan
    plan = re.sub(r"#\d+L?", "", plan)                      # expression ids
    plan = re.sub(r"\[plan_id=\d+\]|\[id=#?\d+\]", "", plan)
    return "\n".join(line[:180] for line in plan.splitlines())


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", shuffle_partitions=16)
    spark.sparkContext.setLogLevel("ERROR")
    print(f"# Executed physical plans ({os.path.basename(sf_dir)}, local[8], AQE final plans)\n")
    print("Generated by `tools/dump_plans.py`; expression ids removed, long lines cut.\n")
    for name in HEADLINE:
        df = catalog.QUERIES[name](spark, sf_dir)
        df.collect()  # run on this execution so AQE reports its final plan
        plan = df._jdf.queryExecution().executedPlan().toString()
        print(f"## {name}\n\n```\n{shorten(plan)}\n```\n")
    spark.stop()


if __name__ == "__main__":
    main()
