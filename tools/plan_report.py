"""Write PLANS.md: the final (post-AQE) physical plan tree of every build step and of
the main reports, executed on the given scale factor.

Usage: python tools/plan_report.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def tree(df) -> str:
    plan = df._jdf.queryExecution().executedPlan()
    plan.execute().count()      # runs this plan, so AQE finalises it (no rows collected)
    text = plan.toString()
    # keep the operator tree, drop long attribute lists
    lines = []
    for line in text.splitlines():
        if len(line) > 160:
            line = line[:157] + "..."
        lines.append(line)
    return "\n".join(lines)


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    from strata.plans import medallion as M
    from strata.plans import bound_increments as I
    from strata.plans import reports as R
    from strata.plans import tpch
    from strata.plans.normalise import normalise
    from strata.operators import quality as Q
    from strata.plans.lakehouse import default_rules
    from strata.session import build_session

    spark = build_session("local[8]", 16)
    raw = tpch.raw_extracts(spark, sf)
    b = tpch.bronze(spark, sf)
    lazy = M.medallion(b)
    m = tpch.model(spark, sf)
    norm = normalise(b["cases"], b["districts"], b["classes"])
    stored = tpch.normalised(spark, sf)
    steps = [
        ("land bronze: raw cases from orders, customer and first closings", raw["cases"]),
        ("land bronze: raw events from lineitem", raw["events"]),
        ("silver cases (typing + whole-row distinct)", lazy["stg_cases"]),
        ("silver classes (preferred spelling survivor)", lazy["stg_classes"]),
        ("silver events", lazy["stg_events"]),
        ("gold calendar (from written silver)", M.gold(m["stg_cases"], m["stg_districts"],
                                                       m["stg_classes"])["dim_calendar"]),
        ("gold fact (from written silver)", M.gold(m["stg_cases"], m["stg_districts"],
                                                   m["stg_classes"])["fact_cases"]),
        ("normalised cases", norm.processo),
        ("normalised events (ids from partition and position)", norm.movimentacao),
        ("report: flagship by district, class, year", R.by_district_class_year(m)),
        ("report: by court, min support 3", R.by_court(m, 3)),
        ("report: fan-out mean", R.fanout(m, m["stg_events"])),
        ("report: by court from the event model", R.duration_from_events(stored, 3)),
        ("check: both paths agree", R.events_equal_gold(m, stored, 3)),
        ("quality suite (20 rules)", Q.run_suite(m, default_rules())),
        *[(title, I.QUERIES[name](spark, sf)) for title, name in (
            ("CSV typed by its values (after the aggregate that infers the types)", "csv_inferred_customer"),
            ("CSV with quoted line ends, read in splits", "csv_quoted_lines"),
            ("duration by the district name valid at opening (as-of join)", "duration_by_district_as_of"),
            ("report from signed changes", "report_from_deltas"),
            ("distinct counts over a range of days (from stored sets)", "distinct_any_range"),
            ("rules on a batch against history", "dq_batch_rules"),
            ("misspelt words (after the components)", "misspelt_words"),
            ("frequent shapes", "format_shapes"))],
    ]
    print(f"# Physical plans (final, after AQE) at {os.path.basename(sf)}\n")
    print("Generated by `tools/plan_report.py`. Build steps are shown as the lazy plans that the "
          "layer writes execute; reports read the written layers.\n")
    for title, df in steps:
        print(f"## {title}\n\n```\n{tree(df)}\n```\n")
    spark.stop()


if __name__ == "__main__":
    main()
