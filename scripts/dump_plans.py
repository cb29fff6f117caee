"""Write PLANS.md: the physical plan tree of every mart and card, as planned at scale.

The sources are staged as parquet first (as the refresh does) and automatic broadcast is
switched off, so the plans show the shuffles a large input would get; at run time AQE may
still turn a measured-small side into a broadcast.

Usage: python scripts/dump_plans.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from valuepay.plans import cards as C  # noqa: E402
from valuepay.plans import marts as M  # noqa: E402
from valuepay.plans.scenario import uplift_scenarios  # noqa: E402
from valuepay.session import local_session, scratch_path  # noqa: E402
from valuepay.sources import fixtures  # noqa: E402


def tree(df) -> str:
    jvm = df.sparkSession._jvm
    text = df._jdf.queryExecution().explainString(
        jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    head = text.split("\n\n\n", 1)[0]
    return re.sub(r"#\d+L?", "", head).replace("== Physical Plan ==\n", "")


def scans(df) -> str:
    """PushedFilters and ReadSchema of every parquet scan in the plan."""
    jvm = df.sparkSession._jvm
    text = df._jdf.queryExecution().explainString(
        jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    out, seen = [], set()
    for block in (b.strip() for b in text.split("\n\n")):
        if not block or "Scan parquet" not in block.splitlines()[0]:
            continue
        fields = {line.split(":", 1)[0]: line.split(":", 1)[1].strip()
                  for line in block.splitlines()[1:] if ":" in line}
        table = fields.get("Location", "").rsplit("/", 1)[-1].rstrip("]")
        item = (table, fields.get("PushedFilters", "[]"), fields.get("ReadSchema", ""))
        if item not in seen:
            seen.add(item)
            out.append(f"* `{table}` — pushed: `{item[1]}`; read: `{item[2]}`")
    return "\n".join(out)


def summary(df) -> str:
    p = df._jdf.queryExecution().executedPlan().toString()
    return (f"exchanges: {p.count('Exchange ')}, hash aggregates: {p.count('HashAggregate(') - p.count('ObjectHashAggregate(')}, "
            f"object-hash aggregates: {p.count('ObjectHashAggregate(')}, sort aggregates: {p.count('SortAggregate(')}, "
            f"sort-merge joins: {p.count('SortMergeJoin')}, single-partition exchanges: {p.count('SinglePartition')}")


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    base = scratch_path(spark, "plans")
    staged = {}
    for name, df in fixtures.load(spark, sf_dir).items():
        df.write.parquet(f"{base}/raw/{name}")
        staged[name] = spark.read.parquet(f"{base}/raw/{name}")
    fact_plan = M.fct_order_payments(staged["orders"], staged["order_payments"], staged["order_items"],
                                     staged["customers"])
    geo_plan = M.dim_geolocation(staged["geolocation"])
    fact_plan.write.parquet(f"{base}/marts/fact")
    geo_plan.write.parquet(f"{base}/marts/geo")
    fact = spark.read.parquet(f"{base}/marts/fact")
    geo = spark.read.parquet(f"{base}/marts/geo")
    dim_plan = M.dim_customer(fact)
    dim_plan.write.parquet(f"{base}/marts/dim")
    dim = spark.read.parquet(f"{base}/marts/dim")
    rollup_plan = M.segment_method_rollup(fact, dim)
    rollup_plan.write.parquet(f"{base}/layers/segment_method")
    rollup = spark.read.parquet(f"{base}/layers/segment_method")
    prof = M.mart_hvc_payment_profile(fact, dim, rollup=rollup)
    upl = M.mart_payment_uplift(fact, dim, rollup=rollup)
    items = [
        ("M1 dim_geolocation", geo_plan),
        ("M2 fct_order_payments", fact_plan),
        ("M3 dim_customer: per-person rollup (thresholds enter as literals)", M.customer_base(fact)),
        ("Rollup per segment and method, which M4 and M6 share", rollup_plan),
        ("M4 mart_hvc_payment_profile", prof),
        ("M5 mart_geo_value", M.mart_geo_value(dim, geo)),
        ("M6 mart_payment_uplift", upl),
        ("C1 card1_kpi", C.card1_kpi(dim)),
        ("C7 card7_monthly_revenue", C.card7_monthly_revenue(fact, dim)),
        ("C8 card8_top_cities (state filter)", C.card8_top_cities(dim, state="BRAZIL")),
        ("U1 uplift_scenarios", uplift_scenarios(upl)),
    ]
    print("# PLANS — physical plans of the marts and cards\n")
    print("Generated by `python scripts/dump_plans.py` over the staged sf0.1 tables with automatic")
    print("broadcast disabled (the shape a large input gets before AQE re-plans at run time).")
    print("Marts read by later marts are read back from parquet, as in the refresh.\n")
    for title, df in items:
        print(f"## {title}\n\n{summary(df)}\n\n```\n{tree(df)}\n```\n\nScans:\n\n{scans(df)}\n")
    spark.stop()


if __name__ == "__main__":
    main()
