"""Command line: run the daily refresh, or print a dashboard card from written marts.

  python -m valuepay refresh --data-dir <csv folder> --out <run folder> [--min-rows table=n ...]
  python -m valuepay card <card name> --marts <marts folder> [--state SP]
  python -m valuepay card uplift_at --marts <marts folder> --adoption 30 --capture 100

A refresh writes below a new folder of ``--out`` and prints its marts' paths.

Uses the active cluster configuration (``spark-submit`` / ``pyspark`` settings); with
no master configured it runs on ``local[*]``.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession

from valuepay.plans import cards as C
from valuepay.plans.quality import QualityGateFailed
from valuepay.plans.refresh import refresh
from valuepay.plans.scenario import uplift_at, uplift_scenarios
from valuepay.schemas import MIN_ROWS
from valuepay.session import apply_scale_defaults, ensure_checkpoint_dir

CARDS = {
    "card1_kpi": lambda m, a: C.card1_kpi(m("dim_customer")),
    "card2_aov_by_segment": lambda m, a: C.card2_aov_by_segment(m("dim_customer")),
    "card3_payment_mix": lambda m, a: C.card3_payment_mix(m("mart_hvc_payment_profile")),
    "card4_installments": lambda m, a: C.card4_installments(m("mart_hvc_payment_profile")),
    "card5_geo": lambda m, a: C.card5_geo(m("mart_geo_value")),
    "card6_uplift": lambda m, a: C.card6_uplift(m("mart_payment_uplift")),
    "card7_monthly_revenue": lambda m, a: C.card7_monthly_revenue(m("fct_order_payments"), m("dim_customer")),
    "card8_top_cities": lambda m, a: C.card8_top_cities(m("dim_customer"), state=a.state),
    "uplift_scenarios": lambda m, a: uplift_scenarios(m("mart_payment_uplift")),
    "uplift_at": lambda m, a: uplift_at(m("mart_payment_uplift"), a.adoption, a.capture),
    "verify_counts": lambda m, a: C.verify_counts(m("dim_customer")),
}


def _session() -> SparkSession:
    spark = SparkSession.builder.appName("valuepay").getOrCreate()
    apply_scale_defaults(spark)
    ensure_checkpoint_dir(spark)
    return spark


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="python -m valuepay")
    sub = p.add_subparsers(dest="cmd", required=True)
    r = sub.add_parser("refresh", help="validate, load, gate, build marts, gate")
    r.add_argument("--data-dir", required=True)
    r.add_argument("--out", required=True)
    r.add_argument("--min-rows", nargs="*", default=[], metavar="TABLE=N")
    r.add_argument("--workers", type=int, default=4)
    r.add_argument("--publish-to", help="gets an entry for this run once both gates pass")
    r.add_argument("--max-orphans", type=int, help="fail when more payments lack an order")
    c = sub.add_parser("card", help="show one dashboard card from written marts")
    c.add_argument("name", choices=sorted(CARDS))
    c.add_argument("--marts", required=True)
    c.add_argument("--state")
    c.add_argument("--adoption", type=float, default=30.0, help="uplift_at: adoption %%")
    c.add_argument("--capture", type=float, default=100.0, help="uplift_at: AOV lift capture %%")
    args = p.parse_args(argv)

    spark = _session()
    if args.cmd == "refresh":
        min_rows = dict(MIN_ROWS)
        for item in args.min_rows:
            table, n = item.split("=", 1)
            min_rows[table] = int(n)
        try:
            res = refresh(spark, args.out.rstrip("/"), data_dir=args.data_dir, min_rows=min_rows,
                          max_workers=args.workers, publish_to=args.publish_to,
                          max_orphans=args.max_orphans)
        except QualityGateFailed as exc:
            print(f"refresh stopped: {exc}", file=sys.stderr)
            return 2
        print(json.dumps({"marts": res.marts, "rows": res.rows,
                          "seconds": {k: round(v, 3) for k, v in res.seconds.items()}}, indent=2))
        return 0
    base = args.marts.rstrip("/")
    CARDS[args.name](lambda name: spark.read.parquet(f"{base}/{name}"), args).show(50, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
