"""The eight dashboard queries (C1-C8) and the verification counts (V1).

Each reads marts only; Catalyst prunes the mart columns it does not use and
pushes the card filters into the scan when the marts are stored as parquet.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from valuepay.functions.scalars import round_money
from valuepay.operators.aggregates import count_if, mean_exact, percent, sum_if
from valuepay.schemas import SEGMENT_HIGH, SEGMENT_WHALE

HVC_COL = "is_high_value_customer"

#: Sort columns of the sorted cards: the figure, largest first, then the card's key, which makes the
#: order of equal figures defined (the reference sorts by the figure alone). Card 7 is sorted by its key.
CARD_ORDER: dict[str, tuple[str, ...]] = {
    "card2": ("avg_order_value", "value_segment"),
    "card3": ("revenue", "primary_payment_type"),
    "card4": ("pct_orders_with_installments", "value_segment"),
    "card5": ("hvc_revenue", "customer_state"),
    "card6": ("projected_uplift", "value_segment"),
    "card7": ("order_month",),
}


def sort_columns(card: str) -> list[Column]:
    """The card's sort columns as expressions: figures descending, the key ascending, NULL last in both."""
    *figures, key = CARD_ORDER[card]
    return [*(F.desc_nulls_last(c) for c in figures), F.asc_nulls_last(key)]


def _hvc():
    return F.col(HVC_COL)


def card1_kpi(dim: DataFrame) -> DataFrame:
    """Total HVC revenue, its share of all revenue, and the HVC count."""
    hvc_rev = sum_if("monetary", _hvc())
    return dim.agg(
        F.round(hvc_rev, 0).alias("hvc_revenue"),
        round_money(percent(hvc_rev, F.sum("monetary")), 1).alias("hvc_revenue_share_pct"),
        count_if(_hvc()).alias("hvc_count"),
    )


def card2_aov_by_segment(dim: DataFrame) -> DataFrame:
    """Unweighted mean of the per-customer order value, per segment."""
    return (dim.groupBy("value_segment")
               .agg(round_money(mean_exact("avg_order_value"), 2).alias("avg_order_value"),
                    F.count(F.lit(1)).alias("customers"))
               .orderBy(*sort_columns("card2")))


def card3_payment_mix(profile: DataFrame) -> DataFrame:
    """What high-value customers pay with (both HVC segment labels)."""
    return (profile.where(F.col("value_segment").isin(SEGMENT_WHALE, SEGMENT_HIGH))
                   .groupBy("primary_payment_type")
                   .agg(F.sum("order_count").alias("orders"),
                        F.round(F.sum("total_revenue"), 0).alias("revenue"))
                   .orderBy(*sort_columns("card3")))


def card4_installments(profile: DataFrame) -> DataFrame:
    """Mean over payment methods of the profile percentages, per segment (unweighted)."""
    return (profile.groupBy("value_segment")
                   .agg(round_money(mean_exact("pct_orders_with_installments"), 1)
                        .alias("pct_orders_with_installments"),
                        round_money(mean_exact("avg_installments_when_used"), 2)
                        .alias("avg_installments_when_used"))
                   .orderBy(*sort_columns("card4")))


def card5_geo(geo_value: DataFrame) -> DataFrame:
    return (geo_value.select("customer_state", "total_customers", "hvc_customers",
                             "hvc_penetration_pct",
                             F.round("hvc_revenue", 0).alias("hvc_revenue"),
                             "hvc_revenue_share_pct")
                     .orderBy(*sort_columns("card5")))


def card6_uplift(uplift: DataFrame) -> DataFrame:
    return (uplift.select("value_segment", "aov_no_installment", "aov_installment", "aov_gap",
                          "addressable_orders",
                          round_money("projected_annual_uplift", 0).alias("projected_uplift"))
                  .orderBy(*sort_columns("card6")))


def card7_monthly_revenue(fact: DataFrame, dim: DataFrame) -> DataFrame:
    """Monthly revenue of HVC and other customers (dated orders of known customers).
    The fact is rolled up per person and month before the join (bounded rows per person)."""
    per = (fact.where((F.col("customer_unique_id") != "") & F.col("order_month").isNotNull())
               .groupBy("customer_unique_id", "order_month")
               .agg(F.sum("order_value").alias("v")))
    j = per.join(dim.select("customer_unique_id", HVC_COL), "customer_unique_id")
    return (j.groupBy("order_month")
             .agg(F.round(sum_if("v", _hvc()), 0).alias("hvc_revenue"),
                  F.round(sum_if("v", ~_hvc()), 0).alias("other_revenue"))
             .orderBy(*sort_columns("card7")))


def card8_top_cities(dim: DataFrame, state: str | None = None, k: int = 25) -> DataFrame:
    """Top ``k`` HVC cities by HVC revenue; ``state`` is the dashboard's optional filter."""
    d = dim.where(_hvc())
    if state is not None:
        d = d.where(F.col("customer_state") == state)
    return (d.groupBy("customer_state", "customer_city")
             .agg(count_if(_hvc()).alias("hvc_customers"),
                  F.round(sum_if("monetary", _hvc()), 0).alias("hvc_revenue"),
                  round_money(mean_exact(F.when(_hvc(), F.col("avg_order_value"))), 2).alias("hvc_avg_order"))
             .orderBy(F.desc("hvc_revenue"), "customer_state", "customer_city")
             .limit(k))


def verify_counts(dim: DataFrame) -> DataFrame:
    """The two hand-run verification numbers: customers and HVC customers."""
    return dim.agg(F.count(F.lit(1)).alias("customers"), count_if(_hvc()).alias("hvc_customers"))
