"""The six marts (M1-M6), each a function from DataFrames to a DataFrame.

Shuffle plan at scale:
* fct_order_payments: payments and items are rolled up per order *before* the
  joins (no payment x item fan-out) and come out hash-partitioned on order_id.
  Orders meet their customer first (a narrow exchange on customer_id; AQE makes
  it a broadcast when the customer side is measured small and splits a skewed
  customer otherwise), then one exchange on order_id lines them up with both
  rollups; the wide fact row itself is never shuffled.
* dim_customer: one aggregation on customer_unique_id with partial (map-side)
  evaluation; p90, p95 and the median come from exact distributed order
  statistics and enter the plan as literals, the latest order date as a scalar
  subquery, so no single-partition window and no join attaches them.
* profile / uplift / card 7 roll the fact up per person (x method / x month)
  with partial aggregation before joining the dimension, so a person holding a
  third of all orders is collapsed map-side and every join key has a bounded
  number of rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from valuepay.functions.scalars import (
    days_between, floor_zero, month_start, order_date, round_money, segment_label,
)
from valuepay.operators.aggregates import (
    arg_max, avg_if, count_if, first_of_earliest, mean, mean_exact, nulls_last, percent, ratio,
    sum_if,
)
from valuepay.operators.frequent import frequent_values
from valuepay.operators.joins import left_join_filled
from valuepay.operators.quantiles import BUCKETS, exact_quantiles
from valuepay.schemas import ADDRESSABLE_METHOD, CANCELLED_STATUS, PAYMENT_TYPES, UPLIFT_ADOPTION
from valuepay.session import written
from valuepay.sources.bucketed import Bucketed


def round_dec(x, digits: int) -> Column:
    """round() of a decimal, staying decimal (half away from zero)."""
    x = F.col(x) if isinstance(x, str) else x
    return F.round(x, digits)


# --------------------------------------------------------------------- M1
def dim_geolocation(geolocation: DataFrame) -> DataFrame:
    """One coordinate (mean) and the most frequent city/state per zip prefix (ties to the smallest
    name), from one scan: the sums of the means ride along with the counts."""
    per = frequent_values(
        geolocation, {"zip_code_prefix": F.col("geolocation_zip_code_prefix")},
        {"city": F.col("geolocation_city"), "state": F.col("geolocation_state")},
        {**{c: F.col(f"geolocation_{c}").cast("decimal(38,18)") for c in ("lat", "lng")},
         **{f"n_{c}": F.col(f"geolocation_{c}").isNotNull().cast("long") for c in ("lat", "lng")}})
    return per.select("zip_code_prefix", *[F.try_divide(F.col(c).cast("double"), F.col(f"n_{c}").cast("double")).alias(c)
                                           for c in ("lat", "lng")], "city", "state")


# --------------------------------------------------------------------- M2
def payment_rank(value: Column, sequential: Column) -> Column:
    """One decimal ordering payments by amount (descending wins) then sequence number
    (ascending wins): ``cents * 2^32 + (2^31 - 1 - seq)``. Exact for any sequence number of the
    column's type and 17 digits of cents, so frames that skipped the range check of the load
    rank rightly too; a fixed-width key keeps the rollup a hash aggregate."""
    width = F.lit(Decimal(2 ** 32))
    return ((value * 100).cast("decimal(17,0)") * width + (F.lit(2147483647) - sequential.cast("long")).cast("decimal(10,0)")).cast("decimal(30,0)")


def payments_per_order(order_payments: DataFrame, counted: bool = False) -> DataFrame:
    """Payments rolled up to one row per order; ``counted`` adds their number, ``_payments``.

    For the known methods every aggregate is fixed-width, so the rollup runs as Spark's
    code-generated hash aggregate: the primary method is the one owning the largest packed
    payment rank (a per-method ``max``), and the distinct-method count sums per-method
    presence. Only payments with other method names need their strings: they are rolled
    up separately (usually a handful of rows) and joined back by order — a join AQE turns
    into a broadcast when that side is measured small.
    """
    t, v = F.col("payment_type"), F.col("payment_value")
    rank = payment_rank(v, F.col("payment_sequential"))
    # NULL counts as another method; written as IS NULL OR NOT IN so that the side scan's
    # filter reaches parquet (dictionary filtering skips row groups of known methods only)
    is_other = t.isNull() | ~t.isin(*PAYMENT_TYPES)
    main = order_payments.groupBy("order_id").agg(
        F.sum(v).alias("order_value"),
        F.max("payment_installments").alias("max_installments"),
        *[sum_if(v, t == pt).alias(f"{pt}_value") for pt in PAYMENT_TYPES],
        *[F.max(F.when(t == pt, rank)).alias(f"_rank{i}") for i, pt in enumerate(PAYMENT_TYPES)],
        F.max(F.when(is_other, rank)).alias("_rank_other"),
        *([F.count(F.lit(1)).alias("_payments")] if counted else []),
    )
    other = order_payments.where(is_other).groupBy("order_id").agg(
        F.max_by(t, rank).alias("_other_primary"),
        F.size(F.collect_set(t)).alias("_other_methods"),
    )
    j = main.join(other, "order_id", "left")
    ranks = [F.col(f"_rank{i}") for i in range(len(PAYMENT_TYPES))]
    best = F.greatest(*ranks, F.col("_rank_other"))           # NULL ranks are skipped
    primary = F.col("_other_primary")
    for pt, r in reversed(list(zip(PAYMENT_TYPES, ranks))):
        primary = F.when(r == best, F.lit(pt)).otherwise(primary)
    methods = sum((r.isNotNull().cast("long") for r in ranks), F.lit(0).cast("long")) \
        + F.coalesce(F.col("_other_methods"), F.lit(0)).cast("long")
    return j.select(
        "order_id", "order_value", "max_installments",
        methods.alias("distinct_payment_methods"),
        # the method carrying the most money; equal amounts -> lowest sequence number
        primary.alias("primary_payment_type"),
        *[f"{pt}_value" for pt in PAYMENT_TYPES],
        *(["_payments"] if counted else []),
    ).withColumn("used_installments", F.col("max_installments") > 1)


def items_per_order(order_items: DataFrame) -> DataFrame:
    """Item price and freight rolled up to one row per order."""
    return order_items.groupBy("order_id").agg(
        F.sum("price").alias("items_price"),
        F.sum("freight_value").alias("freight_value"),
        F.count(F.lit(1)).alias("item_count"),
    )


# The columns of the published mart, in order.
FACT_COLUMNS = [
    "order_id", "customer_id", "customer_unique_id", "order_status", "order_purchase_timestamp",
    "order_date", "order_month", "customer_state", "customer_city", "customer_zip_code_prefix",
    "order_value", "primary_payment_type", "max_installments", "used_installments",
    "distinct_payment_methods", "credit_card_value", "boleto_value", "voucher_value",
    "debit_card_value", "items_price", "freight_value", "item_count",
]


def fct_order_payments(orders: DataFrame, order_payments: DataFrame, order_items: DataFrame,
                       customers: DataFrame, orphans: Observation | None = None,
                       colocated: bool = False) -> DataFrame:
    """One row per non-cancelled order that has at least one payment.

    ``colocated``: the order tables lie in buckets of ``order_id``, so they are rolled up and joined where they
    are, and the customers come last (the only exchange, on ``customer_id``).

    ``orphans`` observes the number of payments whose order is missing (DQ2) while the fact is written:
    the rollup is left-joined with all orders, and rows that meet none are counted and left out. So the
    payments are read and shuffled once for both. Written without a further exchange, the figure comes from
    the writing stage, where Spark takes each task's figures once."""
    live = F.col("order_status") != CANCELLED_STATUS
    o = (orders if orphans else orders.where(live)).select(
        "order_id", "customer_id", "order_status", "order_purchase_timestamp")
    cust = customers.select("customer_id", "customer_unique_id", "customer_state",
                            "customer_city", "customer_zip_code_prefix")
    # The customer attributes join the narrow order rows first (exchange on customer_id
    # of a few columns); the wide per-order rollups then join on order_id, where they
    # are already partitioned, so the widest rows are never shuffled again.
    def with_customer(df: DataFrame) -> DataFrame:
        return left_join_filled(df, cust, "customer_id",
                                {"customer_unique_id": "", "customer_state": "",
                                 "customer_city": "", "customer_zip_code_prefix": ""})

    j = o if colocated else with_customer(o)
    if orphans:
        met = payments_per_order(order_payments, counted=True).join(j.withColumn("_known", F.lit(True)), "order_id", "left")
        j = met.observe(orphans, F.coalesce(F.sum(F.when(F.col("_known").isNull(), F.col("_payments"))), F.lit(0)).alias("orphans")).where(live)
    else:
        j = j.join(payments_per_order(order_payments), "order_id", "inner")
    j = left_join_filled(j, items_per_order(order_items), "order_id",
                         {"items_price": 0, "freight_value": 0, "item_count": 0})
    j = with_customer(j) if colocated else j
    ts = F.col("order_purchase_timestamp")
    return j.select(
        *[order_date(ts).alias(c) if c == "order_date"
          else month_start(ts).alias(c) if c == "order_month"
          else F.col(c) for c in FACT_COLUMNS])


def fct_from_buckets(store: Bucketed, customers: DataFrame) -> DataFrame:
    """The fact from ``orders``, ``order_payments`` and ``order_items`` bucketed by ``order_id``: nothing is exchanged on
    ``order_id``, but for the few orders with very many rows, which are rolled up before they are shuffled."""
    parts = [fct_order_payments(t["orders"], t["order_payments"], t["order_items"], customers, colocated=t is store.cold)
             for t in (store.cold, store.hot)]
    return parts[0].unionByName(parts[1])


# --------------------------------------------------------------------- M3
def customer_base(fact: DataFrame) -> DataFrame:
    """Per-person rollup of the fact, including the '' group of orders without a customer
    (it carries the latest order date of the whole fact and is dropped afterwards)."""
    return fact.groupBy("customer_unique_id").agg(
        first_of_earliest(["customer_state", "customer_city"],
                          "order_purchase_timestamp", "order_id").alias("first_location"),
        F.count(F.lit(1)).alias("frequency"),
        F.sum("order_value").alias("monetary"),
        mean("order_value").alias("avg_order_value"),
        F.max("order_date").alias("last_order_date"),
        avg_if("max_installments", F.col("used_installments")).alias("avg_installments_when_used"),
        ratio(count_if(F.col("used_installments")), F.count(F.lit(1))).alias("installment_order_share"),
        arg_max("primary_payment_type", "order_value",
                nulls_last("order_date"), "order_id").alias("top_payment_type"),
    )


@dataclass(frozen=True)
class Thresholds:
    """Whole-base order statistics the customer dimension is scored against."""

    n: int
    p90: Decimal | None
    p95: Decimal | None
    median: float | None


def customer_thresholds(base_all: DataFrame, *, buckets: int = BUCKETS) -> Thresholds:
    """p90, p95 (quantileExact) and the exact median of monetary value over known persons."""
    persons = base_all.where(F.col("customer_unique_id") != "")
    q = exact_quantiles(persons, "monetary", (0.90, 0.95), median=True, buckets=buckets)
    return Thresholds(q["n"], q[0.90], q[0.95], q["median"])


def _lit(v, dtype: str) -> Column:
    return F.lit(v).cast(dtype) if v is None else F.lit(v)


# The columns of the published mart, in order.
DIM_COLUMNS = [
    "customer_unique_id", "customer_state", "customer_city", "frequency", "monetary",
    "avg_order_value", "recency_days", "last_order_date", "avg_installments_when_used",
    "installment_order_share", "top_payment_type", "is_top5_value", "is_high_value_customer",
    "value_segment",
]


def score_customers(base_all: DataFrame, th: Thresholds) -> DataFrame:
    m = F.col("monetary")
    # latest order date of the whole fact, orders without a customer included: a scalar
    # subquery over the per-person rollup (computed once, inlined as a value; no join)
    latest = base_all.agg(F.max("last_order_date")).scalar()
    p90, p95 = _lit(th.p90, "decimal(22,2)"), _lit(th.p95, "decimal(22,2)")
    med = _lit(th.median, "double")
    return base_all.where(F.col("customer_unique_id") != "").select(
        "customer_unique_id",
        F.col("first_location.customer_state").alias("customer_state"),
        F.col("first_location.customer_city").alias("customer_city"),
        "frequency", "monetary", "avg_order_value",
        days_between("last_order_date", latest).alias("recency_days"),
        "last_order_date", "avg_installments_when_used", "installment_order_share",
        "top_payment_type",
        (m >= p95).alias("is_top5_value"),
        (m >= p90).alias("is_high_value_customer"),
        segment_label(m, p95, p90, med).alias("value_segment"),
    )


def dim_customer(fact: DataFrame, *, base: DataFrame | None = None, buckets: int = BUCKETS) -> DataFrame:
    """RFM, instalment behaviour, thresholds, flags and segment per person.

    The threshold passes and the final projection all read the per-person rollup: it is written
    to the shared folder once, or given as ``base`` (``customer_base(fact)``, written) by a caller
    that keeps it as a layer of its run.
    """
    base_all = base if base is not None else written(customer_base(fact), "customer-base")
    return score_customers(base_all, customer_thresholds(base_all, buckets=buckets))


# --------------------------------------------------------------------- M4
# Marts that join fact and dimension first roll the fact up per person (and per
# payment method or month), with partial aggregation before the shuffle. The join
# then sees a bounded number of rows per person, so a person holding a third of
# all orders is collapsed map-side instead of landing in one join task. Every
# figure is rebuilt exactly from these sums and counts.
def _known_customers(fact: DataFrame) -> DataFrame:
    return fact.where(F.col("customer_unique_id") != "")


def _segments(dim: DataFrame, *cols: str) -> DataFrame:
    return dim.select("customer_unique_id", *cols)


def _div(num: str, den: str) -> Column:
    return F.try_divide(F.sum(num).cast("double"), F.sum(den).cast("double"))


def segment_method_rollup(fact: DataFrame, dim: DataFrame) -> DataFrame:
    """Sums and counts per value segment and payment method, from which M4 and M6 both follow: the
    fact is scanned, shuffled by person and joined to the dimension once. A few rows."""
    used = F.col("used_installments")
    inst = F.col("max_installments")
    per = _known_customers(fact).groupBy("customer_unique_id", "primary_payment_type").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("order_value").alias("v"),
        F.sum(inst).alias("i"),
        F.sum(F.when(used, inst)).alias("iu"),
        count_if(used).alias("u"),
        sum_if("order_value", used).alias("vi"),
    )
    j = per.join(_segments(dim, "value_segment"), "customer_unique_id", "inner")
    return j.groupBy("value_segment", "primary_payment_type").agg(
        F.count(F.lit(1)).alias("persons"),                 # one row per person and method
        *[F.sum(c).alias(c) for c in ("n", "v", "i", "iu", "u", "vi")])


def mart_hvc_payment_profile(fact: DataFrame, dim: DataFrame, rollup: DataFrame | None = None) -> DataFrame:
    """Orders, revenue and instalments per segment and method. ``rollup``:
    ``segment_method_rollup`` where the caller has it written."""
    r = rollup if rollup is not None else segment_method_rollup(fact, dim)
    return r.select(
        "value_segment", "primary_payment_type",
        F.col("n").alias("order_count"),
        F.col("persons").alias("customer_count"),
        round_dec("v", 2).alias("total_revenue"),
        round_money(ratio(F.col("v"), F.col("n")), 2).alias("avg_order_value"),
        round_money(ratio(F.col("i"), F.col("n")), 2).alias("avg_installments"),
        round_money(ratio(F.col("iu"), F.col("u")), 2).alias("avg_installments_when_used"),
        round_money(percent(F.col("u"), F.col("n")), 1).alias("pct_orders_with_installments"),
    )


# --------------------------------------------------------------------- M5
def state_centroids(dim_geo: DataFrame) -> DataFrame:
    """Unweighted mean of the prefix coordinates per state (one row per state)."""
    return dim_geo.groupBy("state").agg(mean_exact("lat").alias("lat"), mean_exact("lng").alias("lng"))


def mart_geo_value(dim: DataFrame, dim_geo: DataFrame) -> DataFrame:
    """HVC concentration per state. The dimension is unique per person, so plain
    counts equal the distinct counts; the centroid is joined after aggregating."""
    hvc, mon = F.col("is_high_value_customer"), F.col("monetary")
    per_state = dim.groupBy("customer_state").agg(
        F.count(F.lit(1)).alias("total_customers"),
        count_if(hvc).alias("hvc_customers"),
        F.sum(mon).alias("_total_revenue"),
        sum_if(mon, hvc).alias("_hvc_revenue"),
    )
    cent = state_centroids(dim_geo).withColumnRenamed("state", "customer_state")
    j = per_state.join(cent, "customer_state", "left")
    return j.select(
        "customer_state", "lat", "lng", "total_customers", "hvc_customers",
        round_money(percent(F.col("hvc_customers"), F.col("total_customers")), 2).alias("hvc_penetration_pct"),
        round_dec("_total_revenue", 2).alias("total_revenue"),
        round_dec("_hvc_revenue", 2).alias("hvc_revenue"),
        round_money(percent(F.col("_hvc_revenue"), F.col("_total_revenue")), 1).alias("hvc_revenue_share_pct"),
    )


# --------------------------------------------------------------------- M6
def mart_payment_uplift(fact: DataFrame, dim: DataFrame, adoption: float = UPLIFT_ADOPTION,
                        rollup: DataFrame | None = None) -> DataFrame:
    """Instalment uplift per segment, from the same rollup as the profile."""
    r = rollup if rollup is not None else segment_method_rollup(fact, dim)
    addressable = F.col("primary_payment_type") == ADDRESSABLE_METHOD
    nn, vn = F.col("n") - F.col("u"), F.col("v") - F.col("vi")      # orders without instalments
    seg = r.withColumns({"nn": nn, "vn": vn}).groupBy("value_segment").agg(
        _div("vi", "u").alias("_aov_i"),                    # NULL when no order matches
        _div("vn", "nn").alias("_aov_n"),
        F.sum(F.when(addressable, F.col("nn")).otherwise(0)).alias("addressable_orders"),
        sum_if("vn", addressable).alias("_addr_rev"),
    )
    gap = F.col("_aov_i") - F.col("_aov_n")
    return seg.select(
        "value_segment",
        round_money("_aov_i", 2).alias("aov_installment"),
        round_money("_aov_n", 2).alias("aov_no_installment"),
        round_money(gap, 2).alias("aov_gap"),
        "addressable_orders",
        round_dec("_addr_rev", 2).alias("current_addressable_revenue"),
        round_money(F.col("addressable_orders").cast("double") * F.lit(float(adoption))
                    * floor_zero(gap), 2).alias("projected_annual_uplift"),
    )


@dataclass
class Marts:
    dim_geolocation: DataFrame
    fct_order_payments: DataFrame
    dim_customer: DataFrame
    mart_hvc_payment_profile: DataFrame
    mart_geo_value: DataFrame
    mart_payment_uplift: DataFrame
