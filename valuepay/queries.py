"""Registered queries: one callable per operator family, each ``(spark, sf_dir) -> DataFrame``.

Every query reads the driver's whole tables through the source adapters. The
sources and marts of one data directory are written to the shared folder once per
session, on first use, and the card and operator queries scan them there.
Results pass through ``portable`` so both engines compare on plain types:
decimals as double, integers as bigint, dates as ISO strings.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from valuepay.functions.scalars import days_between, month_start, order_date, round_money
from valuepay.operators.aggregates import (
    arg_max, avg_if, count_if, distinct_counts, first_of_earliest, percent, sum_if,
)
from valuepay.operators.frequent import frequent_values
from valuepay.operators.joins import left_join_filled
from valuepay.operators.quantiles import exact_quantiles
from valuepay.plans import cards as C
from valuepay.plans import marts as M
from valuepay.plans import quality as Q
from valuepay.plans.scenario import uplift_scenarios
from valuepay.schemas import PAYMENT_TYPES, SOURCES
from valuepay.session import MAX_PARTITION_BYTES, bounded_tasks, planned_bytes, scratch_path, written
from valuepay.sources import fixtures
from valuepay.sources.bucketed import bucket_count, write_bucketed
from valuepay.sources.csv_source import (
    SourceEmpty, SourceMissing, read_category_translation, read_source, validate_source, write_csv,
)
from valuepay.sources.footers import footer_tables
from valuepay.sources.ranged import file_count, read_between, write_ranged

Query = Callable[[SparkSession, str], DataFrame]


def portable(df: DataFrame) -> DataFrame:
    """Plain types for cross-engine comparison: decimals as double, integers as bigint,
    dates as ISO ``yyyy-MM-dd`` strings (client libraries map DATE differently)."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DecimalType, T.FloatType)):
            c = c.cast("double")
        elif isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            c = c.cast("bigint")
        elif isinstance(f.dataType, T.DateType):
            c = c.cast("string")
        cols.append(c.alias(f.name))
    return df.select(cols)


# ------------------------------------------------------------------ shared marts
class _Sources(Mapping):
    """Adapted sources of one data directory, each written to the shared folder on first use and
    read from there, so that a query scans the columns it needs. Payments and items are projections
    of the numbered lines, which are shuffled, sorted and written once for both."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir, self.frames = spark, sf_dir, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self.frames:
            self.frames[name] = (fixtures.LINE_VIEWS[name](self.lines) if name in fixtures.LINE_VIEWS
                                 else self._written(fixtures.VIEWS[name](self.spark, self.sf_dir), name))
        return self.frames[name]

    def _written(self, df: DataFrame, name: str) -> DataFrame:
        with bounded_tasks(self.spark, [df]):
            return written(df, f"source-{name}")

    @cached_property
    def lines(self) -> DataFrame:
        return self._written(fixtures.numbered_lines(self.spark, self.sf_dir), "numbered_lines")

    def __iter__(self):
        return iter(fixtures.VIEWS)

    def __len__(self) -> int:
        return len(fixtures.VIEWS)


class _Bundle:
    """Sources of one data directory, and its marts, written on first use."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.src = _Sources(spark, sf_dir)

    @cached_property
    def marts(self) -> M.Marts:
        src = self.src
        read = [src[t] for t in ("geolocation", "orders", "order_payments", "order_items", "customers")]
        with bounded_tasks(src.spark, read):
            geo = written(M.dim_geolocation(src["geolocation"]), "dim_geolocation")
            fact = written(M.fct_order_payments(src["orders"], src["order_payments"], src["order_items"],
                                                src["customers"]), "fct_order_payments")
            dim = written(M.dim_customer(fact), "dim_customer")
            rollup = written(M.segment_method_rollup(fact, dim), "segment_method")
        return M.Marts(geo, fact, dim, M.mart_hvc_payment_profile(fact, dim, rollup=rollup),
                       M.mart_geo_value(dim, geo), M.mart_payment_uplift(fact, dim, rollup=rollup))


    @cached_property
    def bucketed(self):
        """The order tables in buckets of ``order_id``; more buckets, not larger ones, where there are more rows."""
        frames = {t: self.src[t] for t in ("orders", "order_payments", "order_items")}
        with bounded_tasks(self.src.spark, frames.values()):
            return write_bucketed(frames, scratch_path(self.src.spark, "bucketed"), "order_id",
                                  buckets=bucket_count(frames.values(), least=8))

    @cached_property
    def refreshed(self):
        """A whole refresh of the sources, and the pointer it is published at."""
        from valuepay.plans.refresh import refresh
        spark, sf_dir = self.src.spark, self.src.sf_dir
        pointer = scratch_path(spark, "published")
        # what this session has written already is read there, the rest straight from the tables
        return refresh(spark, scratch_path(spark, "refresh"), sources={**fixtures.load(spark, sf_dir), **self.src.frames},
                       min_rows={t: 1 for t in SOURCES}, publish_to=pointer), pointer


_BUNDLES: dict[tuple[str, str], _Bundle] = {}


def bundle(spark: SparkSession, sf_dir: str) -> tuple[dict[str, DataFrame], M.Marts]:
    """Sources and marts of one data directory, built once per session."""
    return _bundle(spark, sf_dir).src, _bundle(spark, sf_dir).marts


def _bundle(spark: SparkSession, sf_dir: str) -> _Bundle:
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _BUNDLES:
        _BUNDLES[key] = _Bundle(spark, sf_dir)
    return _BUNDLES[key]


def _marts(spark, sf_dir) -> M.Marts:
    return _bundle(spark, sf_dir).marts


def _src(spark, sf_dir) -> dict[str, DataFrame]:
    return _bundle(spark, sf_dir).src


# ------------------------------------------------------------------ marts
def q_fct_order_payments(spark, sf_dir):
    return _marts(spark, sf_dir).fct_order_payments


def q_fct_from_buckets(spark, sf_dir):
    store, src = _bundle(spark, sf_dir).bucketed, _src(spark, sf_dir)
    with bounded_tasks(spark, [src[t] for t in ("orders", "order_payments", "order_items", "customers")]):
        return written(M.fct_from_buckets(store, src["customers"]), "fct_from_buckets")


def q_dim_customer(spark, sf_dir):
    return _marts(spark, sf_dir).dim_customer


def q_dim_geolocation(spark, sf_dir):
    return _marts(spark, sf_dir).dim_geolocation


def q_hvc_payment_profile(spark, sf_dir):
    return _marts(spark, sf_dir).mart_hvc_payment_profile


def _compare_centroid(df: DataFrame) -> DataFrame:
    """The state centroid is a mean of means of doubles, which every engine rounds differently
    in the last bit; the registered result shows it at 9 decimals (the mart keeps all)."""
    return df.withColumns({c: F.col(c).cast("decimal(38,9)").cast("double") for c in ("lat", "lng")})


def q_geo_value(spark, sf_dir):
    return _compare_centroid(_marts(spark, sf_dir).mart_geo_value)


def q_payment_uplift(spark, sf_dir):
    return _marts(spark, sf_dir).mart_payment_uplift


# ------------------------------------------------------------------ cards
def q_card1(spark, sf_dir):
    return C.card1_kpi(_marts(spark, sf_dir).dim_customer)


def q_card2(spark, sf_dir):
    return C.card2_aov_by_segment(_marts(spark, sf_dir).dim_customer)


def q_card3(spark, sf_dir):
    return C.card3_payment_mix(_marts(spark, sf_dir).mart_hvc_payment_profile)


def q_card4(spark, sf_dir):
    return C.card4_installments(_marts(spark, sf_dir).mart_hvc_payment_profile)


def q_card5(spark, sf_dir):
    return C.card5_geo(_marts(spark, sf_dir).mart_geo_value)


def q_card6(spark, sf_dir):
    return C.card6_uplift(_marts(spark, sf_dir).mart_payment_uplift)


def q_card7(spark, sf_dir):
    m = _marts(spark, sf_dir)
    return C.card7_monthly_revenue(m.fct_order_payments, m.dim_customer)


def q_card8(spark, sf_dir):
    return C.card8_top_cities(_marts(spark, sf_dir).dim_customer)


def q_uplift_scenarios(spark, sf_dir):
    return uplift_scenarios(_marts(spark, sf_dir).mart_payment_uplift)


def q_verify_counts(spark, sf_dir):
    return C.verify_counts(_marts(spark, sf_dir).dim_customer)


# ------------------------------------------------------------------ quality
def q_dq_min_rows(spark, sf_dir):
    return Q.staging_min_rows(_src(spark, sf_dir))


def q_dq_orphans(spark, sf_dir):
    s = _src(spark, sf_dir)
    return Q.orphan_payments(s["order_payments"], s["orders"])


def q_dq_stored_min_rows(spark, sf_dir):
    """The minimum-row gate over the refresh's staging tables, answered from their files' footers."""
    return Q.staging_min_rows(footer_tables(spark, _bundle(spark, sf_dir).refreshed[0].staging))


def q_dq_orphans_observed(spark, sf_dir):
    """The orphan check as the refresh observed it while it wrote the fact."""
    return spark.createDataFrame(Q.orphan_rows(_bundle(spark, sf_dir).refreshed[0].orphans), Q.REPORT_SCHEMA)


def q_dq_marts(spark, sf_dir):
    m = _marts(spark, sf_dir)
    return Q.mart_checks(m.fct_order_payments, m.dim_customer)


# ------------------------------------------------------------------ staging via CSV
def _staging(table: str) -> Query:
    def run(spark, sf_dir):
        path = scratch_path(spark, f"landing-{table}")
        write_csv(_src(spark, sf_dir)[table], f"{path}/{table}.csv")
        return read_source(spark, path, table)
    run.__name__ = f"q_staging_{table}"
    return run


def q_staging_customers_reordered(spark, sf_dir):
    """A file whose columns stand in another order loads by header name."""
    path = scratch_path(spark, "landing-reordered")
    df = _src(spark, sf_dir)["customers"]
    write_csv(df.select(*reversed(df.columns)), f"{path}/customers.csv")
    return read_source(spark, path, "customers")


def q_staging_malformed_timestamps(spark, sf_dir):
    """Purchase times that are no timestamps load as NULL, the others as they are."""
    path = scratch_path(spark, "landing-malformed")
    df = _src(spark, sf_dir)["orders"]
    ts = F.col("order_purchase_timestamp")
    bad = F.col("order_id").cast("bigint") % 7 == 0
    text = F.when(bad, F.lit("not a time")).otherwise(F.date_format(ts, "yyyy-MM-dd HH:mm:ss"))
    write_csv(df.withColumn("order_purchase_timestamp", text), f"{path}/orders.csv")
    return read_source(spark, path, "orders").select("order_id", "order_purchase_timestamp")


def q_staging_order_reviews_split(spark, sf_dir):
    """One large file of reviews whose messages hold line breaks and quotes, read in many splits: the
    scan's split size is set to a fraction of the file while it is loaded."""
    path = scratch_path(spark, "landing-split")
    df = _src(spark, sf_dir)["order_reviews"]
    text = F.concat(F.col("review_comment_title"), F.lit('\n"'), F.coalesce("review_comment_message", F.lit("")), F.lit('",\n\nend'))
    write_csv(df.withColumn("review_comment_message", text).coalesce(1), f"{path}/order_reviews.csv")
    size = planned_bytes([spark.read.text(f"{path}/order_reviews.csv")])
    before = spark.conf.get(MAX_PARTITION_BYTES, None)
    spark.conf.set(MAX_PARTITION_BYTES, str(max(size // 16, 1 << 12)))
    try:
        return written(read_source(spark, path, "order_reviews", by_records=True), "reviews-split")
    finally:
        spark.conf.unset(MAX_PARTITION_BYTES) if before is None else spark.conf.set(MAX_PARTITION_BYTES, before)


def q_category_translation(spark, sf_dir):
    """The lookup written as CSV and read back."""
    path = scratch_path(spark, "landing-lookup")
    part = spark.read.parquet(f"{sf_dir.rstrip('/')}/part.parquet")
    write_csv(part.select(F.col("p_type").alias("product_category_name"),
                          F.upper("p_type").alias("product_category_name_english")).distinct(),
              f"{path}/category_translation.csv")
    return read_category_translation(spark, path)


def q_payments_fifth_type(spark, sf_dir):
    """Payment rollup with a method outside the four that have columns."""
    p = _src(spark, sf_dir)["order_payments"]
    t = F.when(F.col("payment_sequential") % 3 == 2, F.lit("pix")).otherwise(F.col("payment_type"))
    return M.payments_per_order(p.withColumn("payment_type", t)).select(
        "order_id", "order_value", "primary_payment_type", "distinct_payment_methods", "credit_card_value")


def q_card8_state(spark, sf_dir):
    return C.card8_top_cities(_marts(spark, sf_dir).dim_customer, state="NATION_7")


def q_card_row_order(spark, sf_dir):
    """Place of every row of the sorted cards 2 to 7, by the card's own sort columns (a card has a few rows)."""
    m = _marts(spark, sf_dir)
    sorted_cards = {
        "card2": C.card2_aov_by_segment(m.dim_customer),
        "card3": C.card3_payment_mix(m.mart_hvc_payment_profile),
        "card4": C.card4_installments(m.mart_hvc_payment_profile),
        "card5": C.card5_geo(m.mart_geo_value),
        "card6": C.card6_uplift(m.mart_payment_uplift),
        "card7": C.card7_monthly_revenue(m.fct_order_payments, m.dim_customer),
    }
    out = None
    for name, df in sorted_cards.items():
        order = C.CARD_ORDER[name]
        placed = df.select(F.lit(name).alias("card"), F.col(order[-1]).cast("string").alias("row_key"),
                           (F.row_number().over(Window.orderBy(*C.sort_columns(name))) - 1).cast("bigint").alias("place"))
        out = placed if out is None else out.union(placed)
    return out


def q_ranged_lookup(spark, sf_dir):
    """Orders of a stretch of keys from the fact mart ranged by ``order_id``: only the files that hold them are read."""
    path = scratch_path(spark, "ranged-fact")
    fact = _marts(spark, sf_dir).fct_order_payments
    with bounded_tasks(spark, [fact]):
        write_ranged(fact, path, "order_id", files=file_count(fact, least=16))
    return read_between(spark, path, "order_id", "2", "3").select("order_id", "customer_unique_id", "order_value", "item_count")


def q_refresh_roundtrip(spark, sf_dir):
    """A whole refresh into the shared folder, published, and its marts read back."""
    from valuepay.plans.refresh import published_marts
    _, pointer = _bundle(spark, sf_dir).refreshed
    marts = published_marts(spark, pointer)
    money = {"fct_order_payments": "order_value", "dim_customer": "monetary", "mart_hvc_payment_profile": "total_revenue",
             "mart_geo_value": "hvc_revenue", "mart_payment_uplift": "current_addressable_revenue"}
    out = None
    for name, df in sorted(marts.items()):
        total = F.sum(money[name]).cast("double") if name in money else F.lit(None).cast("double")
        one = df.agg(F.lit(name).alias("mart"), F.count(F.lit(1)).alias("mart_rows"), total.alias("money"))
        out = one if out is None else out.union(one)
    return out


def q_load_metrics(spark, sf_dir):
    """K5: the metrics table that a refresh leaves beside its marts."""
    result, _ = _bundle(spark, sf_dir).refreshed
    return spark.read.parquet(f"{result.run_dir}/metrics").select(F.col("step"), F.col("table").alias("name"), F.col("rows").alias("n"))


def q_source_checks(spark, sf_dir):
    """S3, S4: what each source folder says when three tables are landed, one of them as a header alone."""
    path = scratch_path(spark, "landing-checks")
    src = _src(spark, sf_dir)
    for table in ("orders", "customers"):
        write_csv(src[table], f"{path}/{table}.csv")
    write_csv(src["order_items"].limit(0).coalesce(1), f"{path}/order_items.csv")
    rows = []
    for table in sorted(SOURCES):
        try:
            n, found = validate_source(spark, path, table), "loaded"
        except (SourceMissing, SourceEmpty) as exc:
            n, found = 0, "missing" if isinstance(exc, SourceMissing) else "empty"
        rows.append((table, found, n))
    return spark.createDataFrame(rows, "name string, found string, n long")


def q_gate_outcomes(spark, sf_dir):
    """DQ6: what ``enforce`` does with the marts' report inside its bounds and with bounds that the marts break."""
    m = _marts(spark, sf_dir)
    rows = []
    for gate, band in (("accepted", (0.0, 1.0)), ("refused", (1.5, 2.0))):
        try:
            rows.append((gate, len(Q.enforce(Q.mart_checks(m.fct_order_payments, m.dim_customer, band), gate)), ""))
        except Q.QualityGateFailed as exc:
            rows.append((gate, 0, str(exc).split(":")[1].strip()))
    return spark.createDataFrame(rows, "gate string, passed long, failing string")


# ------------------------------------------------------------------ operator families
def q_agg_argmax_tiebreak(spark, sf_dir):
    """argMax with ties: the method of the largest payment, lowest sequence number on ties."""
    p = _src(spark, sf_dir)["order_payments"]
    return p.groupBy("order_id").agg(
        arg_max("payment_type", "payment_value", "payment_sequential").alias("primary_payment_type"),
        F.max("payment_value").alias("top_payment_value"),
        F.count(F.lit(1)).alias("payments"))


def q_agg_mode(spark, sf_dir):
    """anyHeavy as a true mode: most frequent city and state per prefix, ties to the smallest."""
    g = _src(spark, sf_dir)["geolocation"]
    return frequent_values(
        g, {"geolocation_zip_code_prefix": F.col("geolocation_zip_code_prefix")},
        {"city": F.col("geolocation_city"), "state": F.col("geolocation_state")}, {"points": F.lit(1)})


def q_agg_any_first_order(spark, sf_dir):
    """any(state), any(city) made deterministic: both from the person's earliest order."""
    f = _marts(spark, sf_dir).fct_order_payments.where(F.col("customer_unique_id") != "")
    return f.groupBy("customer_unique_id").agg(
        first_of_earliest(["customer_state", "customer_city"], "order_purchase_timestamp", "order_id")
        .alias("loc")).select("customer_unique_id", "loc.customer_state", "loc.customer_city")


def q_agg_sum_if(spark, sf_dir):
    """sumIf per state; a condition nothing matches gives 0, not NULL."""
    f = _marts(spark, sf_dir).fct_order_payments
    t, v = F.col("primary_payment_type"), F.col("order_value")
    return f.groupBy("customer_state").agg(
        *[sum_if(v, t == pt).alias(f"{pt}_revenue") for pt in PAYMENT_TYPES],
        sum_if(v, ~t.isin(*PAYMENT_TYPES)).alias("other_revenue"))


def q_agg_avg_if_empty(spark, sf_dir):
    """avgIf: NULL (not NaN) for groups where nothing matches."""
    f = _marts(spark, sf_dir).fct_order_payments
    return f.groupBy("order_status").agg(
        round_money(avg_if("order_value", F.col("used_installments")), 2).alias("aov_installment"),
        round_money(avg_if("order_value", F.col("item_count") == 0), 2).alias("aov_without_items"),
        round_money(avg_if("order_value", F.col("order_value") < 0), 2).alias("aov_negative"))


def q_agg_count_if(spark, sf_dir):
    f = _marts(spark, sf_dir).fct_order_payments
    return f.groupBy("primary_payment_type").agg(
        count_if(F.col("used_installments")).alias("with_installments"),
        count_if(F.col("customer_unique_id") == "").alias("without_customer"),
        count_if(F.col("order_date").isNull()).alias("undated"),
        F.count(F.lit(1)).alias("orders"))


def q_agg_count_distinct_if(spark, sf_dir):
    """uniqExact and uniqExactIf per state: one flag per state and person first, so no row is expanded."""
    f = _marts(spark, sf_dir).fct_order_payments.where(F.col("customer_unique_id") != "")
    return distinct_counts(f, ["customer_state"], "customer_unique_id", {
        "customers": F.lit(True), "customers_with_installments": F.col("used_installments")})


def _acctbal_quantiles(spark, sf_dir, **kw) -> DataFrame:
    cust = spark.read.parquet(f"{sf_dir.rstrip('/')}/customer.parquet")
    q = exact_quantiles(cust, "c_acctbal", (0.90, 0.95), **kw)
    return cust.agg(F.count("c_acctbal").alias("n")).select(
        "n", F.lit(q[0.90]).cast("double").alias("p90"), F.lit(q[0.95]).cast("double").alias("p95"))


def q_agg_quantile_exact(spark, sf_dir):
    """quantileExact at 0.90 / 0.95 on customer balance (p*n is an integer there)."""
    return _acctbal_quantiles(spark, sf_dir)


def q_agg_quantile_exact_bracketed(spark, sf_dir):
    """Same answer in many passes: eight buckets a pass instead of thousands."""
    return _acctbal_quantiles(spark, sf_dir, buckets=8)


def q_agg_median(spark, sf_dir):
    """Exact interpolated median of customer balance and of customer monetary value."""
    cust = spark.read.parquet(f"{sf_dir.rstrip('/')}/customer.parquet")
    a = exact_quantiles(cust, "c_acctbal", median=True)
    dim = _marts(spark, sf_dir).dim_customer
    b = exact_quantiles(dim, "monetary", median=True)
    return cust.agg(F.count("c_acctbal").alias("n")).select(
        "n", F.lit(a["median"]).cast("double").alias("median_acctbal"),
        F.lit(b["median"]).cast("double").alias("median_monetary"))


def q_agg_of_agg(spark, sf_dir):
    """Mean of means, unweighted: state centroid over prefix centroids."""
    return _compare_centroid(M.state_centroids(_marts(spark, sf_dir).dim_geolocation))


def q_ratio_percent(spark, sf_dir):
    f = _marts(spark, sf_dir).fct_order_payments
    used = F.col("used_installments")
    return f.groupBy("customer_state").agg(
        round_money(percent(count_if(used), F.count(F.lit(1))), 1).alias("pct_orders_with_installments"),
        round_money(percent(F.sum("credit_card_value"), F.sum("order_value")), 2).alias("credit_card_share_pct"))


def q_join_inner_using(spark, sf_dir):
    """Orders joined to their payment rollup: unpaid orders drop out."""
    s = _src(spark, sf_dir)
    return s["orders"].select("order_id", "order_status").join(
        M.payments_per_order(s["order_payments"]).select("order_id", "order_value"), "order_id", "inner")


def q_join_left_default_fill(spark, sf_dir):
    """Left joins with default values: missing items give 0, missing customers ''."""
    s = _src(spark, sf_dir)
    o = s["orders"].select("order_id", "customer_id")
    j = left_join_filled(o, M.items_per_order(s["order_items"]), "order_id",
                         {"items_price": 0, "freight_value": 0, "item_count": 0})
    return left_join_filled(j, s["customers"].select("customer_id", "customer_unique_id", "customer_state"),
                            "customer_id", {"customer_unique_id": "", "customer_state": ""})


def q_join_left_anti(spark, sf_dir):
    """Payments whose order does not exist."""
    s = _src(spark, sf_dir)
    return s["order_payments"].join(s["orders"].select("order_id"), "order_id", "left_anti") \
        .select("order_id", "payment_sequential", "payment_type", "payment_value")


def q_scalar_subquery_recency(spark, sf_dir):
    """Days from each person's last order to the latest order date of the whole fact."""
    fact = _marts(spark, sf_dir).fct_order_payments
    latest = fact.agg(F.max("order_date")).scalar()          # uncorrelated scalar subquery
    per = fact.where(F.col("customer_unique_id") != "").groupBy("customer_unique_id") \
        .agg(F.max("order_date").alias("last_order_date"))
    return per.select("customer_unique_id", "last_order_date",
                      days_between("last_order_date", latest).alias("recency_days"))


def q_case_segments(spark, sf_dir):
    d = _marts(spark, sf_dir).dim_customer
    return d.groupBy("value_segment").agg(
        F.count(F.lit(1)).alias("customers"), F.min("monetary").alias("min_monetary"),
        F.max("monetary").alias("max_monetary"),
        count_if(F.col("is_top5_value")).alias("top5"),
        count_if(F.col("is_high_value_customer")).alias("hvc"))


def q_date_month_trunc(spark, sf_dir):
    o = _src(spark, sf_dir)["orders"]
    ts = F.col("order_purchase_timestamp")
    return o.groupBy(month_start(ts).alias("order_month")).agg(
        F.count(F.lit(1)).alias("orders"),
        F.count_distinct(order_date(ts)).alias("days_with_orders"),
        F.min(order_date(ts)).alias("first_day"))


def q_round_half(spark, sf_dir):
    """Half-way values from real amounts: half of a 2-decimal amount ends in 5 at the third decimal."""
    p = _src(spark, sf_dir)["order_payments"]
    half = F.col("payment_value").cast("double") / 2
    return p.select("order_id", "payment_sequential",
                    round_money(half, 2).alias("half_2"), round_money(half, 0).alias("half_0"),
                    round_money(-half, 1).alias("neg_half_1"))


def q_filter_predicates(spark, sf_dir):
    f = _marts(spark, sf_dir).fct_order_payments
    kept = f.where((F.col("order_status") != "canceled") & (F.col("customer_unique_id") != "")
                   & F.col("order_month").isNotNull()
                   & F.col("primary_payment_type").isin("credit_card", "boleto")
                   & ~(F.col("order_value") < 0) & F.col("used_installments"))
    return kept.groupBy("primary_payment_type", "order_status").agg(
        F.count(F.lit(1)).alias("orders"), F.sum("order_value").alias("revenue"))


def q_topk_cities(spark, sf_dir):
    """Top 10 cities by number of customers; state and city break ties."""
    d = _marts(spark, sf_dir).dim_customer
    return (d.groupBy("customer_state", "customer_city")
             .agg(F.count(F.lit(1)).alias("customers"), F.sum("monetary").alias("revenue"))
             .orderBy(F.desc("customers"), "customer_state", "customer_city").limit(10))


REGISTRY: dict[str, Query] = {
    "fct_order_payments": q_fct_order_payments,
    "fct_from_buckets": q_fct_from_buckets,
    "dim_customer": q_dim_customer,
    "dim_geolocation": q_dim_geolocation,
    "hvc_payment_profile": q_hvc_payment_profile,
    "geo_value": q_geo_value,
    "payment_uplift": q_payment_uplift,
    "card1_kpi": q_card1,
    "card2_aov_by_segment": q_card2,
    "card3_payment_mix": q_card3,
    "card4_installments": q_card4,
    "card5_geo": q_card5,
    "card6_uplift": q_card6,
    "card7_monthly_revenue": q_card7,
    "card8_top_cities": q_card8,
    "uplift_scenarios": q_uplift_scenarios,
    "verify_counts": q_verify_counts,
    "dq_min_rows": q_dq_min_rows,
    "dq_stored_min_rows": q_dq_stored_min_rows,
    "dq_orphans": q_dq_orphans,
    "dq_orphans_observed": q_dq_orphans_observed,
    "dq_marts": q_dq_marts,
    **{f"staging_{t}": _staging(t) for t in SOURCES},
    "staging_customers_reordered": q_staging_customers_reordered,
    "staging_malformed_timestamps": q_staging_malformed_timestamps,
    "staging_order_reviews_split": q_staging_order_reviews_split,
    "category_translation": q_category_translation,
    "payments_fifth_type": q_payments_fifth_type,
    "card8_state": q_card8_state,
    "card_row_order": q_card_row_order,
    "ranged_lookup": q_ranged_lookup,
    "refresh_roundtrip": q_refresh_roundtrip,
    "load_metrics": q_load_metrics,
    "source_checks": q_source_checks,
    "gate_outcomes": q_gate_outcomes,
    "agg_argmax_tiebreak": q_agg_argmax_tiebreak,
    "agg_mode": q_agg_mode,
    "agg_any_first_order": q_agg_any_first_order,
    "agg_sum_if": q_agg_sum_if,
    "agg_avg_if_empty": q_agg_avg_if_empty,
    "agg_count_if": q_agg_count_if,
    "agg_count_distinct_if": q_agg_count_distinct_if,
    "agg_quantile_exact": q_agg_quantile_exact,
    "agg_quantile_exact_bracketed": q_agg_quantile_exact_bracketed,
    "agg_median": q_agg_median,
    "agg_of_agg": q_agg_of_agg,
    "ratio_percent": q_ratio_percent,
    "join_inner_using": q_join_inner_using,
    "join_left_default_fill": q_join_left_default_fill,
    "join_left_anti": q_join_left_anti,
    "scalar_subquery_recency": q_scalar_subquery_recency,
    "case_segments": q_case_segments,
    "date_month_trunc": q_date_month_trunc,
    "round_half": q_round_half,
    "filter_predicates": q_filter_predicates,
    "topk_cities": q_topk_cities,
}


def registered() -> dict[str, Query]:
    return {name: (lambda fn: lambda spark, sf_dir: portable(fn(spark, sf_dir)))(fn)
            for name, fn in REGISTRY.items()}
