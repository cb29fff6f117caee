"""Invariants over the sf0.01 marts."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF01
from valuepay.plans import cards as C
from valuepay.plans.scenario import uplift_scenarios
from valuepay.queries import bundle


@pytest.fixture(scope="module")
def marts(spark):
    return bundle(spark, SF01)[1]


def test_each_order_once(marts):
    f = marts.fct_order_payments
    assert f.count() == f.select("order_id").distinct().count() == 13932


def test_profile_counts_fact_rows_with_customer(marts):
    total = marts.mart_hvc_payment_profile.agg(F.sum("order_count")).first()[0]
    assert total == marts.fct_order_payments.where("customer_unique_id != ''").count()


def test_geo_counts_every_person(marts):
    dim_rows = marts.dim_customer.count()
    assert marts.mart_geo_value.agg(F.sum("total_customers")).first()[0] == dim_rows == 1312


def test_segments_partition_dimension(marts):
    seg = {r.value_segment: r["count"] for r in marts.dim_customer.groupBy("value_segment").count().collect()}
    assert set(seg) <= {"Top 5% Whale", "High Value", "Mid Value", "Standard"}
    assert sum(seg.values()) == 1312
    hvc = marts.dim_customer.where("is_high_value_customer").count()
    assert hvc == seg["Top 5% Whale"] + seg["High Value"] == 132     # 10.06 % of 1312


def test_monthly_revenue_adds_up(marts):
    fact, dim = marts.fct_order_payments, marts.dim_customer
    c7 = C.card7_monthly_revenue(fact, dim).agg(F.sum(F.col("hvc_revenue") + F.col("other_revenue")),
                                                 F.count(F.lit(1))).first()
    dated = float(fact.where("customer_unique_id != '' AND order_month IS NOT NULL")
                  .agg(F.sum("order_value")).first()[0])
    assert abs(float(c7[0]) - dated) <= 0.5 * c7[1]


def test_scenario_at_defaults_matches_uplift_mart(marts):
    upl = marts.mart_payment_uplift
    r = uplift_scenarios(upl).where("adoption_pct = 30 AND capture_pct = 100").first()
    mart_total = upl.agg(F.sum("projected_annual_uplift")).first()[0]
    orders = upl.agg(F.sum("addressable_orders")).first()[0]
    assert r.pct_of_baseline == 100.0
    assert abs(r.projected_uplift - mart_total) <= 0.01 * orders + 1     # gaps are rounded to cents


def test_mart_columns_follow_the_contract(marts):
    from valuepay.plans.marts import DIM_COLUMNS, FACT_COLUMNS
    assert marts.fct_order_payments.columns == FACT_COLUMNS
    assert marts.dim_customer.columns == DIM_COLUMNS
    assert marts.dim_geolocation.columns == ["zip_code_prefix", "lat", "lng", "city", "state"]
    assert marts.mart_hvc_payment_profile.columns == [
        "value_segment", "primary_payment_type", "order_count", "customer_count", "total_revenue",
        "avg_order_value", "avg_installments", "avg_installments_when_used", "pct_orders_with_installments"]
    assert marts.mart_geo_value.columns == [
        "customer_state", "lat", "lng", "total_customers", "hvc_customers", "hvc_penetration_pct",
        "total_revenue", "hvc_revenue", "hvc_revenue_share_pct"]
    assert marts.mart_payment_uplift.columns == [
        "value_segment", "aov_installment", "aov_no_installment", "aov_gap", "addressable_orders",
        "current_addressable_revenue", "projected_annual_uplift"]
    types = dict(marts.fct_order_payments.dtypes)
    assert types["order_date"] == "date" and types["order_month"] == "date"
    assert types["order_value"].startswith("decimal") and types["used_installments"] == "boolean"
