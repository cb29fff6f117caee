"""Payments without an order, counted while the fact is written (DQ2 with M2)."""

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from tests import frames
from valuepay.plans import marts as M
from valuepay.plans import quality as Q
from valuepay.plans.refresh import refresh
from valuepay.schemas import MIN_ROWS
from valuepay.session import scratch_path
from valuepay.sources import fixtures
from tests.conftest import SF001


def sources(spark):
    orders = frames.orders(spark, [("o1", "c1", "delivered", "2018-01-01 00:00:00"), ("o2", "c1", "canceled", "2018-01-02 00:00:00"),
                                   ("o3", "cX", "canceled", "2018-01-03 00:00:00"), ("o4", "c2", "shipped", "2018-01-04 00:00:00"),
                                   ("o5", "c2", "shipped", "2018-01-05 00:00:00")])
    payments = frames.payments(spark, [("o1", 1, "boleto", 1, "1.00"), ("o1", 2, "odd", 1, "2.00"), ("o2", 1, "voucher", 1, "3.00"),
                                       ("o3", 1, "boleto", 1, "4.00"), ("o4", 1, "other", 3, "5.00"),
                                       ("gone", 1, "boleto", 1, "6.00"), ("gone", 2, "odd", 1, "7.00"), ("", 1, "boleto", 1, "8.00")])
    items = frames.items(spark, [("o1", 1, "1.00", "0.50")])
    customers = frames.customers(spark, [("c1", "u1", "01000", "a", "SP"), ("c2", "u2", "02000", "b", "RJ")])
    return orders, payments, items, customers


def written_rows(spark, df):
    path = scratch_path(spark, "fact")
    df.write.parquet(path)
    return sorted(map(tuple, spark.read.parquet(path).collect()), key=repr)


def test_observed_orphans_equal_the_anti_join_and_the_fact_stays(spark):
    o, p, i, c = sources(spark)
    seen = Observation("orphans")
    fact = written_rows(spark, M.fct_order_payments(o, p, i, c, seen))
    assert fact == written_rows(spark, M.fct_order_payments(o, p, i, c)) and len(fact) == 2
    assert seen.get["orphans"] == Q.orphan_payments(p, o).first().observed == 3


def test_no_orphans_and_a_hot_order(spark):
    _, _, i, c = sources(spark)
    o = spark.range(300).select(F.concat(F.lit("o"), "id").alias("order_id"), F.lit("c1").alias("customer_id"), F.lit("shipped").alias("order_status"),
                                F.lit("2018-01-01").cast("timestamp_ntz").alias("order_purchase_timestamp"))
    for hot, found in (("o7", 0), ("gone", 10000)):  # one order key holds a third of all payments
        p = spark.range(30000).select(F.when(F.col("id") % 3 == 0, F.lit(hot)).otherwise(F.concat(F.lit("o"), F.col("id") % 300)).alias("order_id"),
                                      (F.col("id") + 1).cast("int").alias("payment_sequential"), F.lit("boleto").alias("payment_type"),
                                      F.lit(1).alias("payment_installments"), F.lit("1.00").cast("decimal(12,2)").alias("payment_value"))
        seen = Observation(f"orphans-{hot}")
        assert written_rows(spark, M.fct_order_payments(o, p, i, c, seen)) == written_rows(spark, M.fct_order_payments(o, p, i, c))
        assert seen.get["orphans"] == found


def test_payments_are_exchanged_once_for_both(spark):
    o, p, i, c = sources(spark)
    plans = [M.fct_order_payments(o, p, i, c, *more)._jdf.queryExecution().executedPlan().toString() for more in ((), (Observation("x"),))]
    assert plans[0].count("Exchange hashpartitioning") == plans[1].count("Exchange hashpartitioning")


@pytest.mark.parametrize("cluster", [True, "ranges"])
def test_refresh_reports_the_orphans_of_either_path(spark, cluster):
    given = fixtures.load(spark, SF001)
    result = refresh(spark, scratch_path(spark, "run"), sources=given, min_rows={t: 1 for t in MIN_ROWS}, cluster=cluster)
    want = Q.orphan_payments(given["order_payments"], given["orders"]).first().observed
    assert (result.orphans is None) == (cluster == "ranges")
    assert [r["observed"] for r in result.staging_report if r["check"] == "orphan_payments"] == [want]
