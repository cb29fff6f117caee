"""Bucketed order tables: nothing is exchanged on the key, hot keys stay out of buckets, the fact is the same."""

import pytest
from pyspark.sql import functions as F

from tests import frames
from valuepay.plans import marts as M
from valuepay.session import scratch_path
from valuepay.sources import bucketed as B

HOT = "o00003"
ORDER_TABLES = ("orders", "order_payments", "order_items")


@pytest.fixture(scope="module")
def sources(spark):
    orders = [(f"o{i:05d}", f"c{i % 40}", "canceled" if i % 37 == 0 else "delivered", "2018-03-04 10:00:00") for i in range(900)]
    kinds = ["credit_card", "boleto", "voucher", "debit_card", "not_defined"]
    pays = [(f"o{i:05d}", q + 1, kinds[(i + q) % 5], q, f"{(i * 7 + q * 13) % 500}.25") for i in range(950) for q in range(i % 4)]
    pays += [(HOT, q, kinds[q % 5], 1 + q % 3, f"{q % 90}.50") for q in range(10, 1510)]     # half of all payments
    items = [(f"o{i:05d}", 1, "10.00", "1.00") for i in range(0, 900, 2)]
    custs = [(f"c{k}", f"U{k // 2}", "02002", f"city{k % 7}", f"S{k % 5}") for k in range(30)]
    return {"orders": frames.orders(spark, orders), "order_payments": frames.payments(spark, pays),
            "order_items": frames.items(spark, items), "customers": frames.customers(spark, custs)}


@pytest.fixture(scope="module")
def store(spark, sources):
    path = scratch_path(spark, "buckets")
    return path, B.write_bucketed({t: sources[t] for t in ORDER_TABLES}, path, "order_id", buckets=6)


def rows(df):
    return sorted(map(str, df.collect()))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_every_row_is_stored_once_and_only_the_hot_key_apart(sources, store):
    for t in ORDER_TABLES:
        assert rows(store[1].cold[t].unionByName(store[1].hot[t])) == rows(sources[t])
        assert {r["order_id"] for r in store[1].hot[t].select("order_id").collect()} <= {HOT}
    assert store[1].hot["order_payments"].count() == 1503 and store[1].hot["orders"].count() == 1


def test_fact_from_buckets_equals_the_fact_from_plain_files(sources, store):
    plain = M.fct_order_payments(*[sources[t] for t in ORDER_TABLES], sources["customers"])
    assert rows(M.fct_from_buckets(store[1], sources["customers"])) == rows(plain)
    assert plain.where(F.col("order_id") == HOT).count() == 1


def test_nothing_is_exchanged_on_the_key(spark, sources, store):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        t = store[1].cold
        fact = M.fct_order_payments(t["orders"], t["order_payments"], t["order_items"], sources["customers"], colocated=True)
        plain = M.fct_order_payments(*[sources[n] for n in ORDER_TABLES], sources["customers"])
        for _ in range(2):                                     # as planned, and as run
            assert "hashpartitioning(order_id" not in plan(fact) and "hashpartitioning(customer_id" in plan(fact)
            assert "BroadcastExchange" not in plan(fact)
            fact.collect()
        assert "hashpartitioning(order_id" in plan(plain)
        count = M.payments_per_order(t["order_payments"]).join(t["orders"], "order_id", "left_anti")
        assert "hashpartitioning" not in plan(count) and count.count() == 37   # orders 901 to 949 that have payments
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_another_session_reads_the_same_buckets(spark, sources, store):
    path, written = store
    B.forget(spark, path, ORDER_TABLES)
    again = B.read_bucketed(spark, path)
    assert (again.key, again.buckets) == ("order_id", 6)
    for t in ORDER_TABLES:
        assert rows(again.cold[t].unionByName(again.hot[t])) == rows(sources[t])
    assert "hashpartitioning" not in plan(again.cold["order_payments"].groupBy("order_id").count())
    assert "hashpartitioning" in plan(again.hot["order_payments"].groupBy("order_id").count())


def test_hot_keys_are_exact(spark):
    df = spark.range(40_000).select(F.when(F.col("id") % 10 == 0, F.lit(None)).when(F.col("id") % 10 == 1, "a").when(F.col("id") < 1500, "b")
                                    .when(F.col("id") < 2000, "c").otherwise(F.col("id").cast("string")).alias("k"))
    assert B.hot_keys(df.repartition(9), "k") == ["a", "b"]      # 4,000 and 1,200 rows; c has 400


def test_empty_tables_and_null_keys(spark):
    path = scratch_path(spark, "buckets-empty")
    one = spark.createDataFrame([(None, 1), ("x", 2), ("it's", 3)], "k string, n int")
    s = B.write_bucketed({"a": one, "b": one.limit(0)}, path, "k", buckets=3)
    assert rows(s.hot["a"]) == rows(one.where("k IS NULL")) and rows(s.cold["a"]) == rows(one.where("k IS NOT NULL"))
    assert s.cold["b"].count() == s.hot["b"].count() == 0 and s.cold["b"].columns == ["k", "n"]
