"""Adapters that shape the driver's tables (TPC-H-like parquet) into the six
source schemas. They are test inputs, written with DataFrame operations; the
same views exist as SQL in the oracle module and give identical rows.

Every row of the driver's tables becomes a row. Edge cases are produced on purpose, by
changing values (see FIXTURES.md): cancelled orders, orders without a purchase time,
payments and items whose order is unknown, orders without payments or items, equal top
payments of different methods, orders whose customer is unknown, persons spanning two
customer ids and two states, a state without coordinates, and missing review messages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from valuepay.schemas import MONEY


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _days(ts, n: int):
    return F.timestamp_add("DAY", F.lit(n), ts)


def _unknown_where(key, cond):
    """The key as text; where ``cond`` holds, one that no other table has."""
    return F.when(cond, F.concat(F.lit("X"), key.cast("string"))).otherwise(key.cast("string"))


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _t(spark, sf_dir, "orders")
    key, st, day = F.col("o_orderkey"), F.col("o_orderstatus"), F.col("o_orderdate")
    no_ts = key % 101 == 0
    return o.select(
        key.cast("string").alias("order_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.when(key % 20 == 7, "canceled").when(st == "F", "delivered")
         .when(st == "O", "shipped").otherwise("processing").alias("order_status"),
        F.when(~no_ts, day).alias("order_purchase_timestamp"),
        F.when(~no_ts, _days(day, 1)).alias("order_approved_at"),
        F.when(st != "P", _days(day, 3)).alias("order_delivered_carrier_date"),
        F.when(st == "F", _days(day, 9)).alias("order_delivered_customer_date"),
        _days(day, 20).alias("order_estimated_delivery_date"),
    )


def numbered_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines with their place in the order, ``seq``: what both views of them (``LINE_VIEWS``) are made from."""
    li = _t(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_tax",
        "l_returnflag", "l_linestatus", "l_shipdate")
    w = Window.partitionBy("l_orderkey").orderBy(
        "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate")
    return li.withColumn("seq", F.row_number().over(w).cast("int"))


def _price():
    return F.col("l_extendedprice").cast(MONEY)


def _freight():
    return (_price() * F.col("l_tax").cast("decimal(4,2)")).cast(MONEY)


def items_of(li: DataFrame) -> DataFrame:
    return li.select(
        _unknown_where(F.col("l_orderkey"), F.col("l_orderkey") % 50 == 3).alias("order_id"),
        F.col("seq").alias("order_item_id"),
        F.col("l_partkey").cast("string").alias("product_id"),
        F.col("l_suppkey").cast("string").alias("seller_id"),
        F.col("l_shipdate").alias("shipping_limit_date"),
        _price().alias("price"),
        _freight().alias("freight_value"),
    )


def payments_of(li: DataFrame) -> DataFrame:
    rf, ls = F.col("l_returnflag"), F.col("l_linestatus")
    ptype = (F.when(rf == "R", "credit_card").when((rf == "A") & (ls == "F"), "boleto")
              .when(rf == "A", "voucher").when(ls == "F", "debit_card").otherwise("credit_card"))
    qty = F.col("l_quantity")
    inst = F.when((ptype == "credit_card") & (qty > 25), F.lit(2) + qty.cast("int") % 9).otherwise(1)
    value = F.when(F.col("l_orderkey") % 50 == 9, F.lit(100).cast(MONEY)) \
             .otherwise((_price() + _freight()).cast(MONEY))
    return li.select(
        _unknown_where(F.col("l_orderkey"), F.col("l_orderkey") % 200 == 11).alias("order_id"),
        F.col("seq").alias("payment_sequential"),
        ptype.alias("payment_type"),
        inst.cast("smallint").alias("payment_installments"),
        value.alias("payment_value"),
    )


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return items_of(numbered_lines(spark, sf_dir))


def order_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return payments_of(numbered_lines(spark, sf_dir))


def _zip(nationkey, custkey):
    return F.lpad((nationkey * 100 + custkey % 7).cast("string"), 5, "0")


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _t(spark, sf_dir, "customer")
    n = _t(spark, sf_dir, "nation")
    ck, nk = F.col("c_custkey"), F.col("c_nationkey")
    person = F.when(ck % 10 == 9, ck - 1).otherwise(ck)
    return c.join(n, nk == F.col("n_nationkey")).select(
        _unknown_where(ck, ck % 40 == 5).alias("customer_id"),
        F.concat(F.lit("U"), person.cast("string")).alias("customer_unique_id"),
        _zip(nk, ck).alias("customer_zip_code_prefix"),
        F.concat("n_name", F.lit("-"), "c_mktsegment").alias("customer_city"),
        F.col("n_name").alias("customer_state"),
    )


def geolocation(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _t(spark, sf_dir, "customer")
    n = _t(spark, sf_dir, "nation")
    ck, nk = F.col("c_custkey"), F.col("c_nationkey")
    return c.join(n, nk == F.col("n_nationkey")).select(
        _zip(nk, ck).alias("geolocation_zip_code_prefix"),
        (nk.cast("double") - 20 + (ck % 64).cast("double") / 64).alias("geolocation_lat"),
        (F.lit(-40.0) - nk.cast("double") / 2 - (ck % 32).cast("double") / 32).alias("geolocation_lng"),
        F.concat("n_name", F.lit("-"), "c_mktsegment").alias("geolocation_city"),
        F.when(nk == 24, F.concat("n_name", F.lit("*"))).otherwise(F.col("n_name")).alias("geolocation_state"),
    )


def order_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _t(spark, sf_dir, "events")
    eid = F.col("event_id")
    return e.select(
        eid.cast("string").alias("review_id"),
        eid.cast("string").alias("order_id"),
        (F.lit(1) + eid % 5).cast("smallint").alias("review_score"),
        F.col("event_type").alias("review_comment_title"),
        F.when(eid % 3 != 0, F.col("props")).alias("review_comment_message"),
        F.col("ts").alias("review_creation_date"),
        _days(F.col("ts"), 2).alias("review_answer_timestamp"),
    )


VIEWS = {
    "orders": orders,
    "order_payments": order_payments,
    "order_items": order_items,
    "customers": customers,
    "geolocation": geolocation,
    "order_reviews": order_reviews,
}


# Views that are projections of the numbered lines.
LINE_VIEWS = {"order_items": items_of, "order_payments": payments_of}


def load(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All six source frames over one driver data directory."""
    return {name: fn(spark, sf_dir) for name, fn in VIEWS.items()}
