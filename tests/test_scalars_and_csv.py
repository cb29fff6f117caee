"""Rounding (decision 9), dates (F1-F3) and the CSV landing path (S1-S4, T1-T4)."""

import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from valuepay import schemas as S
from valuepay.functions.scalars import days_between, month_start, order_date, round_money
from valuepay.sources.csv_source import SourceColumns, SourceMissing, read_source


def test_half_rounding_through_decimal(spark):
    df = spark.createDataFrame([(1.005,), (2.675,), (0.125,), (-2.5,)], "x double")
    got = [r[0] for r in df.select(round_money("x", 2).alias("r2"), round_money("x", 0).alias("r0"))
           .select(F.array("r2", "r0")).collect()]
    assert [g[0] for g in got] == [1.01, 2.68, 0.13, -2.5]
    assert got[3][1] == -3.0


def test_dates(spark):
    df = spark.createDataFrame([("2017-10-02 10:56:33",), (None,)], "s string") \
        .select(F.col("s").cast("timestamp_ntz").alias("t"))
    r = df.select(order_date("t").alias("d"), month_start("t").alias("m"),
                  days_between(F.lit(dt.date(2017, 9, 30)), order_date("t")).alias("n")).collect()
    assert r[0] == (dt.date(2017, 10, 2), dt.date(2017, 10, 1), 2)
    assert r[1] == (None, None, None)


def _land(text, table, name=None):
    d = tempfile.mkdtemp(prefix="valuepay-csv-")
    with open(os.path.join(d, f"{name or table}.csv"), "w") as fh:
        fh.write(text)
    return d


CUSTOMERS_CSV = (
    "customer_id,customer_unique_id,customer_zip_code_prefix,customer_city,customer_state\n"
    '1,"line one\nline ""two""",01001,NA,SP\n'
    "2,,00123,,RJ\n"
)


def test_csv_multiline_quotes_zeros_empty_and_na(spark):
    df = read_source(spark, _land(CUSTOMERS_CSV, "customers"), "customers", multiline=True)
    rows = sorted(df.collect())
    assert rows[0].customer_unique_id == 'line one\nline "two"'
    assert rows[0].customer_zip_code_prefix == "01001"       # leading zero kept
    assert rows[0].customer_city == "NA"                     # NA stays text
    assert rows[1].customer_unique_id == "" and rows[1].customer_city == ""   # missing -> ''
    assert df.schema == S.CUSTOMERS or [f.dataType for f in df.schema] == [f.dataType for f in S.CUSTOMERS]


ORDERS_CSV = (
    "order_id,customer_id,order_status,order_purchase_timestamp,order_approved_at,"
    "order_delivered_carrier_date,order_delivered_customer_date,order_estimated_delivery_date\n"
    "o1,c1,delivered,2017-10-02 10:56:33.750,bad,,2017-10-04,2017-10-10 00:00:00\n"
)


REVIEWS_CSV = (
    "review_id,order_id,review_score,review_comment_title,review_comment_message,"
    "review_creation_date,review_answer_timestamp\n"
    'r1,o1,5,,"Muito bom,\nchegou ""antes"" do prazo",2018-01-01 00:00:00,\n'
    "r2,o2,1,NA,,bad,2018-01-03 10:00:00\n"
)


def test_reviews_keep_line_breaks_by_default(spark):
    rows = {r.review_id: r for r in read_source(spark, _land(REVIEWS_CSV, "order_reviews"), "order_reviews").collect()}
    assert rows["r1"].review_comment_message == 'Muito bom,\nchegou "antes" do prazo'
    assert rows["r1"].review_comment_title == "" and rows["r2"].review_comment_title == "NA"
    assert rows["r2"].review_creation_date is None and rows["r2"].review_score == 1


def test_csv_lenient_timestamps_second_resolution(spark):
    r = read_source(spark, _land(ORDERS_CSV, "orders"), "orders").first()
    assert r.order_purchase_timestamp == dt.datetime(2017, 10, 2, 10, 56, 33)
    assert r.order_approved_at is None and r.order_delivered_carrier_date is None
    assert r.order_delivered_customer_date == dt.datetime(2017, 10, 4)


PAYMENTS_BAD = "order_id,payment_sequential,payment_type,payment_installments,payment_value\no1,1,boleto,x,10.00\n"


def test_csv_malformed_number_fails(spark):
    df = read_source(spark, _land(PAYMENTS_BAD, "order_payments"), "order_payments")
    with pytest.raises(Exception):
        df.collect()


def test_csv_missing_number_in_non_null_column_fails(spark):
    csv = "order_id,payment_sequential,payment_type,payment_installments,payment_value\no1,1,boleto,1,\n"
    df = read_source(spark, _land(csv, "order_payments"), "order_payments")
    with pytest.raises(Exception, match="missing value in non-null column payment_value"):
        df.collect()


def test_missing_and_empty_source(spark):
    with pytest.raises(SourceMissing):
        read_source(spark, tempfile.mkdtemp(), "orders")
    hdr = "order_id,payment_sequential,payment_type,payment_installments,payment_value\n"
    assert read_source(spark, _land(hdr, "order_payments"), "order_payments").count() == 0
    assert read_source(spark, _land("", "order_payments"), "order_payments").count() == 0


def test_columns_are_bound_by_name(spark):
    csv = ("customer_id,customer_unique_id,customer_zip_code_prefix,customer_state,customer_city\n"
           "1,u,00100,SP,sao paulo\n")
    r = read_source(spark, _land(csv, "customers"), "customers").first()
    assert (r["customer_state"], r["customer_city"]) == ("SP", "sao paulo")
    geo = "geolocation_state,geolocation_city,geolocation_lng,geolocation_lat,geolocation_zip_code_prefix\nSP,x,2.5,1.5,01\n"
    g = read_source(spark, _land(geo, "geolocation"), "geolocation").first()
    assert (g["geolocation_lat"], g["geolocation_lng"], g["geolocation_zip_code_prefix"]) == (1.5, 2.5, "01")


def test_missing_and_unknown_columns_are_named(spark):
    csv = "customer_id,customer_unique_id,customer_zip_code_prefix,customer_city,country\n1,u,0,x,BR\n"
    with pytest.raises(SourceColumns, match=r"missing columns \['customer_state'\], unknown columns \['country'\]"):
        read_source(spark, _land(csv, "customers"), "customers")


def test_files_of_one_folder_with_other_column_orders_fail(spark):
    d = tempfile.mkdtemp(prefix="valuepay-csv-")
    os.makedirs(os.path.join(d, "customers.csv"))
    names = ["customer_id", "customer_unique_id", "customer_zip_code_prefix", "customer_city", "customer_state"]
    for i, order in enumerate((names, names[::-1])):
        with open(os.path.join(d, "customers.csv", f"part-{i}.csv"), "w") as fh:
            fh.write(",".join(order) + "\n" + ",".join("abcde") + "\n")
    with pytest.raises(Exception, match="header"):
        read_source(spark, d, "customers").collect()


@pytest.mark.parametrize("row", ["o1,140000,credit_card,1,10.02", "o1,-5,boleto,1,1.00", "o1,1,boleto,300,1.00", "o1,1,boleto,-3,1.00"])
def test_unsigned_columns_are_checked(spark, row):
    csv = f"order_id,payment_sequential,payment_type,payment_installments,payment_value\n{row}\n"
    with pytest.raises(Exception, match="outside 0..(65535|255) in column payment_"):
        read_source(spark, _land(csv, "order_payments"), "order_payments").collect()


def test_payment_rank_holds_for_any_sequence_number(spark):
    from tests import frames
    from valuepay.plans import marts as M
    p = frames.payments(spark, [("o1", 140000, "credit_card", 1, "10.02"), ("o1", 1, "boleto", 1, "10.00"),
                                ("o2", -7, "voucher", 1, "5.00"), ("o2", 3, "pix", 1, "5.00")])
    got = {r["order_id"]: r["primary_payment_type"] for r in M.payments_per_order(p).collect()}
    assert got == {"o1": "credit_card", "o2": "voucher"}


def test_card_means_do_not_depend_on_partitioning(spark):
    import random
    from valuepay.plans import cards as C
    rnd = random.Random(2)
    dim = spark.createDataFrame([("Standard", rnd.random() * 1e6, True, 1.0, "S", "c") for _ in range(5000)],
                                "value_segment string, avg_order_value double, is_high_value_customer boolean, monetary double, "
                                "customer_state string, customer_city string")
    for card in (C.card2_aov_by_segment, C.card8_top_cities):
        assert len({tuple(card(dim.repartition(n)).first()) for n in (1, 7, 50)}) == 1


def test_translation_lookup_scan(spark):
    from valuepay.sources.csv_source import read_category_translation
    d = _land("product_category_name,product_category_name_english\nbeleza_saude,health_beauty\npcs,\n",
              "category_translation")
    rows = sorted(map(tuple, read_category_translation(spark, d).collect()))
    assert rows == [("beleza_saude", "health_beauty"), ("pcs", "")]


def test_validate_source_parses_every_field(spark, tmp_path):
    from valuepay.sources.csv_source import SourceEmpty, SourceMissing, validate_source
    head = "customer_id,customer_unique_id,customer_zip_code_prefix,customer_city,customer_state\n"
    (tmp_path / "customers.csv").write_text(head + "1,u,01234,c,s\n2,u,01234,c,s\n")
    assert validate_source(spark, str(tmp_path), "customers") == 2
    (tmp_path / "customers.csv").write_text(head)
    with pytest.raises(SourceEmpty):
        validate_source(spark, str(tmp_path), "customers")
    with pytest.raises(SourceMissing):
        validate_source(spark, str(tmp_path), "orders")
    (tmp_path / "order_items.csv").write_text("order_id,order_item_id,product_id,seller_id,shipping_limit_date,price,freight_value\no,1,p,s,,x,1\n")
    with pytest.raises(Exception, match="(?i)cast|invalid"):
        validate_source(spark, str(tmp_path), "order_items")
