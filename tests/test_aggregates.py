"""One test per semantic decision on aggregates."""

from pyspark.sql import functions as F

from tests import frames
from valuepay.operators.aggregates import (
    arg_max, avg_if, count_distinct_if, first_of_earliest, mode, nulls_last, ratio, sum_if,
)
from valuepay.plans import marts as M


def test_argmax_tie_goes_to_lowest_sequence(spark):
    pay = frames.payments(spark, [("A", 1, "boleto", 1, "50.00"), ("A", 2, "voucher", 1, "50.00"),
                                  ("B", 1, "voucher", 1, "10.00"), ("B", 2, "boleto", 1, "60.00")])
    got = {r.order_id: r.primary_payment_type for r in M.payments_per_order(pay).collect()}
    assert got == {"A": "boleto", "B": "boleto"}


def test_argmax_is_order_independent(spark):
    rows = [("A", 3, "debit_card", 1, "70.00"), ("A", 1, "boleto", 1, "70.00"), ("A", 2, "voucher", 1, "70.00")]
    for perm in (rows, rows[::-1], rows[1:] + rows[:1]):
        pay = frames.payments(spark, perm).repartition(3)
        assert M.payments_per_order(pay).first().primary_payment_type == "boleto"


def test_payment_rank_orders_negative_and_large_amounts(spark):
    pay = frames.payments(spark, [("A", 1, "x", 1, "-5.00"), ("A", 2, "y", 1, "-4.99"),
                                  ("B", 1, "x", 1, "9999999999.99"), ("B", 2, "y", 1, "9999999999.98")])
    got = {r.order_id: r.primary_payment_type for r in M.payments_per_order(pay).collect()}
    assert got == {"A": "y", "B": "x"}


def test_zero_installments_is_not_used(spark):
    pay = frames.payments(spark, [("B", 1, "credit_card", 0, "10.00")])
    r = M.payments_per_order(pay).first()
    assert r.max_installments == 0 and r.used_installments is False


def test_generic_arg_max_with_tie_breaks(spark):
    df = spark.createDataFrame([("g", "x", 5, None, "o2"), ("g", "y", 5, "2020-01-01", "o3"),
                                ("g", "z", 5, "2020-01-01", "o1"), ("g", "w", 4, "2019-01-01", "o0")],
                               "g string, v string, k int, d string, o string")
    r = df.groupBy("g").agg(arg_max("v", "k", nulls_last(F.col("d").cast("date")), "o").alias("a")).first()
    assert r.a == "z"   # highest key, dated before undated, then lowest id


def test_mode_ties_to_smallest(spark):
    df = spark.createDataFrame([("p", c) for c in ["b", "a", "c", "b", "a", "c"]], "p string, c string")
    for part in (1, 3):
        assert df.repartition(part).groupBy("p").agg(mode("c").alias("m")).first().m == "a"


def test_first_of_earliest_keeps_pair_and_puts_null_last(spark):
    df = spark.createDataFrame(
        [("u", "S1", "C1", None, "o1"), ("u", "S2", "C2", "2020-05-01 00:00:00", "o9"),
         ("u", "S3", "C3", "2020-05-01 00:00:00", "o5")],
        "u string, customer_state string, customer_city string, t string, o string")
    df = df.withColumn("t", F.col("t").cast("timestamp_ntz"))
    r = df.groupBy("u").agg(first_of_earliest(["customer_state", "customer_city"], "t", "o").alias("l")).first()
    assert (r.l.customer_state, r.l.customer_city) == ("S3", "C3")


def test_sum_if_zero_avg_if_null_ratio_null(spark):
    df = spark.createDataFrame([("g", 1.0, False), ("g", 2.0, False)], "g string, x double, c boolean")
    r = df.groupBy("g").agg(sum_if("x", F.col("c")).alias("s"), avg_if("x", F.col("c")).alias("a"),
                            ratio(F.lit(1), F.lit(0)).alias("r"),
                            count_distinct_if("x", F.col("c")).alias("d")).first()
    assert r.s == 0 and r.a is None and r.r is None and r.d == 0


def test_distinct_counts_equal_plain_python_without_expand(spark):
    import random

    from tests.test_plans import plan
    from valuepay.operators.aggregates import distinct_counts
    rng = random.Random(6)
    rows = [(rng.choice(["a", "b", None]), rng.choice(["p", "q", "r", None]), rng.choice([True, False, None])) for _ in range(80)]
    rows += [("hot", f"x{i % 9}", i % 9 < 4) for i in range(300)] + [("none", None, True)]
    df = spark.createDataFrame(rows, "g string, x string, f boolean")
    found = distinct_counts(df, ["g"], "x", {"all": F.lit(True), "some": F.col("f")})
    want = {(g, len({r[1] for r in rows if r[0] == g and r[1]}), len({r[1] for r in rows if r[0] == g and r[1] and r[2]})) for g in {r[0] for r in rows}}
    assert {tuple(r) for r in found.collect()} == want
    assert "Expand" not in plan(found)
