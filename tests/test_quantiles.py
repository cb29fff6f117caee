"""Exact quantiles: index floor(p*n), interpolated median, any input size."""

import math
import random
from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from valuepay.operators.quantiles import exact_quantiles, order_statistics, quantile_rank


def brute(values, p):
    s = sorted(values)
    return s[quantile_rank(p, len(s))]


def brute_median(values):
    s = sorted(values)
    n = len(s)
    lo, hi = s[(n - 1) // 2], s[n // 2]
    return lo + 0.5 * (hi - lo)


def frame(spark, values, typ="double"):
    return spark.createDataFrame([(v,) for v in values], f"x {typ}")


def test_one_to_ten(spark):
    q = exact_quantiles(frame(spark, [float(i) for i in range(1, 11)]), "x", (0.9, 0.95), median=True)
    assert (q[0.9], q[0.95], q["median"]) == (10.0, 10.0, 5.5)


def test_not_percentile_disc(spark):
    # p*n integer: rank floor(0.9*10) = 9 (0-based) -> 10, where percentile_disc gives 9
    q = exact_quantiles(frame(spark, list(range(1, 11)), "int"), "x", (0.9,))
    assert q[0.9] == 10


def test_all_equal_values(spark):
    q = exact_quantiles(frame(spark, [1.0] * 50), "x", (0.9, 0.95), median=True, buckets=2)
    assert (q[0.9], q[0.95], q["median"]) == (1.0, 1.0, 1.0)


def test_empty_and_nulls(spark):
    q = exact_quantiles(frame(spark, [None, None]), "x", (0.9,), median=True)
    assert q == {"n": 0, 0.9: None, "median": None}


def test_decimal_values_keep_type(spark):
    vals = [Decimal(f"{i}.{i % 100:02d}") for i in range(1, 200)]
    q = exact_quantiles(frame(spark, vals, "decimal(12,2)"), "x", (0.9,), buckets=3)
    assert q[0.9] == brute(vals, 0.9) and isinstance(q[0.9], Decimal)


def test_hot_value_third_of_rows_few_buckets(spark):
    rnd = random.Random(7)
    vals = [float(rnd.randint(0, 10_000)) for _ in range(3000)] + [5000.0] * 1500
    df = frame(spark, vals).repartition(8)
    ranks = [0, 100, 2000, 2250, 2300, 4000, 4499]
    got = order_statistics(df, "x", ranks, buckets=4)
    s = sorted(vals)
    assert got == {r: s[r] for r in ranks}


def test_customer_balance_fixture(spark):
    cust = spark.read.parquet("/root/testdata/sf0.01/customer.parquet")
    q = exact_quantiles(cust, "c_acctbal", (0.90, 0.95))
    assert q["n"] == 1500 and math.isclose(q[0.90], 9038.40) and math.isclose(q[0.95], 9485.25)
    q2 = exact_quantiles(cust, "c_acctbal", (0.90, 0.95), buckets=8)
    assert (q2[0.90], q2[0.95]) == (q[0.90], q[0.95])


@settings(max_examples=15, deadline=None)
@given(st.lists(st.integers(min_value=-50, max_value=50), min_size=1, max_size=300),
       st.sampled_from([0.0, 0.1, 0.5, 0.9, 0.95, 0.999]),
       st.sampled_from([2, 5, 2048]))
def test_matches_sorted_list(spark, values, p, buckets):
    vals = [float(v) for v in values]
    q = exact_quantiles(frame(spark, vals), "x", (p,), median=True, buckets=buckets)
    assert q[p] == brute(vals, p)
    assert q["median"] == pytest.approx(brute_median(vals))


def test_real_column(spark):
    """600,000 prices (sf0.1 lineitem) give the same values as sorting everything."""
    import numpy as np
    li = spark.read.parquet("/root/testdata/sf0.1/lineitem.parquet").select("l_extendedprice")
    vals = np.sort(np.array([r[0] for r in li.collect()]))          # brute force for the test only
    probs = (0.1, 0.5, 0.9, 0.95, 0.999)
    q = exact_quantiles(li, "l_extendedprice", probs, median=True)
    n = len(vals)
    for p in probs:
        assert q[p] == vals[quantile_rank(p, n)]
    lo, hi = vals[(n - 1) // 2], vals[n // 2]
    assert q["median"] == lo + 0.5 * (hi - lo)


def test_infinite_and_extreme_doubles(spark):
    vals = [float("-inf"), -1.7e308, -1.0, -5e-324, 0.0, 5e-324, 1.0, 1.0 + 2 ** -52, 1.7e308, float("inf"), float("inf")]
    got = order_statistics(frame(spark, vals), "x", range(len(vals)), buckets=2)
    assert [got[i] for i in range(len(vals))] == vals


def test_wide_decimals_that_differ_in_the_last_digit(spark):
    vals = [Decimal("12345678901234567890.00") + Decimal(i) / 100 for i in range(40)]
    got = order_statistics(frame(spark, vals, "decimal(22,2)"), "x", [0, 7, 39], buckets=4)
    assert got == {0: vals[0], 7: vals[7], 39: vals[39]}


def test_no_task_receives_the_column(spark):
    """Every pass is a hash aggregate whose exchange carries bucket rows, not values."""
    from valuepay.operators import quantiles as q
    x = __import__("pyspark.sql.functions", fromlist=["col"])
    df = frame(spark, [float(i) for i in range(1000)]).repartition(4)
    passes = df.select("x", q._bucket(x.col("x"), 0.0, 999.0, 8).alias("bucket")).groupBy("bucket").agg(x.count("x"), x.min("x"), x.max("x"))
    plan = passes._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "SortAggregate" not in plan and "SinglePartition" not in plan
    assert plan.count("HashAggregate") == 2 and "partial_count" in plan


def passes(spark, monkeypatch, values, ranks, kind="double", buckets=2048):
    """The values at the ranks, and the number of bucket passes they took."""
    from valuepay.operators import quantiles as Q
    seen = []
    real = Q._bucket
    monkeypatch.setattr(Q, "_bucket", lambda *a: seen.append(1) or real(*a))
    got = Q.order_statistics(spark.createDataFrame([(v,) for v in values], f"v {kind}"), "v", ranks, buckets=buckets)
    return [got[r] for r in ranks], len(seen)


def test_ordered_bits_are_the_bits(spark):
    import math
    import random
    import struct

    from valuepay.operators.quantiles import _bits_of, ordered_bits
    rng = random.Random(2)
    values = [0.0, -0.0, math.inf, -math.inf, 5e-324, -5e-324, 2.2250738585072014e-308, 2.225073858507201e-308, 1.7976931348623157e308,
              -1.7976931348623157e308, 1.0, 2.0, 0.9999999999999999, 4503599627370497.5, 1e-300, 1e300]
    values += [x for x in (struct.unpack("<d", rng.randbytes(8))[0] for _ in range(3000)) if not math.isnan(x)]
    values += [2.0 ** e * f for e in range(-1070, 1023, 7) for f in (1.0, 1.0000000000000002, 1.9999999999999998)]
    from pyspark.sql import functions as F
    rows = spark.createDataFrame([(v,) for v in values], "v double").select("v", ordered_bits(F.col("v")).alias("k")).collect()
    assert [r["k"] for r in rows] == [_bits_of(v) for v in values]


def test_passes_are_bounded_whatever_the_values(spark, monkeypatch):
    import math
    wide = sorted([10.0 ** e * s for e in range(-300, 301, 5) for s in (1, -1)] + [math.inf, -math.inf, 0.0, 5e-324])
    ranks = [0, 1, 30, len(wide) // 2, len(wide) - 1]
    got, n = passes(spark, monkeypatch, wide, ranks)
    assert got == [wide[r] for r in ranks] and n <= 6 * len(ranks)
    values = [float(i) for i in range(60)] + [math.nan] * 2           # NaN is the largest value
    got, n = passes(spark, monkeypatch, values, [30])
    assert got == [30.0] and n <= 6
    got, n = passes(spark, monkeypatch, values, [59, 60, 61])
    assert got[0] == 59.0 and math.isnan(got[1]) and math.isnan(got[2])
    got, n = passes(spark, monkeypatch, [math.nan], [0])
    assert math.isnan(got[0]) and n == 0
    got, n = passes(spark, monkeypatch, [float(x) for x in (1.5, 2.5, 1.5)], [1, 2], kind="float")
    assert got == [1.5, 2.5]
    got, n = passes(spark, monkeypatch, [-2 ** 63, 2 ** 63 - 1, 0, 7], [0, 1, 2, 3], kind="long")
    assert got == [-2 ** 63, 0, 7, 2 ** 63 - 1] and n <= 6 * 4
