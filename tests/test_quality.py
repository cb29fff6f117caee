"""Quality gates (DQ1-DQ6): each fails on a doctored frame, one message names every failure."""

import pytest

from tests import frames
from valuepay.plans import quality as Q


def test_min_rows_failures_in_one_message(spark):
    t = {"a": spark.range(3), "b": spark.range(1), "c": spark.range(10)}
    rep = Q.staging_min_rows(t, {"a": 5, "b": 2, "c": 10})
    with pytest.raises(Q.QualityGateFailed) as e:
        Q.enforce(rep, "staging gate")
    assert "min_rows:a" in str(e.value) and "min_rows:b" in str(e.value) and "min_rows:c" not in str(e.value)


def test_orphans_warn_only_unless_bounded(spark):
    o = frames.orders(spark, [("o1", "c", "delivered", None)])
    p = frames.payments(spark, [("o1", 1, "x", 1, "1.00"), ("o9", 1, "x", 1, "1.00")])
    rows = Q.enforce(Q.orphan_payments(p, o), "g")
    assert rows[0].observed == 1.0 and rows[0].severity == "warn"
    with pytest.raises(Q.QualityGateFailed):
        Q.enforce(Q.orphan_payments(p, o, max_orphans=0), "g")


def _dim(spark, flags):
    return spark.createDataFrame([(f"U{i}", f) for i, f in enumerate(flags)],
                                 "customer_unique_id string, is_high_value_customer boolean")


def _fact(spark, values):
    return spark.createDataFrame([(v,) for v in values], "order_value double")


def test_mart_gate_passes_inside_band(spark):
    Q.enforce(Q.mart_checks(_fact(spark, [1.0]), _dim(spark, [True] + [False] * 9)), "mart gate")


def test_everyone_hvc_fails_share(spark):
    with pytest.raises(Q.QualityGateFailed, match="hvc_share"):
        Q.enforce(Q.mart_checks(_fact(spark, [1.0]), _dim(spark, [True] * 5)), "mart gate")


def test_negative_value_and_empty_marts_fail(spark):
    with pytest.raises(Q.QualityGateFailed, match="no_negative_order_value"):
        Q.enforce(Q.mart_checks(_fact(spark, [1.0, -2.0]), _dim(spark, [True] + [False] * 9)), "g")
    with pytest.raises(Q.QualityGateFailed, match="dim_not_empty"):
        Q.enforce(Q.mart_checks(_fact(spark, [1.0]), _dim(spark, [])), "g")


def test_observed_counts_give_the_same_report(spark):
    fact, dim = _fact(spark, [1.0, -2.0]), _dim(spark, [True] + [False] * 9)
    a = sorted(map(tuple, Q.mart_checks(fact, dim).collect()))
    b = sorted(map(tuple, Q.mart_check_rows(fact_rows=2, negative=1, dim_rows=10, hvc=1)))
    assert a == b
