"""Rows of the sorted cards as a reader gets them: equal figures stand in the order of the card's key."""

from decimal import Decimal as D

from valuepay.plans import cards as C


def keys(df, column):
    return [r[column] for r in df.collect()]


def test_equal_figures_are_ordered_by_key(spark):
    dim = spark.createDataFrame([(s, D("1.00"), v) for s, v in [("Mid Value", 5.0), ("Standard", 5.0), ("High Value", 5.0), ("A", 9.0), ("Z", None)]],
                                "value_segment string, monetary decimal(22,2), avg_order_value double").repartition(4)
    assert keys(C.card2_aov_by_segment(dim), "value_segment") == ["A", "High Value", "Mid Value", "Standard", "Z"]
    profile = spark.createDataFrame([("High Value", m, 1, D("7.20"), 3.0, 2.0) for m in ("voucher", "boleto", "credit_card")]
                                    + [("Standard", "boleto", 1, D("1.00"), 3.0, 2.0)],
                                    "value_segment string, primary_payment_type string, order_count long, total_revenue decimal(22,2), "
                                    "pct_orders_with_installments double, avg_installments_when_used double").repartition(4)
    assert keys(C.card3_payment_mix(profile), "primary_payment_type") == ["boleto", "credit_card", "voucher"]
    assert keys(C.card4_installments(profile), "value_segment") == ["High Value", "Standard"]
    geo = spark.createDataFrame([(s, 1, 0, 0.0, D(v), 0.0) for s, v in [("C", "0.00"), ("A", "0.00"), ("B", "0.40"), ("D", "8.00"), ("E", "0.00")]],
                                "customer_state string, total_customers long, hvc_customers long, hvc_penetration_pct double, "
                                "hvc_revenue decimal(22,2), hvc_revenue_share_pct double").repartition(5)
    assert keys(C.card5_geo(geo), "customer_state") == ["D", "A", "B", "C", "E"]
    uplift = spark.createDataFrame([(s, 1.0, 1.0, 0.0, 1, v) for s, v in [("Standard", 0.2), ("High Value", 0.4), ("Mid Value", 12.0), ("X", None)]],
                                   "value_segment string, aov_no_installment double, aov_installment double, aov_gap double, "
                                   "addressable_orders long, projected_annual_uplift double").repartition(4)
    assert keys(C.card6_uplift(uplift), "value_segment") == ["Mid Value", "High Value", "Standard", "X"]
