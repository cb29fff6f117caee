"""Marts on hand-written frames: default fills, exclusions, empty averages, floors, centroids."""

from tests import frames
from valuepay.plans import marts as M
from valuepay.plans.scenario import uplift_at, uplift_scenarios


def _fact(spark):
    o = frames.orders(spark, [("o1", "c1", "delivered", "2018-01-05 10:00:00"),
                              ("o2", "cX", "delivered", "2018-03-11 00:00:00"),   # unknown customer, latest
                              ("o3", "c1", "shipped", "2018-03-01 00:00:00"),     # no items
                              ("o4", "c1", "delivered", "2018-03-02 00:00:00"),   # no payments
                              ("o5", "c2", "canceled", "2018-03-03 00:00:00")])   # cancelled
    p = frames.payments(spark, [("o1", 1, "credit_card", 3, "100.00"), ("o2", 1, "boleto", 1, "20.00"),
                                ("o3", 1, "credit_card", 1, "30.00"), ("o5", 1, "voucher", 1, "5.00")])
    i = frames.items(spark, [("o1", 1, "90.00", "10.00"), ("o2", 1, "15.00", "5.00")])
    c = frames.customers(spark, [("c1", "U1", "01001", "city", "SP"), ("c2", "U2", "02002", "c2", "RJ")])
    return M.fct_order_payments(o, p, i, c)


def test_fact_fills_and_exclusions(spark):
    rows = {r.order_id: r for r in _fact(spark).collect()}
    assert set(rows) == {"o1", "o2", "o3"}                   # unpaid and cancelled dropped
    assert rows["o2"].customer_unique_id == "" and rows["o2"].customer_state == ""
    assert rows["o3"].item_count == 0 and float(rows["o3"].items_price) == 0.0
    assert rows["o1"].used_installments and not rows["o3"].used_installments
    assert float(rows["o1"].credit_card_value) == 100.0 and float(rows["o1"].boleto_value) == 0.0


def test_dim_excludes_unknown_customer_and_uses_whole_fact_for_recency(spark):
    fact = _fact(spark)
    dim = M.dim_customer(fact).collect()
    assert [r.customer_unique_id for r in dim] == ["U1"]
    r = dim[0]
    assert r.frequency == 2 and float(r.monetary) == 130.0
    assert r.recency_days == 10      # latest date of the whole fact is the unknown customer's
    assert r.avg_installments_when_used == 3.0 and r.installment_order_share == 0.5
    assert r.top_payment_type == "credit_card"
    assert r.is_high_value_customer and r.value_segment == "Top 5% Whale"


def test_segment_without_installments_and_negative_gap(spark):
    o = frames.orders(spark, [(f"o{i}", f"c{i}", "delivered", "2018-01-01 00:00:00") for i in range(4)])
    p = frames.payments(spark, [("o0", 1, "credit_card", 1, "10.00"), ("o1", 1, "credit_card", 1, "10.00"),
                                ("o2", 1, "credit_card", 4, "40.00"), ("o3", 1, "credit_card", 1, "100.00")])
    c = frames.customers(spark, [(f"c{i}", f"U{i}", "0", "x", "S") for i in range(4)])
    fact = M.fct_order_payments(o, p, frames.items(spark, []), c)
    dim = M.dim_customer(fact)
    up = {r.value_segment: r for r in M.mart_payment_uplift(fact, dim).collect()}
    # U3 (100) is the only whale: no instalment order -> empty average -> NULL, uplift 0
    assert up["Top 5% Whale"].aov_installment is None and up["Top 5% Whale"].projected_annual_uplift == 0.0
    # p90 = p95 = 100, median 25: the High band is empty, U2 (40, instalments) is Mid alone
    assert set(up) == {"Top 5% Whale", "Mid Value", "Standard"}
    assert up["Mid Value"].aov_no_installment is None and up["Mid Value"].aov_installment == 40.0
    assert up["Standard"].aov_installment is None and up["Standard"].addressable_orders == 2
    prof = {(r.value_segment, r.primary_payment_type): r for r in M.mart_hvc_payment_profile(fact, dim).collect()}
    assert prof[("Top 5% Whale", "credit_card")].avg_installments_when_used is None


def test_negative_gap_is_floored(spark):
    upl = spark.createDataFrame([("S", 10.0, 20.0, -10.0, 5, 1.0, 0.0)],
                                "value_segment string, aov_installment double, aov_no_installment double, "
                                "aov_gap double, addressable_orders bigint, current_addressable_revenue double, "
                                "projected_annual_uplift double")
    r = uplift_scenarios(upl).where("adoption_pct = 30 AND capture_pct = 100").first()
    assert r.projected_uplift == 0.0 and r.pct_of_baseline == 0.0


def test_geo_centroid_is_unweighted(spark):
    pts = [("A", 0.0, 0.0, "a", "S")] * 100 + [("B", 10.0, 10.0, "b", "S")]
    g = M.dim_geolocation(frames.geolocation(spark, pts))
    r = M.state_centroids(g).first()
    assert (r.lat, r.lng) == (5.0, 5.0)


def test_state_without_centroid_keeps_null(spark):
    dim = spark.createDataFrame([("U1", "ZZ", 10.0, True)],
                                "customer_unique_id string, customer_state string, monetary double, "
                                "is_high_value_customer boolean")
    g = M.dim_geolocation(frames.geolocation(spark, [("A", 1.0, 1.0, "a", "S")]))
    r = M.mart_geo_value(dim, g).first()
    assert r.lat is None and r.total_customers == 1 and r.hvc_revenue_share_pct == 100.0


def test_scenario_matches_published_page_rows(spark):
    rows = [("Top 5% Whale", 454, 64.87), ("High Value", 503, 9.63),
            ("Mid Value", 6310, 13.78), ("Standard", 16608, 9.64)]
    upl = spark.createDataFrame(rows, "value_segment string, addressable_orders bigint, aov_gap double")
    grid = uplift_scenarios(upl)
    assert grid.count() == 101 * 21
    r = grid.where("adoption_pct = 30 AND capture_pct = 100").first()
    assert r.projected_uplift == 84404.0 and r.addressable_orders == 7162 and r.pct_of_baseline == 100.0
    assert grid.where("adoption_pct = 0").agg({"projected_uplift": "max"}).first()[0] == 0.0


def test_single_scenario_per_segment(spark):
    rows = [("Top 5% Whale", 454, 64.87), ("High Value", 503, 9.63),
            ("Mid Value", 6310, 13.78), ("Standard", 16608, 9.64)]
    upl = spark.createDataFrame(rows, "value_segment string, addressable_orders bigint, aov_gap double")
    got = {r.value_segment: (r.projected_uplift, r.orders_adopting) for r in uplift_at(upl, 30, 100).collect()}
    assert got["Top 5% Whale"] == (8835.0, 136) and got["Standard"] == (48030.0, 4982)
    assert sum(v[1] for v in got.values()) == 7162
