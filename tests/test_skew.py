"""Hot keys: one person holds a third of all orders, and many orders have no known customer.
The marts must stay exact; they are checked against the oracle's SQL for the marts, run by
DuckDB over the same hand-written rows."""

import random

import duckdb
import pytest

from tests import frames
from valuepay import oracle
from valuepay.plans import cards as C
from valuepay.plans import marts as M
from valuepay.queries import portable
from valuepay.session import scratch_path
from scripts.check_oracle import digest

N = 1500


@pytest.fixture(scope="module")
def sources(spark):
    rnd = random.Random(11)
    orders, pays, items = [], [], []
    for i in range(N):
        cust = "cHOT" if i % 3 == 0 else (f"cX{i}" if i % 10 == 1 else f"c{rnd.randint(0, 199)}")
        day = f"2018-{1 + i % 12:02d}-{1 + i % 28:02d} 10:00:00" if i % 50 else None
        orders.append((f"o{i:05d}", cust, "canceled" if i % 37 == 0 else "delivered", day))
        for q in range(1, 1 + rnd.randint(1, 3)):
            t = rnd.choice(["credit_card", "boleto", "voucher", "debit_card", "not_defined"])
            pays.append((f"o{i:05d}", q, t, rnd.choice([0, 1, 1, 2, 6, 10]), f"{rnd.randint(1, 50000) / 100:.2f}"))
        items.append((f"o{i:05d}", 1, "10.00", "1.00"))
    custs = [("cHOT", "UHOT", "01001", "city-hot", "SP")] + \
            [(f"c{k}", f"U{k // 2}", "02002", f"city{k % 7}", f"S{k % 5}") for k in range(200)]
    return {"orders": frames.orders(spark, orders), "order_payments": frames.payments(spark, pays),
            "order_items": frames.items(spark, items), "customers": frames.customers(spark, custs)}


@pytest.fixture(scope="module")
def duck(spark, sources):
    con = duckdb.connect()
    base = scratch_path(spark, "skew").removeprefix("file:")
    for name, df in sources.items():
        df.write.parquet(f"{base}/{name}")
        con.execute(f"CREATE VIEW src_{name} AS SELECT * FROM read_parquet('{base}/{name}/*.parquet')")
    return con


@pytest.fixture(scope="module")
def marts(spark, sources):
    fact = M.fct_order_payments(sources["orders"], sources["order_payments"], sources["order_items"],
                                sources["customers"]).persist()
    dim = M.dim_customer(fact, buckets=4)
    return fact, dim


def _same(df, con, body):
    res = con.execute("WITH " + oracle.MART_CTES.strip() + "\n" + body)
    cols, rows = [d[0] for d in res.description], res.fetchall()
    srows = [tuple(r) for r in portable(df).collect()]
    assert sorted(df.columns) == sorted(cols)
    assert len(srows) == len(rows)
    assert digest(df.columns, srows)[0] == digest(cols, rows)[0]


def test_hot_person_is_a_third(marts):
    fact, _ = marts
    top = fact.groupBy("customer_unique_id").count().orderBy("count", ascending=False).first()
    assert top["customer_unique_id"] == "UHOT" and top["count"] > fact.count() / 4


def test_dimension_on_skew(marts, duck):
    _, dim = marts
    _same(dim, duck, oracle.DIM_SELECT)


def test_profile_uplift_monthly_on_skew(marts, duck):
    fact, dim = marts
    body = {k: v.split(oracle.WITH, 1)[1] for k, v in oracle.SQL.items()
            if k in ("hvc_payment_profile", "payment_uplift", "card7_monthly_revenue")}
    _same(M.mart_hvc_payment_profile(fact, dim), duck, body["hvc_payment_profile"])
    _same(M.mart_payment_uplift(fact, dim), duck, body["payment_uplift"])
    _same(C.card7_monthly_revenue(fact, dim), duck, body["card7_monthly_revenue"])
