"""Plan shape at scale: no single-partition exchange, pushdown, pruning."""

import pytest

from tests.conftest import SF001, SF01
from valuepay.plans import cards as C
from valuepay.plans import marts as M
from valuepay.queries import registered
from valuepay.session import scratch_path
from valuepay.sources import fixtures


def plan(df, mode="simple"):
    jvm = df.sparkSession._jvm
    qe = df._jdf.queryExecution()
    if mode == "simple":
        return qe.executedPlan().toString()
    return qe.explainString(jvm.org.apache.spark.sql.execution.ExplainMode.fromString(mode))


@pytest.fixture(scope="module")
def staged(spark):
    base = scratch_path(spark, "plan-test")
    out = {}
    for name, df in fixtures.load(spark, SF01).items():
        df.write.parquet(f"{base}/{name}")
        out[name] = spark.read.parquet(f"{base}/{name}")
    return out


def test_fact_and_dimension_have_no_single_partition_exchange(spark, staged):
    fact = M.fct_order_payments(staged["orders"], staged["order_payments"], staged["order_items"],
                                staged["customers"])
    assert "SinglePartition" not in plan(fact)
    assert "SinglePartition" not in plan(M.customer_base(fact))
    # the latest order date is a global maximum: only one partial row per task meets in one task
    lines = plan(M.dim_customer(fact)).splitlines()
    single = [i for i, line in enumerate(lines) if "SinglePartition" in line]
    assert single and all("partial_max(last_order_date" in lines[i + 1] for i in single)


def test_payment_rollup_is_a_hash_aggregate(spark, staged):
    """Known methods: fixed-width buffers, so a code-generated hash aggregate with one exchange
    of the payments; only payments of other methods (filtered at the scan) take a small
    object-hash rollup of their own. No two-phase distinct aggregate."""
    df = M.payments_per_order(staged["order_payments"])
    p = plan(df)
    assert "Expand" not in p and "SortAggregate" not in p
    assert p.count("Exchange hashpartitioning") == 2           # main rollup + other methods
    main = [line for line in p.splitlines() if "HashAggregate(" in line and "ObjectHashAggregate" not in line]
    assert main and all("max_by" not in line and "collect_set" not in line for line in main)
    pushed = [line for line in plan(df, "formatted").splitlines() if line.startswith("PushedFilters")]
    assert any("Not(In(payment_type" in line for line in pushed)     # other-method side, at the scan


def test_card_filter_pushed_and_columns_pruned(spark, staged):
    fact = M.fct_order_payments(staged["orders"], staged["order_payments"], staged["order_items"],
                                staged["customers"])
    path = scratch_path(spark, "dim")
    M.dim_customer(fact).write.parquet(path)
    dim = spark.read.parquet(path)
    p = plan(C.card8_top_cities(dim, state="GERMANY"), "formatted")
    pushed = [line for line in p.splitlines() if line.startswith("PushedFilters")][0]
    assert "EqualTo(is_high_value_customer,true)" in pushed and "EqualTo(customer_state,GERMANY)" in pushed
    schema = [line for line in p.splitlines() if line.startswith("ReadSchema")][0]
    assert "frequency" not in schema and "recency_days" not in schema and "monetary" in schema


def test_orders_filter_reaches_scan(spark, staged):
    fact = M.fct_order_payments(staged["orders"], staged["order_payments"], staged["order_items"],
                                staged["customers"])
    p = plan(fact, "formatted")
    assert "Not(EqualTo(order_status,canceled))" in p


FORBIDDEN = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas",
             "CartesianProduct", "BroadcastNestedLoopJoin", "ExternalRDD")


def test_no_udf_or_cross_join_in_any_registered_query(spark):
    for name, fn in registered().items():
        p = plan(fn(spark, SF001))
        bad = [op for op in FORBIDDEN if op in p]
        assert not bad, (name, bad)
