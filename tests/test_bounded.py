"""Work of one task: bounded whatever the input's size, by more and not larger partitions, splits, buckets and files."""

import pytest

from tests.conftest import SF001
from valuepay import queries as Q
from valuepay import session as S
from valuepay.plans import marts as M
from valuepay.plans import refresh as R
from valuepay.sources import bucketed as B
from valuepay.sources import fixtures
from valuepay.sources import ranged

KEYS = (S.SHUFFLE_PARTITIONS, S.ADVISORY_BYTES, S.MAX_PARTITION_BYTES)
SMALL = 16 << 10


def settings(spark):
    return {k: spark.conf.get(k, None) for k in KEYS}


@pytest.fixture
def small_tasks(monkeypatch):
    """A task's share is so small that the smallest tables are many of them."""
    for module in (S, B, ranged):
        monkeypatch.setattr(module, "TASK_BYTES", SMALL)


@pytest.fixture
def own(spark):
    """Sources and marts that no other test has built."""
    key = (spark.sparkContext.applicationId, SF001)
    kept = Q._BUNDLES.pop(key, None)
    yield Q._bundle(spark, SF001)
    Q._BUNDLES.pop(key, None)
    if kept:
        Q._BUNDLES[key] = kept


def same_rows(a, b):
    return a.count() == b.count() and a.exceptAll(b).isEmpty()


def test_the_size_of_a_join_is_that_of_its_tables(spark):
    a, b = (spark.read.parquet(f"{SF001}/{t}.parquet") for t in ("customer", "nation"))
    joined = a.join(b, a.c_nationkey == b.n_nationkey)
    assert S.input_bytes([joined]) == S.input_bytes([a]) + S.input_bytes([b])
    assert S.input_bytes([joined, a]) == 2 * S.input_bytes([a]) + S.input_bytes([b])
    unknown = spark.createDataFrame(spark.sparkContext.parallelize([(1,)]), "x int")
    assert S.input_bytes([unknown, a]) == S.input_bytes([a])


def test_settings_are_made_finer_by_the_input_and_restored(spark, small_tasks):
    before = settings(spark)
    lines = spark.read.parquet(f"{SF001}/lineitem.parquet")
    with S.bounded_tasks(spark, [lines]):
        partitions, advisory, split = (int(spark.conf.get(k).rstrip("b")) for k in KEYS)
        assert partitions >= S.input_bytes([lines]) / SMALL and (advisory, split) == (2 * SMALL, SMALL)
    assert settings(spark) == before
    with pytest.raises(RuntimeError), S.bounded_tasks(spark, [lines]):
        raise RuntimeError
    assert settings(spark) == before


def test_small_input_and_finer_settings_stay(spark):
    spark.conf.set(S.MAX_PARTITION_BYTES, "1m")
    try:
        with S.bounded_tasks(spark, [spark.range(10)]):
            assert spark.conf.get(S.SHUFFLE_PARTITIONS) == "8" and spark.conf.get(S.MAX_PARTITION_BYTES) == str(1 << 20)
        assert spark.conf.get(S.MAX_PARTITION_BYTES) == "1m"
    finally:
        spark.conf.unset(S.MAX_PARTITION_BYTES)


def test_marts_are_built_in_bounded_tasks(spark, small_tasks, own, monkeypatch):
    seen, before = [], settings(spark)
    for name in ("fct_order_payments", "dim_customer"):
        monkeypatch.setattr(M, name, lambda *a, real=getattr(M, name), **k: seen.append(settings(spark)) or real(*a, **k))
    assert Q.q_card2(spark, SF001).count() > 0
    assert len(seen) == 2 and all(int(s[S.SHUFFLE_PARTITIONS]) > 8 and s[S.MAX_PARTITION_BYTES] == str(SMALL) for s in seen)
    assert settings(spark) == before


def test_lines_are_numbered_and_shuffled_once(spark, own, monkeypatch):
    calls, real = [], fixtures.numbered_lines
    monkeypatch.setattr(fixtures, "numbered_lines", lambda *a: calls.append(a) or real(*a))
    items, pays = own.src["order_items"], own.src["order_payments"]
    assert own.marts.fct_order_payments.count() > 0 and len(calls) == 1
    assert sorted(items.inputFiles()) == sorted(pays.inputFiles())
    for df in (items, pays):
        assert "Window" not in df._jdf.queryExecution().optimizedPlan().toString()
    assert same_rows(items, fixtures.order_items(spark, SF001)) and same_rows(pays, fixtures.order_payments(spark, SF001))


def test_refresh_works_in_bounded_tasks(spark, small_tasks, monkeypatch):
    seen, before = [], settings(spark)
    real = R.sinks.write_table
    monkeypatch.setattr(R.sinks, "write_table", lambda *a: seen.append(settings(spark)) or real(*a))
    sources = fixtures.load(spark, SF001)
    R.refresh(spark, S.scratch_path(spark, "bounded"), sources=sources, min_rows={t: 1 for t in sources})
    assert len(seen) >= 12 and all(int(s[S.SHUFFLE_PARTITIONS]) > 8 and s[S.MAX_PARTITION_BYTES] == str(SMALL) for s in seen)
    assert settings(spark) == before


def test_larger_tables_have_more_buckets(spark, own, monkeypatch):
    monkeypatch.setattr(B, "TASK_BYTES", SMALL // 8)
    from_buckets = Q.q_fct_from_buckets(spark, SF001)
    # the projections of the lines are sized by the lines' files
    assert own.bucketed.buckets > 8 and own.bucketed.buckets >= S.input_bytes([own.src.lines]) / (SMALL // 8)
    assert same_rows(from_buckets, own.marts.fct_order_payments)


def test_larger_tables_have_more_ranged_files(spark, own, monkeypatch):
    monkeypatch.setattr(ranged, "TASK_BYTES", SMALL // 16)
    asked, real = [], Q.write_ranged
    monkeypatch.setattr(Q, "write_ranged", lambda *a, files: asked.append(files) or real(*a, files=files))
    found = Q.q_ranged_lookup(spark, SF001)
    fact = own.marts.fct_order_payments
    assert asked[0] > 16 and asked[0] >= S.input_bytes([fact]) / (SMALL // 16)
    assert same_rows(found, fact.where("order_id BETWEEN '2' AND '3'").select(found.columns))
    assert ranged.file_count(fact, least=100_000) == 100_000
