"""Full refresh from CSV files (L1, S1-S5, K1-K5) and idempotence."""

import json

import pytest

from tests.conftest import SF001
from valuepay.plans.refresh import refresh
from valuepay.schemas import MIN_ROWS
from valuepay.session import scratch_path
from valuepay.sources import fixtures
from valuepay.sources.csv_source import write_csv

ONE = {t: 1 for t in MIN_ROWS}


@pytest.fixture(scope="module")
def landing(spark):
    d = scratch_path(spark, "landing")
    for name, df in fixtures.load(spark, SF001).items():
        write_csv(df.coalesce(1), f"{d}/{name}.csv")
    return d


def scratch_dir_of(result):
    return result.marts["dim_customer"].rsplit("/marts/", 1)[0]   # the run's own folder


def _rows(spark, path):
    return sorted(map(tuple, spark.read.parquet(path).collect()), key=repr)


def test_refresh_from_csv_and_idempotent(spark, landing):
    a = refresh(spark, scratch_path(spark, "run"), data_dir=landing, min_rows=ONE)
    b = refresh(spark, scratch_path(spark, "run"), data_dir=landing, min_rows=ONE)
    assert set(a.marts) == {"dim_geolocation", "fct_order_payments", "dim_customer",
                            "mart_hvc_payment_profile", "mart_geo_value", "mart_payment_uplift"}
    for name in a.marts:
        assert _rows(spark, a.marts[name]) == _rows(spark, b.marts[name]), name
    assert {m[1] for m in a.metrics if m[0] == "load"} == set(MIN_ROWS) and all(m[2] > 0 for m in a.metrics)
    assert a.rows["order_payments"] == spark.read.parquet(a.staging["order_payments"]).count()
    assert any(r["check"] == "orphan_payments" for r in a.staging_report)
    metrics = spark.read.parquet(scratch_dir_of(a) + "/metrics").collect()
    assert {(m.step, m.table) for m in metrics} >= {("load", "orders"), ("mart", "dim_customer")}


def test_refresh_matches_registry_marts(spark, landing):
    from valuepay.queries import bundle
    res = refresh(spark, scratch_path(spark, "run"), data_dir=landing, min_rows=ONE)
    marts = bundle(spark, SF001)[1]
    for name in ("dim_customer", "mart_payment_uplift", "mart_geo_value"):
        want = sorted(map(tuple, getattr(marts, name).collect()), key=repr)
        assert _rows(spark, res.marts[name]) == want, name


def test_empty_source_fails_the_refresh(spark):
    from valuepay.sources.csv_source import SourceEmpty
    d = scratch_path(spark, "landing-empty")
    for name, df in fixtures.load(spark, SF001).items():
        write_csv(df.where("false") if name == "order_items" else df.coalesce(1), f"{d}/{name}.csv")
    with pytest.raises(SourceEmpty, match="order_items"):
        refresh(spark, scratch_path(spark, "run"), data_dir=d, min_rows=ONE)


def test_reference_thresholds_stop_the_refresh(spark, landing):
    from valuepay.plans.quality import QualityGateFailed
    with pytest.raises(QualityGateFailed) as e:
        refresh(spark, scratch_path(spark, "run"), data_dir=landing)
    msg = str(e.value)
    assert all(f"min_rows:{t}" in msg for t in MIN_ROWS)


def test_shuffle_sized_from_input():
    from valuepay.session import shuffle_partitions_for
    assert shuffle_partitions_for(10 << 20, 8) == 8                     # small input: keep
    assert shuffle_partitions_for(100 * (1 << 40), 200) == 50_000       # 100 TB: capped
    assert shuffle_partitions_for(1 << 40, 200) == 4096                 # 1 TB / 256 MB


def test_refresh_sizes_and_restores_partitions(spark, landing):
    res = refresh(spark, scratch_path(spark, "run"), data_dir=landing, min_rows=ONE)
    assert res.shuffle_partitions == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None) is None


def test_command_line_refresh_and_card(spark, landing, capsys):
    from valuepay.__main__ import main
    out = scratch_path(spark, "cli").removeprefix("file:")
    args = ["refresh", "--data-dir", landing, "--out", out, "--min-rows"] + [f"{t}=1" for t in MIN_ROWS]
    assert main(args) == 0
    printed = capsys.readouterr().out
    marts = json.loads(printed[printed.index("{"):])["marts"]["dim_customer"].rsplit("/", 1)[0]
    assert main(["card", "verify_counts", "--marts", marts]) == 0
    assert "hvc_customers" in capsys.readouterr().out
    assert main(["card", "uplift_at", "--marts", marts, "--adoption", "50", "--capture", "80"]) == 0
    assert "orders_adopting" in capsys.readouterr().out
    assert main(["refresh", "--data-dir", landing, "--out", out + "-strict"]) == 2   # reference minimums


def test_everyone_equal_is_all_hvc_and_fails_the_mart_gate(spark):
    from tests import frames
    from valuepay.plans import marts as M
    from valuepay.plans import quality as Q
    o = frames.orders(spark, [(f"o{i}", f"c{i}", "delivered", "2018-01-01 00:00:00") for i in range(20)])
    p = frames.payments(spark, [(f"o{i}", 1, "boleto", 1, "10.00") for i in range(20)])
    c = frames.customers(spark, [(f"c{i}", f"U{i}", "0", "x", "S") for i in range(20)])
    fact = M.fct_order_payments(o, p, frames.items(spark, []), c)
    dim = M.dim_customer(fact)
    assert dim.where("is_high_value_customer").count() == 20
    assert {r.value_segment for r in dim.collect()} == {"Top 5% Whale"}
    with pytest.raises(Q.QualityGateFailed, match="hvc_share"):
        Q.enforce(Q.mart_checks(fact, dim), "mart gate")


def test_concurrent_runner_propagates_failures():
    from valuepay.plans.refresh import run_concurrently
    assert run_concurrently({"a": lambda: 1, "b": lambda: 2}) == {"a": 1, "b": 2}

    def boom():
        raise ValueError("job failed")
    with pytest.raises(ValueError, match="job failed"):
        run_concurrently({"ok": lambda: 1, "bad": boom})


def test_scan_split_sized_from_input():
    from valuepay.session import _bytes, split_bytes_for
    assert _bytes("134217728b") == 128 << 20 and _bytes("128m") == 128 << 20 and _bytes("1g") == 1 << 30
    assert split_bytes_for(10 << 30, 128 << 20) == 128 << 20               # 10 GB: keep 128 MB
    assert split_bytes_for(100 * (1 << 40), 128 << 20) > 500 << 20          # 100 TB: ~550 MB splits
    assert split_bytes_for(2 ** 63 - 1, 128 << 20) == 1 << 30               # unknown size: capped


def test_publish_moves_only_after_checked_runs(spark, landing):
    from valuepay.plans.quality import QualityGateFailed
    from valuepay.plans.refresh import published_marts
    pointer, out = scratch_path(spark, "current"), scratch_path(spark, "run")
    good = refresh(spark, out, data_dir=landing, min_rows=ONE, publish_to=pointer)
    marts = published_marts(spark, pointer)
    assert set(marts) == set(good.marts) and marts["dim_customer"].count() > 0
    before = {name: _rows(spark, path) for name, path in good.marts.items()}
    with pytest.raises(QualityGateFailed):   # same out folder, gate fails
        refresh(spark, out, data_dir=landing, min_rows=ONE, publish_to=pointer, max_orphans=0)
    assert {name: sorted(map(tuple, df.collect()), key=repr) for name, df in published_marts(spark, pointer).items()} == before
    later = refresh(spark, out, data_dir=landing, min_rows=ONE, publish_to=pointer)
    assert not set(later.marts.values()) & set(good.marts.values())
    assert {name: df.inputFiles()[0].split("/marts/")[0] for name, df in published_marts(spark, pointer).items()} == {
        name: spark.read.parquet(path).inputFiles()[0].split("/marts/")[0] for name, path in later.marts.items()}
    assert {name: _rows(spark, path) for name, path in good.marts.items()} == before


def test_unclustered_refresh_gives_the_same_marts(spark, landing):
    a = refresh(spark, scratch_path(spark, "run"), data_dir=landing, min_rows=ONE)
    b = refresh(spark, scratch_path(spark, "run"), data_dir=landing, min_rows=ONE, cluster=False)
    for name in a.marts:
        assert _rows(spark, a.marts[name]) == _rows(spark, b.marts[name]), name


def test_orphan_maximum_stops_the_refresh(spark, landing):
    from valuepay.plans.quality import QualityGateFailed
    with pytest.raises(QualityGateFailed, match="orphan_payments"):
        refresh(spark, scratch_path(spark, "run"), data_dir=landing, min_rows=ONE, max_orphans=0)


def test_sized_shuffle_respects_user_settings(spark):
    from valuepay.session import INITIAL_PARTITIONS, MAX_PARTITION_BYTES, sized_shuffle
    df = spark.range(10)
    spark.conf.set(INITIAL_PARTITIONS, "7")
    try:
        with sized_shuffle(spark, [df]) as n:
            assert n is None and spark.conf.get(INITIAL_PARTITIONS) == "7"
        assert spark.conf.get(INITIAL_PARTITIONS) == "7"            # the user's value survives
    finally:
        spark.conf.unset(INITIAL_PARTITIONS)
    with sized_shuffle(spark, [df]) as n:
        assert n == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert spark.conf.get(INITIAL_PARTITIONS, None) is None
    assert spark.conf.get(MAX_PARTITION_BYTES, None) is None         # small input: untouched


def test_refresh_with_ranged_marts_gives_the_same_marts(spark):
    from valuepay.sources.ranged import file_ranges
    sources = fixtures.load(spark, SF001)
    low = {t: 1 for t in sources}
    plain = refresh(spark, scratch_path(spark, "plain"), sources=sources, min_rows=low)
    ranges = refresh(spark, scratch_path(spark, "ranges"), sources=sources, min_rows=low, cluster="ranges")
    for name, path in plain.marts.items():
        a, b = spark.read.parquet(path), spark.read.parquet(ranges.marts[name])
        assert a.count() == b.count() and a.exceptAll(b).isEmpty()
    files = sorted((r["low"], r["high"]) for r in file_ranges(spark, ranges.marts["fct_order_payments"]).collect())
    assert all(a[1] <= b[0] for a, b in zip(files, files[1:]))


def test_failed_refresh_continues_where_it_stopped(spark, landing, monkeypatch):
    from valuepay.plans import marts as M

    def killed(*args, **kwargs):
        raise RuntimeError("killed after the fact")

    built = []
    real = M.fct_order_payments
    monkeypatch.setattr(M, "fct_order_payments", lambda *a: built.append("fact") or real(*a))
    with monkeypatch.context() as m:
        m.setattr(M, "customer_base", killed)
        with pytest.raises(RuntimeError, match="killed") as failed:
            refresh(spark, scratch_path(spark, "resume"), data_dir=landing, min_rows=ONE)
    folder = failed.value.__notes__[0].split("resume=")[1].strip("'")
    pointer = scratch_path(spark, "pointer")
    again = refresh(spark, "unused", data_dir=landing, min_rows=ONE, resume=folder, publish_to=pointer)
    assert built == ["fact"] and again.run_dir == folder
    assert set(again.reused) == {"mart:dim_geolocation", "mart:fct_order_payments", *(f"load:{t}" for t in ONE)}
    whole = refresh(spark, scratch_path(spark, "whole"), data_dir=landing, min_rows=ONE)
    assert whole.reused == [] and whole.rows == again.rows and whole.mart_counts == again.mart_counts
    for name in whole.marts:
        assert _rows(spark, whole.marts[name]) == _rows(spark, again.marts[name])
    # a finished run is read whole
    assert len(refresh(spark, "unused", data_dir=landing, min_rows=ONE, resume=folder).reused) == len(ONE) + 7


def test_half_written_table_is_built_again(spark, landing, tmp_path):
    import os
    first = refresh(spark, str(tmp_path), data_dir=landing, min_rows=ONE)
    os.rename(f"{first.marts['dim_customer']}/_SUCCESS", tmp_path / "moved")
    again = refresh(spark, "unused", data_dir=landing, min_rows=ONE, resume=first.run_dir)
    assert "mart:dim_customer" not in again.reused and "mart:fct_order_payments" in again.reused
    assert _rows(spark, again.marts["dim_customer"]) and again.mart_counts == first.mart_counts


def test_expired_runs(spark, tmp_path):
    from valuepay.plans.refresh import RefreshResult, expired_runs, publish
    pointer = str(tmp_path / "pointer")
    for k in [0, 1, 2, 1, 3]:
        publish(spark, RefreshResult(marts={"dim_customer": f"/x/run={k}/marts/dim_customer"}), pointer)
    assert expired_runs(spark, pointer, keep=2) == ["/x/run=2", "/x/run=0"]
    assert expired_runs(spark, pointer, keep=9) == []
