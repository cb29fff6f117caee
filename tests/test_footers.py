"""Figures from file footers: nothing but footers is read, and the figures equal a scan's."""

from pyspark.sql import functions as F

from valuepay.plans import quality as Q
from valuepay.plans.cards import verify_counts
from valuepay.session import scratch_path
from valuepay.sources.footers import SETTINGS, footer_tables


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def stored(spark, df):
    path = scratch_path(spark, "footers")
    df.write.parquet(path)
    return path


def test_min_rows_are_pushed_into_the_scan(spark):
    paths = {n: stored(spark, spark.range(k).repartition(3)) for n, k in (("a", 40), ("b", 5), ("c", 0))}
    report = Q.staging_min_rows(footer_tables(spark, paths), {"a": 40, "b": 6, "c": 0})
    assert plan(report).count("PushedAggregation: [COUNT(*)]") == 2  # the empty table is read as usual
    assert [(r.observed, r.passed) for r in report.collect()] == [(40.0, True), (5.0, False), (0.0, True)]


def test_figures_equal_a_scan_with_nulls_and_other_types(spark):
    df = spark.sql("select if(id % 7 = 0, null, cast(id as int)) i, date_add(date'2020-01-01', cast(id as int)) d,"
                   " cast(id as decimal(12,2)) m, cast(id as string) s from range(100)")
    path = stored(spark, df.repartition(4))
    pushed = [F.count(F.lit(1)).alias("rows"), F.count("i").alias("known"), F.min("i").alias("lo"), F.max("d").alias("last")]
    footer = footer_tables(spark, {"t": path})["t"]
    fast = footer.agg(*pushed)
    assert "PushedAggregation: [COUNT(*), COUNT(i), MIN(i), MAX(d)]" in plan(fast)
    assert fast.collect() == spark.read.parquet(path).agg(*pushed).collect()
    read = [F.min("m").alias("least"), F.max("s").alias("most")]  # such types are read
    assert "PushedAggregation: []" in plan(footer.agg(*read))
    assert footer.agg(*read).collect() == spark.read.parquet(path).agg(*read).collect()


def test_files_without_rows_beside_others(spark):
    path = stored(spark, spark.range(10).repartition(1))
    spark.range(0).write.mode("append").parquet(path)
    table = footer_tables(spark, {"t": path})["t"]
    assert table.count() == 10 and tuple(table.agg(F.min("id"), F.max("id")).first()) == (0, 9)
    assert footer_tables(spark, {"t": stored(spark, spark.range(0))})["t"].count() == 0


def test_the_callers_settings_stay(spark):
    before = {k: spark.conf.get(k) for k in SETTINGS}
    footer_tables(spark, {"t": stored(spark, spark.range(1))})
    assert {k: spark.conf.get(k) for k in SETTINGS} == before


def test_verification_of_an_empty_dimension(spark):
    path = stored(spark, spark.createDataFrame([], "customer_unique_id string, is_high_value_customer boolean"))
    assert tuple(verify_counts(footer_tables(spark, {"d": path})["d"]).first()) == (0, 0)
