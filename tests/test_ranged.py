"""Key-ranged tables: ranges of files do not overlap, a hot key is cut, a key filter opens few files."""

import pytest
from pyspark.sql import functions as F

from valuepay.session import scratch_path
from valuepay.sources import ranged


@pytest.fixture(scope="module")
def table(spark):
    path = scratch_path(spark, "ranged")
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("k05000")).when(F.col("id") % 1001 == 1, F.lit(None))
         .otherwise(F.format_string("k%05d", F.pmod(F.xxhash64("id"), F.lit(9000)))).alias("key"), F.col("id").alias("n"))
    ranged.write_ranged(df.repartition(7), path, "key", files=12)
    return df, path


def test_ranges_do_not_overlap_but_for_the_hot_key(spark, table):
    df, path = table
    files = sorted((r for r in ranged.file_ranges(spark, path).collect()), key=lambda r: (r["low"] or "", r["high"] or ""))
    assert len(files) >= 10 and sum(r["rows"] for r in files) == df.count()
    for a, b in zip(files, files[1:]):
        # two neighbours share at most the key at which they meet, and that is a cut key only if it is hot
        assert a["high"] <= b["low"]
    shared = {a["high"] for a, b in zip(files, files[1:]) if a["high"] == b["low"]}
    hot = [r for r in files if r["low"] <= "k05000" <= r["high"]]
    assert "k05000" in shared and len(hot) >= 4
    assert max(r["rows"] for r in files) < 30_000 / 4      # the hot key alone has 10,000 rows


def test_key_filters_open_few_files_and_miss_nothing(spark, table):
    df, path = table
    total = len(spark.read.parquet(path).inputFiles())
    one = ranged.read_keys(spark, path, "key", ["k01234", "k08999", None])
    assert len(one.inputFiles()) <= 4 < total
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, df.where("key IN ('k01234', 'k08999')").collect()))
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(key, [k01234,k08999])]" in plan or "In(key" in plan
    part = ranged.read_between(spark, path, "key", "k02000", "k02100")
    assert len(part.inputFiles()) <= 3
    assert part.count() == df.where("key BETWEEN 'k02000' AND 'k02100'").count() > 0
    hot = ranged.read_keys(spark, path, "key", ["k05000"])
    assert hot.count() == df.where("key = 'k05000'").count() >= 10_000 and len(hot.inputFiles()) < total
    assert ranged.read_keys(spark, path, "key", ["none", "zzz"]).count() == ranged.read_keys(spark, path, "key", []).count() == 0


def test_plain_readers_see_the_rows_only(spark, table):
    df, path = table
    assert spark.read.parquet(path).count() == df.count() and spark.read.parquet(path).columns == ["key", "n"]


def test_empty_table(spark):
    path = scratch_path(spark, "ranged-empty")
    ranged.write_ranged(spark.createDataFrame([], "key string, n long"), path, "key")
    assert ranged.read_keys(spark, path, "key", ["a"]).collect() == [] and ranged.file_ranges(spark, path).where("rows > 0").count() == 0
