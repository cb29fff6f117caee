"""The count tree against plain Python, and its plan: one scan, no map of values."""

import random
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from tests.test_plans import plan
from valuepay.operators.frequent import frequent_values
from valuepay.plans import marts as M
from valuepay.session import scratch_path


def test_frequent_values_equal_plain_python(spark):
    rng = random.Random(4)
    rows = [(rng.choice(["a", "b", "c", None]), rng.choice(["x", "y", "z", None]), rng.choice([1, 2, None]), rng.choice([5, None]))
            for _ in range(400)]
    rows += [("hot", f"v{i % 7}", i % 5, 1) for i in range(700)] + [("none", None, None, None)] * 3
    found = frequent_values(spark.createDataFrame(rows, "g string, s string, i int, t long").repartition(6),
                            {"g": F.col("g")}, {"s": F.col("s"), "i": F.col("i")}, {"total": F.col("t"), "n": F.lit(1)})
    groups = defaultdict(list)
    for r in rows:
        groups[r[0]].append(r)
    want = set()
    for g, own in groups.items():
        modes = []
        for k in (1, 2):
            c = Counter(r[k] for r in own if r[k] is not None)
            modes.append(min(c, key=lambda v: (-c[v], v)) if c else None)
        known = [r[3] for r in own if r[3] is not None]
        want.add((g, *modes, sum(known) if known else None, len(own)))
    assert {tuple(r) for r in found.collect()} == want


def test_one_value_column_and_no_rows(spark):
    df = spark.createDataFrame([("p", "b"), ("p", "a"), ("p", "b"), ("p", "a")], "g string, s string")
    assert [tuple(r) for r in frequent_values(df, {"g": F.col("g")}, {"s": F.col("s")}).collect()] == [("p", "a")]
    assert frequent_values(df.limit(0), {"g": F.col("g")}, {"s": F.col("s")}).collect() == []


def test_geolocation_mart_scans_once_without_value_maps(spark):
    path = scratch_path(spark, "geo")
    spark.createDataFrame([("1", 0.5, 1.5, "c", "s")], "geolocation_zip_code_prefix string, geolocation_lat double, "
                          "geolocation_lng double, geolocation_city string, geolocation_state string").write.parquet(path)
    p = plan(M.dim_geolocation(spark.read.parquet(path)))
    assert p.count("FileScan") == 1 and p.count("Exchange hashpartitioning") == 3 and "Join" not in p
    assert "mode(" not in p and "collect_" not in p


def test_state_without_coordinates_or_names(spark):
    df = spark.createDataFrame([("1", None, 2.0, None, "s"), ("1", None, 4.0, None, "s"), ("2", 1.0, None, "c", None)],
                               "geolocation_zip_code_prefix string, geolocation_lat double, geolocation_lng double, "
                               "geolocation_city string, geolocation_state string")
    assert {tuple(r) for r in M.dim_geolocation(df).collect()} == {("1", None, 3.0, None, "s"), ("2", 1.0, None, "c", None)}
