"""Record-aligned reading of multi-line CSV against Spark's multiLine reader, at many split sizes."""

import random

import pytest
from pyspark.sql import functions as F

from valuepay.session import MAX_PARTITION_BYTES, scratch_path
from valuepay.sources import csv_records, csv_source

OPTIONS = {"escape": '"', "mode": "FAILFAST"}


def field(rng):
    text = "".join(rng.choice(["a", "b", ",", '"', "\n", "é", "x y", "\n\n", '""', ""]) for _ in range(rng.randint(0, 8)))
    return '"' + text.replace('"', '""') + '"' if any(c in text for c in ',"\n') or rng.random() < .3 else text


@pytest.fixture
def split_bytes(spark):
    yield lambda n: (spark.conf.set(MAX_PARTITION_BYTES, str(n)), spark.conf.set("spark.sql.files.openCostInBytes", "0"))
    spark.conf.unset(MAX_PARTITION_BYTES)
    spark.conf.unset("spark.sql.files.openCostInBytes")


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("eol,seed", [("\n", 1), ("\n", 2), ("\r\n", 3)])
def test_random_files_equal_the_multiline_reader(spark, tmp_path, split_bytes, eol, seed):
    rng = random.Random(seed)
    for k in range(3):
        with open(tmp_path / f"f{k}.csv", "w", newline="") as f:
            f.write("a,b,c" + eol)
            f.writelines(f"{i},{field(rng)},{field(rng)}{eol}" for i in range(150))
            f.write(["", "9,x,y", '9,"last\n"'.ljust(500, "z") + '",y'][k] if k < 2 else '9,"' + "long\n" * 200 + '",y')
    want = rows(spark.read.schema("a string, b string, c string").options(header=True, multiLine=True, **OPTIONS).csv(str(tmp_path)))
    for n in (50, 211, 1000, 1 << 20):     # at 50 bytes a record crosses several splits
        split_bytes(n)
        found = csv_records.read_csv_records(spark, str(tmp_path), ["a", "b", "c"], OPTIONS)
        assert rows(found) == want
    split_bytes(211)
    assert spark.read.text(str(tmp_path)).select(F.spark_partition_id()).distinct().count() > 8


def test_one_file_is_read_in_several_tasks(spark, split_bytes):
    path = scratch_path(spark, "reviews")
    df = spark.range(2000).select(*[F.concat(F.lit(f'{c}\n"'), F.col("id").cast("string"), F.lit('", ')).alias(c)
                                    for c in ("review_comment_title", "review_comment_message")],
                                  *[F.col("id").cast("string").alias(c) for c in ("review_id", "order_id")],
                                  (F.col("id") % 5).alias("review_score"),
                                  *[F.lit("2020-01-02 03:04:05").alias(c) for c in ("review_creation_date", "review_answer_timestamp")])
    csv_source.write_csv(df.coalesce(1), f"{path}/order_reviews.csv")
    split_bytes(1 << 13)
    found = csv_source.read_source(spark, path, "order_reviews")     # larger than a split: by records
    assert "monotonically_increasing_id" in found._jdf.queryExecution().executedPlan().toString()
    assert spark.read.text(f"{path}/order_reviews.csv").select(F.spark_partition_id()).distinct().count() > 4
    assert rows(found) == rows(csv_source.read_source(spark, path, "order_reviews", by_records=False))
    assert found.count() == 2000


def test_odd_quotes_and_other_headers_fail(spark, tmp_path):
    (tmp_path / "odd.csv").write_text('a,b\n1,"open\n')
    with pytest.raises(Exception, match="quotes do not pair up"):
        csv_records.read_csv_records(spark, str(tmp_path / "odd.csv"), ["a", "b"], OPTIONS).collect()
    folder = tmp_path / "two"
    folder.mkdir()
    (folder / "x.csv").write_text("a,b\n1,2\n")
    (folder / "y.csv").write_text("b,a\n1,2\n")
    with pytest.raises(Exception, match="another header"):
        csv_records.read_csv_records(spark, str(folder), ["a", "b"], OPTIONS).collect()
    (tmp_path / "short.csv").write_text('a,b\n"1\n1"\n')
    with pytest.raises(Exception, match="(?i)malformed"):
        csv_records.read_csv_records(spark, str(tmp_path / "short.csv"), ["a", "b"], OPTIONS).collect()


def test_header_only_and_empty_file(spark, tmp_path):
    (tmp_path / "head.csv").write_text("a,b\n")
    assert csv_records.read_csv_records(spark, str(tmp_path / "head.csv"), ["a", "b"], OPTIONS).collect() == []
    (tmp_path / "none.csv").write_text("")
    assert csv_records.read_csv_records(spark, str(tmp_path / "none.csv"), ["a", "b"], OPTIONS).collect() == []
