"""Bucketed tables: tables that share a key, hashed by it into the same buckets when they are stored, so that rollups
and joins on the key read matching buckets and exchange nothing.

A bucket is read by one task, so a key that holds a large part of a table's rows must not be in one. Such hot keys are
found exactly before the tables are written: Spark's frequent-items summary (one scan, no shuffle) names every key
that can hold ``HOT_SHARE`` of the rows, and one count of these candidates keeps those that do. All tables keep the rows of
hot keys (and of null keys) in plain files beside the buckets, for plans that aggregate before they shuffle. So a result over
the key is the union of the same plan over both parts.

Writing costs one exchange of each table's rows. It pays where stored tables are read more than once (marts rebuilt from one
landing, several rollups and checks on the key); for one pass the plain files are cheaper.

Below ``path``: ``cold/<table>`` (buckets), ``hot/<table>`` and ``_layout`` (table, key, buckets; written last, so a
reader that finds it finds complete tables). Buckets are known to Spark by a table of the session's catalog, named after
the folder; it holds no data, and ``forget`` removes it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from valuepay.session import TASK_BYTES, input_bytes, shuffle_partitions_for

LAYOUT = "_layout"
HOT_SHARE = 0.0005  # of a table's rows; so a table has 2,000 hot keys at most
HOT_ROWS = 1000     # fewer rows are no burden to a task, whatever their share


@dataclass(frozen=True)
class Bucketed:
    key: str
    buckets: int
    cold: dict[str, DataFrame]
    hot: dict[str, DataFrame]


def _table(path: str) -> str:
    return f"bucketed_{hashlib.sha256(path.encode()).hexdigest()[:24]}"


def hot_keys(df: DataFrame, key: str) -> list:
    """The keys that hold at least ``HOT_SHARE`` of the rows, and ``HOT_ROWS``, exactly. At most 1 / ``HOT_SHARE``
    candidates and counts come to the driver, whatever the table."""
    keys = df.select(F.col(f"`{key}`").alias("k")).where("k IS NOT NULL")
    found = [k for k in keys.stat.freqItems(["k"], HOT_SHARE).first()[0] or [] if k is not None]
    counts = keys.groupBy(F.when(F.col("k").isin(found), F.col("k")).alias("k")).count().collect()
    least = max(HOT_ROWS, HOT_SHARE * sum(r["count"] for r in counts))
    return sorted(r["k"] for r in counts if r["k"] is not None and r["count"] >= least)


def _is_hot(key: str, hot: list) -> Column:
    k = F.col(f"`{key}`")
    return k.isNull() | k.isin(hot) if hot else k.isNull()


def bucket_count(frames: Iterable[DataFrame], least: int = 1) -> int:
    """Buckets such that each holds about ``TASK_BYTES`` of the largest of the tables that the frames scan, as one task rolls
    up and joins a whole bucket."""
    return max(shuffle_partitions_for(input_bytes([df]), least, TASK_BYTES) for df in frames)


def write_bucketed(frames: Mapping[str, DataFrame], path: str, key: str, buckets: int | None = None) -> Bucketed:
    """Store the frames below ``path``, which must be new; ``buckets``: by default ``bucket_count``."""
    path = path.rstrip("/")
    spark = next(iter(frames.values())).sparkSession
    n = buckets or bucket_count(frames.values())
    hot = sorted({k for df in frames.values() for k in hot_keys(df, key)})
    for name, df in frames.items():
        df.where(_is_hot(key, hot)).write.parquet(f"{path}/hot/{name}")
        target = f"{path}/cold/{name}"
        (df.where(~_is_hot(key, hot)).repartition(n, F.col(f"`{key}`")).write.format("parquet").option("path", target)
         .bucketBy(n, key).sortBy(key).saveAsTable(_table(target)))
    (spark.createDataFrame([(name, key, n) for name in frames], "name string, key string, buckets int").coalesce(1)
     .write.parquet(f"{path}/{LAYOUT}"))
    return read_bucketed(spark, path)


def read_bucketed(spark: SparkSession, path: str) -> Bucketed:
    """The tables stored below ``path``, by this session or another."""
    path = path.rstrip("/")
    layout = spark.read.parquet(f"{path}/{LAYOUT}").collect()   # one row for each table
    key, n = layout[0]["key"], layout[0]["buckets"]
    cold = {}
    for name in (r["name"] for r in layout):
        target = f"{path}/cold/{name}"
        fields = spark.read.parquet(f"{path}/hot/{name}").schema.fields
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
        place = target.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(f"CREATE TABLE IF NOT EXISTS {_table(target)} ({columns}) USING parquet "
                  f"CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {n} BUCKETS LOCATION '{place}'")
        cold[name] = spark.table(_table(target))
    return Bucketed(key, n, cold, {name: spark.read.parquet(f"{path}/hot/{name}") for name in cold})


def forget(spark: SparkSession, path: str, names: Iterable[str]) -> None:
    """Take the tables below ``path`` out of the session's catalog; their files stay."""
    for name in names:
        spark.sql(f"DROP TABLE IF EXISTS {_table(path.rstrip('/') + '/cold/' + name)}")
