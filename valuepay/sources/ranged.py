"""Key-ranged tables (K3): files whose key ranges do not overlap, and a reader that opens only those a key needs.

Rows are range-partitioned at splitters that Spark samples from the key, so a file holds one stretch of keys,
sorted. A key with more rows than a file should hold is cut by a hash of the row, the last splitter column: such a key
has several files, which overlap in that key alone. Beside the files lies a table with one row for each of them
(``_ranges``: file, smallest and largest key, rows); it is made from the key column of the written files and
written last, so a reader that finds it finds a complete table. A key filter first reads ``_ranges`` and then
scans the files it names, with the filter pushed down to their row groups.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from valuepay.session import TASK_BYTES, input_bytes, shuffle_partitions_for

RANGES = "_ranges"  # a name that scans of the folder leave out


def file_count(df: DataFrame, least: int = 1) -> int:
    """Files such that each holds about ``TASK_BYTES`` of a stored frame, as one task sorts a whole file."""
    return shuffle_partitions_for(input_bytes([df]), least, TASK_BYTES)


def write_ranged(df: DataFrame, path: str, key: str, sort_key: Sequence[str] = (), files: int | None = None) -> None:
    """Replace the table at ``path`` by the rows of ``df``, ranged by ``key`` and sorted in each file by ``sort_key``
    (default: the key). ``files``: how many, about; by default AQE merges small ranges to its advisory size."""
    cut = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])   # cuts a hot key; rows repeated whole stay together
    bounds = [F.col(f"`{key}`").asc_nulls_first(), cut]
    ranged = df.repartitionByRange(files, *bounds) if files else df.repartitionByRange(*bounds)
    ranged.sortWithinPartitions(*(sort_key or (key,))).write.mode("overwrite").parquet(path)
    written = df.sparkSession.read.parquet(path)
    k = F.col(f"`{key}`")
    (written.groupBy(F.col("_metadata.file_path").alias("file"))
     .agg(F.min(k).alias("low"), F.max(k).alias("high"), F.count_if(k.isNull()).alias("nulls"), F.count(F.lit(1)).alias("rows"))
     .coalesce(1).write.mode("overwrite").parquet(f"{path}/{RANGES}"))


def file_ranges(spark: SparkSession, path: str) -> DataFrame:
    """``file, low, high, nulls, rows`` of every file of a ranged table."""
    return spark.read.parquet(f"{path}/{RANGES}")


def _scan(spark: SparkSession, path: str, wanted: Column) -> DataFrame:
    """The files whose range satisfies ``wanted``; their names, one string each, come to the driver as for any scan."""
    files = [r["file"] for r in file_ranges(spark, path).where(wanted).select("file").collect()]
    return spark.read.parquet(*files) if files else spark.read.parquet(path).limit(0)


def read_between(spark: SparkSession, path: str, key: str, low, high) -> DataFrame:
    """The rows with ``low <= key <= high``."""
    found = _scan(spark, path, (F.col("high") >= F.lit(low)) & (F.col("low") <= F.lit(high)))
    return found.where(F.col(f"`{key}`").between(F.lit(low), F.lit(high)))


def read_keys(spark: SparkSession, path: str, key: str, keys: Iterable) -> DataFrame:
    """The rows of the given keys (a list of the caller's; null matches nothing)."""
    keys = [k for k in keys if k is not None]
    if not keys:
        return spark.read.parquet(path).limit(0)
    near = F.exists(F.array(*[F.lit(k) for k in keys]), lambda k: (k >= F.col("low")) & (k <= F.col("high")))
    return _scan(spark, path, near).where(F.col(f"`{key}`").isin(keys))
