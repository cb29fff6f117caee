"""Whole-table figures from parquet file footers (DQ1, V1): counts, minima and maxima without reading rows.

Spark's DataSource V2 parquet reader can push ungrouped, unfiltered ``count``, ``min`` and ``max`` into the scan,
which then answers from the footers: a task reads the end of each file, whatever its size. ``min`` and ``max``
are pushed for booleans, integers, floats and dates; with other types, a filter or a grouping, Spark reads the
columns as usual, so the figures are the same in any case.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

# Settings of the session that reads footers.
SETTINGS = {"spark.sql.sources.useV1SourceList": "", "spark.sql.parquet.aggregatePushdown": "true"}


def footer_tables(spark: SparkSession, paths: Mapping[str, str]) -> dict[str, DataFrame]:
    """The parquet tables at ``paths``, read so that whole-table counts, minima and maxima come from file footers.

    They belong to a session of their own (same application), so the caller's settings, and reads in
    its other threads, stay as they are; unite them with each other, not with other frames.

    A table without rows is read as usual: a pushed count is the sum of the files' counts, which is null
    where no file has any. Whether there are rows is looked up here, by reading one at most.
    """
    own = spark.newSession()
    usual = {name: own.read.parquet(path) for name, path in paths.items()}
    for key, value in SETTINGS.items():
        own.conf.set(key, value)
    return {name: usual[name] if usual[name].isEmpty() else own.read.schema(usual[name].schema).parquet(path)
            for name, path in paths.items()}
