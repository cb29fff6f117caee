"""Sinks (K1-K5): clustered parquet tables written with overwrite, and load metrics."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


def write_table(df: DataFrame, path: str, sort_key: Sequence[str] = ()) -> None:
    """Full rebuild of a table (drop-and-create / truncate-and-load).

    With a sort key every output file is sorted on it, so parquet row-group
    min/max statistics let later scans skip row groups (the clustered layout of
    the staging and mart tables). The rows keep the partitioning of the last
    shuffle: a global range repartition would need an extra sampling pass that
    recomputes the final stage. A refresh writes below a run folder of
    its own, so readers never see a half-written table.
    """
    if sort_key:
        df = df.sortWithinPartitions(*sort_key)
    df.write.mode("overwrite").parquet(path)


def committed(spark: SparkSession, path: str) -> bool:
    """Whether a table was written to its end: Spark leaves ``_SUCCESS`` when a write job has committed all its
    files. Only the path is looked up; no job runs."""
    try:
        spark.read.text(f"{path}/_SUCCESS")
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    return True


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def metrics_frame(spark: SparkSession, rows: Sequence[tuple[str, str, int]]) -> DataFrame:
    """Load metrics (K5): step, table, rows, run timestamp."""
    now = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    return spark.createDataFrame(
        [(step, table, int(n), now) for step, table, n in rows],
        "step string, table string, rows bigint, run_ts timestamp_ntz",
    )
