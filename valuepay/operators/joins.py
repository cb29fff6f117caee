"""Join helpers (J2, J3, J7).

Joins are plain equi-joins: Catalyst plans a sort-merge join, and AQE
replaces it by a broadcast hash join only when the measured size of one side
is under ``spark.sql.autoBroadcastJoinThreshold`` — the size check — and
splits skewed partitions otherwise. No side is broadcast on trust.
"""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def left_join_filled(left: DataFrame, right: DataFrame, on: str, defaults: dict[str, Any]) -> DataFrame:
    """Left equi-join where unmatched right columns take type defaults (0, '') instead of NULL."""
    j = left.join(right, on, "left")
    cols = [F.coalesce(F.col(c), F.lit(defaults[c])).alias(c) if c in defaults else F.col(c)
            for c in j.columns]
    return j.select(cols)


def anti_count(left: DataFrame, right: DataFrame, on: str) -> DataFrame:
    """One row: number of left rows without a match on the right (left anti join). Left rows are
    counted per key first, so a hot key is one row in the join; a null key matches nothing."""
    per_key = left.groupBy(on).agg(F.count(F.lit(1)).alias("n"))
    return per_key.join(right.select(on), on, "left_anti").agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("orphans"))
