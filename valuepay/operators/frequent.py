"""Frequent value per group (A6) by a count tree: no task ever holds a map of a group's values.

Level 1 counts rows per group and combination of values; it is the only level that reads the input. Level 2
turns a combination into one counter for each value column and merges equal counters; level 3 keeps the largest
counter of each column. Counters and the ``totals`` that ride along are sums, so every level is evaluated partially
before its exchange, and a group with a third of all rows, or a value in a third of them, is a few rows per task.
Three exchanges for any number of columns (two for one column), one scan.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def frequent_values(df: DataFrame, keys: Mapping[str, Column], values: Mapping[str, Column],
                    totals: Mapping[str, Column] | None = None) -> DataFrame:
    """One row per group: ``keys``, the most frequent value of each of ``values`` (ties to the smallest; NULL is no
    value and is the result where a group has no other), and the sums named in ``totals`` (each a column that is
    summed; NULL where it is NULL in all rows of the group)."""
    totals = dict(totals or {})
    counted = df.select(*[c.alias(k) for k, c in keys.items()], *[c.alias(f"_v{i}") for i, c in enumerate(values.values())],
                        *[c.alias(f"_t{i}") for i, c in enumerate(totals.values())])
    columns, sums = [f"_v{i}" for i in range(len(values))], [f"_t{i}" for i in range(len(totals))]
    counted = counted.groupBy(*keys, *columns).agg(F.count(F.lit(1)).alias("_n"), *[F.sum(s).alias(s) for s in sums])
    if len(columns) > 1:
        # one row for each column: its value and count; the totals go with the first
        split = F.explode(F.array(*[F.struct(
            F.lit(i).alias("_which"),
            *[(F.col(v) if j == i else F.lit(None)).alias(v) for j, v in enumerate(columns)],
            *[(F.col(s) if i == 0 else F.lit(None)).alias(s) for s in sums]) for i in range(len(columns))]))
        counted = (counted.select(*keys, "_n", split.alias("_s")).select(*keys, "_n", "_s.*")
                   .groupBy(*keys, "_which", *columns).agg(F.sum("_n").alias("_n"), *[F.sum(s).alias(s) for s in sums]))
    # counts are compared first, then the value itself; a column is NULL in the rows of the others
    best = [F.min(F.when(F.col(v).isNotNull(), F.struct((-F.col("_n")).alias("less"), F.col(v).alias("value"))))["value"].alias(name)
            for v, name in zip(columns, values)]
    return counted.groupBy(*keys).agg(*best, *[F.sum(s).alias(t) for s, t in zip(sums, totals)])
