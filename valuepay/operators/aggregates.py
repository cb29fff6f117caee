"""Aggregate building blocks (A5-A12, A18) as Spark Column expressions.

All of them are declarative aggregates that Spark evaluates partially on the map
side and merges after the shuffle, so a group holding a third of all rows costs
one partial row per map task, never a single task holding the group.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A date far in the future: a missing date sorts after every real one.
FAR_FUTURE_DATE = "9999-12-31"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def nulls_last(x) -> tuple[Column, Column]:
    """Sort key parts that place NULL after every value (struct comparison puts NULL
    first): ``(x IS NULL, x)``, spliced flat into the ordering struct."""
    x = _c(x)
    return x.isNull(), x


def _order(*keys) -> Column:
    """One flat struct of ordering keys; tuples from ``nulls_last`` are spliced in, so the
    comparison per row stays a single struct comparison."""
    parts: list[Column] = []
    for k in keys:
        parts.extend(k if isinstance(k, tuple) else (_c(k),))
    return F.struct(*parts)


def arg_max(value, key, *tie_breaks) -> Column:
    """Value at the row with the largest ``key``; ties go to the smallest tie-break tuple.

    ``min_by`` over ``(-key, tie_breaks...)`` picks exactly one well-defined row,
    unlike ``max_by`` on the bare key whose tie winner depends on row order.
    """
    return F.min_by(_c(value), _order(-_c(key), *tie_breaks))


def first_by(value, *order) -> Column:
    """Value of the first row in ``order`` (ascending, each key as given)."""
    return F.min_by(_c(value), _order(*order))


def sum_if(x, cond: Column) -> Column:
    """Sum over matching rows; 0 (not NULL) when nothing matches."""
    return F.sum(F.when(cond, _c(x)).otherwise(F.lit(0)))


def count_if(cond: Column) -> Column:
    return F.count_if(cond)


def mean(x) -> Column:
    """Exact mean as double: exact (decimal or integer) sum divided by the count.

    Summing first keeps money sums exact; one division gives the same double in
    every engine. NULL for an empty group.
    """
    x = _c(x)
    return F.try_divide(F.sum(x).cast("double"), F.count(x).cast("double"))


def mean_exact(x, scale: int = 18) -> Column:
    """Mean of bounded doubles (e.g. coordinates) that does not depend on row order.

    A double sum rounds differently for each partitioning, so a rebuilt table
    could differ in the last bit. Summing the values as decimal(38, scale) is
    exact and associative; one conversion and one division give the double.
    Values must stay below 10^(38-scale) in magnitude.
    """
    x = _c(x)
    return F.try_divide(F.sum(x.cast(f"decimal(38,{scale})")).cast("double"), F.count(x).cast("double"))


def avg_if(x, cond: Column) -> Column:
    """Mean over matching rows; NULL (not NaN) when nothing matches."""
    return mean(F.when(cond, _c(x)))


def count_distinct_if(x, cond: Column) -> Column:
    return F.count_distinct(F.when(cond, _c(x)))


def distinct_counts(df: DataFrame, keys: Sequence[str], x: str, conditions: Mapping[str, Column]) -> DataFrame:
    """Per group, the number of distinct values of ``x`` among the rows that meet each condition (NULL is no value;
    a group without a match has 0). Each group and value is first one row with a flag for each condition, so
    rows are not expanded per distinct column, and a hot group or value is combined before the exchange."""
    flagged = df.groupBy(*keys, x).agg(*[F.max(F.coalesce(c, F.lit(False))).alias(f"_{i}") for i, c in enumerate(conditions.values())])
    return flagged.groupBy(*keys).agg(*[F.count_if(F.col(f"_{i}") & F.col(x).isNotNull()).alias(name) for i, name in enumerate(conditions)])


def ratio(num: Column, den: Column) -> Column:
    """num / den as double; NULL when den is 0."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def percent(num: Column, den: Column) -> Column:
    return ratio(num, den) * F.lit(100.0)


def mode(x) -> Column:
    """Most frequent value; ties go to the smallest value (deterministic)."""
    return F.mode(_c(x), True)


def first_of_earliest(values: Sequence[str], ts, tie) -> Column:
    """Struct of ``values`` from the earliest row by ``ts`` (NULL last), then ``tie``.

    The columns come from one row, so e.g. state and city stay consistent.
    """
    return first_by(F.struct(*[F.col(v) for v in values]), nulls_last(ts), _c(tie))
