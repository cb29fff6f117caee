"""Data-quality gates (DQ1-DQ6).

Each check returns a report DataFrame with one row per check:
``check, observed (double), bound (string), passed (boolean), severity``.
``enforce`` collects that small report and raises one ``QualityGateFailed``
naming every failing error-severity check, which stops the refresh.
Counts are full-table aggregates (partial per task, merged after one shuffle).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from valuepay.operators.joins import anti_count
from valuepay.schemas import HVC_SHARE_BAND, MIN_ROWS

REPORT_COLUMNS = ["check", "observed", "bound", "passed", "severity"]


class QualityGateFailed(RuntimeError):
    """A gate found at least one failing check of severity 'error'."""


def _row(check: str, observed: Column, bound: str, passed: Column, severity: str = "error") -> list[Column]:
    return [F.lit(check).alias("check"), observed.cast("double").alias("observed"),
            F.lit(bound).alias("bound"), F.coalesce(passed, F.lit(False)).alias("passed"),
            F.lit(severity).alias("severity")]


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def staging_min_rows(tables: Mapping[str, DataFrame], min_rows: Mapping[str, int] = MIN_ROWS) -> DataFrame:
    """DQ1: every staging table holds at least its minimum number of rows."""
    parts = []
    for name, minimum in min_rows.items():
        parts.append(tables[name].agg(F.count(F.lit(1)).alias("n")).select(
            *_row(f"min_rows:{name}", F.col("n"), f">= {minimum}", F.col("n") >= minimum)))
    return _union(parts)


REPORT_SCHEMA = "check string, observed double, bound string, passed boolean, severity string"


def min_rows_rows(counts: Mapping[str, int], min_rows: Mapping[str, int] = MIN_ROWS) -> list[Row]:
    """DQ1 report rows from row counts already observed while loading (no scan, no job)."""
    return [Row(check=f"min_rows:{t}", observed=float(counts[t]), bound=f">= {m}",
                passed=counts[t] >= m, severity="error") for t, m in min_rows.items()]


def orphan_payments(order_payments: DataFrame, orders: DataFrame, max_orphans: int | None = None) -> DataFrame:
    """DQ2: payments whose order is missing (left anti join). Logged only unless a maximum is given."""
    c = anti_count(order_payments.select("order_id"), orders.select("order_id"), "order_id")
    if max_orphans is None:
        return c.select(*_row("orphan_payments", F.col("orphans"), "logged", F.lit(True), "warn"))
    return c.select(*_row("orphan_payments", F.col("orphans"), f"<= {max_orphans}",
                          F.col("orphans") <= max_orphans))


def orphan_rows(orphans: int) -> list[Row]:
    """DQ2 report row from the number observed while the fact was written (no scan); logged only."""
    return [Row(check="orphan_payments", observed=float(orphans), bound="logged", passed=True, severity="warn")]


def mart_checks(fact: DataFrame, dim: DataFrame, band: tuple[float, float] = HVC_SHARE_BAND) -> DataFrame:
    """DQ3-DQ5: marts not empty, HVC share inside the band, no negative order value."""
    lo, hi = band
    share = F.try_divide(F.col("hvc").cast("double"), F.col("dim_rows").cast("double"))
    # one scan per table: its figures are one row, which becomes its report rows
    f = fact.agg(F.count(F.lit(1)).alias("fact_rows"),
                 F.count_if(F.col("order_value") < 0).alias("negative"))
    d = dim.agg(F.count(F.lit(1)).alias("dim_rows"),
                F.count_if(F.col("is_high_value_customer")).alias("hvc"))
    return _union([
        _rows(f, _row("fact_not_empty", F.col("fact_rows"), "> 0", F.col("fact_rows") > 0),
              _row("no_negative_order_value", F.col("negative"), "= 0", F.col("negative") == 0)),
        _rows(d, _row("dim_not_empty", F.col("dim_rows"), "> 0", F.col("dim_rows") > 0),
              _row("hvc_share", share, f"[{lo}, {hi}]", (share >= lo) & (share <= hi))),
    ])


def _rows(figures: DataFrame, *rows: list) -> DataFrame:
    """Report rows made of one row of figures."""
    return figures.select(F.inline(F.array(*[F.struct(*r) for r in rows])))


def mart_check_rows(fact_rows: int, negative: int, dim_rows: int, hvc: int,
                    band: tuple[float, float] = HVC_SHARE_BAND) -> list[Row]:
    """DQ3-DQ5 report rows from figures observed while the marts were written (no scan)."""
    lo, hi = band
    share = hvc / dim_rows if dim_rows else None
    rows = [("fact_not_empty", float(fact_rows), "> 0", fact_rows > 0),
            ("dim_not_empty", float(dim_rows), "> 0", dim_rows > 0),
            ("hvc_share", share, f"[{lo}, {hi}]", share is not None and lo <= share <= hi),
            ("no_negative_order_value", float(negative), "= 0", negative == 0)]
    return [Row(check=c, observed=o, bound=b, passed=p, severity="error") for c, o, b, p in rows]


def enforce(report: DataFrame | list, gate: str) -> list:
    """Collect the (small) report, or take its rows; raise naming every failing error check."""
    rows = report if isinstance(report, list) else report.collect()
    failing = [r for r in rows if not r["passed"] and r["severity"] == "error"]
    if failing:
        msg = "; ".join(f"{r['check']}: {'NULL' if r['observed'] is None else format(r['observed'], 'g')}"
                        f" not {r['bound']}" for r in failing)
        raise QualityGateFailed(f"{gate} failed: {msg}")
    return rows
