"""Uplift scenario sweep (U1): the what-if calculation over a grid of adoption and
capture rates, computed from the uplift mart rather than from frozen numbers.

Each segment row expands into the grid with ``explode(sequence(...))`` (no join),
then one aggregation per grid point sums the segments. The baseline (adoption
30 %, full capture) is summed inside the same group, so no second pass is needed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from valuepay.functions.scalars import floor_zero, round_money
from valuepay.schemas import UPLIFT_ADOPTION


def uplift_scenarios(uplift: DataFrame, adoption_step: int = 1, capture_step: int = 5) -> DataFrame:
    """One row per (adoption %, capture %): projected uplift, addressable orders adopting,
    and the uplift as a percentage of the baseline scenario."""
    orders = F.col("addressable_orders").cast("double")
    gap = floor_zero(F.col("aov_gap"))
    grid = uplift.select(
        orders.alias("orders"), gap.alias("gap"),
        F.explode(F.sequence(F.lit(0), F.lit(100), F.lit(adoption_step))).alias("adoption_pct"),
    ).select("*", F.explode(F.sequence(F.lit(0), F.lit(100), F.lit(capture_step))).alias("capture_pct"))
    a = F.col("adoption_pct").cast("double") / 100
    c = F.col("capture_pct").cast("double") / 100
    per_segment = grid.select(
        "adoption_pct", "capture_pct",
        (F.col("orders") * a * F.col("gap") * c).alias("uplift"),
        F.round(F.col("orders") * a, 0).cast("bigint").alias("orders_adopting"),
        (F.col("orders") * F.lit(UPLIFT_ADOPTION) * F.col("gap")).alias("baseline"),
    )
    agg = per_segment.groupBy("adoption_pct", "capture_pct").agg(
        F.sum("uplift").alias("_uplift"),
        F.sum("orders_adopting").alias("addressable_orders"),
        F.sum("baseline").alias("_baseline"),
    )
    return agg.select(
        F.col("adoption_pct").cast("bigint").alias("adoption_pct"),
        F.col("capture_pct").cast("bigint").alias("capture_pct"),
        round_money("_uplift", 0).alias("projected_uplift"),
        "addressable_orders",
        round_money(F.when(F.col("_baseline") > 0, F.col("_uplift") / F.col("_baseline") * 100)
                    .otherwise(F.lit(0.0)), 0).alias("pct_of_baseline"),
    )


def uplift_at(uplift: DataFrame, adoption_pct: float, capture_pct: float) -> DataFrame:
    """One scenario, per segment (the page's bars): projected uplift and orders adopting."""
    a, c = float(adoption_pct) / 100, float(capture_pct) / 100
    orders = F.col("addressable_orders").cast("double")
    return uplift.select(
        "value_segment",
        round_money(orders * F.lit(a) * floor_zero(F.col("aov_gap")) * F.lit(c), 0).alias("projected_uplift"),
        F.round(orders * F.lit(a), 0).cast("bigint").alias("orders_adopting"),
    )
