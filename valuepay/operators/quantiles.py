"""Exact order statistics at any scale (A13 quantileExact, A14 median, W1).

``exact_quantiles`` works like ``DataFrame.approxQuantile`` (it returns Python
values to the driver) but the answer is exact. One path serves every size, and no
task ever receives the column:

1. one aggregate finds the number of values, the smallest and the largest;
2. the bracket that holds a wanted rank is cut into equal buckets, and one hash
   aggregate on the bucket number takes each bucket's count, smallest and largest
   value. Partial evaluation leaves each task a few thousand rows of fixed width
   at most, so a value held by a third of all rows costs nothing extra;
3. the counts name the bucket that holds the rank; its smallest and largest value
   are the next bracket. When they are equal, that is the answer.

A bracket's ends always fall in different buckets, and a pass divides a bracket's width by the number of
buckets. Width is counted in values of the type: decimals and integers by themselves, floating-point
numbers by their bit patterns, which are integers in the same order. So the number of passes is bounded by
the type (six for doubles, twelve for 38 digits, with 2,048 buckets), whatever the values. NaN is the largest
value, as in Spark's order, and counted apart. Only bucket rows reach the driver.
"""

from __future__ import annotations

import math
import struct
from collections.abc import Iterable, Sequence
from decimal import Decimal
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKETS = 2048


def quantile_rank(p: float, n: int) -> int:
    """Zero-based rank of quantileExact(p): floor(p*n) in double arithmetic, clamped."""
    return min(max(int(math.floor(float(p) * n)), 0), n - 1)


def median_ranks(n: int) -> tuple[int, int]:
    """Ranks of the two middle values (equal when n is odd)."""
    return (n - 1) // 2, n // 2


LARGEST = 2047 << 52  # bits of an infinite double


def ordered_bits(x: Column) -> Column:
    """An integer for every double but NaN, in the order of the doubles: the bits of its magnitude, negated where
    it is negative; both zeros are 0. Made from its exponent and fraction, exactly: only powers of two divide."""
    a = F.abs(x.cast("double"))
    two = F.lit(2.0)
    # the logarithm may round up or down to the next power
    guess = F.greatest(F.least(F.floor(F.log2(a)), F.lit(1023)), F.lit(-1022))
    part = a / F.pow(two, guess)
    exponent = F.when(part >= 2, guess + 1).when((part < 1) & (guess > -1022), guess - 1).otherwise(guess)
    part = a / F.pow(two, exponent)
    fraction = F.lit(float(1 << 52))
    bits = (F.when(a == 0, F.lit(0).cast("long")).when(a == F.lit(math.inf), F.lit(LARGEST))
            .when(part < 1, (part * fraction).cast("long"))                 # subnormal
            .otherwise((exponent + 1023) * F.lit(1 << 52) + ((part - 1) * fraction).cast("long")))
    return F.when(x < 0, -bits).otherwise(bits)


def _bits_of(v: float) -> int:
    bits = struct.unpack("<q", struct.pack("<d", v))[0]
    return bits if bits >= 0 else -(bits & (1 << 63) - 1)


def _bucket(k: Column, lo: Any, hi: Any, buckets: int) -> Column:
    """Bucket number of a key in ``[lo, hi]``, never falling as the key grows; the ends are settled first."""
    low, high = F.lit(lo), F.lit(hi)
    part = (k - low).cast("double") / (high - low).cast("double")       # the differences are exact
    inner = F.least(F.floor(part * buckets), F.lit(buckets - 1))
    return F.when(k == low, 0).when(k == high, buckets - 1).otherwise(inner).cast("int")


def order_statistics(df: DataFrame, col: str, ranks: Iterable[int], *, buckets: int = BUCKETS) -> dict[int, Any]:
    """Exact values at the given zero-based ranks of the non-null values of ``col``."""
    return _select(df, col, lambda n: ranks, buckets)[1]


def _select(df: DataFrame, col: str, ranks_of, buckets: int) -> tuple[int, dict[int, Any]]:
    """The number of non-null values, and the values at the ranks that ``ranks_of`` names for it."""
    x = F.col("x")
    vals = df.select(F.col(col).alias("x")).where(x.isNotNull())
    floating = isinstance(vals.schema["x"].dataType, T.FractionalType) and not isinstance(vals.schema["x"].dataType, T.DecimalType)
    nan = F.isnan(x) if floating else F.lit(False)
    ends = vals.agg(F.count(x).alias("n"), F.count_if(nan).alias("nan"), F.min(F.when(~nan, x)).alias("lo"),
                    F.max(F.when(~nan, x)).alias("hi")).first()
    n = ends["n"]
    wanted = sorted({int(r) for r in ranks_of(n)}) if n else []
    if any(r < 0 or r >= n for r in wanted):
        raise ValueError(f"ranks {wanted} outside 0..{n - 1}")
    whole = T.DecimalType(20, 0)   # differences of two keys exceed 64 bits
    if floating:
        vals = vals.where(~nan).withColumn("k", ordered_bits(x).cast(whole))
    else:
        integral = isinstance(vals.schema["x"].dataType, T.IntegralType)
        vals = vals.withColumn("k", x.cast(whole) if integral else x)
    k = F.col("k")

    def key_of(v: Any) -> Any:
        return Decimal(_bits_of(float(v))) if floating else Decimal(v) if isinstance(v, int) else v

    found: dict[int, Any] = {r: math.nan for r in wanted if r >= n - ends["nan"]}
    wanted = [r for r in wanted if r not in found]
    # bracket (smallest, largest value) -> number of values before it, ranks wanted inside
    open_ = {(ends["lo"], ends["hi"]): (0, wanted)} if wanted else {}
    while open_:
        for (lo, hi), (_, inside) in list(open_.items()):
            if lo == hi:
                found.update(dict.fromkeys(inside, lo))
                del open_[lo, hi]
        if not open_:
            break
        brackets = list(open_)
        tag = bucket = None
        for i, (lo, hi) in enumerate(brackets):      # brackets do not overlap
            lo, hi = key_of(lo), key_of(hi)
            here = (k >= F.lit(lo)) & (k <= F.lit(hi))
            tag = F.when(here, i) if tag is None else tag.when(here, i)
            number = _bucket(k, lo, hi, buckets)
            bucket = F.when(here, number) if bucket is None else bucket.when(here, number)
        rows = (vals.select(x, k, tag.alias("bracket"), bucket.alias("bucket")).where("bracket IS NOT NULL")
                .groupBy("bracket", "bucket").agg(F.count(x).alias("c"), F.min(x).alias("lo"), F.max(x).alias("hi"))
                .collect())
        following = {}
        for i, key in enumerate(brackets):
            before, inside = open_[key]
            for r in sorted((r for r in rows if r["bracket"] == i), key=lambda r: r["bucket"]):
                here = [k for k in inside if before <= k < before + r["c"]]
                if here:
                    following[r["lo"], r["hi"]] = (before, here)
                before += r["c"]
        open_ = following
    return n, found


def exact_quantiles(df: DataFrame, col: str, probs: Sequence[float] = (), *, median: bool = False,
                    buckets: int = BUCKETS) -> dict[str, Any]:
    """quantileExact(p) for each p (value at rank floor(p*n)) and, if asked, the exact
    interpolated median. Returns ``{"n": n, p: value, ..., "median": float}``;
    values are None when the column has no non-null value."""
    def ranks(n: int) -> list[int]:
        return [*(quantile_rank(p, n) for p in probs), *(median_ranks(n) if median else ())]

    n, stats = _select(df, col, ranks, buckets)
    out: dict[str, Any] = {"n": n}
    if n == 0:
        out.update({p: None for p in probs})
        if median:
            out["median"] = None
        return out
    out.update({p: stats[quantile_rank(p, n)] for p in probs})
    if median:
        lo, hi = (float(stats[r]) for r in median_ranks(n))
        out["median"] = lo + 0.5 * (hi - lo)
    return out
