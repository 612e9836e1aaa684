"""Mergeable sketches next to exact aggregates: medians and distinct counts.

Exact paths never hold a column in one task and never copy a row per distinct set.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ACCURACY = 1000         # of the quantile sketch: rank error 1 / ACCURACY
FEW = 10_000            # distinct values of a bracket that the driver may read
LG_K = 12               # 2 ** LG_K registers: a relative standard error of about 1.6 %


def exact_median(df: DataFrame, col: str, few: int = FEW, accuracy: int = ACCURACY) -> float | None:
    """The interpolated median of the non-NULL values of ``col``; None without any.

    A mergeable quantile sketch brackets the two middle ranks, an exact count proves that the bracket holds them,
    and it narrows until it has ``few`` distinct values or less, whose counts give the answer.  Ties are counted,
    not listed, so a value that half of the rows share is one row.
    """
    x = df.where(F.col(col).isNotNull()).select(F.col(col).cast("double").alias("x"))
    n = x.count()
    if not n:
        return None
    low_rank, high_rank = (n - 1) // 2, n // 2      # from 0
    lo, hi, below = float("-inf"), float("inf"), 0
    while True:
        inside = x.where(F.col("x").between(lo, hi))
        rows = inside.groupBy("x").agg(F.count(F.lit(1)).alias("n")).limit(few + 1).collect()
        if len(rows) <= few:
            break
        m, slack = inside.count(), 2 / accuracy
        at = [max(0.0, (low_rank - below) / m - slack), min(1.0, (high_rank - below) / m + slack)]
        a, b = inside.agg(F.percentile_approx("x", at, accuracy).alias("q")).first()["q"]
        under, upto = x.agg(F.count_if(F.col("x") < a), F.count_if(F.col("x") <= b)).first()
        narrowed = lo, hi
        if under <= low_rank and a > lo:
            lo, below = a, under
        if upto > high_rank and b < hi:
            hi = b
        if (lo, hi) == narrowed:
            accuracy *= 10
    value, seen = {}, below
    for r in sorted(rows, key=lambda r: r["x"]):
        for k in (low_rank, high_rank):
            if seen <= k < seen + r["n"]:
                value[k] = r["x"]
        seen += r["n"]
    return (value[low_rank] + value[high_rank]) / 2


def distinct_exact(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row, a column for each of ``cols``: its distinct non-NULL values, each a group by of its own.

    Several ``count(DISTINCT ...)`` in one aggregate repeat every row once per column; this does not.
    """
    one = df.sparkSession.range(1)
    return one.select(*[df.select(c).distinct().agg(F.count(c)).scalar().alias(c) for c in cols])


def distinct_sketches(df: DataFrame, cols: Sequence[str], by: Sequence[str] = (), lg_k: int = LG_K) -> DataFrame:
    """by..., one HyperLogLog sketch (binary) for each of ``cols``, all in one pass; NULLs don't count."""
    return df.groupBy(*by).agg(*[F.hll_sketch_agg(F.col(c).cast("string"), F.lit(lg_k)).alias(c) for c in cols])


def distinct_estimates(sketches: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """by..., estimated distinct counts from sketches merged to the coarser grain ``by``."""
    return sketches.groupBy(*by).agg(*[F.hll_sketch_estimate(F.hll_union_agg(c)).alias(c) for c in cols])


def sketch_error(lg_k: int = LG_K) -> float:
    """Relative standard error of an estimate."""
    return 1.04 / (1 << lg_k) ** 0.5
