"""Target mask, imputation, slices, null audits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillcast.horizon import DEFAULT, Horizon
from tillcast.schema import DOW, KEYS

TARGET = "quantity_filled"


def in_fit(hz: Horizon = DEFAULT, target: str = TARGET) -> Column:
    """Training-row predicate: before the fit boundary with a known target."""
    return (F.col("date") < F.lit(hz.fit_end)) & F.col(target).isNotNull()


def mask_target(p: DataFrame, hz: Horizon = DEFAULT, y: str = "quantity", out: str = TARGET) -> DataFrame:
    """copy of the target that is NULL on and after the test start."""
    return p.withColumn(out, F.when(F.col("date") < F.lit(hz.test_start), F.col(y)))


def impute_group_mean(p: DataFrame, keys: Sequence[str] = (*KEYS, DOW), target: str = TARGET,
                      hz: Horizon = DEFAULT) -> DataFrame:
    """fill NULL training targets with the mean of their group's known training values.

    A window over ``keys`` instead of aggregate + join: on a panel already
    hash-partitioned by series key the window needs no exchange, only a sort,
    and a group (one weekday of one series) is bounded by the horizon length.
    """
    train = F.col("date") < F.lit(hz.test_start)
    known = F.col("date") < F.lit(hz.fit_end)
    fill = F.avg(F.when(known, F.col(target))).over(Window.partitionBy(*keys))
    return p.withColumn(target, F.when(F.col(target).isNull() & train, fill).otherwise(F.col(target)))


def prepare(p: DataFrame, hz: Horizon = DEFAULT) -> DataFrame:
    """F1 then F9 — the order the lag features depend on."""
    return impute_group_mean(mask_target(p, hz), hz=hz)


def train_slice(p: DataFrame, hz: Horizon = DEFAULT, target: str = TARGET) -> DataFrame:
    """rows before the fit boundary with a known target."""
    return p.where(in_fit(hz, target))


def season_slice(t: DataFrame, months: Sequence[int] | None = None, years=None,
                 before_year: int | None = None, hz: Horizon = DEFAULT) -> DataFrame:
    """season months, optionally one/several years or all years before one."""
    out = t.where(F.col("month").isin(list(months or hz.season_months)))
    if years is not None:
        out = out.where(F.col("year").isin(list(years) if isinstance(years, (list, tuple)) else [years]))
    if before_year is not None:
        out = out.where(F.col("year") < before_year)
    return out


def null_audit(p: DataFrame, cols: Sequence[str], where: Column | None = None,
               only_nonzero: bool = False) -> DataFrame:
    """Per column NULL count and rate, one aggregate pass, unpivoted.

    Returns (column, rows, nulls, null_rate).
    """
    src = p if where is None else p.where(where)
    aggs = [F.count(F.lit(1)).alias("__rows")]
    aggs += [F.count_if(F.col(c).isNull()).alias(f"__n_{i}") for i, c in enumerate(cols)]
    stats = src.agg(*aggs)
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"__n_{i}").alias("nulls"))
                      for i, c in enumerate(cols)])
    out = (stats.select(F.col("__rows").alias("rows"), F.explode(pairs).alias("x"))
                .select("x.column", "rows", "x.nulls",
                        F.try_divide(F.col("x.nulls").cast("double"), F.col("rows")).alias("null_rate")))
    if only_nonzero:
        out = out.where(F.col("nulls") > 0)
    return out
