"""Offset and moving-frame windows over series.

All series expressions share one ``Window.partitionBy(store, item).orderBy(date)``
so Spark sorts once; on the series-partitioned panel there is no exchange.  A
series has at most one row per day, so no window group can outgrow the horizon.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillcast import functions as fn
from tillcast.schema import KEYS


def series_window(keys: Sequence[str] = KEYS, order: str = "date"):
    return Window.partitionBy(*keys).orderBy(order)


def lag_columns(x: str, ns: Sequence[int], keys: Sequence[str] = KEYS, order: str = "date",
                prefix: str = "lag_") -> dict[str, Column]:
    """W1 (row mode, T4): positional lags — equal to calendar lags on a complete panel."""
    w = series_window(keys, order)
    return {f"{prefix}{n}": F.lag(x, n).over(w) for n in ns}


def lags(p: DataFrame, x: str, ns: Sequence[int], keys: Sequence[str] = KEYS, order: str = "date",
         mode: str = "row", prefix: str = "lag_") -> DataFrame:
    """W1.  ``mode='calendar'``: value at exactly ``date - n`` days, NULL when that day has no row —
    correct on sparse panels.  One-day RANGE frames on the day number, so all lags share the one
    series sort and nothing is joined."""
    if mode == "row":
        return p.withColumns(lag_columns(x, ns, keys, order, prefix))
    if mode != "calendar":
        raise ValueError(mode)
    return p.withColumns(calendar_lag_columns(x, ns, keys, order, prefix))


def calendar_lag_columns(x: str, ns: Sequence[int], keys: Sequence[str] = KEYS, order: str = "date",
                         prefix: str = "lag_") -> dict[str, Column]:
    w = Window.partitionBy(*keys).orderBy(F.unix_date(order))
    return {f"{prefix}{n}": F.first(x).over(w.rangeBetween(-n, -n)) for n in ns}


def rolling_expr(x: str, n: int, fn_: str = "mean", min_periods: int = 1, shift: int = 0,
                 keys: Sequence[str] = KEYS, order: str = "date") -> Column:
    """``x.shift(shift).rolling(n, min_periods)`` — ``min_periods`` counts non-NULL values (T5)."""
    w = series_window(keys, order).rowsBetween(-(n - 1) - shift, -shift)
    agg = {"mean": F.avg, "std": F.stddev_samp, "sum": F.sum, "min": F.min, "max": F.max}[fn_]
    return F.when(F.count(x).over(w) >= min_periods, agg(x).over(w))


def rolling(p: DataFrame, x: str, n: int, fn_: str = "mean", min_periods: int = 1, shift: int = 0,
            name: str | None = None, keys: Sequence[str] = KEYS, order: str = "date") -> DataFrame:
    return p.withColumn(name or f"rolling_{fn_}_{n}", rolling_expr(x, n, fn_, min_periods, shift, keys, order))


def store_order_memory(p: DataFrame, x: str = "avg_temp_f", store: str = "store_id",
                       item: str = "item_id", order: str = "date") -> DataFrame:
    """B30 with parity semantics (T6): over rows ordered by (store, item, date) within a
    store, ``{x}_lag1`` = previous row's value (own value when none) and
    ``{x}_rolling3`` = mean of the last three rows (min 1).

    A window partitioned by store alone would put a whole store — possibly a
    third of all rows — into one task.  Instead: within-series lags (the shared
    series sort) plus, for the first two rows of each series, the tail of the
    preceding series in item order, taken from a per-series summary (one row
    per series; the item-order window runs over a store's series list only).
    """
    w = Window.partitionBy(store, item).orderBy(order)
    staged = p.withColumns({
        "__l1": F.lag(x, 1).over(w),
        "__l2": F.lag(x, 2).over(w),
        "__rn": F.row_number().over(w),
        "__last": F.lead(order, 1).over(w).isNull(),
    })
    tails = (staged.where("__last")
             .select(store, item, F.col(x).alias("__t1"), F.col("__l1").alias("__t2"), F.col("__rn").alias("__n")))
    wi = Window.partitionBy(store).orderBy(item)
    prev = tails.select(
        store, item,
        F.lag("__t1", 1).over(wi).alias("__b1"),
        F.when(F.lag("__n", 1).over(wi) >= 2, F.lag("__t2", 1).over(wi))
         .otherwise(F.lag("__t1", 2).over(wi)).alias("__b2"))
    j = staged.join(prev, [store, item], "left")
    rn = F.col("__rn")
    p1 = F.when(rn == 1, F.col("__b1")).otherwise(F.col("__l1"))
    p2 = F.when(rn == 1, F.col("__b2")).when(rn == 2, F.col("__b1")).otherwise(F.col("__l2"))
    cnt = F.col(x).isNotNull().cast("int") + p1.isNotNull().cast("int") + p2.isNotNull().cast("int")
    tot = F.coalesce(F.col(x), F.lit(0.0)) + F.coalesce(p1, F.lit(0.0)) + F.coalesce(p2, F.lit(0.0))
    return (j.withColumns({f"{x}_lag1": F.coalesce(p1, F.col(x)), f"{x}_rolling3": F.when(cnt > 0, tot / cnt)})
             .drop("__l1", "__l2", "__rn", "__last", "__b1", "__b2"))


def store_date_memory(p: DataFrame, x: str = "avg_temp_f", store: str = "store_id",
                      order: str = "date") -> DataFrame:
    """B30 option ``by='store_date'``: the same features on the store's daily series
    (distinct store, date) — the reading the feature names suggest."""
    daily = p.groupBy(store, order).agg(F.first(x).alias("__x"))
    w = Window.partitionBy(store).orderBy(order)
    daily = daily.select(store, order,
                         F.coalesce(F.lag("__x", 1).over(w), F.col("__x")).alias(f"{x}_lag1"),
                         F.avg("__x").over(w.rowsBetween(-2, 0)).alias(f"{x}_rolling3"))
    return p.join(daily, [store, order], "left")


def lag_null_audit(p: DataFrame, cols: Sequence[str], where: Column | None = None) -> DataFrame:
    """NULL rate of lag columns (e.g. in the test quarter, before/after gap fill)."""
    from tillcast.operators.prep import null_audit
    return null_audit(p, cols, where)


__all__ = ["series_window", "lag_columns", "lags", "calendar_lag_columns", "rolling_expr", "rolling", "store_order_memory",
           "store_date_memory", "lag_null_audit", "fn"]
