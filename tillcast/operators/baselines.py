"""Closed-form forecasts: structural (B1/B3), domain formula (M16), per-series
temperature regression (M17), seasonal naive (P10/J9)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillcast import functions as fn
from tillcast.horizon import DEFAULT, Horizon
from tillcast.operators import windows
from tillcast.operators.prep import TARGET, in_fit
from tillcast.schema import KEYS


def structural(f: DataFrame) -> Column:
    """Structural mean with the category fallback."""
    return F.coalesce(F.col("struct_rimdow"), F.col("struct_cmdow"))


def domain_forecast(f: DataFrame | None = None) -> Column:
    """Base x holiday x event x (1 + elasticity x temperature deviation)
    x store growth x promotion lift, clipped at 0 (the model-free formula chain)."""
    return fn.clip(domain_raw(), lo=0.0)


def domain_raw() -> Column:
    """The formula before the clip: a weather impact below -1 makes it negative."""
    base = F.coalesce(F.col("struct_rimdow"), F.col("struct_cmdow"))
    return (base * F.col("holiday_mult") * F.col("event_mult") * (F.lit(1.0) + F.col("weather_impact"))
            * F.col("store_growth_mult") * F.col("promo_lift_cat"))


def series_regression(p: DataFrame, x: str = "avg_temp_f", y: str = TARGET, keys=KEYS,
                      hz: Horizon = DEFAULT, name: str = "series_reg") -> DataFrame:
    """Per-series least-squares line of y on x over training rows, applied to every row.

    Window regression aggregates over the series partitioning — no join.
    """
    fit = in_fit(hz, y)
    w = Window.partitionBy(*keys)
    yy, xx = F.when(fit, F.col(y)), F.when(fit, F.col(x))
    slope = F.regr_slope(yy, xx).over(w)
    icpt = F.regr_intercept(yy, xx).over(w)
    return p.withColumns({f"{name}_slope": slope, f"{name}_intercept": icpt}) \
            .withColumn(name, F.col(f"{name}_intercept") + F.col(f"{name}_slope") * F.col(x))


def seasonal_naive(p: DataFrame, y: str = TARGET, days: int = 365, fallback: str = "struct_cmdow",
                   keys=KEYS, name: str = "seasonal_naive") -> DataFrame:
    """Value of the same series ``days`` earlier (calendar self-join), else ``fallback``."""
    out = windows.lags(p, y, [days], keys=keys, mode="calendar", prefix="__sn_")
    return out.withColumn(name, F.coalesce(F.col(f"__sn_{days}"), F.col(fallback))).drop(f"__sn_{days}")
