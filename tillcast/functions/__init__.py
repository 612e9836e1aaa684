"""NULL-preserving scalar column helpers (inventory X1-X14).

All helpers return ``Column`` expressions built from ``pyspark.sql.functions``
so they stay inside whole-stage codegen; none is a Python UDF.
"""

from __future__ import annotations

import datetime as _dt
import math

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(x) -> Column:
    if isinstance(x, Column):
        return x
    if isinstance(x, str):
        return F.col(x)
    return F.lit(x)


def clip(x: ColumnOrName, lo=None, hi=None) -> Column:
    """Bound ``x`` to [lo, hi]; NULL stays NULL (``greatest`` would not, T1)."""
    x = _c(x)
    out = x
    if lo is not None and hi is not None:
        return F.when(x < _c(lo), _c(lo)).when(x > _c(hi), _c(hi)).otherwise(x)
    if lo is not None:
        out = F.when(x < _c(lo), _c(lo)).otherwise(x)
    if hi is not None:
        out = F.when(x > _c(hi), _c(hi)).otherwise(x)
    return out


def safe_div(a: ColumnOrName, b: ColumnOrName) -> Column:
    """a / b, NULL when b is 0 or NULL (ANSI mode raises on plain ``/``, T3)."""
    return F.try_divide(_c(a).cast("double"), _c(b).cast("double"))


def safe_ratio(a: ColumnOrName, b: ColumnOrName, floor=None) -> Column:
    """Ratio with the denominator clipped from below (``b.clip(lower=floor)``)."""
    den = clip(b, lo=floor) if floor is not None else _c(b)
    return safe_div(a, den)


def flag(cond: Column) -> Column:
    """Boolean -> 0/1 int; a NULL comparison counts as False."""
    return F.coalesce(cond, F.lit(False)).cast("int")


def weekday_mon0(d: ColumnOrName) -> Column:
    """Day of week with Monday = 0."""
    return F.weekday(_c(d))


def nth_weekday(year: ColumnOrName, month: int, weekday: str, n: int) -> Column:
    """X11: date of the n-th ``weekday`` ('MON'..'SUN') of ``month`` in ``year``."""
    first = F.make_date(_c(year), F.lit(month), F.lit(1))
    first_hit = F.next_day(F.date_sub(first, 1), weekday)
    return F.date_add(first_hit, 7 * (n - 1))


def thanksgiving(year: ColumnOrName) -> Column:
    """Fourth Thursday of November, any year."""
    return nth_weekday(year, 11, "THU", 4)


def fixed_day(year: ColumnOrName, month: int, day: int) -> Column:
    return F.make_date(_c(year), F.lit(month), F.lit(day))


def days_between(d: ColumnOrName, ref: ColumnOrName) -> Column:
    """(d - ref) in days."""
    return F.datediff(_c(d), _c(ref))


def fourier_terms(doy: ColumnOrName, ks=(1, 2, 3), period: float = 365.25) -> dict[str, Column]:
    """sin/cos harmonics of 2*pi*k*doy/period, named sin_k / cos_k."""
    out = {}
    for k in ks:
        arg = F.lit(2 * math.pi * k) * _c(doy).cast("double") / F.lit(period)
        out[f"sin_{k}"] = F.sin(arg)
        out[f"cos_{k}"] = F.cos(arg)
    return out


def days_from_payday(day_of_month: ColumnOrName, paydays=(1, 15, 16)) -> Column:
    """Distance to the nearest payday in the same month (no wrap)."""
    d = _c(day_of_month)
    return F.least(*[F.abs(d - F.lit(p)) for p in paydays])


def date_text(d: ColumnOrName, fmt: str = "yyyy-MM-dd") -> Column:
    """X10."""
    return F.date_format(_c(d), fmt)


def temp_bin(t: ColumnOrName, edges=(0, 32, 50, 70, 120)) -> Column:
    """Right-closed bins ``(e_i, e_{i+1}]`` labelled like pandas; outside -> NULL."""
    t = _c(t)
    expr = None
    for lo, hi in zip(edges[:-1], edges[1:]):
        label = F.lit(f"({lo}, {hi}]")
        cond = (t > F.lit(lo)) & (t <= F.lit(hi))
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr


def date_spine(keys_df, start: _dt.date, end_inclusive: _dt.date, name: str = "date"):
    """One row per key row and calendar day (a generator, not a join)."""
    return keys_df.select(
        "*",
        F.explode(F.sequence(F.lit(start), F.lit(end_inclusive), F.expr("INTERVAL 1 DAY"))).alias(name),
    )


def nan_to_null(x: ColumnOrName) -> Column:
    """Spark orders NaN above every number; normalise to NULL at the source."""
    x = _c(x)
    return F.when(F.isnan(x), F.lit(None).cast("double")).otherwise(x)


__all__ = [
    "clip", "safe_div", "safe_ratio", "flag", "weekday_mon0", "nth_weekday", "thanksgiving",
    "fixed_day", "days_between", "fourier_terms", "days_from_payday", "date_text", "temp_bin",
    "date_spine", "nan_to_null",
]
