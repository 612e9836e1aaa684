"""Grain aggregates and lookups.

Two ways to put a fitted aggregate back on the panel:

* series grains (keys contain store_id and item_id): a window aggregate over
  the series-partitioned panel — no join and no exchange, only a local sort;
* other grains: ``groupBy`` (partial + final aggregation) and a left join.  No
  broadcast hint: AQE broadcasts the aggregate only when its measured size is
  under ``spark.sql.adaptive.autoBroadcastJoinThreshold`` and keeps a shuffle
  join otherwise.

Scalars (global means) are attached with ``DataFrame.scalar()``: Spark runs the
one-row aggregate once as a subquery and inlines the value — no cross join.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillcast import functions as fn


def _keys(keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def not_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Spark keeps NULL groups (T11); lookups must not carry a NULL key."""
    cond = None
    for k in keys:
        c = F.col(k).isNotNull()
        cond = c if cond is None else cond & c
    return df.where(cond) if cond is not None else df


def group_agg(t: DataFrame, keys, **aggs: Column) -> DataFrame:
    """A4: named multi-aggregate by ``keys`` (NULL keys dropped)."""
    keys = _keys(keys)
    return not_null_keys(t, keys).groupBy(*keys).agg(*[c.alias(n) for n, c in aggs.items()])


def group_mean(t: DataFrame, keys, x: str, name: str) -> DataFrame:
    """A1."""
    return group_agg(t, keys, **{name: F.avg(x)})


def group_sum(t: DataFrame, keys, x: str, name: str) -> DataFrame:
    """A2."""
    return group_agg(t, keys, **{name: F.sum(x)})


def group_count(t: DataFrame, keys, name: str, x: str | None = None) -> DataFrame:
    """A3: row count, or non-NULL count of ``x``."""
    return group_agg(t, keys, **{name: F.count(F.lit(1)) if x is None else F.count(x)})


def scalar(t: DataFrame, expr: Column) -> Column:
    """A one-row aggregate as a scalar-subquery column."""
    return t.agg(expr).scalar()


def lookup_left(p: DataFrame, agg: DataFrame, keys, fills: Mapping[str, object] | None = None) -> DataFrame:
    """Left join of an aggregate on ``keys`` with per-column defaults.

    ``fills`` values may be constants, column names of ``p`` or Columns (T19).
    The aggregate must be unique on ``keys`` so the row count cannot change.
    """
    keys = _keys(keys)
    out = p.join(agg, keys, "left")
    if fills:
        out = out.withColumns({c: F.coalesce(F.col(c), v if isinstance(v, Column) else
                                              (F.col(v) if isinstance(v, str) else F.lit(v)))
                               for c, v in fills.items()})
    return out


def window_mean(keys, x: Column | str, where: Column | None = None) -> Column:
    """Series-grain mean as a window expression: avg over rows satisfying ``where``."""
    x = F.col(x) if isinstance(x, str) else x
    v = x if where is None else F.when(where, x)
    return F.avg(v).over(Window.partitionBy(*_keys(keys)))


def window_agg(fn_, keys, x: Column | str, where: Column | None = None) -> Column:
    x = F.col(x) if isinstance(x, str) else x
    v = x if where is None else F.when(where, x)
    return fn_(v).over(Window.partitionBy(*_keys(keys)))


def share_of_total(t: DataFrame, child_keys, parent_keys, x: str, name: str,
                   floor: float | None = 1.0) -> DataFrame:
    """Child sum / parent sum (denominator clipped at ``floor``).

    Two levels: the child aggregate is small, the parent total is a window sum
    over it, so no join is needed.  ``child_keys`` must contain ``parent_keys``.
    """
    child_keys, parent_keys = _keys(child_keys), _keys(parent_keys)
    child = group_sum(t, child_keys, x, "__child")
    parent = F.sum("__child").over(Window.partitionBy(*parent_keys))
    return child.select(*child_keys, fn.safe_ratio(F.col("__child"), parent, floor).alias(name))


def lift_vs_baseline(t: DataFrame, flag: str, x: str, name: str, by=None, level: str | None = None,
                     base_by=None, base_fallback: Column | None = None, positive_base: bool = False,
                     sum_col: str | None = None, cnt_col: str | None = None) -> DataFrame:
    """Mean of ``x`` on flagged rows (per ``level`` and ``by``) / mean on unflagged rows.

    The baseline is global, or per ``base_by`` (falling back to the global
    unflagged mean when a group has no unflagged rows).  With ``positive_base``
    the ratio exists only where the baseline is > 0.  ``sum_col``/``cnt_col``:
    ``t`` is pre-aggregated (sums and counts of ``x``); means are sum/count.
    """
    by = _keys(by) if by else []
    levels = ([level] if level else []) + by

    def mean():
        if sum_col:
            return fn.safe_div(F.sum(sum_col), F.sum(cnt_col))
        return F.avg(x)

    on = t.where(F.col(flag) == 1)
    num = group_agg(on, levels, __num=mean())
    glob = scalar(t.where(F.col(flag) == 0), mean())
    if base_by:
        base_by = _keys(base_by)
        base = group_agg(t.where(F.col(flag) == 0), base_by, __base=mean())
        num = num.join(base, base_by, "left").withColumn(
            "__base", F.coalesce(F.col("__base"), base_fallback if base_fallback is not None else glob))
    else:
        num = num.withColumn("__base", glob)
    ratio = fn.safe_div(F.col("__num"), F.col("__base"))
    if positive_base:
        num = num.where(F.col("__base") > 0)
    return num.select(*levels, ratio.alias(name))


def elasticity(t: DataFrame, by, x: str, y: str, name: str, min_rows: int = 100) -> DataFrame:
    """Least-squares slope of y on x divided by mean y; groups with > min_rows rows."""
    by = _keys(by)
    return (group_agg(t, by, __n=F.count(F.lit(1)), __slope=F.regr_slope(y, x), __mean=F.avg(y))
            .where(F.col("__n") > min_rows)
            .select(*by, fn.safe_div(F.col("__slope"), F.col("__mean")).alias(name)))


def first_per_key(df: DataFrame, key, order: Sequence[str], values: Sequence[str]) -> DataFrame:
    """First row per key under ``order`` (``drop_duplicates`` keeps the first, T13)."""
    key = _keys(key)
    picked = F.min_by(F.struct(*[F.col(v) for v in values]), F.struct(*[F.col(o) for o in order]))
    return df.groupBy(*key).agg(picked.alias("__v")).select(*key, *[F.col(f"__v.{v}").alias(v) for v in values])


def quantile_edges(df: DataFrame, x: str, q: int = 3, approx: bool = False, accuracy: int = 100000) -> Column:
    """Interpolated quantile edges as an array scalar.

    Exact ``percentile`` keeps one count per distinct value, so its state is
    bounded by the column's cardinality (prices: the item catalog).  For
    high-cardinality columns pass ``approx=True`` (bounded sketch).
    """
    probs = F.array(*[F.lit(i / q) for i in range(1, q)])
    agg = F.percentile_approx(x, probs, accuracy) if approx else F.percentile(F.col(x), probs)
    return df.agg(agg).scalar()


def quantile_bins(df: DataFrame, x: str, name: str, q: int = 3, approx: bool = False,
                  edges_from: DataFrame | None = None) -> DataFrame:
    """Right-closed bins on global quantile edges, labels 0..q-1.

    ``edges_from``: a cheaper frame with the same rows of ``x`` to take the edges from.
    """
    edges = quantile_edges(edges_from if edges_from is not None else df, x, q, approx)
    expr = None
    for i in range(q - 1):
        cond = F.col(x) <= F.element_at(edges, i + 1)
        expr = F.when(cond, F.lit(i)) if expr is None else expr.when(cond, F.lit(i))
    return df.withColumn(name, expr.otherwise(F.lit(q - 1)))


def pivot_deviation(t: DataFrame, row: str, col: str, x: str, values: Sequence[str]) -> DataFrame:
    """Pivot mean(x) by (row, col) and express each cell as % deviation from the row mean."""
    piv = t.where(F.col(col).isNotNull()).groupBy(row).pivot(col, list(values)).agg(F.avg(x))
    cells = [F.col(f"`{v}`") for v in values]
    n = sum((F.when(c.isNotNull(), 1).otherwise(0) for c in cells), F.lit(0))
    s = sum((F.coalesce(c, F.lit(0.0)) for c in cells), F.lit(0.0))
    mean = fn.safe_div(s, n)
    return piv.select(row, *[((fn.safe_div(F.col(f"`{v}`"), mean) - 1) * 100).alias(v) for v in values])


def monthly_mean(p: DataFrame, x: str = "quantity", name: str = "mean_qty") -> DataFrame:
    """Resample to month start and average."""
    return (p.groupBy(F.trunc("date", "month").alias("month_start"))
             .agg(F.avg(x).alias(name)))


def geo_mean(cols: Sequence[Column]) -> Column:
    """Geometric mean of a few rate columns (``(r1*r2*...)**(1/n)``)."""
    prod = cols[0]
    for c in cols[1:]:
        prod = prod * c
    return F.pow(prod, F.lit(1.0 / len(cols)))


def attach_attrs(preds: DataFrame, p: DataFrame, keys: Sequence[str] = ("date", "store_id", "item_id"),
                 attrs: Sequence[str] = ("category", "month")) -> DataFrame:
    """Re-attach attributes to predictions on the full key, the right side made
    distinct on the key first so the join can never fan out."""
    keys = list(keys)
    right = p.select(*keys, *attrs).dropDuplicates(keys)
    return preds.join(right, keys, "left")
