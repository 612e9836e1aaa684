"""Splits, weights, blend-weight grid, blending, bias correction, run comparison."""

from __future__ import annotations

from collections.abc import Sequence
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillcast import functions as fn
from tillcast.horizon import DEFAULT, Horizon
from tillcast.operators.metrics import wmape_expr
from tillcast.operators.prep import TARGET

# fixed values: blend weights of a group for which the search finds no point below a wMAPE of 1
DEFAULT_WEIGHTS = (0.33, 0.33, 0.34)
SPLITS = ("train1", "val", "train2", "test")


def split_predicates(hz: Horizon = DEFAULT, target: str = TARGET) -> dict[str, Column]:
    """M1: train1 / val / train2 (= train1 + val + gap) / test, as row predicates."""
    d, known = F.col("date"), F.col(target).isNotNull()
    return {
        "train1": (d < F.lit(hz.val_start)) & known,
        "val": (d >= F.lit(hz.val_start)) & (d <= F.lit(hz.val_end)) & known,
        "train2": (d < F.lit(hz.test_start)) & known,
        "test": d >= F.lit(hz.test_start),
    }


def temporal_split(p: DataFrame, hz: Horizon = DEFAULT, target: str = TARGET) -> dict[str, DataFrame]:
    return {k: p.where(v) for k, v in split_predicates(hz, target).items()}


def split_summary(p: DataFrame, hz: Horizon = DEFAULT, target: str = TARGET) -> DataFrame:
    """Rows and date range per split from one pass (conditional aggregates, unpivoted)."""
    preds = split_predicates(hz, target)
    aggs = []
    for k, c in preds.items():
        aggs += [F.count_if(c).alias(f"{k}__n"), F.min(F.when(c, F.col("date"))).alias(f"{k}__lo"),
                 F.max(F.when(c, F.col("date"))).alias(f"{k}__hi")]
    wide = p.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(k).alias("split"), F.col(f"{k}__n").alias("rows"),
                              F.col(f"{k}__lo").alias("first_date"), F.col(f"{k}__hi").alias("last_date"))
                     for k in preds])
    return wide.select(F.explode(rows).alias("s")).select("s.*")


def volume_weight(struct_col: str = "struct_rimdow", floor: float = 1.0) -> Column:
    """M2: sample weight = structural mean clipped below at 1 (NULL stays NULL)."""
    return fn.clip(struct_col, lo=floor)


def weight_grid(step: str = "0.05", lo: str = "0.10", cap: str = "0.80",
                extra: Sequence[tuple[str, str]] = (("0.10", "0.70"),)) -> list[tuple[int, float, float, float]]:
    """M8 grid: w1, w2 on ``lo + k*step`` with w1 + w2 < cap, w3 = 1 - w1 - w2.

    Generated from integers (exact), plus ``extra`` points; ids follow the
    search order (w1 outer, w2 inner ascending) so ties keep the first point.
    With the defaults: 78 exact points + (0.10, 0.70) = 79.  ``step='0.02',
    lo='0.05', cap='0.85', extra=()`` gives 741.
    """
    st, l0, cp = Fraction(step), Fraction(lo), Fraction(cap)
    pts = set()
    k = 0
    while l0 + k * st < cp:
        j = 0
        while (l0 + k * st) + (l0 + j * st) < cp:
            pts.add((l0 + k * st, l0 + j * st))
            j += 1
        k += 1
    pts |= {(Fraction(a), Fraction(b)) for a, b in extra}
    out = []
    for gid, (a, b) in enumerate(sorted(pts)):
        out.append((gid, float(a), float(b), float(1 - a - b)))
    return out


BLOCK_ROWS = 4096


def grid_scores(preds: DataFrame, members: Sequence[str], y: str = TARGET, by=("store_id",),
                grid=None, positive_only: bool = True) -> DataFrame:
    """M8: wMAPE of every grid point per group: (by..., grid_id, w1, w2, w3, wmape).

    A vector-valued aggregate: each task blends its rows with all grid points as one matrix product per block of
    rows and keeps, per group, one vector of absolute errors and the total of y (the map side of the aggregate).
    Only those vectors are taken apart and summed by (group, point); no prediction row is repeated.
    A missing prediction makes the group's errors unknown, as in ``wmape_expr``.
    """
    grid = grid or weight_grid()
    by = [by] if isinstance(by, str) else list(by)
    weights = np.array([g[1:] for g in grid], float).T
    used = F.col(y) > 0 if positive_only else F.col(y).isNotNull()
    src = preds.where(used).select(*by, F.col(y).cast("double").alias("__y"),
                                   *[F.col(m).cast("double").alias(f"__m{i}") for i, m in enumerate(members)])
    keys = src.select(*by).schema.fields
    schema = T.StructType([*keys, T.StructField("__t", T.DoubleType()), T.StructField("__e", T.ArrayType(T.DoubleType()))])

    def partial(batches):
        acc: dict = {}
        for pdf in batches:
            for key, g in pdf.groupby(by, sort=False, dropna=False):
                key = tuple(None if pd.isna(k) else k for k in key)
                total, errors = acc.get(key, (0.0, np.zeros(weights.shape[1])))
                yv, m = g["__y"].to_numpy(float), g[[f"__m{i}" for i in range(len(members))]].to_numpy(float)
                for lo in range(0, len(g), BLOCK_ROWS):
                    errors = errors + np.abs(yv[lo:lo + BLOCK_ROWS, None] - m[lo:lo + BLOCK_ROWS] @ weights).sum(0)
                acc[key] = (total + float(yv.sum()), errors)
        if acc:
            out = pd.DataFrame(list(acc), columns=by, dtype=object)
            out["__t"], out["__e"] = [t for t, _ in acc.values()], [e for _, e in acc.values()]
            yield out

    parts = src.mapInPandas(partial, schema)
    points = F.array(*[F.struct(F.lit(g).alias("grid_id"), F.lit(a).alias("w1"), F.lit(b).alias("w2"),
                                F.lit(c).alias("w3")) for g, a, b, c in grid])
    summed = (parts.select(*by, "__t", F.posexplode("__e").alias("__i", "__v"))
                   .groupBy(*by, "__i").agg(F.sum("__t").alias("__t"), F.sum("__v").alias("__v")))
    point = F.element_at(points, F.col("__i") + 1)
    error = F.when(~F.isnan("__v"), F.col("__v"))
    return (summed.withColumn("__g", point)
                  .select(*by, "__g.*", F.when(F.col("__t") != 0, error / F.col("__t")).alias("wmape")))


def blend_grid(preds: DataFrame, members: Sequence[str], y: str = TARGET, by=("store_id",),
               grid=None, positive_only: bool = True) -> DataFrame:
    """M8/K5: per group, the grid point with the lowest wMAPE (first point wins ties).

    Returns (by..., grid_id, w1, w2, w3, wmape).  A group whose best point is not
    below 1.0 gets ``DEFAULT_WEIGHTS`` and no grid_id.
    """
    return best_points(grid_scores(preds, members, y, by, grid, positive_only), by)


def best_points(scored: DataFrame, by=("store_id",)) -> DataFrame:
    """K5: the best point of each group of ``grid_scores``."""
    by = [by] if isinstance(by, str) else list(by)
    best = F.min_by(F.struct("grid_id", "w1", "w2", "w3", "wmape"),
                    F.struct(F.round(F.coalesce("wmape", F.lit(float("inf"))), 12), F.col("grid_id")))
    won = F.col("b.wmape") < 1.0
    return scored.groupBy(*by).agg(best.alias("b")).select(
        *by, F.when(won, F.col("b.grid_id")).alias("grid_id"),
        *[F.when(won, F.col(f"b.w{i}")).otherwise(F.lit(w)).alias(f"w{i}") for i, w in enumerate(DEFAULT_WEIGHTS, 1)],
        F.col("b.wmape").alias("wmape"))


def blend(preds: DataFrame, weights: DataFrame, members: Sequence[str], by=("store_id",),
          name: str = "ensemble") -> DataFrame:
    """M9: join the chosen weights (``DEFAULT_WEIGHTS`` for groups without any) and form the weighted sum."""
    by = [by] if isinstance(by, str) else list(by)
    m1, m2, m3 = members
    w = weights.select(*by, "w1", "w2", "w3")
    own = {f"w{i}": F.coalesce(F.col(f"w{i}"), F.lit(d)) for i, d in enumerate(DEFAULT_WEIGHTS, 1)}
    return (preds.join(w, by, "left").withColumns(own)
                 .withColumn(name, F.col("w1") * F.col(m1) + F.col("w2") * F.col(m2) + F.col("w3") * F.col(m3)))


def bias_factors(val_preds: DataFrame, y: str = TARGET, yhat: str = "ensemble", by=("store_id",)) -> DataFrame:
    """mean(y) / mean(yhat) on validation rows per group; 1 when mean(yhat) <= 0."""
    by = [by] if isinstance(by, str) else list(by)
    g = val_preds.groupBy(*by).agg(F.avg(y).alias("__my"), F.avg(yhat).alias("__mp"))
    return g.select(*by, F.when(F.col("__mp") > 0, fn.safe_div("__my", "__mp")).otherwise(F.lit(1.0)).alias("bias"))


def bias_correct(preds: DataFrame, factors: DataFrame, yhat: str = "ensemble", out: str = "predicted",
                 by=("store_id",)) -> DataFrame:
    by = [by] if isinstance(by, str) else list(by)
    return (preds.join(factors, by, "left")
                 .withColumn(out, F.col(yhat) * F.coalesce(F.col("bias"), F.lit(1.0))))


def global_bias(preds: DataFrame, val: Column, y: str = TARGET, yhat: str = "ensemble", out: str = "predicted") -> DataFrame:
    """M10, one factor for all groups: mean(y) / mean(yhat) on the validation rows, 1 when mean(yhat) <= 0."""
    mean_y, mean_p = F.avg(F.when(val, F.col(y))), F.avg(F.when(val, F.col(yhat)))
    factor = preds.agg(F.when(mean_p > 0, mean_y / mean_p).otherwise(F.lit(1.0))).scalar()
    return preds.withColumns({"bias": factor, out: F.col(yhat) * factor})


def clip_predictions(df: DataFrame, col: str = "predicted") -> DataFrame:
    """Non-negative predictions."""
    return df.withColumn(col, fn.clip(col, lo=0.0))


def clip_report(df: DataFrame, raw: str = "raw_prediction") -> DataFrame:
    """Distribution before/after the non-negative clip and the clipped count.

    The median is exact without one task that holds the column: see ``sketch.exact_median``.
    """
    from tillcast.operators.sketch import exact_median
    clipped = fn.clip(raw, lo=0.0)
    median = exact_median(df.select(clipped.alias("__c")), "__c")
    return df.agg(F.min(raw).alias("min_raw"), F.avg(raw).alias("mean_raw"), F.avg(clipped).alias("mean_clipped"),
                  F.lit(median).cast("double").alias("median"), F.max(clipped).alias("max"),
                  F.count_if(F.col(raw) < 0).alias("clipped_rows"))


def compare_runs(metrics: DataFrame, run_col: str = "run", order_col: str = "step",
                 value: str = "wmape", by=("split",)) -> DataFrame:
    """M15/M14 delta: change vs the previous run (percentage points)."""
    by = [by] if isinstance(by, str) else list(by)
    w = Window.partitionBy(*by).orderBy(order_col)
    return metrics.withColumn("delta_pp", (F.col(value) - F.lag(value).over(w)) * 100)
