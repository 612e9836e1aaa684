"""R1-R12 analytic reports, U2 coverage, A17/A18 correlation reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillcast import functions as fn
from tillcast.horizon import DEFAULT, Horizon
from tillcast.operators import grain

S, I = "store_id", "item_id"
TEMP_EDGES = (0, 32, 50, 70, 120)   # fixed value: right-closed temperature bins (°F)


def dataset_profile(p: DataFrame, y: str = "quantity") -> DataFrame:
    """Rows, date range, distinct stores/items/categories, target NULL count and rate."""
    one = p.agg(F.count(F.lit(1)).alias("rows"), F.min("date").alias("first_date"), F.max("date").alias("last_date"),
                F.count_if(F.col(y).isNull()).alias("null_qty"),
                F.avg(F.col(y).isNull().cast("double")).alias("null_rate"))
    levels = {n: p.select(c).distinct().agg(F.count(c)).scalar() for n, c in (("stores", S), ("items", I), ("categories", "category"))}
    return one.withColumns(levels).select("rows", "first_date", "last_date", "stores", "items", "categories", "null_qty", "null_rate")


def category_share(p: DataFrame, where: Column | None = None, y: str = "quantity") -> DataFrame:
    """Category volume and % share (of the rows selected by ``where``)."""
    src = p if where is None else p.where(where)
    total = grain.scalar(src, F.sum(y))
    g = src.groupBy("category").agg(F.sum(y).alias("volume"))
    return g.withColumn("share_pct", fn.safe_div(F.col("volume"), total) * 100)


def temperature_sensitivity(p: DataFrame, y: str = "quantity", edges=TEMP_EDGES) -> DataFrame:
    """Category x temperature bin mean, as % deviation from the category's mean over bins."""
    labels = [f"({lo}, {hi}]" for lo, hi in zip(edges[:-1], edges[1:])]
    return grain.pivot_deviation(p.withColumn("temp_bin", fn.temp_bin("avg_temp_f", edges)), "category",
                                 "temp_bin", y, labels)


def holiday_impact(p: DataFrame, names: Sequence[str] | None = None, y: str = "quantity",
                   where: Column | None = None) -> DataFrame:
    """Per holiday, % difference of its mean from the non-holiday mean (all rows, T28).

    ``names`` (F6 IN-list) and ``where`` (e.g. a name ``contains`` test, X12)
    select holidays; the baseline always uses every non-holiday row.
    """
    base = grain.scalar(p.where(F.col("is_holiday") == 0), F.avg(y))
    src = p.where((F.col("is_holiday") == 1) & F.col("holiday_name").isNotNull())
    if names:
        src = src.where(F.col("holiday_name").isin(list(names)))
    if where is not None:
        src = src.where(where)
    g = src.groupBy("holiday_name").agg(F.avg(y).alias("mean_qty"))
    return g.withColumn("impact_pct", (fn.safe_div(F.col("mean_qty"), base) - 1) * 100)


def event_lift(t: DataFrame, y: str = "quantity_filled") -> DataFrame:
    """Per event on training rows: mean, distinct days, lift % over the non-event mean."""
    base = grain.scalar(t.where(F.col("is_special_event") == 0), F.avg(y))
    g = (t.where((F.col("is_special_event") == 1) & F.col("special_event_name").isNotNull())
          .groupBy("special_event_name")
          .agg(F.avg(y).alias("mean_qty"), F.count_distinct("date").alias("days")))
    return g.withColumn("lift_pct", (fn.safe_div(F.col("mean_qty"), base) - 1) * 100).orderBy(F.desc("lift_pct"))


def unseen_levels(p: DataFrame, cols, hz: Horizon = DEFAULT) -> DataFrame:
    """Levels of a column, or combinations of columns, of the test period that never occur before it (anti join)."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    known = F.lit(True)
    for c in cols:
        known = known & F.col(c).isNotNull()
    test = p.where((F.col("date") >= F.lit(hz.test_start)) & known).select(*cols).distinct()
    train = p.where((F.col("date") < F.lit(hz.test_start)) & known).select(*cols).distinct()
    return test.join(train, cols, "left_anti")


def event_coverage(f: DataFrame, hz: Horizon = DEFAULT) -> DataFrame:
    """Events of the test period with their fitted multiplier, test days and whether seen in training."""
    test = f.where((F.col("date") >= F.lit(hz.test_start)) & F.col("special_event_name").isNotNull())
    g = test.groupBy("special_event_name").agg(F.max("event_mult").alias("event_mult"),
                                               F.count_distinct("date").alias("test_days"))
    unseen = unseen_levels(f, "special_event_name", hz).withColumn("__unseen", F.lit(True))
    return (g.join(unseen, "special_event_name", "left")
             .select("special_event_name", "event_mult", "test_days",
                     F.coalesce("__unseen", F.lit(False)).alias("unseen_in_training")))


def importance_by_layer(imp: DataFrame, layers: dict[str, Sequence[str]]) -> DataFrame:
    """Feature importance summed by layer, a layer being a set of name prefixes."""
    expr = None
    for layer, prefixes in layers.items():
        cond = None
        for pre in prefixes:
            c = F.col("feature").startswith(pre)
            cond = c if cond is None else cond | c
        expr = F.when(cond, F.lit(layer)) if expr is None else expr.when(cond, F.lit(layer))
    return (imp.withColumn("layer", expr.otherwise(F.lit("other")))
               .groupBy("layer").agg(F.sum("importance").alias("importance")))


def sample_series(preds: DataFrame, store: str | None = None, item: str | None = None,
                  y: str = "quantity", yhat: str = "predicted") -> DataFrame:
    """One series' actual vs predicted by date (default: the first series in
    (store, item) order)."""
    if store is None or item is None:
        first = preds.agg(F.min(F.struct(S, I)).alias("k")).scalar()
        cond = F.struct(S, I) == first
    else:
        cond = (F.col(S) == store) & (F.col(I) == item)
    return preds.where(cond).select("date", S, I, y, yhat).orderBy("date")


def elasticity_ranking(t: DataFrame, y: str = "quantity_filled", min_rows: int = 100) -> DataFrame:
    """Temperature elasticity per category as % change per +10 °F, sorted."""
    el = grain.elasticity(t, "category", "avg_temp_f", y, "elasticity", min_rows)
    return el.withColumn("pct_per_10f", F.col("elasticity") * 1000).orderBy(F.desc("pct_per_10f"))


def store_cagr_top(t: DataFrame, hz: Horizon = DEFAULT, k: int = 5, y: str = "quantity_filled") -> DataFrame:
    """Top-k stores by growth multiplier (a top-k report: the limit is the feature)."""
    from tillcast.operators.features import store_growth
    g = store_growth(t, hz, y)
    return g.orderBy(F.desc("store_growth_mult"), F.asc(S)).limit(k)


def promo_ranking(t: DataFrame, y: str = "quantity_filled") -> DataFrame:
    """Promotion lift % per category, sorted."""
    g = t.groupBy("category").agg(F.avg(F.when(F.col("is_promotion") == 1, F.col(y))).alias("__on"),
                                  F.avg(F.when(F.col("is_promotion") == 0, F.col(y))).alias("__off"))
    return (g.where(F.col("__off") > 0)
             .select("category", ((F.col("__on") / F.col("__off") - 1) * 100).alias("promo_lift_pct"))
             .orderBy(F.desc("promo_lift_pct")))


def member_vs_rest_corr(p: DataFrame, member: str, group: str, y: str = "quantity", on: str = "date") -> DataFrame:
    """A17 (re-aimed): correlation of each member's daily series with the rest of its group.

    Stores within a city or items within a category: the group total minus the
    member (leave-one-out) per day, then ``corr`` per member.  O(rows) — no
    pair of members is ever formed.
    """
    daily = p.groupBy(group, member, on).agg(F.sum(y).alias("__own"))
    tot = F.sum("__own").over(Window.partitionBy(group, on))
    d = daily.withColumn("__rest", tot - F.col("__own"))
    return d.groupBy(group, member).agg(F.corr("__own", "__rest").alias("corr_vs_rest"),
                                        F.count(F.lit(1)).alias("days"))


def pair_corr(p: DataFrame, pairs: Sequence[tuple[str, str]], y: str = "quantity",
              keys: Sequence[str] = (S, "date")) -> DataFrame:
    """Correlation of listed item pairs (combo vs component) over (store, date) cells
    where both sold; one conditional aggregate per cell, no self-join."""
    items = sorted({i for pr in pairs for i in pr})
    cells = (p.where(F.col(I).isin(items)).groupBy(*keys)
              .agg(*[F.sum(F.when(F.col(I) == it, F.col(y))).alias(f"__{k}") for k, it in enumerate(items)]))
    idx = {it: k for k, it in enumerate(items)}
    return cells.select(F.explode(F.array(*[
        F.struct(F.lit(a).alias("item_a"), F.lit(b).alias("item_b"),
                 F.col(f"__{idx[a]}").alias("qa"), F.col(f"__{idx[b]}").alias("qb")) for a, b in pairs])).alias("x")) \
        .groupBy("x.item_a", "x.item_b").agg(F.corr("x.qa", "x.qb").alias("corr"),
                                             F.count(F.col("x.qa") * F.col("x.qb")).alias("cells"))


def explained(df: DataFrame, y: str, yhat: str, flag: str | None = None) -> DataFrame:
    """R² of a fitted mean (1 - SSE/SST) and, optionally, corr(flag, residual)."""
    res = F.col(y) - F.col(yhat)
    ok = F.col(y).isNotNull() & F.col(yhat).isNotNull()
    src = df.where(ok)
    ybar = grain.scalar(src, F.avg(y))
    aggs = [(F.lit(1.0) - fn.safe_div(F.sum(res * res), F.sum((F.col(y) - ybar) * (F.col(y) - ybar)))).alias("r2")]
    if flag:
        aggs.append(F.corr(F.col(flag).cast("double"), res).alias("flag_residual_corr"))
    return src.agg(*aggs)
