"""The model-free plan — season base from growth rates, holiday /
weather / store / promotion adjustments, day-of-week disaggregation,
reconciliation and sanity checks, breakdowns and method comparison.

Every step is a grouped aggregate, a window over a small aggregate, or an
equi-join on keys; the daily spine is generated per series (``explode``), not
by a cross join.
"""

from __future__ import annotations

import calendar


from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillcast import functions as fn
from tillcast.horizon import DEFAULT, Horizon
from tillcast.operators import baselines, grain, metrics
from tillcast.schema import DOW
from tillcast.session import stage

S, I = "store_id", "item_id"

# ---- fixed values of the plan ---------------------------------------------------
# temperature bins (°F, [lo, hi)) used by the binned elasticity
TEMP_BINS = ((0, 60), (60, 70), (70, 80), (80, 90))
# for climates whose season stays below the second bin
COLD_BINS = ((20, 35), (35, 40), (40, 45), (45, 50), (50, 60))
# sanity bands: season growth vs last year, store multipliers
GROWTH_BAND = (-0.10, 0.20)
MULT_BAND = (0.90, 1.10)
RECONCILE_TOL = 0.01
# ----------------------------------------------------------------------------------


def _years(hz: Horizon) -> list[int]:
    return list(range(hz.growth_first_year, hz.growth_last_year + 1))


def season_keys(p: DataFrame, hz: Horizon = DEFAULT) -> DataFrame:
    """(store, item, category, month) for every season month of every observed series."""
    keys = p.select(S, I, "category").distinct()
    return keys.select("*", F.explode(F.array(*[F.lit(m) for m in hz.season_months])).alias("month"))


def base_forecast(p: DataFrame, hz: Horizon = DEFAULT, y: str = "quantity") -> DataFrame:
    """Last year's (store, item, month) total x geometric mean of the yearly growth rates.

    Rate = 1 when the previous year is not > 0.  A series whose base is not
    positive falls back to its category's mean base for that month.
    """
    yrs = _years(hz)
    season = p.where(F.col("month").isin(list(hz.season_months)) & F.col("year").isin(yrs))
    sums = season.groupBy(S, I, "month").agg(
        *[F.sum(F.when(F.col("year") == yr, F.col(y))).alias(f"__q{yr}") for yr in yrs])
    base = season_keys(p, hz).join(sums, [S, I, "month"], "left")
    q = {yr: F.coalesce(F.col(f"__q{yr}"), F.lit(0.0)) for yr in yrs}
    rates = [F.when(q[a] > 0, q[b] / q[a]).otherwise(F.lit(1.0)) for a, b in zip(yrs[:-1], yrs[1:])]
    growth = grain.geo_mean(rates)
    base = base.withColumns({"last_year_qty": q[yrs[-1]], "avg_growth": growth,
                             "__base": q[yrs[-1]] * growth})
    # a group by with a map side and a small join: a window would gather all series of a category in one task
    cat_avg = base.groupBy("category", "month").agg(F.avg(F.when(F.col("__base") > 0, F.col("__base"))).alias("__avg"))
    return (base.join(cat_avg, ["category", "month"], "left")
                .select(S, I, "category", "month", "last_year_qty", "avg_growth",
                        F.when(F.col("__base") > 0, F.col("__base")).otherwise(F.col("__avg")).alias("base_qty")))


def holiday_impact_by_year(p: DataFrame, hz: Horizon = DEFAULT, y: str = "quantity") -> DataFrame:
    """Per holiday, (holiday-day mean - same month's non-holiday mean) / non-holiday mean,
    computed per year and averaged over the years where both exist."""
    yrs = _years(hz)
    src = p.where(F.col("year").isin(yrs))
    hol = (src.where((F.col("is_holiday") == 1) & F.col("holiday_name").isNotNull())
              .groupBy("holiday_name", "year", "month").agg(F.avg(y).alias("__h")))
    normal = src.where(F.col("is_holiday") == 0).groupBy("year", "month").agg(F.avg(y).alias("__n"))
    per_year = hol.join(normal, ["year", "month"]).where(F.col("__n") != 0)
    return (per_year.groupBy("holiday_name")
                    .agg(F.min("month").alias("month"), F.count(F.lit(1)).alias("years"),
                         F.avg((F.col("__h") - F.col("__n")) / F.col("__n")).alias("impact")))


def apply_multiplier(base: DataFrame, impacts: DataFrame, col: str = "base_qty",
                     out: str = "holiday_adj_qty") -> DataFrame:
    """Multiply each month by (1 + impact) of the holidays falling in it."""
    per_month = impacts.groupBy("month").agg(
        F.exp(F.sum(F.log(F.lit(1.0) + F.col("impact")))).alias("__mult"))
    return (base.join(per_month, "month", "left")
                .withColumn(out, F.col(col) * F.coalesce(F.col("__mult"), F.lit(1.0))).drop("__mult"))


def elasticity_binned(p: DataFrame, hz: Horizon = DEFAULT, y: str = "quantity", bins=TEMP_BINS) -> DataFrame:
    """Mean demand per temperature bin, slope over bin midpoints (needs > 2 bins),
    divided by the mean of the bin means; season rows of the growth years."""
    src = p.where(F.col("month").isin(list(hz.season_months)) & F.col("year").isin(_years(hz))
                  & F.col(y).isNotNull() & F.col("avg_temp_f").isNotNull())
    mid = None
    for lo, hi in bins:
        cond = (F.col("avg_temp_f") >= lo) & (F.col("avg_temp_f") < hi)
        mid = F.when(cond, F.lit((lo + hi) / 2.0)) if mid is None else mid.when(cond, F.lit((lo + hi) / 2.0))
    per_bin = (src.withColumn("__mid", mid).where(F.col("__mid").isNotNull())
                  .groupBy("category", "__mid").agg(F.avg(y).alias("__d")))
    return (per_bin.groupBy("category")
                   .agg(F.count(F.lit(1)).alias("bins"), F.regr_slope("__d", "__mid").alias("__s"),
                        F.avg("__d").alias("__m"))
                   .where(F.col("bins") > 2)
                   .select("category", "bins", fn.safe_div("__s", "__m").alias("elasticity")))


def store_multiplier(p: DataFrame, hz: Horizon = DEFAULT, y: str = "quantity") -> DataFrame:
    """P5: store CAGR on yearly totals over the unweighted chain mean."""
    from tillcast.operators.features import store_growth
    return store_growth(p.where(F.col(y).isNotNull()), hz, y, agg="sum", name="store_mult")


def promo_lift_item(p: DataFrame, y: str = "quantity") -> DataFrame:
    """(promoted mean - regular mean) / regular mean per item, where regular mean > 0."""
    g = p.groupBy(I).agg(F.avg(F.when(F.col("is_promotion") == 1, F.col(y))).alias("__on"),
                         F.avg(F.when(F.col("is_promotion") == 0, F.col(y))).alias("__off"))
    return g.where(F.col("__off") > 0).select(I, ((F.col("__on") - F.col("__off")) / F.col("__off")).alias("promo_lift"))


def cannibalization(p: DataFrame, y: str = "quantity") -> DataFrame:
    """P7 (re-aimed): effect of an item's promotion on the rest of its category.

    For every row, the rest-of-category demand at the same store and date is
    the category total minus the row's own demand (a window sum over
    (store, date, category) — no pair of items is ever formed).  Per promoted
    item: (mean rest demand on its promoted days - on its regular days) /
    regular-day mean.
    """
    own = F.coalesce(F.col(y), F.lit(0.0))
    tot = F.sum(own).over(Window.partitionBy(S, "date", "category"))
    rows = p.withColumn("__rest", tot - own)
    g = rows.groupBy(I, "category").agg(
        F.avg(F.when(F.col("is_promotion") == 1, F.col("__rest"))).alias("rest_on_promo"),
        F.avg(F.when(F.col("is_promotion") == 0, F.col("__rest"))).alias("rest_regular"))
    return g.withColumn("cannibalization", F.when(F.col("rest_regular") > 0,
                                                  (F.col("rest_on_promo") - F.col("rest_regular")) / F.col("rest_regular")))


def dow_profile(p: DataFrame, hz: Horizon = DEFAULT, y: str = "quantity") -> DataFrame:
    """Season mean by (store, item, weekday), falling back to (category, weekday)."""
    src = p.where(F.col("month").isin(list(hz.season_months)) & F.col("year").isin(_years(hz)))
    own = src.groupBy(S, I, DOW).agg(F.avg(y).alias("__own"))
    cat = src.groupBy("category", DOW).agg(F.avg(y).alias("__cat"))
    keys = p.select(S, I, "category").distinct().select("*", F.explode(F.sequence(F.lit(0), F.lit(6))).alias(DOW))
    return (keys.join(own, [S, I, DOW], "left").join(cat, ["category", DOW], "left")
                .select(S, I, "category", DOW, F.coalesce("__own", "__cat").alias("pattern")))


def disaggregate(targets: DataFrame, profile: DataFrame, hz: Horizon = DEFAULT,
                 target_col: str = "target_qty") -> DataFrame:
    """Month targets -> days via the weekday profile, scaled so the days of each
    (store, item, month) sum to the target (scale 1 when the skeleton sums to <= 0)."""
    keys = targets.select(S, I, "category").distinct()
    spine = fn.date_spine(keys, hz.test_start, hz.test_end).withColumns(
        {"month": F.month("date"), DOW: F.weekday("date")})
    days = (spine.join(profile.select(S, I, DOW, "pattern"), [S, I, DOW], "left")
                 .join(targets.select(S, I, "month", target_col), [S, I, "month"], "left"))
    sk = F.coalesce(F.col("pattern"), F.lit(0.0))
    tot = F.sum(sk).over(Window.partitionBy(S, I, "month"))
    scale = F.when(tot > 0, F.col(target_col) / tot).otherwise(F.lit(1.0))
    return days.select(S, I, "category", "date", "month", DOW, target_col, sk.alias("skeleton"),
                       (sk * scale).alias("daily_qty"))


def adjust_daily(daily: DataFrame, p: DataFrame, elasticity: DataFrame, impacts: DataFrame,
                 hz: Horizon = DEFAULT) -> DataFrame:
    """Weather (1 + elasticity x (day temperature - store's historical month mean))
    and holiday (1 + impact of the day's holiday) adjustments, then clip at 0."""
    from tillcast.sources.star import holiday_name
    day_temp = p.where(F.col("date") >= F.lit(hz.test_start)).groupBy(S, "date").agg(F.avg("avg_temp_f").alias("__t"))
    hist = (p.where(F.col("date") < F.lit(hz.test_start)).groupBy(S, "month")
             .agg(F.avg("avg_temp_f").alias("__h")))
    d = (daily.join(day_temp, [S, "date"], "left").join(hist, [S, "month"], "left")
              .join(elasticity.select("category", "elasticity"), "category", "left")
              .withColumn("holiday_name", holiday_name(F.col("date")))
              .join(impacts.select("holiday_name", "impact"), "holiday_name", "left"))
    temp_adj = F.lit(1.0) + F.coalesce(F.col("elasticity") * (F.col("__t") - F.col("__h")), F.lit(0.0))
    hol_adj = F.lit(1.0) + F.coalesce(F.col("impact"), F.lit(0.0))
    return d.select(S, I, "category", "date", "month", "daily_qty",
                    fn.clip(F.col("daily_qty") * temp_adj * hol_adj, lo=0.0).alias("adjusted_qty"))


def monthly_targets(p: DataFrame, hz: Horizon = DEFAULT) -> DataFrame:
    """P1 -> P3 -> P5: season month targets per (store, item)."""
    base = base_forecast(p, hz)
    adj = apply_multiplier(base, holiday_impact_by_year(p, hz))
    mult = store_multiplier(p, hz)
    return (adj.join(mult, S, "left")
               .withColumn("target_qty", F.col("holiday_adj_qty") * F.coalesce(F.col("store_mult"), F.lit(1.0))))


def daily_plan(p: DataFrame, hz: Horizon = DEFAULT, bins=TEMP_BINS, materialize: bool = True) -> DataFrame:
    """P1..P11 chained: daily forecast for the test season.  ``materialize`` stages the panel, which five branches read."""
    p = stage(p) if materialize else p
    targets = monthly_targets(p, hz)
    daily = disaggregate(targets, dow_profile(p, hz), hz)
    return adjust_daily(daily, p, elasticity_binned(p, hz, bins=bins), holiday_impact_by_year(p, hz), hz)


def reconcile_check(daily: DataFrame, targets: DataFrame, col: str = "daily_qty",
                    target_col: str = "target_qty", tol: float = RECONCILE_TOL) -> DataFrame:
    """|sum(days) - month target| / month target per (store, item, month); an unknown error is not ok."""
    s = daily.groupBy(S, I, "month").agg(F.sum(col).alias("day_sum"))
    j = s.join(targets.select(S, I, "month", target_col), [S, I, "month"])
    err = fn.safe_div(F.abs(F.col("day_sum") - F.col(target_col)), F.col(target_col))
    return j.select(S, I, "month", "day_sum", target_col, err.alias("rel_error"),
                    F.coalesce(err < tol, F.lit(False)).alias("ok"))


def sanity_checks(targets: DataFrame, mult: DataFrame, hz: Horizon = DEFAULT) -> DataFrame:
    """Growth band vs last year, store multiplier band, season month means."""
    g = fn.safe_div(F.col("target_qty") - F.col("last_year_qty"), F.col("last_year_qty"))
    a = targets.agg(
        F.count_if(g.isNotNull() & ((g <= GROWTH_BAND[0]) | (g >= GROWTH_BAND[1]))).alias("growth_out"),
        *[F.avg(F.when(F.col("month") == m, F.col("target_qty"))).alias(f"mean_m{m}") for m in hz.season_months])
    m = mult.agg(F.min("store_mult").alias("mn"), F.max("store_mult").alias("mx"))
    lo, hi = MULT_BAND
    checks = F.array(
        F.struct(F.lit("growth_in_band").alias("check"), (F.col("growth_out") == 0).alias("ok"),
                 F.col("growth_out").cast("double").alias("value")),
        *[F.struct(F.lit(f"mean_{calendar.month_abbr[m].lower()}").alias("check"), F.lit(True).alias("ok"),
                   F.col(f"mean_m{m}").alias("value")) for m in hz.season_months])
    mult_checks = F.array(
        F.struct(F.lit("min_store_mult").alias("check"), ((F.col("mn") > lo) & (F.col("mn") < hi)).alias("ok"),
                 F.col("mn").alias("value")),
        F.struct(F.lit("max_store_mult").alias("check"), ((F.col("mx") > lo) & (F.col("mx") < hi)).alias("ok"),
                 F.col("mx").alias("value")))
    return (a.select(F.explode(checks).alias("c")).select("c.*")
             .unionByName(m.select(F.explode(mult_checks).alias("c")).select("c.*")))


def season_share(p: DataFrame, hz: Horizon = DEFAULT, y: str = "quantity") -> DataFrame:
    """Season share of annual demand and season growth vs the previous year."""
    season = F.col("month").isin(list(hz.season_months))
    g = (p.where(F.col("year").isin(_years(hz))).groupBy(S, I, "year")
          .agg(F.sum(F.when(season, F.col(y))).alias("season_qty"), F.sum(y).alias("year_qty")))
    w = Window.partitionBy(S, I).orderBy("year")
    return g.select(S, I, "year", "season_qty", "year_qty",
                    fn.safe_div("season_qty", "year_qty").alias("season_share"),
                    (fn.safe_div(F.col("season_qty"), F.lag("season_qty").over(w)) - 1).alias("season_yoy"))


def forecast_breakdown(daily: DataFrame, p: DataFrame, hz: Horizon = DEFAULT,
                       col: str = "adjusted_qty") -> tuple[DataFrame, DataFrame]:
    """Forecast mean/std by category; store totals vs the last growth year."""
    by_cat = daily.groupBy("category").agg(F.avg(col).alias("mean_qty"), F.stddev_pop(col).alias("std_qty"))
    last = (p.where(F.col("year") == hz.growth_last_year).groupBy(S).agg(F.sum("quantity").alias("last_year_total")))
    by_store = (daily.groupBy(S).agg(F.sum(col).alias("forecast_total")).join(last, S, "left")
                     .withColumn("growth_pct", (fn.safe_div("forecast_total", "last_year_total") - 1) * 100))
    return by_cat, by_store


def method_comparison(daily: DataFrame, p: DataFrame, hz: Horizon = DEFAULT, col: str = "adjusted_qty",
                      naive_days: int = 365) -> DataFrame:
    """wMAPE of the plan vs seasonal naive over all known actuals of the test season.

    The naive forecast of a series without a sale that day last year is its
    category's mean for the month and weekday before the test; a cell that
    neither method forecasts counts as 0.
    """
    test = F.col("date") >= F.lit(hz.test_start)
    mean = p.where(~test).groupBy("category", "month", DOW).agg(F.avg("quantity").alias("__mean"))
    past = baselines.seasonal_naive(p.select(S, I, "date", "category", "month", DOW, "quantity")
                                    .join(mean, ["category", "month", DOW], "left"),
                                    y="quantity", days=naive_days, fallback="__mean", name="__naive")
    j = past.where(test).join(daily.select(S, I, "date", F.col(col).alias("__plan")), [S, I, "date"], "left")
    j = j.withColumns({"plan": F.coalesce("__plan", F.lit(0.0)), "naive": F.coalesce("__naive", F.lit(0.0))})
    return j.agg(metrics.wmape_expr("quantity", "plan", positive_only=False).alias("plan_wmape"),
                 metrics.wmape_expr("quantity", "naive", positive_only=False).alias("naive_wmape"))
