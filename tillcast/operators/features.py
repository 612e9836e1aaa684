"""Feature layers B1-B36 and cross signals C1-C17 as one lazy plan.

Grain grouping: every fitted feature is an aggregate over the training rows at
some grain.  Series grains (keys containing store and item) are computed as
window aggregates on the series-partitioned panel — no join, no exchange.
Every other grain is one ``groupBy`` with all its aggregates and one left join
(AQE broadcasts it when small).  Dimension attributes are collapsed into one
table per dimension (store, item, category) so each costs a single join.
Global scalars are scalar subqueries.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillcast import functions as fn
from tillcast.horizon import DEFAULT, Horizon
from tillcast.operators import encode, grain, windows
from tillcast.operators.prep import TARGET, in_fit
from tillcast.schema import DOW
from tillcast.session import stage

S, I, M, D = "store_id", "item_id", "month", DOW
ROWS_PER_TASK = 20_000      # panel rows of a task that holds the series windows


def _clean(name: str) -> str:
    return "".join(ch if ch.isalnum() else "_" for ch in name)


@dataclass(frozen=True)
class Catalog:
    """Domain parameters of the feature layers."""
    # component groups in priority order (first listed group wins, T16)
    component_groups: dict = field(default_factory=dict)
    size_pairs: tuple = ()           # (small item, large item)
    combos: tuple = ()               # (combo item, component item)
    smooth: float = 100.0            # target-encoding smoothing
    elasticity_min_rows: int = 100
    lag_days: tuple = (7, 14, 364, 365, 728)
    rolling_n: int = 28
    rolling_min: int = 7
    fourier_k: tuple = (1, 2, 3)
    fourier_period: float = 365.25
    # The state-item index includes the store itself (parity); True excludes it
    leave_one_out: bool = False

    def size_ratio_names(self) -> list[str]:
        return [f"size_ratio_{_clean(a)}_{_clean(b)}" for a, b in self.size_pairs]

    def combo_ratio_names(self) -> list[str]:
        return [f"combo_ratio_{_clean(c)}" for c, _ in self.combos]


# ---- fixed values of the driver binding (FIXTURES §2) -------------------------
_CATS = ("anvil", "bolt", "gear", "gizmo", "plate", "ring", "rod", "widget")
DRIVER_CATALOG = Catalog(
    component_groups={
        "metal": [f"{c}-{s}" for c in ("bolt", "gear", "rod") for s in "SLR"],
        "round": [f"{c}-{s}" for c in ("ring", "plate", "gear") for s in "SLR"],
        "combo": ["gizmo-R", "widget-R", "gear-R"],
    },
    size_pairs=tuple((f"{c}-S", f"{c}-L") for c in _CATS),
    combos=(("gear-R", "bolt-R"), ("gizmo-R", "rod-R"), ("plate-R", "ring-R"), ("widget-R", "anvil-R")),
)
# -------------------------------------------------------------------------------

# Feature names of the model layers, in model order.
FEATURES_BASE = [
    "menu_item_enc", "category_enc", "unit_price",
    "month", DOW, "is_weekend", "day_of_year", "week_of_year", "day_of_month",
    "is_holiday", "is_special_event", "is_promotion",
    "days_from_thanksgiving", "days_from_christmas",
    "is_thanksgiving_week", "is_black_friday", "is_christmas_week", "is_new_year_period",
    "avg_temp_f", "precip_inches", "precip_type_enc",
    "temp_freezing", "temp_cold", "temp_mild", "has_precip", "heavy_precip",
    "struct_rimdow", "struct_rim", "struct_cmdow", "q4_hist_ri", "struct_rimdow_q4",
    "holiday_mult", "cat_holiday_mult",
    "cat_temp_elasticity", "temp_deviation", "weather_impact",
    "event_mult", "store_growth_mult", "promo_lift_cat",
    "lag_364", "lag_365", "lag_7_filled", "lag_14_filled",
    "rolling_mean_28", "rolling_std_28",
    "sin_1", "cos_1", "sin_2", "cos_2", "sin_3", "cos_3",
    "struct_x_event", "struct_x_holiday", "yoy_ratio", "cat_temp_interaction",
    "yoy_growth", "q4_cmdow", "q4_trend_ratio", "struct_rimdow_trended",
]
FEATURES_60 = ["restaurant_enc", *FEATURES_BASE]
FEATURES_70 = [*FEATURES_BASE,
               "dow_x_month", "target_enc_rim", "target_enc_ridow", "temp_lag1", "temp_rolling3",
               "days_from_payday", "is_payday_window", "is_month_start", "is_month_end",
               "promo_count_cat", "item_cv"]


def features_94(cat: Catalog = DRIVER_CATALOG) -> list[str]:
    return [*FEATURES_70,
            "city_enc", "state_enc", "city_demand_idx", "state_demand_idx", "rest_city_share",
            "n_restaurants_city", "n_restaurants_state",
            "cat_chain_demand_idx", "item_category_share", "cat_rest_share",
            "component_group_enc", "component_demand_idx", "item_component_share",
            *cat.size_ratio_names(), *cat.combo_ratio_names(),
            "state_item_demand_idx", "rest_vs_state_ratio",
            "price_vs_cat_avg", "price_tier"]


def feature_list(level: str = "v4", cat: Catalog = DRIVER_CATALOG) -> list[str]:
    return {"v2": FEATURES_60, "v3": FEATURES_70, "v4": features_94(cat)}[level]


# ---------------------------------------------------------------- row features
def calendar_columns(date: str = "date") -> dict:
    """Pure functions of the date."""
    d = F.col(date)
    y = F.year(d)
    dtg = fn.clip(fn.days_between(d, fn.thanksgiving(y)), -60, 60)
    dxm = fn.clip(fn.days_between(d, fn.fixed_day(y, 12, 25)), -60, 30)
    dom = F.dayofmonth(d)
    pay = fn.days_from_payday(dom)
    cols = {
        "day_of_year": F.dayofyear(d),
        "week_of_year": F.weekofyear(d),
        "day_of_month": dom,
        "days_from_thanksgiving": dtg,
        "days_from_christmas": dxm,
        "is_thanksgiving_week": fn.flag((dtg >= -3) & (dtg <= 3)),
        "is_black_friday": fn.flag(dtg == 1),
        "is_christmas_week": fn.flag((dxm >= -7) & (dxm <= 1)),
        "is_new_year_period": fn.flag(((F.month(d) == 12) & (dom >= 28)) | ((F.month(d) == 1) & (dom <= 3))),
        "days_from_payday": pay,
        "is_payday_window": fn.flag(pay <= 2),
        "is_month_start": fn.flag(dom <= 3),
        "is_month_end": fn.flag(dom >= 28),
        "dow_x_month": F.weekday(d) * 100 + F.month(d),
    }
    cols.update(fn.fourier_terms(F.dayofyear(d)))
    return cols


def weather_flags(temp: str = "avg_temp_f", precip: str = "precip_inches") -> dict:
    """B12."""
    t, p = F.col(temp), F.col(precip)
    return {
        "temp_freezing": fn.flag(t < 32),
        "temp_cold": fn.flag((t >= 32) & (t < 50)),
        "temp_mild": fn.flag((t >= 50) & (t < 70)),
        "has_precip": fn.flag(p > 0),
        "heavy_precip": fn.flag(p > 0.5),
    }


# ------------------------------------------------------------- dimension tables
def dim_store(p: DataFrame) -> DataFrame:
    """First (city, state) per store in (store, item, date) order, codes, counts."""
    dim = grain.first_per_key(p, S, [I, "date"], ["city", "state"])
    counts_city = dim.groupBy("city").agg(F.count(F.lit(1)).alias("n_restaurants_city"))
    counts_state = dim.groupBy("state").agg(F.count(F.lit(1)).alias("n_restaurants_state"))
    out = (encode.label_encode(dim, S, "restaurant_enc"))
    out = encode.label_encode(out, "city", "city_enc")
    out = encode.label_encode(out, "state", "state_enc")
    return (out.join(counts_city, "city", "left").join(counts_state, "state", "left")
               .select(S, "city", "state", "restaurant_enc", "city_enc", "state_enc",
                       "n_restaurants_city", "n_restaurants_state"))


def store_growth(t: DataFrame, hz: Horizon = DEFAULT, x: str = TARGET, agg: str = "mean",
                 name: str = "store_growth_mult") -> DataFrame:
    """CAGR from the first to the last growth year over the unweighted chain mean.

    Rate = 1 when the first-year level is not > 0.  A store lacking the last
    year has no rate and is skipped by the chain mean (T12, documented).
    """
    f = F.avg if agg == "mean" else F.sum
    yrs = hz.growth_last_year - hz.growth_first_year
    per = grain.group_agg(t, S,
                          __q0=f(F.when(F.col("year") == hz.growth_first_year, F.col(x))),
                          __q1=f(F.when(F.col("year") == hz.growth_last_year, F.col(x))))
    g = F.when(F.col("__q0") > 0, F.pow(fn.safe_div(F.col("__q1"), F.col("__q0")), F.lit(1.0 / yrs))) \
         .otherwise(F.lit(1.0))
    per = per.select(S, g.alias("__g"))
    chain = per.agg(F.avg("__g")).scalar()
    return per.select(S, fn.safe_div(F.col("__g"), chain).alias(name))


def item_table(p: DataFrame, cat: Catalog) -> DataFrame:
    """Item code, primary component group and its code."""
    items = encode.assign_groups(p.select(I).distinct(), cat.component_groups)
    items = encode.label_encode(items, I, "menu_item_enc")
    items = encode.label_encode(items, "component_group", "component_group_enc")
    return items.select(I, "component_group", "menu_item_enc", "component_group_enc")


def category_table(p: DataFrame, t: DataFrame, cat: Catalog, x: str = TARGET) -> DataFrame:
    """B8, B11 code, B15, C16: one row per category (one pass over the training rows)."""
    cats = encode.label_codes(p, "category", "category_enc").withColumnRenamed("__v", "category")
    xs, promo = F.col(x), F.col("is_promotion")
    g = grain.group_agg(t, "category", __n=F.count(F.lit(1)), __slope=F.regr_slope(x, "avg_temp_f"),
                        __mean=F.avg(x), __on=F.avg(F.when(promo == 1, xs)), __off=F.avg(F.when(promo == 0, xs)))
    g = g.select("category",
                 F.when(F.col("__n") > cat.elasticity_min_rows, fn.safe_div("__slope", "__mean"))
                  .alias("cat_temp_elasticity"),
                 F.when(F.col("__off") > 0, fn.safe_div("__on", "__off")).alias("__promo_lift"))
    first_price = grain.first_per_key(p, I, [S, "date"], ["category", "unit_price"])
    price = first_price.groupBy("category").agg(F.avg("unit_price").alias("cat_avg_price"))
    return (cats.join(g, "category", "left").join(price, "category", "left")
                .withColumn("cat_temp_elasticity", F.coalesce("cat_temp_elasticity", F.lit(0.0))))


# --------------------------------------------------------------------- builder
def build_features(p: DataFrame, hz: Horizon = DEFAULT, cat: Catalog = DRIVER_CATALOG,
                   x: str = TARGET, temp_memory: str = "parity", materialize: bool = True) -> DataFrame:
    """All 94 v4 features (plus the notebook's ``restaurant_enc``) on a prepared panel.

    ``materialize`` checkpoints the prepared panel once (shared checkpoint
    folder) so the twenty-odd aggregate branches read it instead of each
    re-deriving the panel from the raw tables, and checkpoints the finished
    feature frame so downstream consumers do not re-expand its plan.
    """
    keep = stage if materialize else (lambda df: df)
    # promotions per (store, category, date): the one window off the series key, while the panel is narrow
    p = keep(p.withColumn("promo_count_cat", F.sum("is_promotion").over(Window.partitionBy(S, "category", "date"))))
    p0 = p     # every aggregate branch reads the staged panel, never the windowed frame
    fit = in_fit(hz, x)
    season = F.col("month").isin(list(hz.season_months))
    y = F.col("year")

    # series grains (windows) + row features first.  The panel is spread by series over a number of tasks that grows
    # with its rows (a given number is not coalesced), and sorted three times for all windows: by date for memory,
    # lags and rolling frames, by month and weekday, by weekday
    if materialize:
        p = p.repartition(max(p.sparkSession.sparkContext.defaultParallelism, -(-p.count() // ROWS_PER_TASK)), S, I)
    wm, wa = grain.window_mean, grain.window_agg
    p = p.sortWithinPartitions(S, I, "date")
    if temp_memory == "parity":
        p = windows.store_order_memory(p, "avg_temp_f")
    else:
        p = windows.store_date_memory(p, "avg_temp_f")
    dated = windows.lag_columns(x, cat.lag_days)
    dated["__roll_mean"] = windows.rolling_expr(x, cat.rolling_n, "mean", cat.rolling_min, shift=1)
    dated["__roll_std"] = windows.rolling_expr(x, cat.rolling_n, "std", cat.rolling_min, shift=1)
    p = p.withColumns(dated)
    p = p.sortWithinPartitions(S, I, M, D).withColumns({
        "struct_rimdow": wm([S, I, M, D], x, fit),
        "struct_rim": wm([S, I, M], x, fit),
        "__q4_rimdow": wm([S, I, M, D], x, fit & season),
        "__q4_ri": wm([S, I], x, fit & season),
        "__q4_recent": wm([S, I], x, fit & season & (y == hz.trend_year)),
        "__q4_earlier": wm([S, I], x, fit & season & (y < hz.trend_year)),
        "__n_rim": wa(F.count, [S, I, M], x, fit),
        "__cv_mean": wm([S, I], x, fit),
        "__cv_std": wa(F.stddev_samp, [S, I], x, fit),
        "__sum_rim": wa(F.sum, [S, I, M], x, fit),
    })
    p = p.sortWithinPartitions(S, I, D).withColumns({
        "__n_ridow": wa(F.count, [S, I, D], x, fit),
        "__mean_ridow": wm([S, I, D], x, fit),
    })
    p = p.withColumns({**calendar_columns(), **weather_flags()})
    p = p.withColumnsRenamed({"avg_temp_f_lag1": "temp_lag1", "avg_temp_f_rolling3": "temp_rolling3"})

    # dimensions: store (city/state re-mapped from the first row per store), item, category
    # staged as small tables, so that their sizes are known when joins are planned
    stores = keep(dim_store(p0))
    items = keep(item_table(p0, cat))
    base = p0.drop("city", "state").join(stores, S, "left").join(items, I, "left")
    t = base.where(fit)
    cats = keep(category_table(base, t, cat, x))
    grown = keep(stores.join(store_growth(t, hz, x), S, "left"))
    p = p.drop("city", "state").join(grown, S, "left").join(items, I, "left")

    # precip code (NULL precipitation type encodes as the text 'None')
    p = encode.label_encode(p, "precip_type", "precip_type_enc", null_as="None",
                            codes=encode.label_codes(p0, "precip_type", "precip_type_enc", null_as="None"))

    # non-series grains.  All but the holiday / event / temperature ones are
    # coarsenings of (store, item, month, weekday) — category, city, state and
    # component group are functions of store or item — so the training rows are
    # pre-aggregated once to sums and counts at that grain and every coarser
    # mean or total is summed from that small table (one pass over the fact).
    xs = F.col(x)
    # staged: ten coarser grains read it, and no reuse of an exchange serves them all
    fine = keep(grain.group_agg(t, [S, I, M, D, "category", "city", "state", "component_group"],
                                __s=F.sum(xs), __n=F.count(xs),
                                __ss=F.sum(F.when(season, xs)), __sn=F.count(F.when(season, xs))))

    gm = grain.scalar(fine, fn.safe_div(F.sum("__s"), F.sum("__n")))

    def mean(s_col: str = "__s", n_col: str = "__n", cond=None):
        sv, nv = F.col(s_col), F.col(n_col)
        if cond is not None:
            sv, nv = F.when(cond, sv), F.when(cond, nv)
        return fn.safe_div(F.sum(sv), F.sum(nv))

    cmdow = grain.group_agg(fine, ["category", M, D], struct_cmdow=mean(), __q4_cmdow=mean("__ss", "__sn"))
    city = grain.group_agg(fine, ["city", M, D], city_demand_idx=mean())
    state = grain.group_agg(fine, ["state", M, D], state_demand_idx=mean())
    if cat.leave_one_out:
        # (state total - own total) / (state count - own count) per row's store
        st_item = (grain.group_agg(fine, ["state", I, M, D], __st_s=F.sum("__s"), __st_n=F.sum("__n"))
                   .join(fine.select(S, "state", I, M, D, F.col("__s").alias("__own_s"),
                                     F.col("__n").alias("__own_n")), ["state", I, M, D])
                   .select(S, "state", I, M, D,
                           fn.safe_div(F.col("__st_s") - F.col("__own_s"),
                                       F.col("__st_n") - F.col("__own_n")).alias("state_item_demand_idx")))
        st_item_keys = [S, "state", I, M, D]
    else:
        st_item = grain.group_agg(fine, ["state", I, M, D], state_item_demand_idx=mean())
        st_item_keys = ["state", I, M, D]
    st_item_m = grain.group_agg(fine, ["state", I, M], __state_item_avg=mean())
    comp = grain.group_agg(fine, [S, "component_group", M, D], component_demand_idx=mean())
    comp_m = grain.group_agg(fine, [S, "component_group", M], __comp_total=F.sum("__s"))
    s_cat_m = grain.group_agg(fine, [S, "category", M], __cat_total=F.sum("__s"))
    s_cat_m = s_cat_m.withColumn(
        "cat_rest_share", fn.safe_ratio(F.col("__cat_total"), F.sum("__cat_total").over(Window.partitionBy(S, M)), 1))
    pair_aggs = {}
    for a, b in list(cat.size_pairs) + list(cat.combos):
        for it in (a, b):
            pair_aggs[f"__m_{_clean(it)}"] = mean(cond=F.col(I) == it)
    s_m = grain.group_agg(fine, [S, "city", M], __rest_total=F.sum("__s"), **pair_aggs)
    ratio_cols = {}
    for (a, b), nm in zip(cat.size_pairs, cat.size_ratio_names()):
        ratio_cols[nm] = F.coalesce(fn.safe_ratio(F.col(f"__m_{_clean(a)}"), F.col(f"__m_{_clean(b)}"), 1), F.lit(1.0))
    for (c, b), nm in zip(cat.combos, cat.combo_ratio_names()):
        ratio_cols[nm] = F.coalesce(fn.safe_ratio(F.col(f"__m_{_clean(c)}"), F.col(f"__m_{_clean(b)}"), 1), F.lit(1.0))
    s_m = s_m.select(S, M, fn.safe_ratio(F.col("__rest_total"),
                                          F.sum("__rest_total").over(Window.partitionBy("city", M)), 1)
                     .alias("rest_city_share"), *[v.alias(k) for k, v in ratio_cols.items()])
    # holiday / event lifts from one pre-aggregate (NULL names are real groups here)
    # staged: eight lifts and baselines read it
    flags = keep(t.groupBy("category", "is_holiday", "holiday_name", "is_special_event", "special_event_name")
                  .agg(F.sum(xs).alias("__s"), F.count(xs).alias("__n")))
    lift = dict(sum_col="__s", cnt_col="__n")
    hol = grain.lift_vs_baseline(flags, "is_holiday", x, "holiday_mult", level="holiday_name", **lift)
    cat_hol = grain.lift_vs_baseline(flags, "is_holiday", x, "cat_holiday_mult", by="category",
                                     level="holiday_name", base_by="category", positive_base=True, **lift)
    event = grain.lift_vs_baseline(flags, "is_special_event", x, "event_mult", level="special_event_name", **lift)
    q4_temp = grain.scalar(t.where(season), F.avg("avg_temp_f"))

    # the coarse grains are looked up for the panel's cells, a table of a row per series, month and weekday, in two
    # steps; the panel then takes all of them by one join (a task that holds every lookup at once outgrows its memory)
    cell = [S, I, "category", M, D]
    cells = base.select(*cell, "city", "state", "component_group").distinct()
    cells = keep(cells.join(cmdow, ["category", M, D], "left")
                      .join(city, ["city", M, D], "left")
                      .join(state, ["state", M, D], "left")
                      .join(st_item, st_item_keys, "left")
                      .join(st_item_m, ["state", I, M], "left"))
    cells = keep(cells.join(comp, [S, "component_group", M, D], "left")
                      .join(comp_m, [S, "component_group", M], "left")
                      .join(s_cat_m, [S, "category", M], "left")
                      .join(s_m, [S, M], "left")
                      .drop("city", "state", "component_group")
                      .withColumnsRenamed({k: f"__k_{k}" for k in cell}))
    same = [F.col(k).eqNullSafe(F.col(f"__k_{k}")) for k in cell]
    p = (p.join(cells, same, "left")
          .join(hol, "holiday_name", "left")
          .join(cat_hol, ["category", "holiday_name"], "left")
          .join(event, "special_event_name", "left")
          .join(cats, "category", "left"))

    c = F.col
    one = F.lit(1.0)
    p = p.withColumns({
        "q4_hist_ri": F.coalesce(c("__q4_ri"), c("struct_rim")),
        "struct_rimdow_q4": F.coalesce(c("__q4_rimdow"), c("struct_rimdow")),
        "holiday_mult": F.coalesce(c("holiday_mult"), one),
        "cat_holiday_mult": F.coalesce(c("cat_holiday_mult"), one),
        "event_mult": F.coalesce(c("event_mult"), one),
        "store_growth_mult": F.coalesce(c("store_growth_mult"), one),
        "promo_lift_cat": F.when(c("is_promotion") == 1, F.coalesce(c("__promo_lift"), one)).otherwise(one),
        "temp_deviation": c("avg_temp_f") - q4_temp,
        "cat_temp_interaction": c("category_enc") * c("avg_temp_f"),
        "lag_7_filled": F.coalesce(c("lag_7"), c("lag_364")),
        "lag_14_filled": F.coalesce(c("lag_14"), c("lag_364")),
        "yoy_growth": fn.clip(F.coalesce(fn.safe_ratio(c("lag_364"), c("lag_728"), 1), one), 0.5, 2.0),
        "rolling_mean_28": F.coalesce(c("__roll_mean"), c("struct_rimdow")),
        "rolling_std_28": F.coalesce(c("__roll_std"), F.lit(0.0)),
        "q4_cmdow": F.coalesce(c("__q4_cmdow"), c("struct_cmdow")),
        "q4_trend_ratio": F.coalesce(fn.clip(fn.safe_ratio(c("__q4_recent"), c("__q4_earlier"), 1), 0.5, 2.0), one),
        "yoy_ratio": fn.safe_ratio(c("lag_364"), c("struct_rimdow"), 1),
        "target_enc_rim": F.coalesce(encode.smoothed_mean(c("__n_rim"), c("struct_rim"), gm, cat.smooth), gm),
        "target_enc_ridow": F.coalesce(encode.smoothed_mean(c("__n_ridow"), c("__mean_ridow"), gm, cat.smooth), gm),
        "item_cv": F.coalesce(fn.clip(fn.safe_ratio(c("__cv_std"), c("__cv_mean"), 1), 0.0, 2.0), F.lit(0.5)),
        "city_demand_idx": F.coalesce(c("city_demand_idx"), gm),
        "state_demand_idx": F.coalesce(c("state_demand_idx"), gm),
        "rest_city_share": F.coalesce(c("rest_city_share"), F.lit(0.5)),
        "cat_chain_demand_idx": F.coalesce(c("struct_cmdow"), gm),
        "item_category_share": F.coalesce(fn.safe_ratio(c("__sum_rim"), c("__cat_total"), 1), F.lit(0.1)),
        "cat_rest_share": F.coalesce(c("cat_rest_share"), F.lit(0.125)),
        "component_demand_idx": F.coalesce(c("component_demand_idx"), gm),
        "item_component_share": F.coalesce(fn.safe_ratio(c("__sum_rim"), c("__comp_total"), 1), F.lit(0.1)),
        "state_item_demand_idx": F.coalesce(c("state_item_demand_idx"), gm),
        "rest_vs_state_ratio": F.coalesce(fn.safe_ratio(c("struct_rim"), c("__state_item_avg"), 1), one),
        "price_vs_cat_avg": fn.safe_ratio(c("unit_price"), c("cat_avg_price"), 1),
        **{k: F.coalesce(c(k), one) for k in cat.size_ratio_names() + cat.combo_ratio_names()},
    })
    p = p.withColumns({
        "weather_impact": c("cat_temp_elasticity") * c("temp_deviation"),
        "struct_rimdow_trended": c("struct_rimdow") * c("q4_trend_ratio"),
        "struct_x_event": c("struct_rimdow") * c("event_mult"),
        "struct_x_holiday": c("struct_rimdow") * c("holiday_mult"),
    })
    p = grain.quantile_bins(p, "unit_price", "price_tier", 3, edges_from=p0)
    p = p.drop(*[col for col in p.columns if col.startswith("__")])
    # write the feature frame once: every model, member and report reads it
    return keep(p)


def feature_frame(p: DataFrame, level: str = "v4", cat: Catalog = DRIVER_CATALOG,
                  extra: Sequence[str] = ("date", S, I, "category", "quantity", TARGET)) -> DataFrame:
    """Keys + target + the feature columns of ``level`` in model order."""
    return p.select(*extra, *[f for f in feature_list(level, cat) if f not in extra])
