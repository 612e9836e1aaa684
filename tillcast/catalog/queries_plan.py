"""Model-free plan queries."""

from __future__ import annotations


from tillcast.catalog.queries_core import panel
from tillcast.catalog.registry import register, rounded, sql_round
from tillcast.catalog.sqlbase import with_panel
from tillcast.catalog.sqlplan import plan_cte
from tillcast.horizon import DEFAULT as HZ
from tillcast.plans import monthly


def _sql(body, cols=None, bins=monthly.TEMP_BINS):
    return with_panel(plan_cte(bins) + (sql_round(body, cols) if cols else body))


@register("p1_base_forecast", _sql("SELECT * FROM PBASE", ["last_year_qty", "avg_growth", "base_qty"]))
def p1_base_forecast(spark, sf):
    return rounded(monthly.base_forecast(panel(spark, sf), HZ))


@register("p2_holiday_impact_by_year", _sql("SELECT * FROM IMPACT", ["impact"]))
def p2_holiday_impact_by_year(spark, sf):
    return rounded(monthly.holiday_impact_by_year(panel(spark, sf), HZ))


@register("p3_p5_monthly_targets", _sql(
    "SELECT store_id, item_id, month, base_qty, holiday_adj_qty, store_mult, target_qty FROM TARGETS",
    ["base_qty", "holiday_adj_qty", "store_mult", "target_qty"]))
def p3_p5_monthly_targets(spark, sf):
    t = monthly.monthly_targets(panel(spark, sf), HZ)
    return rounded(t.select("store_id", "item_id", "month", "base_qty", "holiday_adj_qty", "store_mult", "target_qty"))


@register("p4_elasticity_binned", _sql("SELECT * FROM ELAST", ["elasticity"]))
def p4_elasticity_binned(spark, sf):
    return rounded(monthly.elasticity_binned(panel(spark, sf), HZ))


@register("p4_elasticity_cold_bins", _sql("SELECT * FROM ELAST", ["elasticity"], monthly.COLD_BINS))
def p4_elasticity_cold_bins(spark, sf):
    """The same with bins inside the season's temperatures, so that every category has a slope."""
    return rounded(monthly.elasticity_binned(panel(spark, sf), HZ, bins=monthly.COLD_BINS))


@register("p5_store_multiplier", _sql("SELECT * FROM SMULT", ["store_mult"]))
def p5_store_multiplier(spark, sf):
    return rounded(monthly.store_multiplier(panel(spark, sf), HZ))


@register("p6_promo_lift_item", with_panel("""
SELECT item_id, round((avg(CASE WHEN is_promotion = 1 THEN quantity END) - avg(CASE WHEN is_promotion = 0 THEN quantity END))
                      / avg(CASE WHEN is_promotion = 0 THEN quantity END), 6) AS promo_lift
FROM panel GROUP BY item_id HAVING avg(CASE WHEN is_promotion = 0 THEN quantity END) > 0"""))
def p6_promo_lift_item(spark, sf):
    return rounded(monthly.promo_lift_item(panel(spark, sf)))


@register("p7_cannibalization", with_panel(sql_round("""
SELECT item_id, category, rest_on_promo, rest_regular,
       CASE WHEN rest_regular > 0 THEN (rest_on_promo - rest_regular) / rest_regular END AS cannibalization
FROM (SELECT item_id, category, avg(CASE WHEN is_promotion = 1 THEN rest END) AS rest_on_promo,
             avg(CASE WHEN is_promotion = 0 THEN rest END) AS rest_regular
      FROM (SELECT *, sum(coalesce(quantity, 0.0)) OVER (PARTITION BY store_id, date, category)
                      - coalesce(quantity, 0.0) AS rest FROM panel) r GROUP BY ALL) g""",
    ["rest_on_promo", "rest_regular", "cannibalization"])))
def p7_cannibalization(spark, sf):
    return rounded(monthly.cannibalization(panel(spark, sf)))


@register("p8_dow_profile", _sql("SELECT * FROM PROFILE", ["pattern"]))
def p8_dow_profile(spark, sf):
    return rounded(monthly.dow_profile(panel(spark, sf), HZ))


@register("p9_disaggregate", _sql(
    "SELECT store_id, item_id, date, month, skeleton, target_qty, daily_qty FROM DAILY",
    ["skeleton", "target_qty", "daily_qty"]))
def p9_disaggregate(spark, sf):
    p = panel(spark, sf)
    d = monthly.disaggregate(monthly.monthly_targets(p, HZ), monthly.dow_profile(p, HZ), HZ)
    return rounded(d.select("store_id", "item_id", "date", "month", "skeleton", "target_qty", "daily_qty"))


@register("p11_adjust_daily", _sql(
    "SELECT store_id, item_id, date, daily_qty, adjusted_qty FROM ADJ", ["daily_qty", "adjusted_qty"]))
def p11_adjust_daily(spark, sf):
    d = monthly.daily_plan(panel(spark, sf), HZ)
    return rounded(d.select("store_id", "item_id", "date", "daily_qty", "adjusted_qty"))


@register("p11_adjust_daily_weather", _sql(
    "SELECT store_id, item_id, date, daily_qty, adjusted_qty FROM ADJ", ["daily_qty", "adjusted_qty"], monthly.COLD_BINS))
def p11_adjust_daily_weather(spark, sf):
    """With elasticities from the cold bins: the weather factor is not 1."""
    d = monthly.daily_plan(panel(spark, sf), HZ, monthly.COLD_BINS)
    return rounded(d.select("store_id", "item_id", "date", "daily_qty", "adjusted_qty"))


@register("p12_reconcile_check", _sql("""
SELECT d.store_id, d.item_id, d.month, d.day_sum, t.target_qty, abs(d.day_sum - t.target_qty) / nullif(t.target_qty, 0) AS rel_error,
       coalesce(abs(d.day_sum - t.target_qty) / nullif(t.target_qty, 0) < 0.01, false) AS ok
FROM (SELECT store_id, item_id, month, sum(adjusted_qty) AS day_sum FROM ADJ GROUP BY ALL) d
JOIN TARGETS t USING (store_id, item_id, month)""", ["day_sum", "target_qty", "rel_error"]))
def p12_reconcile_check(spark, sf):
    p = panel(spark, sf)
    targets = monthly.monthly_targets(p, HZ)
    return rounded(monthly.reconcile_check(monthly.daily_plan(p, HZ), targets, col="adjusted_qty"))


@register("p13_sanity_checks", _sql("""
, gr AS (SELECT (target_qty - last_year_qty) / nullif(last_year_qty, 0) AS g, month, target_qty FROM TARGETS),
a AS (SELECT count(*) FILTER (WHERE g IS NOT NULL AND (g <= -0.10 OR g >= 0.20)) AS growth_out,
             avg(CASE WHEN month = 10 THEN target_qty END) AS m10, avg(CASE WHEN month = 11 THEN target_qty END) AS m11,
             avg(CASE WHEN month = 12 THEN target_qty END) AS m12 FROM gr),
m AS (SELECT min(store_mult) AS mn, max(store_mult) AS mx FROM SMULT)
SELECT "check", ok, round(value, 6) AS value FROM (
  SELECT 'growth_in_band' AS "check", growth_out = 0 AS ok, CAST(growth_out AS DOUBLE) AS value FROM a
  UNION ALL SELECT 'mean_oct', true, m10 FROM a UNION ALL SELECT 'mean_nov', true, m11 FROM a
  UNION ALL SELECT 'mean_dec', true, m12 FROM a
  UNION ALL SELECT 'min_store_mult', mn > 0.9 AND mn < 1.1, mn FROM m
  UNION ALL SELECT 'max_store_mult', mx > 0.9 AND mx < 1.1, mx FROM m) x"""))
def p13_sanity_checks(spark, sf):
    p = panel(spark, sf)
    return rounded(monthly.sanity_checks(monthly.monthly_targets(p, HZ), monthly.store_multiplier(p, HZ)))


@register("p14_season_share", with_panel(sql_round("""
SELECT store_id, item_id, year, season_qty, year_qty, season_qty / nullif(year_qty, 0) AS season_share,
       season_qty / nullif(lag(season_qty) OVER (PARTITION BY store_id, item_id ORDER BY year), 0) - 1 AS season_yoy
FROM (SELECT store_id, item_id, year, sum(CASE WHEN month IN (10, 11, 12) THEN quantity END) AS season_qty,
             sum(quantity) AS year_qty FROM panel WHERE year BETWEEN 1996 AND 1999 GROUP BY ALL) g""",
    ["season_qty", "year_qty", "season_share", "season_yoy"])))
def p14_season_share(spark, sf):
    return rounded(monthly.season_share(panel(spark, sf), HZ))


@register("p15_breakdown_category", _sql(
    "SELECT category, avg(adjusted_qty) AS mean_qty, stddev_pop(adjusted_qty) AS std_qty FROM ADJ GROUP BY category",
    ["mean_qty", "std_qty"]))
def p15_breakdown_category(spark, sf):
    p = panel(spark, sf)
    by_cat, _ = monthly.forecast_breakdown(monthly.daily_plan(p, HZ), p, HZ)
    return rounded(by_cat)


@register("p15_breakdown_store", _sql("""
SELECT f.store_id, f.forecast_total, l.last_year_total, (f.forecast_total / nullif(l.last_year_total, 0) - 1) * 100 AS growth_pct
FROM (SELECT store_id, sum(adjusted_qty) AS forecast_total FROM ADJ GROUP BY store_id) f
LEFT JOIN (SELECT store_id, sum(quantity) AS last_year_total FROM panel WHERE year = 1999 GROUP BY store_id) l
USING (store_id)""", ["forecast_total", "last_year_total", "growth_pct"]))
def p15_breakdown_store(spark, sf):
    p = panel(spark, sf)
    _, by_store = monthly.forecast_breakdown(monthly.daily_plan(p, HZ), p, HZ)
    return rounded(by_store)


@register("p16_method_comparison", _sql("""
, cm AS (SELECT category, month, day_of_week_num, avg(quantity) AS c FROM panel WHERE date < DATE '2000-10-01' GROUP BY ALL),
j AS (SELECT a.quantity, coalesce(d.adjusted_qty, 0.0) AS plan, coalesce(n.quantity, cm.c, 0.0) AS naive
        FROM (SELECT * FROM panel WHERE date >= DATE '2000-10-01') a
        LEFT JOIN ADJ d ON d.store_id = a.store_id AND d.item_id = a.item_id AND d.date = a.date
        LEFT JOIN panel n ON n.store_id = a.store_id AND n.item_id = a.item_id AND n.date = CAST(a.date - INTERVAL 365 DAY AS DATE)
        LEFT JOIN cm ON cm.category = a.category AND cm.month = a.month AND cm.day_of_week_num = a.day_of_week_num)
SELECT round(sum(abs(quantity - plan)) / sum(quantity), 6) AS plan_wmape,
       round(sum(abs(quantity - naive)) / sum(quantity), 6) AS naive_wmape
FROM j WHERE quantity IS NOT NULL"""))
def p16_method_comparison(spark, sf):
    p = panel(spark, sf)
    return rounded(monthly.method_comparison(monthly.daily_plan(p, HZ), p, HZ))
