"""Sources, preparation and the minimum end-to-end slice."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillcast.catalog.registry import register, rounded, sql_round
from tillcast.catalog.sqlbase import with_dense, with_panel
from tillcast.horizon import DEFAULT as HZ
from tillcast.operators import grain, metrics, prep
from tillcast.schema import DOW
from tillcast.sources import star

PANEL_COLS = ["date", "store_id", "item_id", "city", "state", "category", "quantity", "unit_price",
              "year", "month", "day_of_week_num", "is_weekend", "is_holiday", "is_special_event",
              "is_promotion", "holiday_name", "special_event_name", "precip_type", "avg_temp_f",
              "precip_inches"]


def panel(spark, sf):
    return star.panel_from_star(spark, sf, HZ)


def prepared(spark, sf):
    return prep.prepare(panel(spark, sf), HZ)


@register("s4_panel", with_panel(sql_round("SELECT * FROM panel", ["quantity", "unit_price", "avg_temp_f", "precip_inches"])))
def s4_panel(spark, sf):
    return rounded(panel(spark, sf))


@register("s4_panel_dense", with_dense(sql_round(
    "SELECT store_id, item_id, date, quantity, year, month, day_of_week_num FROM dense", ["quantity"])))
def s4_panel_dense(spark, sf):
    return rounded(star.panel_dense(spark, sf, HZ))


@register("f9_impute_weekday_mean", with_panel(sql_round(
    "SELECT store_id, item_id, date, quantity, quantity_filled FROM prep", ["quantity", "quantity_filled"])))
def f9_impute_weekday_mean(spark, sf):
    return rounded(prepared(spark, sf).select("store_id", "item_id", "date", "quantity", "quantity_filled"))


def structural_forecast(p):
    """Minimum slice: yhat = mean by (store,item,month,dow), fallback (category,month,dow)."""
    fit = prep.in_fit(HZ)
    rimdow = grain.window_mean(["store_id", "item_id", "month", DOW], "quantity_filled", fit)
    t = prep.train_slice(p, HZ)
    cmdow = grain.group_mean(t, ["category", "month", DOW], "quantity_filled", "struct_cmdow")
    p = p.withColumn("struct_rimdow", rimdow)
    p = grain.lookup_left(p, cmdow, ["category", "month", DOW])
    return p.withColumn("predicted", F.coalesce("struct_rimdow", "struct_cmdow"))


MIN_SLICE_SQL = with_panel("""
, rimdow AS (SELECT store_id, item_id, month, day_of_week_num, avg(quantity_filled) AS s1 FROM train GROUP BY ALL),
cmdow AS (SELECT category, month, day_of_week_num, avg(quantity_filled) AS s2 FROM train GROUP BY ALL),
fc AS (SELECT p.*, coalesce(r.s1, c.s2) AS predicted FROM prep p
       LEFT JOIN rimdow r USING (store_id, item_id, month, day_of_week_num)
       LEFT JOIN cmdow c USING (category, month, day_of_week_num))
SELECT category, count(*) AS rows,
       round(sum(CASE WHEN quantity > 0 THEN abs(quantity - predicted) END)
             / sum(CASE WHEN quantity > 0 THEN quantity END), 6) AS wmape
FROM fc WHERE date >= DATE '2000-10-01' AND date <= DATE '2000-12-31' GROUP BY category
""")


@register("m12_structural_wmape_by_category", MIN_SLICE_SQL)
def m12_structural_wmape_by_category(spark, sf):
    fc = structural_forecast(prepared(spark, sf))
    test = fc.where((F.col("date") >= F.lit(HZ.test_start)) & (F.col("date") <= F.lit(HZ.test_end)))
    out = test.groupBy("category").agg(F.count(F.lit(1)).alias("rows"),
                                       metrics.wmape_expr("quantity", "predicted").alias("wmape"))
    return rounded(out)
