"""Report queries R1-R12, coverage U2, correlations A17/A18, sources S1/S3."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tillcast.catalog.queries_core import PANEL_COLS, panel, prepared
from tillcast.catalog.queries_features import features
from tillcast.catalog.queries_forecast import _fc
from tillcast.catalog.registry import register, rounded, sql_round
from tillcast.catalog.sqlbase import with_panel
from tillcast.catalog.sqlfeatures import features_cte
from tillcast.catalog.sqlforecast import forecast_cte
from tillcast.horizon import DEFAULT as HZ
from tillcast.operators import grain, sketch
from tillcast.operators.features import DRIVER_CATALOG as CAT
from tillcast.operators.prep import train_slice
from tillcast.plans import reports
from tillcast.session import ensure_checkpoint_dir, stage
from tillcast.sources import readers


@register("r1_dataset_profile", with_panel("""
SELECT count(*) AS rows, min(date) AS first_date, max(date) AS last_date, count(DISTINCT store_id) AS stores,
       count(DISTINCT item_id) AS items, count(DISTINCT category) AS categories,
       count(*) FILTER (WHERE quantity IS NULL) AS null_qty,
       round(avg(CASE WHEN quantity IS NULL THEN 1.0 ELSE 0.0 END), 6) AS null_rate FROM panel"""))
def r1_dataset_profile(spark, sf):
    return rounded(reports.dataset_profile(panel(spark, sf)))


@register("r2_monthly_mean", with_panel("""
SELECT CAST(date_trunc('month', date) AS DATE) AS month_start, round(avg(quantity), 6) AS mean_qty
FROM panel GROUP BY 1"""))
def r2_monthly_mean(spark, sf):
    return rounded(grain.monthly_mean(panel(spark, sf)))


@register("r3_category_share_test", with_panel("""
, s AS (SELECT category, sum(quantity) AS volume FROM panel WHERE date >= DATE '2000-10-01' GROUP BY category)
SELECT category, round(volume, 6) AS volume, round(volume / (SELECT sum(volume) FROM s) * 100, 6) AS share_pct FROM s"""))
def r3_category_share_test(spark, sf):
    return rounded(reports.category_share(panel(spark, sf), F.col("date") >= F.lit(HZ.test_start)))


_BINS = [("(0, 32]", 0, 32), ("(32, 50]", 32, 50), ("(50, 70]", 50, 70), ("(70, 120]", 70, 120)]
_BIN_SQL = " ".join(f"WHEN avg_temp_f > {lo} AND avg_temp_f <= {hi} THEN '{lab}'" for lab, lo, hi in _BINS)
_PIV = ", ".join(f"avg(CASE WHEN b = '{lab}' THEN quantity END) AS c{k}" for k, (lab, _, _) in enumerate(_BINS))
_DEV = ", ".join(
    f"round((c{k} / (({' + '.join(f'coalesce(c{j}, 0.0)' for j in range(len(_BINS)))}) / "
    f"({' + '.join(f'(CASE WHEN c{j} IS NOT NULL THEN 1 ELSE 0 END)' for j in range(len(_BINS)))})) - 1) * 100, 6) AS \"{lab}\""
    for k, (lab, _, _) in enumerate(_BINS))


@register("r4_temperature_sensitivity", with_panel(f"""
, bb AS (SELECT *, CASE {_BIN_SQL} END AS b FROM panel),
pv AS (SELECT category, {_PIV} FROM bb WHERE b IS NOT NULL GROUP BY category)
SELECT category, {_DEV} FROM pv"""))
def r4_temperature_sensitivity(spark, sf):
    return rounded(reports.temperature_sensitivity(panel(spark, sf)))


@register("r5_holiday_impact", with_panel("""
SELECT holiday_name, round(avg(quantity), 6) AS mean_qty,
       round((avg(quantity) / (SELECT avg(quantity) FROM panel WHERE is_holiday = 0) - 1) * 100, 6) AS impact_pct
FROM panel WHERE is_holiday = 1 AND holiday_name IS NOT NULL GROUP BY holiday_name"""))
def r5_holiday_impact(spark, sf):
    return rounded(reports.holiday_impact(panel(spark, sf)))


@register("r5_holiday_impact_named", with_panel("""
SELECT holiday_name, round(avg(quantity), 6) AS mean_qty,
       round((avg(quantity) / (SELECT avg(quantity) FROM panel WHERE is_holiday = 0) - 1) * 100, 6) AS impact_pct
FROM panel WHERE is_holiday = 1 AND holiday_name IN ('Thanksgiving Day', 'Christmas Day', 'Independence Day')
GROUP BY holiday_name"""))
def r5_holiday_impact_named(spark, sf):
    return rounded(reports.holiday_impact(panel(spark, sf), ["Thanksgiving Day", "Christmas Day", "Independence Day"]))


@register("r6_event_lift", with_panel("""
SELECT special_event_name, round(avg(quantity_filled), 6) AS mean_qty, count(DISTINCT date) AS days,
       round((avg(quantity_filled) / (SELECT avg(quantity_filled) FROM train WHERE is_special_event = 0) - 1) * 100, 6) AS lift_pct
FROM train WHERE is_special_event = 1 AND special_event_name IS NOT NULL GROUP BY 1"""))
def r6_event_lift(spark, sf):
    return rounded(reports.event_lift(train_slice(prepared(spark, sf), HZ)))


@register("u2_unseen_events", with_panel("""
SELECT DISTINCT special_event_name FROM panel WHERE date >= DATE '2000-10-01' AND special_event_name IS NOT NULL
EXCEPT SELECT DISTINCT special_event_name FROM panel WHERE date < DATE '2000-10-01' AND special_event_name IS NOT NULL"""))
def u2_unseen_events(spark, sf):
    return reports.unseen_levels(panel(spark, sf), "special_event_name", HZ)


@register("u2_unseen_items", with_panel("""
SELECT DISTINCT item_id FROM panel WHERE date >= DATE '2000-10-01'
EXCEPT SELECT DISTINCT item_id FROM panel WHERE date < DATE '2000-10-01'"""))
def u2_unseen_items(spark, sf):
    return reports.unseen_levels(panel(spark, sf), "item_id", HZ)


@register("u2_unseen_cells", with_panel("""
SELECT DISTINCT store_id, item_id, month, day_of_week_num FROM panel WHERE date >= DATE '2000-10-01'
EXCEPT SELECT DISTINCT store_id, item_id, month, day_of_week_num FROM panel WHERE date < DATE '2000-10-01'"""))
def u2_unseen_cells(spark, sf):
    """Cells of the structural mean that test rows ask for and training never filled."""
    return reports.unseen_levels(panel(spark, sf), ["store_id", "item_id", "month", "day_of_week_num"], HZ)


_LEVELS = ["date", "store_id", "item_id", "category", "holiday_name"]


@register("a6_distinct_counts", with_panel("SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS distinct_values, true AS sketch_within_bound FROM panel" for c in _LEVELS) + ") x"))
def a6_distinct_counts(spark, sf):
    """Exact distinct counts, and whether sketches by store, merged, are within five standard errors of them."""
    p = stage(panel(spark, sf).select(*_LEVELS, F.col("store_id").alias("__s")))
    near = stage(sketch.distinct_estimates(sketch.distinct_sketches(p, _LEVELS, ["__s"]), _LEVELS))
    both = sketch.distinct_exact(p, _LEVELS).withColumns({f"__{c}": near.select(c).scalar() for c in _LEVELS})
    bound = 5 * sketch.sketch_error()
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("distinct_values"),
                              (F.abs(F.col(f"__{c}") - F.col(c)) <= bound * F.col(c)).alias("sketch_within_bound")) for c in _LEVELS])
    return both.select(F.explode(rows).alias("r")).select("r.*")


@register("r7_event_coverage", with_panel(features_cte(CAT) + """
, tst AS (SELECT * FROM FEATS WHERE date >= DATE '2000-10-01' AND special_event_name IS NOT NULL),
uns AS (SELECT DISTINCT special_event_name FROM tst
        EXCEPT SELECT DISTINCT special_event_name FROM FEATS WHERE date < DATE '2000-10-01' AND special_event_name IS NOT NULL)
SELECT special_event_name, round(max(event_mult), 6) AS event_mult, count(DISTINCT date) AS test_days,
       special_event_name IN (SELECT special_event_name FROM uns) AS unseen_in_training
FROM tst GROUP BY special_event_name"""))
def r7_event_coverage(spark, sf):
    return rounded(reports.event_coverage(features(spark, sf), HZ))


_AUDIT = ["lag_7", "lag_14", "lag_364", "lag_365", "lag_728", "lag_7_filled", "lag_14_filled",
          "rolling_mean_28", "struct_rimdow", "yoy_ratio", "price_vs_cat_avg"]


@register("r8_test_null_audit", with_panel(features_cte(CAT) + """
, st AS (SELECT count(*) AS n, """ + ", ".join(f"count(*) FILTER (WHERE {c} IS NULL) AS n_{c}" for c in _AUDIT) + """
         FROM FEATS WHERE date >= DATE '2000-10-01')
SELECT * FROM (""" + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", n AS rows, n_{c} AS nulls, round(n_{c} / n, 6) AS null_rate FROM st" for c in _AUDIT)
    + ") x WHERE nulls > 0"))
def r8_test_null_audit(spark, sf):
    from tillcast.operators.prep import null_audit
    f = features(spark, sf)
    return rounded(null_audit(f, _AUDIT, F.col("date") >= F.lit(HZ.test_start), only_nonzero=True))


@register("w7_lag_null_rates_test", with_panel(features_cte(CAT) + """
SELECT round(avg(CASE WHEN lag_7 IS NULL THEN 1.0 ELSE 0.0 END), 6) AS lag_7_null_rate,
       round(avg(CASE WHEN lag_14 IS NULL THEN 1.0 ELSE 0.0 END), 6) AS lag_14_null_rate,
       round(avg(CASE WHEN lag_7_filled IS NULL THEN 1.0 ELSE 0.0 END), 6) AS lag_7_filled_null_rate,
       round(avg(CASE WHEN lag_14_filled IS NULL THEN 1.0 ELSE 0.0 END), 6) AS lag_14_filled_null_rate
FROM FEATS WHERE date >= DATE '2000-10-01'"""))
def w7_lag_null_rates_test(spark, sf):
    f = features(spark, sf).where(F.col("date") >= F.lit(HZ.test_start))
    rate = lambda c: F.avg(F.col(c).isNull().cast("double")).alias(f"{c}_null_rate")
    return rounded(f.agg(rate("lag_7"), rate("lag_14"), rate("lag_7_filled"), rate("lag_14_filled")))


@register("r10_prediction_distribution", with_panel(features_cte(CAT) + forecast_cte() + """
, tdist AS (SELECT raw_prediction AS raw, greatest(raw_prediction, 0.0) AS predicted FROM PRED WHERE split = 'test')
SELECT round(min(raw), 6) AS min_raw, round(avg(raw), 6) AS mean_raw, round(avg(predicted), 6) AS mean_clipped,
       round(median(predicted), 6) AS median, round(max(predicted), 6) AS max, count(*) FILTER (WHERE raw < 0) AS clipped_rows
FROM tdist"""))
def r10_prediction_distribution(spark, sf):
    from tillcast.operators.ensemble import clip_report
    out, _, _ = _fc(spark, sf)
    return rounded(clip_report(out.where(F.col("split") == "test"), "raw_prediction"))


@register("r11_sample_series", with_panel(features_cte(CAT) + forecast_cte() + """
SELECT date, store_id, item_id, round(quantity, 6) AS quantity, round(predicted, 6) AS predicted FROM PRED
WHERE split = 'test' AND (store_id, item_id) = (
  SELECT (store_id, item_id) FROM PRED WHERE split = 'test' ORDER BY store_id, item_id LIMIT 1)"""))
def r11_sample_series(spark, sf):
    out, _, _ = _fc(spark, sf)
    return rounded(reports.sample_series(out.where(F.col("split") == "test")))


@register("r12_elasticity_ranking", with_panel("""
SELECT category, round(regr_slope(quantity_filled, avg_temp_f) / avg(quantity_filled), 6) AS elasticity,
       round(regr_slope(quantity_filled, avg_temp_f) / avg(quantity_filled) * 1000, 6) AS pct_per_10f
FROM train GROUP BY category HAVING count(*) > 100"""))
def r12_elasticity_ranking(spark, sf):
    return rounded(reports.elasticity_ranking(train_slice(prepared(spark, sf), HZ)))


@register("r12_store_growth_top5", with_panel("""
, g0 AS (SELECT store_id, avg(CASE WHEN year = 1996 THEN quantity_filled END) AS q0,
                avg(CASE WHEN year = 1999 THEN quantity_filled END) AS q1 FROM train GROUP BY store_id),
g1 AS (SELECT store_id, CASE WHEN q0 > 0 THEN pow(q1 / q0, 1.0 / 3) ELSE 1.0 END AS g FROM g0),
g2 AS (SELECT store_id, g / (SELECT avg(g) FROM g1) AS store_growth_mult FROM g1)
SELECT store_id, round(store_growth_mult, 6) AS store_growth_mult FROM g2
ORDER BY store_growth_mult DESC NULLS LAST, store_id LIMIT 5"""))
def r12_store_growth_top5(spark, sf):
    return rounded(reports.store_cagr_top(train_slice(prepared(spark, sf), HZ), HZ, 5))


@register("r12_promo_ranking", with_panel("""
SELECT category, round((avg(CASE WHEN is_promotion = 1 THEN quantity_filled END)
                        / avg(CASE WHEN is_promotion = 0 THEN quantity_filled END) - 1) * 100, 6) AS promo_lift_pct
FROM train GROUP BY category HAVING avg(CASE WHEN is_promotion = 0 THEN quantity_filled END) > 0"""))
def r12_promo_ranking(spark, sf):
    return rounded(reports.promo_ranking(train_slice(prepared(spark, sf), HZ)))


@register("a17_store_vs_city_corr", with_panel("""
, d AS (SELECT city, store_id, date, sum(quantity) AS own FROM panel GROUP BY ALL),
r AS (SELECT *, sum(own) OVER (PARTITION BY city, date) - own AS rest FROM d)
SELECT city, store_id, round(corr(own, rest), 6) AS corr_vs_rest, count(*) AS days FROM r GROUP BY ALL"""))
def a17_store_vs_city_corr(spark, sf):
    return rounded(reports.member_vs_rest_corr(panel(spark, sf), "store_id", "city"))


@register("a17_item_vs_category_corr", with_panel("""
, d AS (SELECT category, item_id, date, sum(quantity) AS own FROM panel GROUP BY ALL),
r AS (SELECT *, sum(own) OVER (PARTITION BY category, date) - own AS rest FROM d)
SELECT category, item_id, round(corr(own, rest), 6) AS corr_vs_rest, count(*) AS days FROM r GROUP BY ALL"""))
def a17_item_vs_category_corr(spark, sf):
    return rounded(reports.member_vs_rest_corr(panel(spark, sf), "item_id", "category"))


_PAIRS = list(CAT.combos)
_PAIR_ITEMS = sorted({i for pr in _PAIRS for i in pr})


@register("a17_combo_component_corr", with_panel("""
, c AS (SELECT store_id, date, """ + ", ".join(
    f"sum(CASE WHEN item_id = '{it}' THEN quantity END) AS q{k}" for k, it in enumerate(_PAIR_ITEMS)) + """
        FROM panel WHERE item_id IN (""" + ", ".join(f"'{it}'" for it in _PAIR_ITEMS) + """) GROUP BY ALL)
SELECT * FROM (""" + " UNION ALL ".join(
    f"SELECT '{a}' AS item_a, '{b}' AS item_b, round(corr(q{_PAIR_ITEMS.index(a)}, q{_PAIR_ITEMS.index(b)}), 6) AS corr, "
    f"count(q{_PAIR_ITEMS.index(a)} * q{_PAIR_ITEMS.index(b)}) AS cells FROM c" for a, b in _PAIRS) + ") x"))
def a17_combo_component_corr(spark, sf):
    return rounded(reports.pair_corr(panel(spark, sf), _PAIRS))


@register("a18_structural_r2_event_corr", with_panel(features_cte(CAT) + """
, s AS (SELECT * FROM FEATS WHERE date < DATE '2000-10-01' AND quantity_filled IS NOT NULL AND struct_rimdow IS NOT NULL)
SELECT round(1 - sum((quantity_filled - struct_rimdow) ^ 2)
                 / sum((quantity_filled - (SELECT avg(quantity_filled) FROM s)) ^ 2), 6) AS r2,
       round(corr(CAST(is_special_event AS DOUBLE), quantity_filled - struct_rimdow), 6) AS flag_residual_corr
FROM s"""))
def a18_structural_r2_event_corr(spark, sf):
    f = features(spark, sf).where(F.col("date") < F.lit(HZ.test_start))
    return rounded(reports.explained(f, "quantity_filled", "struct_rimdow", flag="is_special_event"))


def _scratch(spark, name: str) -> str:
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


@register("s1_csv_roundtrip", with_panel(sql_round("SELECT * FROM panel",
                                                    ["quantity", "unit_price", "avg_temp_f", "precip_inches"])))
def s1_csv_roundtrip(spark, sf):
    """Write the panel as header CSV (NULL as the text 'None'), read it back
    through the token-normalising reader."""
    path = _scratch(spark, "panel-csv")
    panel(spark, sf).select(*PANEL_COLS).write.option("header", True).option("nullValue", "None").csv(path)
    return rounded(readers.read_panel_csv(spark, path))


@register("s3_parquet_source", with_panel(sql_round("SELECT * FROM panel",
                                                     ["quantity", "unit_price", "avg_temp_f", "precip_inches"])))
def s3_parquet_source(spark, sf):
    """S3: the panel written as Parquet partitioned by year (pruning on later date filters)
    and read back through the generic reader."""
    path = _scratch(spark, "panel-parquet")
    panel(spark, sf).write.partitionBy("year").parquet(path)
    return rounded(readers.read_panel(spark, path, "parquet").select(*PANEL_COLS))
