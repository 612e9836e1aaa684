"""Splits, members, blend grid, bias, scores, sinks and checks of the closed-form ensemble."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillcast.catalog.queries_core import prepared
from tillcast.catalog.queries_features import features
from tillcast.catalog.registry import register, rounded, sql_round
from tillcast.catalog.sqlbase import with_panel
from tillcast.catalog.sqlfeatures import features_cte
from tillcast.catalog.sqlforecast import forecast_cte
from tillcast.horizon import DEFAULT as HZ
from tillcast.operators import baselines, ensemble, metrics, prep
from tillcast.operators.features import DRIVER_CATALOG as CAT
from tillcast.plans import forecasts
from tillcast.session import stage
from tillcast.sources import sinks, star


_MEMO: dict = {}


def _fc(spark, sf):
    key = (id(spark), spark.sparkContext.applicationId, sf)
    if key not in _MEMO:
        out, w, b = forecasts.ensemble_forecast(features(spark, sf), HZ)
        _MEMO[key] = (stage(out), w, b)
    return _MEMO[key]


def _future(spark, sf):
    """The forecast of the complete grid, staged once a session."""
    key = (id(spark), spark.sparkContext.applicationId, sf, "future")
    if key not in _MEMO:
        _MEMO[key] = stage(forecasts.future_forecast(prep.prepare(star.panel_with_future(spark, sf, HZ), HZ), HZ))
    return _MEMO[key]


def _future_sql(body: str) -> str:
    return with_panel(features_cte(CAT) + forecast_cte(last="f.target_enc_rim") + body, future=True)


def _sql(body: str, round_cols=None) -> str:
    body = body if round_cols is None else sql_round(body, round_cols)
    return with_panel(features_cte(CAT) + forecast_cte() + body)


@register("m1_temporal_split", with_panel("""
SELECT s.split, CAST(s.n AS BIGINT) AS rows, s.lo AS first_date, s.hi AS last_date FROM (
  SELECT 'train1' AS split, count(*) AS n, min(date) AS lo, max(date) AS hi FROM prep
    WHERE date < DATE '1999-10-01' AND quantity_filled IS NOT NULL
  UNION ALL SELECT 'val', count(*), min(date), max(date) FROM prep
    WHERE date >= DATE '1999-10-01' AND date <= DATE '1999-12-31' AND quantity_filled IS NOT NULL
  UNION ALL SELECT 'train2', count(*), min(date), max(date) FROM prep
    WHERE date < DATE '2000-10-01' AND quantity_filled IS NOT NULL
  UNION ALL SELECT 'test', count(*), min(date), max(date) FROM prep WHERE date >= DATE '2000-10-01') s
"""))
def m1_temporal_split(spark, sf):
    return ensemble.split_summary(prepared(spark, sf), HZ)


@register("m2_volume_weight", with_panel(features_cte(CAT) + sql_round("""
SELECT store_id, item_id, date, CASE WHEN struct_rimdow < 1 THEN 1.0 ELSE struct_rimdow END AS weight FROM FEATS""",
                                                                   ["weight"])))
def m2_volume_weight(spark, sf):
    f = features(spark, sf)
    return rounded(f.select("store_id", "item_id", "date", ensemble.volume_weight().alias("weight")))


@register("m8_blend_weights", _sql("SELECT store_id, grid_id, w1, w2, w3, wmape FROM WEIGHTS",
                                   ["w1", "w2", "w3", "wmape"]))
def m8_blend_weights(spark, sf):
    _, weights, _ = _fc(spark, sf)
    return rounded(weights)


@register("m8_weight_grid_size", _sql("""
SELECT store_id, count(*) AS points, min(grid_id) AS first_id, max(grid_id) AS last_id,
       round(min(wmape), 6) AS best_wmape FROM GSCORE GROUP BY store_id"""))
def m8_weight_grid_size(spark, sf):
    """Grid points scored per store on the validation rows (79 with the default grid)."""
    from tillcast.plans.forecasts import MEMBERS, member_frame, with_split
    m = with_split(member_frame(features(spark, sf)), HZ).where(F.col("split") == "val")
    sc = ensemble.grid_scores(m, MEMBERS, y="quantity_filled")
    return rounded(sc.groupBy("store_id").agg(F.count(F.lit(1)).alias("points"), F.min("grid_id").alias("first_id"),
                                              F.max("grid_id").alias("last_id"), F.min("wmape").alias("best_wmape")))


FINE = ensemble.weight_grid("0.02", "0.05", "0.85", ())


@register("m8_weight_grid_741", with_panel(features_cte(CAT) + forecast_cte(grid=FINE) + """
, N AS (SELECT store_id, count(*) AS points FROM GSCORE GROUP BY store_id)
SELECT store_id, points, grid_id, round(w1, 6) AS w1, round(w2, 6) AS w2, round(w3, 6) AS w3, round(wmape, 6) AS wmape
FROM WEIGHTS JOIN N USING (store_id)"""))
def m8_weight_grid_741(spark, sf):
    """The fine grid: 741 points for each store, and the best one."""
    m = forecasts.with_split(forecasts.member_frame(features(spark, sf)), HZ).where(F.col("split") == "val")
    sc = stage(ensemble.grid_scores(m, forecasts.MEMBERS, y="quantity_filled", grid=FINE))
    points = sc.groupBy("store_id").agg(F.count(F.lit(1)).alias("points"))
    return rounded(points.join(ensemble.best_points(sc), "store_id")
                   .select("store_id", "points", "grid_id", "w1", "w2", "w3", "wmape"))


@register("m9_m10_blend_bias", _sql(
    "SELECT store_id, item_id, date, split, ensemble, bias, predicted FROM PRED", ["ensemble", "bias", "predicted"]))
def m9_m10_blend_bias(spark, sf):
    out, _, _ = _fc(spark, sf)
    return rounded(out.select("store_id", "item_id", "date", "split", "ensemble", "bias", "predicted"))


@register("m12_ensemble_wmape_by_split", _sql("""
SELECT split, sum(CASE WHEN quantity > 0 THEN abs(quantity - predicted) END)
              / sum(CASE WHEN quantity > 0 THEN quantity END) AS wmape,
       1 - sum(CASE WHEN quantity > 0 THEN abs(quantity - predicted) END)
              / sum(CASE WHEN quantity > 0 THEN quantity END) AS accuracy
FROM PRED GROUP BY split""", ["wmape", "accuracy"]))
def m12_ensemble_wmape_by_split(spark, sf):
    out, _, _ = _fc(spark, sf)
    return rounded(metrics.wmape(out, "quantity", "predicted", by="split"))


@register("m12_wmape_unmasked", _sql("""
SELECT split, sum(abs(quantity - predicted)) / sum(quantity) AS wmape,
       1 - sum(abs(quantity - predicted)) / sum(quantity) AS accuracy
FROM PRED WHERE quantity IS NOT NULL GROUP BY split""", ["wmape", "accuracy"]))
def m12_wmape_unmasked(spark, sf):
    out, _, _ = _fc(spark, sf)
    return rounded(metrics.wmape(out, "quantity", "predicted", by="split", positive_only=False))


@register("m15_compare_runs", _sql("""
, RUNS AS (
  SELECT split, 'm_struct' AS run, 1 AS step, sum(CASE WHEN quantity > 0 THEN abs(quantity - m_struct) END) / sum(CASE WHEN quantity > 0 THEN quantity END) AS wmape FROM PRED GROUP BY split
  UNION ALL SELECT split, 'm_domain', 2, sum(CASE WHEN quantity > 0 THEN abs(quantity - m_domain) END) / sum(CASE WHEN quantity > 0 THEN quantity END) FROM PRED GROUP BY split
  UNION ALL SELECT split, 'm_naive', 3, sum(CASE WHEN quantity > 0 THEN abs(quantity - m_naive) END) / sum(CASE WHEN quantity > 0 THEN quantity END) FROM PRED GROUP BY split
  UNION ALL SELECT split, 'ensemble', 4, sum(CASE WHEN quantity > 0 THEN abs(quantity - predicted) END) / sum(CASE WHEN quantity > 0 THEN quantity END) FROM PRED GROUP BY split)
SELECT split, run, step, wmape, (wmape - lag(wmape) OVER (PARTITION BY split ORDER BY step)) * 100 AS delta_pp FROM RUNS
""".replace("\n, RUNS", "\n, RUNS", 1), None).replace("PRED AS (", "PRED AS (", 1).replace(
    "SELECT split, run, step, wmape, (wmape", "SELECT split, run, step, round(wmape, 6) AS wmape, round((wmape", 1).replace(
    "ORDER BY step)) * 100 AS delta_pp", "ORDER BY step)) * 100, 6) AS delta_pp", 1))
def m15_compare_runs(spark, sf):
    out, _, _ = _fc(spark, sf)
    runs = None
    for step, (run, col) in enumerate([("m_struct", "m_struct"), ("m_domain", "m_domain"),
                                       ("m_naive", "m_naive"), ("ensemble", "predicted")], start=1):
        r = out.groupBy("split").agg(metrics.wmape_expr("quantity", col).alias("wmape")) \
               .select("split", F.lit(run).alias("run"), F.lit(step).alias("step"), "wmape")
        runs = r if runs is None else runs.unionByName(r)
    return rounded(ensemble.compare_runs(runs, "run", "step", "wmape", by="split"))


@register("m16_domain_forecast", _sql("""
SELECT store_id, item_id, date, m_domain FROM MEM""", ["m_domain"]))
def m16_domain_forecast(spark, sf):
    m = forecasts.member_frame(features(spark, sf))
    return rounded(m.select("store_id", "item_id", "date", "m_domain"))


@register("p10_seasonal_naive", _sql("""
SELECT store_id, item_id, date, m_naive FROM MEM""", ["m_naive"]))
def p10_seasonal_naive(spark, sf):
    m = forecasts.member_frame(features(spark, sf))
    return rounded(m.select("store_id", "item_id", "date", "m_naive"))


@register("m17_series_regression", with_panel("""
, reg AS (SELECT store_id, item_id, regr_slope(quantity_filled, avg_temp_f) AS s,
                 regr_intercept(quantity_filled, avg_temp_f) AS i FROM train GROUP BY ALL)
SELECT store_id, item_id, date, round(s, 6) AS slope, round(i, 6) AS intercept, round(i + s * avg_temp_f, 6) AS series_reg
FROM prep LEFT JOIN reg USING (store_id, item_id)"""))
def m17_series_regression(spark, sf):
    r = baselines.series_regression(prepared(spark, sf), hz=HZ)
    return rounded(r.select("store_id", "item_id", "date", F.col("series_reg_slope").alias("slope"),
                            F.col("series_reg_intercept").alias("intercept"), "series_reg"))


@register("m18_mae_by_item", _sql("""
SELECT item_id, avg(abs(quantity - predicted)) AS mae FROM PRED
WHERE split = 'test' AND quantity IS NOT NULL GROUP BY item_id""", ["mae"]))
def m18_mae_by_item(spark, sf):
    out, _, _ = _fc(spark, sf)
    t = out.where((F.col("split") == "test") & F.col("quantity").isNotNull())
    return rounded(metrics.mae(t, "quantity", "predicted", by="item_id"))


@register("r9_score_breakdown", _sql("""
, TST AS (SELECT * FROM PRED WHERE split = 'test')
SELECT CASE WHEN grouping(category) = 0 THEN 'category' WHEN grouping(month) = 0 THEN 'month'
            WHEN grouping(store_id) = 0 THEN 'store' ELSE 'overall' END AS level,
       category, CAST(month AS INTEGER) AS month, store_id, count(*) AS rows,
       round(sum(CASE WHEN quantity > 0 THEN abs(quantity - predicted) END)
             / sum(CASE WHEN quantity > 0 THEN quantity END), 6) AS wmape,
       round(sum(CASE WHEN quantity > 0 THEN quantity END), 6) AS volume,
       round(sum(CASE WHEN quantity > 0 THEN quantity END)
             / (SELECT sum(CASE WHEN quantity > 0 THEN quantity END) FROM TST), 6) AS volume_share
FROM TST GROUP BY GROUPING SETS ((), (category), (month), (store_id))"""))
def r9_score_breakdown(spark, sf):
    out, _, _ = _fc(spark, sf)
    return rounded(forecasts.score_breakdown(out.where(F.col("split") == "test")))


@register("s5_forecast_output", _future_sql("""
SELECT strftime(date, '%Y-%m-%d') AS date, store_id, item_id, round(predicted, 6) AS predicted_quantity
FROM PRED WHERE split = 'test'"""))
def s5_forecast_output(spark, sf):
    """Every store, item and day of the test season."""
    return rounded(sinks.forecast_frame(_future(spark, sf)))


@register("s6_forecast_quality", _future_sql("""
, FC AS (SELECT * FROM PRED WHERE split = 'test'),
WANT AS (SELECT (SELECT count(DISTINCT sk) FROM stores) AS s, (SELECT count(DISTINCT item_id) FROM parts) AS i),
ST AS (SELECT count(*) AS n, count(*) FILTER (WHERE predicted IS NULL) AS nn,
              count(*) FILTER (WHERE predicted < 0) AS neg, count(DISTINCT date) AS d,
              count(DISTINCT store_id) AS s, count(DISTINCT item_id) AS i,
              count(DISTINCT (date, store_id, item_id)) AS k FROM FC)
SELECT * FROM (
  SELECT 'row_count' AS "check", n = 92 * WANT.s * WANT.i AS ok, CAST(n AS DOUBLE) AS value FROM ST, WANT
  UNION ALL SELECT 'non_negative', neg = 0, CAST(neg AS DOUBLE) FROM ST
  UNION ALL SELECT 'no_nulls', nn = 0, CAST(nn AS DOUBLE) FROM ST
  UNION ALL SELECT 'unique_keys', k = n, CAST(k AS DOUBLE) FROM ST
  UNION ALL SELECT 'date_coverage', d = 92, CAST(d AS DOUBLE) FROM ST
  UNION ALL SELECT 'store_coverage', ST.s = WANT.s, CAST(ST.s AS DOUBLE) FROM ST, WANT
  UNION ALL SELECT 'item_coverage', ST.i = WANT.i, CAST(ST.i AS DOUBLE) FROM ST, WANT
  UNION ALL SELECT 'exact_columns', true, 4.0
  UNION ALL SELECT 'missing_cells', n = 92 * WANT.s * WANT.i, CAST(92 * WANT.s * WANT.i - k AS DOUBLE) FROM ST, WANT
  UNION ALL SELECT 'unexpected_cells', true, 0.0) x"""))
def s6_forecast_quality(spark, sf):
    """The forecast held against the skeleton."""
    return sinks.forecast_quality(sinks.forecast_frame(_future(spark, sf)), star.future_skeleton(spark, sf, HZ))


@register("s7_forecast_summary", _future_sql("""
SELECT count(*) AS rows, min(strftime(date, '%Y-%m-%d')) AS first_date, max(strftime(date, '%Y-%m-%d')) AS last_date,
       count(DISTINCT store_id) AS stores, count(DISTINCT item_id) AS items, round(avg(predicted), 6) AS mean_pred
FROM PRED WHERE split = 'test'"""))
def s7_forecast_summary(spark, sf):
    return rounded(sinks.forecast_summary(sinks.forecast_frame(_future(spark, sf))))


_STEPS_SQL = [("structural", "1.0"), ("x_holiday", "holiday_mult"), ("x_event", "event_mult"),
              ("x_weather", "(1.0 + weather_impact)"), ("x_store_growth", "store_growth_mult"),
              ("x_promotion", "promo_lift_cat")]


def _ablation_sql() -> str:
    expr, sel = "coalesce(struct_rimdow, struct_cmdow)", []
    for i, (name, factor) in enumerate(_STEPS_SQL, start=1):
        expr = expr if i == 1 else f"({expr}) * {factor}"
        y = f"(CASE WHEN ({expr}) < 0 THEN 0.0 ELSE ({expr}) END)"
        sel.append(f"SELECT split, {i} AS step, '{name}' AS layer, "
                   f"sum(CASE WHEN quantity > 0 THEN abs(quantity - {y}) END) / "
                   f"sum(CASE WHEN quantity > 0 THEN quantity END) AS wmape FROM abl GROUP BY split")
    return f"""
, abl AS (SELECT *, CASE WHEN date >= DATE '1999-10-01' AND date <= DATE '1999-12-31' AND quantity_filled IS NOT NULL
                         THEN 'val' WHEN date >= DATE '2000-10-01' THEN 'test' END AS split FROM FEATS),
steps AS ({" UNION ALL ".join(sel)})
SELECT split, step, layer, round(wmape, 6) AS wmape,
       round((wmape - lag(wmape) OVER (PARTITION BY split ORDER BY step)) * 100, 6) AS delta_pp
FROM steps WHERE split IS NOT NULL"""


@register("m14_closed_form_ablation", with_panel(features_cte(CAT) + _ablation_sql()))
def m14_closed_form_ablation(spark, sf):
    return rounded(forecasts.closed_form_ablation(features(spark, sf), HZ))
