"""MLlib learner queries (rows-only: no SQL oracle for model fits)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillcast import functions as fn
from tillcast.catalog.queries_features import features
from tillcast.catalog.registry import register, rounded
from tillcast.horizon import DEFAULT as HZ
from tillcast.operators import ensemble, metrics, models
from tillcast.operators.prep import TARGET
from tillcast.plans import forecasts, learners

_MEMO: dict = {}


def _ens(spark, sf):
    key = (id(spark), spark.sparkContext.applicationId, sf)
    if key not in _MEMO:
        _MEMO[key] = learners.learner_ensemble(features(spark, sf), HZ, gbt_iter=8, rf_trees=8, rf_depth=6, patience=3,
                                               per_store=True, min_rows=1_000, trials=learners.TRIALS)
    return _MEMO[key]


@register("m4_m6_learner_member_wmape")
def m4_m6_learner_member_wmape(spark, sf):
    """Per-member and ensemble wMAPE by split (gbt, forest, per-store ridge, blend)."""
    out, _, _, _ = _ens(spark, sf)
    runs = None
    for step, col in enumerate([*learners.LEARNERS, "predicted"], start=1):
        r = out.groupBy("split").agg(metrics.wmape_expr("quantity", col).alias("wmape")) \
               .select("split", F.lit(col).alias("run"), F.lit(step).alias("step"), "wmape")
        runs = r if runs is None else runs.unionByName(r)
    return rounded(ensemble.compare_runs(runs, "run", "step", "wmape", by="split"))


@register("m8_learner_blend_weights")
def m8_learner_blend_weights(spark, sf):
    _, weights, factors, _ = _ens(spark, sf)
    return rounded(weights.join(factors, "store_id"))


@register("r9_learner_score_breakdown")
def r9_learner_score_breakdown(spark, sf):
    out, _, _, _ = _ens(spark, sf)
    return rounded(forecasts.score_breakdown(out.where(F.col("split") == "test")))


@register("m6_per_store_ridge")
def m6_per_store_ridge(spark, sf):
    _, _, _, info = _ens(spark, sf)
    df, names = info["frame"], info["names"]
    train2 = ensemble.temporal_split(df, HZ)["train2"]
    coefs = models.fit_per_store(train2, names, TARGET, "weight")
    return coefs.select("store_id", "n", F.size("coef").alias("n_coef"),
                        F.round(F.element_at("coef", 1), 6).alias("intercept"))


@register("m13_feature_importance")
def m13_feature_importance(spark, sf):
    _, _, _, info = _ens(spark, sf)
    return rounded(models.feature_importance(info["gbt"], info["names"], spark))


@register("m7_random_search")
def m7_random_search(spark, sf):
    """All trials of the successive-halving search whose winners the fits use."""
    return rounded(_ens(spark, sf)[3]["trials"])


@register("m7_store_winners")
def m7_store_winners(spark, sf):
    """The winning trial of each store and the number of trees its own model kept."""
    info = _ens(spark, sf)[3]
    kept = spark.createDataFrame([(s, n) for s, (_, n) in sorted(info["store_models"].items())], "store_id string, n_trees int")
    return rounded(info["winners"].join(kept, "store_id", "left"))


@register("m14_ablation")
def m14_ablation(spark, sf):
    """Nested feature sets at the searched parameters and the kept number of trees: wMAPE and its change, val and test."""
    _, _, _, info = _ens(spark, sf)
    df = info["frame"]
    sp = ensemble.temporal_split(df, HZ)
    base = ["menu_item_enc", "category_enc", "unit_price", "month", "day_of_week_num", "is_weekend",
            "day_of_year", "week_of_year", "day_of_month", "is_holiday", "is_special_event", "is_promotion"]
    structural = base + ["struct_rimdow", "struct_rim", "struct_cmdow", "lag_7_filled",
                         "lag_14_filled", "rolling_mean_28", "rolling_std_28"]
    domain = structural + ["holiday_mult", "cat_holiday_mult", "event_mult", "store_growth_mult", "promo_lift_cat",
                           "weather_impact", "q4_trend_ratio"]
    full = list(info["names"])
    steps = [("base", base), ("structural_and_lags", structural), ("domain_layers", domain), ("full", full)]
    ev_y = TARGET

    def fit_and_score(feats):
        from pyspark.ml.feature import VectorAssembler
        from pyspark.ml.regression import GBTRegressor
        va = VectorAssembler(inputCols=list(feats), outputCol="fx")
        m = GBTRegressor(featuresCol="fx", labelCol=ev_y, weightCol="weight", lossType="absolute",
                         maxIter=info["n_trees"], seed=models.SEED, **info["params"]).fit(va.transform(sp["train2"]))
        pred = forecasts.with_split(m.transform(va.transform(df)).withColumn("yh", fn.clip("prediction", lo=0.0)), HZ)
        got = pred.where("split IS NOT NULL").groupBy("split").agg(metrics.wmape_expr("quantity", "yh").alias("w")).collect()
        return {r["split"]: r["w"] for r in got}

    recs = models.ablate(steps, fit_and_score)
    rows = [(r["step"], r["name"], r["n_features"], split, float(r[split])) for r in recs for split in ("val", "test")]
    out = spark.createDataFrame(rows, "step int, name string, n_features int, split string, wmape double")
    return rounded(ensemble.compare_runs(out, "name", "step", "wmape", by="split"))
