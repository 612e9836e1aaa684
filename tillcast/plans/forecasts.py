"""Composed forecasts.

``ensemble_forecast`` is the per-store ensemble contract of the reference —
members -> per-store blend-weight grid on the validation season -> blend ->
per-store bias -> non-negative clip -> scores — with closed-form members
(structural, domain formula, seasonal naive) so every step is deterministic.
``plans.learners`` runs the same contract with MLlib members.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast import functions as fn
from tillcast.horizon import DEFAULT, Horizon
from tillcast.operators import baselines, ensemble, metrics
from tillcast.operators.features import build_features
from tillcast.operators.prep import TARGET
from tillcast.session import stage

MEMBERS = ("m_struct", "m_domain", "m_naive")
ID_COLS = ("date", "store_id", "item_id", "category", "month", "quantity", TARGET)


def member_frame(f: DataFrame, last: str | None = None) -> DataFrame:
    """Closed-form members on a feature frame.

    A member that is NULL (neither the series nor its category has history for the month and weekday) falls back
    to the column ``last``, or to 0 without one.  ``m_domain_raw`` is the formula before its clip at 0.
    """
    f = baselines.seasonal_naive(f)
    end = F.lit(0.0) if last is None else F.coalesce(F.col(last), F.lit(0.0))
    return f.select(*ID_COLS, "struct_rimdow",
                    F.coalesce(baselines.structural(f), end).alias("m_struct"),
                    F.coalesce(baselines.domain_forecast(f), end).alias("m_domain"),
                    F.coalesce(F.col("seasonal_naive"), end).alias("m_naive"),
                    F.coalesce(baselines.domain_raw(), end).alias("m_domain_raw"))


def with_split(df: DataFrame, hz: Horizon = DEFAULT, target: str = TARGET) -> DataFrame:
    preds = ensemble.split_predicates(hz, target)
    return df.withColumn("split", F.when(preds["val"], F.lit("val")).when(preds["test"], F.lit("test")))


def ensemble_forecast(f: DataFrame, hz: Horizon = DEFAULT, members: Sequence[str] = MEMBERS,
                      grid=None, by=("store_id",), last: str | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Returns (predictions with split/ensemble/predicted/raw_prediction, weights, bias factors).

    ``raw_prediction`` blends the members before their clips at 0; ``last``: see ``member_frame``.
    """
    m = stage(with_split(member_frame(f, last), hz).where(F.col("split").isNotNull()))
    val = m.where(F.col("split") == "val")
    weights = ensemble.blend_grid(val, members, y=TARGET, by=by, grid=grid)
    b = ensemble.blend(m, weights, members, by=by)
    factors = ensemble.bias_factors(b.where(F.col("split") == "val"), y=TARGET, yhat="ensemble", by=by)
    out = ensemble.bias_correct(b, factors, "ensemble", "predicted", by=by)
    raw = [f"{m}_raw" if f"{m}_raw" in out.columns else m for m in members]
    blended = sum((F.col(f"w{i}") * F.col(c) for i, c in enumerate(raw, 1)), F.lit(0.0))
    out = out.withColumn("raw_prediction", blended * F.coalesce(F.col("bias"), F.lit(1.0)))
    out = ensemble.clip_predictions(out, "predicted")
    return out, weights, factors


def future_forecast(p: DataFrame, hz: Horizon = DEFAULT, **build) -> DataFrame:
    """Blended, bias-corrected forecast of every cell of the test season, for a prepared panel that holds the
    complete skeleton there (``star.panel_with_future``).  Cells fall back from their series to their category and
    then to the smoothed training mean (``target_enc_rim``), so none is left without a value."""
    out, _, _ = ensemble_forecast(build_features(p, hz, **build), hz, last="target_enc_rim")
    return out.where(F.col("split") == "test")


def score_breakdown(preds: DataFrame, y: str = "quantity", yhat: str = "predicted") -> DataFrame:
    """wMAPE, volume and volume share overall / by category / by month / by store
    in one GROUPING SETS aggregate."""
    keep = F.col(y) > 0
    vol = F.sum(F.when(keep, F.col(y)))
    total = preds.agg(vol).scalar()
    g = preds.groupingSets([[], ["category"], ["month"], ["store_id"]], "category", "month", "store_id").agg(
        F.grouping("category").alias("__gc"), F.grouping("month").alias("__gm"), F.grouping("store_id").alias("__gs"),
        F.count(F.lit(1)).alias("rows"), metrics.wmape_expr(y, yhat).alias("wmape"), vol.alias("volume"))
    level = (F.when(F.col("__gc") == 0, "category").when(F.col("__gm") == 0, "month")
              .when(F.col("__gs") == 0, "store").otherwise("overall"))
    return g.select(level.alias("level"), "category", "month", "store_id", "rows", "wmape", "volume",
                    fn.safe_div(F.col("volume"), total).alias("volume_share"))


# closed-form layer steps: each multiplies the previous step's forecast by one factor
# (factors are built lazily: Column objects need an active session)
ABLATION_STEPS = (
    ("structural", None),
    ("x_holiday", lambda: F.col("holiday_mult")),
    ("x_event", lambda: F.col("event_mult")),
    ("x_weather", lambda: F.lit(1.0) + F.col("weather_impact")),
    ("x_store_growth", lambda: F.col("store_growth_mult")),
    ("x_promotion", lambda: F.col("promo_lift_cat")),
)


def closed_form_ablation(f: DataFrame, hz: Horizon = DEFAULT, steps=ABLATION_STEPS) -> DataFrame:
    """M14 (closed form): wMAPE on val and test after each multiplicative layer, with the
    change vs the previous step in percentage points — one aggregate pass."""
    base = F.coalesce(F.col("struct_rimdow"), F.col("struct_cmdow"))
    cols, expr = {}, base
    for name, factor in steps:
        expr = expr if factor is None else expr * factor()
        cols[f"__y_{name}"] = fn.clip(expr, lo=0.0)
    src = with_split(f, hz).where(F.col("split").isNotNull()).withColumns(cols)
    g = src.groupBy("split").agg(*[metrics.wmape_expr("quantity", f"__y_{n}").alias(n) for n, _ in steps])
    rows = F.array(*[F.struct(F.lit(i + 1).alias("step"), F.lit(n).alias("layer"), F.col(n).alias("wmape"))
                     for i, (n, _) in enumerate(steps)])
    long = g.select("split", F.explode(rows).alias("r")).select("split", "r.*")
    return ensemble.compare_runs(long, "layer", "step", "wmape", by="split")
