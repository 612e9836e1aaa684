"""Future grid contract, sketches, calendar lags, blend grid and learners against brute force on small fixtures."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from tillcast.horizon import DEFAULT as HZ
from tillcast.operators import ensemble, models, sketch, windows
from tillcast.operators.prep import TARGET
from tillcast.plans import forecasts, reports
from tillcast.sources import sinks, star

SMALL = "/root/testdata/sf0.001"


# --- future grid -------------------------------------------------------------

def test_skeleton_has_every_cell_once(spark):
    cells = star.future_skeleton(spark, SMALL, HZ)
    n = cells.agg(F.count_distinct("store_id").alias("s"), F.count_distinct("item_id").alias("i"),
                  F.count_distinct("date", "store_id", "item_id").alias("k"), F.count("*").alias("n"),
                  F.count("quantity").alias("q"), F.sum("is_promotion").alias("p")).first()
    assert n["n"] == n["k"] == n["s"] * n["i"] * 92 and n["q"] == n["p"] == 0
    # covariates are those of observed cells of the same day and store
    past = star.panel_from_star(spark, SMALL, HZ).where(F.col("date") >= F.lit(HZ.test_start))
    names = ["holiday_name", "special_event_name", "avg_temp_f", "precip_inches", "precip_type", "city", "category", "unit_price"]
    keys = ["date", "store_id", "item_id"]
    seen = past.select(*keys, *names)
    assert seen.count() == seen.intersect(cells.select(*keys, *names)).count() > 0


def _cells():
    return [(d, s, i, 1.0) for d in ("2000-10-01", "2000-10-02") for s in ("A", "B") for i in ("x", "y")]


def _checks(spark, rows, expected):
    schema = "date string, store_id string, item_id string, predicted_quantity double"
    got = sinks.forecast_quality(spark.createDataFrame(rows, schema), spark.createDataFrame(expected, schema))
    return {r["check"]: (r["ok"], r["value"]) for r in got.collect()}


def test_contract_fails_on_each_fault(spark):
    whole = _cells()
    assert all(ok for ok, _ in _checks(spark, whole, whole).values())
    gone = _checks(spark, whole[1:], whole)
    assert not gone["row_count"][0] and gone["missing_cells"] == (False, 1.0) and gone["unexpected_cells"][0]
    other = _checks(spark, [*whole[1:], ("2000-10-09", "A", "x", 1.0)], whole)
    assert other["row_count"][0] and not other["missing_cells"][0] and not other["unexpected_cells"][0] and not other["date_coverage"][0]
    twice = _checks(spark, [*whole, whole[0]], whole)
    assert not twice["unique_keys"][0] and not twice["row_count"][0]
    bad = _checks(spark, [(*whole[0][:3], -1.0), (*whole[1][:3], None), *whole[2:]], whole)
    assert bad["non_negative"] == (False, 1.0) and bad["no_nulls"] == (False, 1.0)
    assert not _checks(spark, [r for r in whole if r[1] == "A"], whole)["store_coverage"][0]
    assert not _checks(spark, [], whole)["row_count"][0]


def test_written_forecast_is_read_back(spark, tmp_path):
    rows = [(dt.date(2000, 10, 2), "B", "y", 2.5), (dt.date(2000, 10, 1), "A", "x", 0.0)]
    preds = spark.createDataFrame(rows, "date date, store_id string, item_id string, predicted double")
    sinks.write_forecast(preds, str(tmp_path / "f"), single_file=True)
    got = spark.read.option("header", True).csv(str(tmp_path / "f")).collect()
    assert [tuple(r) for r in got] == [("2000-10-01", "A", "x", "0.0"), ("2000-10-02", "B", "y", "2.5")]


def test_cells_without_history_take_the_last_fallback(spark):
    day = dt.date(2000, 10, 2)
    cols = {"category": "c", "month": 10, "quantity": None, TARGET: None, "struct_rimdow": None, "struct_cmdow": None,
            "holiday_mult": 1.0, "event_mult": 1.0, "weather_impact": -1.5, "store_growth_mult": 1.0, "promo_lift_cat": 1.0, "mean": 7.0}
    rows = [{"date": day, "store_id": "A", "item_id": "new", **cols},
            {"date": day, "store_id": "A", "item_id": "old", **cols, "struct_rimdow": 4.0, "struct_cmdow": 3.0}]
    schema = ("date date, store_id string, item_id string, category string, month int, quantity double, quantity_filled double, "
              "struct_rimdow double, struct_cmdow double, holiday_mult double, event_mult double, weather_impact double, "
              "store_growth_mult double, promo_lift_cat double, mean double")
    f = spark.createDataFrame([tuple(r[c.split()[0]] for c in schema.split(", ")) for r in rows], schema)
    got = {r["item_id"]: r for r in forecasts.member_frame(f, "mean").collect()}
    assert got["new"]["m_struct"] == got["new"]["m_domain"] == got["new"]["m_naive"] == 7.0
    # a weather impact below -1 makes the formula negative: clipped in the member, kept in the raw one
    assert (got["old"]["m_domain"], got["old"]["m_domain_raw"]) == (0.0, -2.0)
    report = ensemble.clip_report(forecasts.member_frame(f, "mean"), "m_domain_raw").first()
    assert (report["clipped_rows"], report["min_raw"], report["median"], report["max"]) == (1, -2.0, 3.5, 7.0)


def test_unseen_combinations(spark):
    rows = [(dt.date(2000, 9, 1), "A", 1), (dt.date(2000, 10, 5), "A", 1), (dt.date(2000, 10, 5), "A", 2), (dt.date(2000, 10, 5), None, 2)]
    p = spark.createDataFrame(rows, "date date, store_id string, k int")
    assert [tuple(r) for r in reports.unseen_levels(p, ["store_id", "k"], HZ).collect()] == [("A", 2)]
    assert reports.unseen_levels(p, "store_id", HZ).collect() == []


# --- sketches and windows ----------------------------------------------------

@pytest.mark.parametrize("values", [
    [1.0], [3.0, 1.0], list(map(float, range(999))), [5.0] * 700 + [1.0, 9.0], [0.0] * 500 + list(map(float, range(500))),
    [random.Random(4).gauss(0, 1) for _ in range(2001)],
])
def test_median_is_exact(spark, values):
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "x double").repartition(5)
    assert sketch.exact_median(df, "x", few=20, accuracy=50) == float(np.median(values))


def test_median_of_nothing(spark):
    assert sketch.exact_median(spark.createDataFrame([(None,)], "x double"), "x") is None


def test_distinct_counts(spark):
    df = spark.range(20_000).select((F.col("id") % 7).alias("g"), F.col("id").alias("a"), F.when(F.col("id") % 2 == 0, F.col("id") % 50).alias("b"))
    plan = sketch.distinct_exact(df, ["a", "b"])
    assert tuple(plan.first()) == (20_000, 25)
    near = sketch.distinct_estimates(sketch.distinct_sketches(df, ["a", "b"], ["g"]), ["a", "b"]).first()
    assert abs(near["a"] - 20_000) < 5 * sketch.sketch_error() * 20_000 and near["b"] == 25


def test_calendar_lags_on_a_sparse_panel(spark):
    r = random.Random(1)
    rows = [(s, "i", dt.date(2000, 1, 1) + dt.timedelta(days=d), None if d % 11 == 0 else float(d))
            for s in "ab" for d in sorted(r.sample(range(60), 35))]
    df = spark.createDataFrame(rows, "store_id string, item_id string, date date, x double")
    known = {(s, d): x for s, _, d, x in rows}
    out = windows.lags(df, "x", [1, 7], mode="calendar")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan
    for row in out.collect():
        for n in (1, 7):
            assert row[f"lag_{n}"] == known.get((row["store_id"], row["date"] - dt.timedelta(days=n)))


# --- blend grid --------------------------------------------------------------

def test_fine_grid_equals_a_loop(spark):
    rng = np.random.default_rng(2)
    grid = ensemble.weight_grid("0.02", "0.05", "0.85", ())
    assert len(grid) == 741
    rows = [(s, float(y), *map(float, m)) for s in ("A", "B", None) for y, m in zip(rng.integers(-1, 9, 40), rng.random((40, 3)) * 8)]
    df = spark.createDataFrame(rows, "store_id string, y double, a double, b double, c double").repartition(6)
    got = {(r["store_id"], r["grid_id"]): r["wmape"] for r in ensemble.grid_scores(df, ("a", "b", "c"), "y", grid=grid).collect()}
    assert len(got) == 3 * 741
    for s in ("A", "B", None):
        data = np.array([r[1:] for r in rows if r[0] == s and r[1] > 0])
        for g, *w in grid[::60]:
            assert got[s, g] == pytest.approx(np.abs(data[:, 0] - data[:, 1:] @ np.array(w)).sum() / data[:, 0].sum())


def test_missing_member_makes_the_score_unknown(spark):
    df = spark.createDataFrame([("A", 2.0, 1.0, 1.0, None), ("B", 2.0, 1.0, 1.0, 1.0)], "store_id string, y double, a double, b double, c double")
    got = {r["store_id"]: r["wmape"] for r in ensemble.grid_scores(df, ("a", "b", "c"), "y").where("grid_id = 0").collect()}
    assert got["A"] is None and got["B"] == pytest.approx(0.5)
    won = {r["store_id"]: r["w1"] for r in ensemble.blend_grid(df, ("a", "b", "c"), "y").collect()}
    assert won["A"] == ensemble.DEFAULT_WEIGHTS[0]


# --- learners ----------------------------------------------------------------

def _panel(spark, stores=("A", "B"), n=260, shift=0.0):
    r = random.Random(7)
    rows = []
    for s in stores:
        for k in range(n):
            d = dt.date(1999, 1, 1) + dt.timedelta(days=k * 729 // n)
            x, z = r.random(), r.random()
            rows.append((s, d, x, z, (20 if s == "A" else 5) * x + 3 * z + (shift if s == "B" else 0)))
    df = spark.createDataFrame(rows, f"store_id string, date date, x double, z double, {TARGET} double")
    return VectorAssembler(inputCols=["x", "z"], outputCol="features").transform(df)


def test_preparation_is_learned_on_training_rows(spark):
    schema = "x double, z double, base double, cat double, y double"
    train = spark.createDataFrame([(1.0, None, 5.0, 6.0, 2.0), (2.0, 3.0, None, 6.0, 4.0)], schema)
    model = models.FeaturePreparer(["x", "z"], "y", ["base", "cat"]).fit(train)
    assert model.names == ["x", "z", "z__missing"]
    test = spark.createDataFrame([(None, None, 9.0, 8.0, None), (float("nan"), 1.0, None, 8.0, None), (None, None, None, None, None)], schema)
    got = [tuple(r) for r in model.transform(test).select(*model.names).collect()]
    assert got == [(9.0, 9.0, 1.0), (8.0, 1.0, 0.0), (3.0, 3.0, 1.0)]
    with pytest.raises(ValueError, match="missing features: z"):
        model.transform(test.drop("z"))
    with pytest.raises(ValueError, match="missing features: z"):
        models.FeaturePreparer(["x", "z"], "y", ["base", "cat"]).fit(train.drop("z"))


def test_iteration_curve_equals_truncated_models(spark):
    df = _panel(spark)
    model = GBTRegressor(labelCol=TARGET, lossType="absolute", maxIter=5, maxDepth=3, seed=1).fit(df)
    rows = df.collect()
    want = []
    for k in range(1, 6):
        e = t = 0.0
        for r in rows:
            if r[TARGET] > 0:
                yhat = sum(w * tree.predict(r["features"]) for w, tree in zip(model.treeWeights[:k], model.trees[:k]))
                e, t = e + abs(r[TARGET] - max(yhat, 0.0)), t + r[TARGET]
        want.append(e / t)
    assert models.iteration_curve(model, df.repartition(4), TARGET) == pytest.approx(want)


def test_best_iteration_has_patience():
    assert models.best_iteration([5, 4, 4.5, 3, 3.5, 3.2, 1], 2) == 4
    assert models.best_iteration([5, 4, 4.5, 3, 3.5, 3.2, 1], 3) == 7
    assert models.best_iteration([2, 2, 2], 5) == 1


def test_search_feeds_the_fit_and_stores_keep_to_their_rows(spark):
    cut = ensemble.split_predicates(HZ)
    trials = [{"maxDepth": 1, "stepSize": 0.01}, {"maxDepth": 4, "stepSize": 0.3}, {"maxDepth": 2, "stepSize": 0.02}]
    seen, chosen = {}, {}
    for shift in (0.0, 50.0):
        df = models.stage_by(_panel(spark, shift=shift).withColumn("weight", F.lit(1.0)))
        sp = ensemble.temporal_split(df, HZ)
        if not chosen:
            table, winners = models.halving_search(sp["train1"], sp["val"], TARGET, trials, "weight", (2, 4))
            got = table.collect()
            first = sorted((r["val_wmape"], r["trial"]) for r in got if r["rung"] == 0)
            # the better half of the first rung goes on, and every store's winner is one of them
            assert sorted(r["trial"] for r in got if r["rung"] == 1) == sorted(k for _, k in first[:2])
            assert {r["trial"] for r in winners.collect()} <= {k for _, k in first[:2]}
            chosen = {r["store_id"]: trials[r["trial"]] for r in winners.collect()}
            assert set(chosen) == {"A", "B"}
        fitted = {}

        def fit(store, rows):
            assert {r["store_id"] for r in rows.select("store_id").distinct().collect()} == {store}
            s = ensemble.temporal_split(rows, HZ)
            model, n = models.fit_gbt(s["train1"], s["val"], s["train2"], TARGET, "weight", 4, 2, subsamplingRate=1.0, **chosen[store])
            fitted[store] = model
            return {"m": model}

        rest = models.fit_forest(sp["train2"], TARGET, num_trees=2, max_depth=2)
        out, own = models.fit_predict_per_group(df, fit, {"m": rest}, ["m"], cut["train2"], 100)
        assert own == ["A", "B"]
        assert all(fitted[k].getOrDefault(name) == v for k in own for name, v in chosen[k].items())
        assert out.count() == df.count()
        seen[shift] = sorted((r["date"], round(r["m"], 6)) for r in out.where("store_id = 'A'").collect())
    assert seen[0.0] == seen[50.0]      # store B's rows changed, store A's models did not
    few, none = models.fit_predict_per_group(df, fit, {"m": rest}, ["m"], cut["train2"], 10_000)
    assert none == [] and few.count() == df.count()
