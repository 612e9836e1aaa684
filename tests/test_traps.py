"""Unit fixtures for the semantic traps (hand-computed answers)."""

import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tillcast import functions as fn
from tillcast.operators import encode, ensemble, grain, metrics, windows
from tillcast.plans import monthly
from tillcast.session import ensure_checkpoint_dir


def test_t1_clip_keeps_null(spark):
    df = spark.createDataFrame([(None,), (0.0,), (3.0,)], "x double")
    got = [r[0] for r in df.select(fn.clip("x", lo=1.0)).collect()]
    assert got == [None, 1.0, 3.0]


def test_t3_safe_div_null_on_zero(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, 2.0)], "a double, b double")
    assert [r[0] for r in df.select(fn.safe_div("a", "b")).collect()] == [None, 0.5]


def test_t5_shift_roll_min_periods(spark):
    vals = [1.0, None, 3.0, 4.0, 5.0, 6.0, 7.0, 8.0, 9.0]
    df = spark.createDataFrame([("s", "i", dt.date(2000, 1, 1) + dt.timedelta(days=k), v) for k, v in enumerate(vals)],
                               "store_id string, item_id string, date date, x double")
    out = df.select("date", windows.rolling_expr("x", 28, "mean", 7, shift=1).alias("m"),
                    windows.rolling_expr("x", 28, "std", 7, shift=1).alias("s")).orderBy("date").collect()
    assert all(r.m is None for r in out[:8])
    assert out[8].m == pytest.approx(4.857142857142857, abs=1e-12)
    assert out[8].s == pytest.approx(2.410295378065479, abs=1e-12)


def test_t6_store_order_memory(spark):
    rows = [("s", it, dt.date(2000, 1, d), float(t)) for it in ("a", "b") for d, t in ((1, 10), (2, 20))]
    df = spark.createDataFrame(rows, "store_id string, item_id string, date date, avg_temp_f double")
    out = {(r.item_id, r.date.day): r.avg_temp_f_lag1 for r in windows.store_order_memory(df).collect()}
    assert out == {("a", 1): 10.0, ("a", 2): 10.0, ("b", 1): 20.0, ("b", 2): 10.0}


def test_t6_matches_store_window_on_random_panel(spark):
    import random
    rng = random.Random(7)
    rows = []
    for s in ("s1", "s2"):
        for it in ("a", "b", "c", "d"):
            n = rng.choice([1, 1, 2, 3, 5])
            days = sorted(rng.sample(range(1, 28), n))
            rows += [(s, it, dt.date(2000, 1, d), float(rng.randint(0, 90))) for d in days]
    df = spark.createDataFrame(rows, "store_id string, item_id string, date date, avg_temp_f double")
    w = Window.partitionBy("store_id").orderBy("item_id", "date")
    ref = df.select("store_id", "item_id", "date",
                    F.coalesce(F.lag("avg_temp_f").over(w), F.col("avg_temp_f")).alias("l1"),
                    F.avg("avg_temp_f").over(w.rowsBetween(-2, 0)).alias("r3"))
    got = windows.store_order_memory(df)
    j = ref.join(got, ["store_id", "item_id", "date"]).collect()
    assert len(j) == len(rows)
    for r in j:
        assert r.l1 == pytest.approx(r.avg_temp_f_lag1)
        assert r.r3 == pytest.approx(r.avg_temp_f_rolling3)


def test_t7_label_codes_alphabetical(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",)], "c string").withColumn("k", F.monotonically_increasing_id())
    out = [r.c_enc for r in encode.label_encode(df, "c").orderBy("k").collect()]
    assert out == [1, 0, 1]


def test_t8_quantile_bins_off_edges(spark):
    df = spark.createDataFrame([(float(v),) for v in (1.5, 2.5, 3.5, 4.5, 5.5, 6.5)], "x double")
    out = sorted((r.x, r.b) for r in grain.quantile_bins(df, "x", "b", 3).collect())
    assert [b for _, b in out] == [0, 0, 1, 1, 2, 2]


def test_t9_temp_bins_right_closed(spark):
    df = spark.createDataFrame([(float(v),) for v in (0, 32, 32.1, 50, 70, 120, 121)], "t double")
    got = [r[0] for r in df.select(fn.temp_bin("t")).collect()]
    assert got == [None, "(0, 32]", "(32, 50]", "(32, 50]", "(50, 70]", "(70, 120]", None]


def test_t10_csv_null_tokens(spark, tmp_path):
    from pyspark.sql import types as T

    from tillcast.sources.readers import read_panel_csv
    p = tmp_path / "x.csv"
    p.write_text("store_id,precip_type\nS1,None\nS2,NA\nS3,x\n")
    schema = T.StructType([T.StructField("store_id", T.StringType()), T.StructField("precip_type", T.StringType())])
    got = [r.precip_type for r in read_panel_csv(spark, str(p), schema=schema).orderBy("store_id").collect()]
    assert got == [None, None, "x"]


def test_t16_first_group_wins(spark):
    df = spark.createDataFrame([("gear-R",), ("rod-S",), ("zzz",)], "item_id string")
    groups = {"metal": ["gear-R", "rod-S"], "round": ["gear-R"]}
    got = {r.item_id: r.component_group for r in encode.assign_groups(df, groups).collect()}
    assert got == {"gear-R": "metal", "rod-S": "metal", "zzz": "other"}


def test_t17_payday_distance(spark):
    df = spark.createDataFrame([(d,) for d in (1, 8, 15, 16, 17, 31)], "d int")
    assert [r[0] for r in df.select(fn.days_from_payday("d")).collect()] == [0, 7, 0, 0, 1, 15]


def test_t18_wmape_masking(spark):
    df = spark.createDataFrame([(0.0, 5.0), (10.0, 8.0)], "y double, yhat double")
    masked = df.agg(metrics.wmape_expr("y", "yhat")).first()[0]
    unmasked = df.agg(metrics.wmape_expr("y", "yhat", positive_only=False)).first()[0]
    assert masked == pytest.approx(0.2) and unmasked == pytest.approx(0.7)


def test_t23_iso_week_and_thanksgiving(spark):
    df = spark.createDataFrame([(dt.date(2024, 12, 30), 2025)], "d date, y int")
    r = df.select(F.weekofyear("d").alias("w"), fn.thanksgiving(F.col("y")).alias("tg")).first()
    assert r.w == 1 and r.tg == dt.date(2025, 11, 27)


def test_m8_grid_sizes():
    assert len(ensemble.weight_grid()) == 79
    assert len(ensemble.weight_grid("0.02", "0.05", "0.85", ())) == 741
    assert all(abs(a + b + c - 1.0) < 1e-12 for _, a, b, c in ensemble.weight_grid())


def test_k5_argmin_first_wins_ties(spark):
    rows = [("s", 1.0, 1.0, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "store_id string, y double, m1 double, m2 double, m3 double")
    best = ensemble.blend_grid(df, ["m1", "m2", "m3"], y="y").first()
    assert best.grid_id == 0 and best.wmape == pytest.approx(0.0)


def test_t2_nan_normalised_to_null(spark):
    df = spark.createDataFrame([(float("nan"),), (1.0,)], "x double")
    assert [r[0] for r in df.select(fn.nan_to_null("x")).collect()] == [None, 1.0]


def test_t11_lookups_drop_null_keys(spark):
    t = spark.createDataFrame([("a", 1.0), (None, 5.0)], "k string, x double")
    agg = grain.group_mean(t, "k", "x", "m")
    assert agg.count() == 1
    p = spark.createDataFrame([("a",), (None,)], "k string")
    out = {r.k: r.m for r in grain.lookup_left(p, agg, "k", {"m": 0.0}).collect()}
    assert out == {"a": 1.0, None: 0.0}


def test_t13_first_row_per_key(spark):
    df = spark.createDataFrame([("s1", "b", 1, "X"), ("s1", "a", 2, "Y"), ("s1", "a", 1, "Z")],
                               "store_id string, item_id string, d int, city string")
    got = grain.first_per_key(df, "store_id", ["item_id", "d"], ["city"]).first().city
    assert got == "Z"


def test_t19_defaults_on_lookup_miss(spark):
    p = spark.createDataFrame([("a", 2.0), ("b", 3.0)], "k string, base double")
    agg = spark.createDataFrame([("a", 1.5)], "k string, mult double")
    out = {r.k: r.mult for r in grain.lookup_left(p, agg, "k", {"mult": 1.0}).collect()}
    assert out == {"a": 1.5, "b": 1.0}
    out2 = {r.k: r.mult for r in grain.lookup_left(p, agg, "k", {"mult": "base"}).collect()}
    assert out2 == {"a": 1.5, "b": 3.0}


def test_t22_monday_is_zero(spark):
    df = spark.createDataFrame([(dt.date(2024, 12, 30),), (dt.date(2024, 12, 29),)], "d date")
    assert [r[0] for r in df.select(fn.weekday_mon0("d")).collect()] == [0, 6]


def test_w4_rolling3_skips_null_input(spark):
    df = spark.createDataFrame([("s", "i", dt.date(2000, 1, 1 + k), v) for k, v in enumerate([10.0, None, 30.0])],
                               "store_id string, item_id string, date date, avg_temp_f double")
    got = {r.date.day: r.avg_temp_f_rolling3 for r in windows.store_order_memory(df).collect()}
    assert got == {1: 10.0, 2: 10.0, 3: 20.0}


def test_f9_honest_mode_averages_before_fit_end_only(spark):
    from tillcast.horizon import Horizon
    from tillcast.operators import prep
    hz = Horizon(fit_until=dt.date(1999, 10, 1))
    rows = [(dt.date(1999, 9, 13), 10.0), (dt.date(1999, 9, 20), None), (dt.date(1999, 11, 1), 100.0)]
    df = spark.createDataFrame([("s", "i", d, 0, v) for d, v in rows],
                               f"store_id string, item_id string, date date, {prep.DOW} int, {prep.TARGET} double")
    got = {r.date: r[prep.TARGET] for r in prep.impute_group_mean(df, hz=hz).collect()}
    assert got[dt.date(1999, 9, 20)] == 10.0


def test_m12_missing_prediction_is_not_forgiven(spark):
    df = spark.createDataFrame([("a", 10.0, None), ("a", 5.0, 5.0), ("b", 0.0, None), ("b", 4.0, 3.0)],
                               "k string, y double, yhat double")
    got = {r.k: r.wmape for r in metrics.wmape(df, "y", "yhat", by="k").collect()}
    assert got["a"] is None and got["b"] == pytest.approx(0.25)


def test_m8_m9_default_weights(spark):
    val = spark.createDataFrame([("bad", 1.0, 9.0, 9.0, 9.0), ("ok", 1.0, 1.0, 1.0, 1.0)],
                                "store_id string, y double, m1 double, m2 double, m3 double")
    w = ensemble.blend_grid(val, ["m1", "m2", "m3"], y="y")
    row = {r.store_id: r for r in w.collect()}["bad"]
    assert (row.grid_id, row.w1, row.w2, row.w3) == (None, 0.33, 0.33, 0.34)
    # a store without validation rows
    new = spark.createDataFrame([("new", 10.0, 20.0, 30.0)], "store_id string, m1 double, m2 double, m3 double")
    assert ensemble.blend(new, w, ["m1", "m2", "m3"]).first().ensemble == pytest.approx(20.1)


def test_p12_unknown_error_and_adjusted_days_fail(spark):
    daily = spark.createDataFrame([("s", "i", 10, 6.0, 6.0), ("s", "i", 10, 4.0, 5.0), ("s", "j", 10, 1.0, 1.0)],
                                  "store_id string, item_id string, month int, daily_qty double, adjusted_qty double")
    targets = spark.createDataFrame([("s", "i", 10, 10.0), ("s", "j", 10, None)],
                                    "store_id string, item_id string, month int, target_qty double")

    def ok(col):
        return {r.item_id: r.ok for r in monthly.reconcile_check(daily, targets, col=col).collect()}
    assert ok("daily_qty") == {"i": True, "j": False}
    assert ok("adjusted_qty") == {"i": False, "j": False}


def test_staging_needs_a_shared_folder_on_a_cluster():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = {}
    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(Session())
