"""Operators without a SQL oracle, checked against brute force on small fixtures."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillcast.horizon import Horizon
from tillcast.operators import baselines, ensemble, models


def _rows(seed=3, stores=3, n=60, p=3):
    rng = random.Random(seed)
    rows = []
    for s in range(stores):
        beta = [rng.uniform(-2, 2) for _ in range(p)]
        for _ in range(n):
            x = [rng.uniform(0, 10) for _ in range(p)]
            y = 5 + sum(b * v for b, v in zip(beta, x)) + rng.gauss(0, 1)
            rows.append((f"S{s}", y, rng.uniform(0.5, 2.0), *x))
    return rows


def test_per_store_ridge_matches_numpy(spark):
    p = 3
    rows = _rows(p=p)
    cols = [f"x{j}" for j in range(p)]
    df = spark.createDataFrame(rows, "store_id string, y double, w double, " + ", ".join(f"{c} double" for c in cols))
    df = df.repartition(4)  # several partial Gram matrices per store
    l2 = 0.5
    got = {r.store_id: r.coef for r in models.fit_per_store(df, cols, "y", "w", l2=l2).collect()}
    for s in {r[0] for r in rows}:
        sub = [r for r in rows if r[0] == s]
        X = np.column_stack([np.ones(len(sub)), np.array([r[3:] for r in sub])])
        w = np.array([r[2] for r in sub])
        y = np.array([r[1] for r in sub])
        A = X.T @ (X * w[:, None])
        sw = w.sum()
        mean = (X[:, 1:] * w[:, None]).sum(0) / sw
        var = (X[:, 1:] ** 2 * w[:, None]).sum(0) / sw - mean ** 2
        pen = np.diag(np.concatenate([[0.0], l2 * sw * var]))
        want = np.linalg.solve(A + pen, X.T @ (w * y))
        assert np.allclose(got[s], want, rtol=1e-8, atol=1e-8)


def test_blend_grid_matches_exhaustive_loop(spark):
    rng = random.Random(11)
    rows = [(f"S{s}", rng.uniform(0, 20), rng.uniform(0, 20), rng.uniform(0, 20), rng.uniform(0, 20))
            for s in range(3) for _ in range(40)]
    df = spark.createDataFrame(rows, "store_id string, y double, a double, b double, c double")
    got = {r.store_id: (r.grid_id, r.wmape) for r in ensemble.blend_grid(df, ["a", "b", "c"], y="y").collect()}
    grid = ensemble.weight_grid()
    for s in {r[0] for r in rows}:
        sub = [r for r in rows if r[0] == s]
        best = None
        for gid, w1, w2, w3 in grid:
            num = sum(abs(y - (w1 * a + w2 * b + w3 * c)) for _, y, a, b, c in sub if y > 0)
            den = sum(y for _, y, *_ in sub if y > 0)
            score = round(num / den, 12)
            if best is None or score < best[1]:
                best = (gid, score)
        assert got[s][0] == best[0]
        assert got[s][1] == pytest.approx(best[1], abs=1e-9)


def test_series_regression_matches_polyfit(spark):
    import datetime as dt
    rng = random.Random(5)
    rows = []
    for s in ("S1", "S2"):
        for k in range(50):
            t = rng.uniform(20, 80)
            rows.append((s, "i", dt.date(1997, 1, 1) + dt.timedelta(days=k), t, 3 + 0.5 * t + rng.gauss(0, 2)))
    df = spark.createDataFrame(rows, "store_id string, item_id string, date date, avg_temp_f double, quantity_filled double")
    out = baselines.series_regression(df, hz=Horizon()).select("store_id", "series_reg_slope", "series_reg_intercept") \
        .distinct().collect()
    for r in out:
        sub = [x for x in rows if x[0] == r.store_id]
        slope, icpt = np.polyfit([x[3] for x in sub], [x[4] for x in sub], 1)
        assert r.series_reg_slope == pytest.approx(slope, rel=1e-9)
        assert r.series_reg_intercept == pytest.approx(icpt, rel=1e-9)


def test_per_store_gram_salted_equals_unsalted(spark):
    p = 3
    rows = _rows(seed=9, p=p)
    cols = [f"x{j}" for j in range(p)]
    df = spark.createDataFrame(rows, "store_id string, y double, w double, " + ", ".join(f"{c} double" for c in cols))
    a = {r.store_id: (r.n, r.G, r.b) for r in models.per_store_gram(df, cols, "y", "w").collect()}
    b = {r.store_id: (r.n, r.G, r.b) for r in models.per_store_gram(df, cols, "y", "w", salts=4).collect()}
    assert a.keys() == b.keys()
    for k in a:
        assert a[k][0] == b[k][0]
        assert np.allclose(a[k][1], b[k][1]) and np.allclose(a[k][2], b[k][2])
