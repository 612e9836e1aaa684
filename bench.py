"""Headline timings: panel binding, minimum slice, v4 feature build, closed-form
ensemble report, model-free daily plan and the MLlib learner ensemble, each
run from the raw tables in a fresh plan (no memoised frames).

Prints one JSON line.  Env: BENCH_SF_DIR (default /root/testdata/sf0.1),
BENCH_CPUS (default 8).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from tillcast.horizon import DEFAULT as HZ  # noqa: E402
from tillcast.operators import metrics, prep  # noqa: E402
from tillcast.operators.features import build_features  # noqa: E402
from tillcast.plans import forecasts, learners, monthly  # noqa: E402
from tillcast.session import local_session  # noqa: E402
from tillcast.sources import star  # noqa: E402


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None
    spark = local_session(cpus, shuffle_partitions=max(8, cpus))
    # warm the JVM (class loading / codegen) outside the timings
    spark.read.parquet(f"{sf_dir}/region.parquet").count()

    def panel():
        return star.panel_from_star(spark, sf_dir, HZ)

    def q_panel():
        return panel().count()

    def q_min_slice():
        from tillcast.catalog.queries_core import structural_forecast
        fc = structural_forecast(prep.prepare(panel(), HZ))
        test = fc.where(F.col("date") >= F.lit(HZ.test_start))
        return test.groupBy("category").agg(metrics.wmape_expr("quantity", "predicted")).collect()

    state = {}

    def q_features():
        state["f"] = build_features(prep.prepare(panel(), HZ))
        return state["f"].count()

    def q_ensemble_report():
        out, _, _ = forecasts.ensemble_forecast(state["f"], HZ)
        return forecasts.score_breakdown(out.where(F.col("split") == "test")).collect()

    def q_daily_plan():
        p = panel()
        return monthly.method_comparison(monthly.daily_plan(p, HZ), p, HZ).collect()

    def q_learner_ensemble():
        out, _, _, _ = learners.learner_ensemble(state["f"], HZ)
        return metrics.wmape(out, "quantity", "predicted", by="split").collect()

    timings = {}
    for name, fn_ in [("panel", q_panel), ("min_slice", q_min_slice), ("features_v4", q_features),
                      ("ensemble_report", q_ensemble_report), ("daily_plan", q_daily_plan),
                      ("learner_ensemble", q_learner_ensemble)]:
        t0 = time.time()
        fn_()
        timings[name] = round(time.time() - t0, 3)
    spark.stop()
    print(json.dumps({"metric": "headline_total", "value": round(sum(timings.values()), 3), "unit": "sec",
                      "queries": timings, "sf": sf}))


if __name__ == "__main__":
    main()
