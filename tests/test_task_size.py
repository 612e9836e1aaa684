"""What one task holds: joins of a stage, rows of the series windows, files of a frame staged by store."""

import os
import re

from pyspark.sql import functions as F

from tillcast.catalog.queries_core import prepared
from tillcast.operators import features, models

SF_SMALL = "/root/testdata/sf0.001"


def test_feature_frame_joins_few_tables_a_stage_and_spreads_the_windows(spark, monkeypatch):
    plans, stage = [], features.stage

    def seen(df):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return stage(df)

    monkeypatch.setattr(features, "stage", seen)
    monkeypatch.setattr(features, "ROWS_PER_TASK", 100, raising=False)
    f = features.build_features(prepared(spark, SF_SMALL))
    rows = f.count()
    assert rows == prepared(spark, SF_SMALL).count()
    assert max(len(re.findall(r"\bJoin ", p)) for p in plans) <= 12      # 21 before
    spread = [int(n) for n in re.findall(r"RepartitionByExpression \[store_id#\d+, item_id#\d+\], (\d+)", plans[-1])]
    assert spread and min(spread) >= rows // 100


def test_frame_staged_by_store_has_files_for_its_rows(spark, monkeypatch):
    monkeypatch.setattr(models, "FILE_ROWS", 100, raising=False)
    df = spark.range(0, 3000, 1, 16).select(F.when(F.col("id") % 3 > 0, "hot").when(F.col("id") % 2 == 0, "cold").alias("store_id"),
                                            F.date_add(F.lit("2000-01-01"), F.col("id").cast("int")).alias("date"), "id")
    out = models.stage_by(df)
    assert sorted(out.select("id", "store_id").collect()) == sorted(df.select("id", "store_id").collect())
    by_store = {}
    for name in out.inputFiles():
        by_store[os.path.dirname(name)] = by_store.get(os.path.dirname(name), 0) + 1
    # 16 tasks wrote a file for every store before
    assert len(by_store) == 3 and max(by_store.values()) <= 20 and min(by_store.values()) <= 5
