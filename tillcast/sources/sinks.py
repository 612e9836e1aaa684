"""Forecast sink, output contract checks, summary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast import functions as fn

FORECAST_COLUMNS = ("date", "store_id", "item_id", "predicted_quantity")


def forecast_frame(preds: DataFrame, yhat: str = "predicted") -> DataFrame:
    """S5 query part: project, rename, format the date, sort by (date, store, item)."""
    return (preds.select(fn.date_text("date").alias("date"), "store_id", "item_id",
                         F.col(yhat).alias("predicted_quantity"))
                 .orderBy("date", "store_id", "item_id"))


def write_forecast(preds: DataFrame, path: str, yhat: str = "predicted", fmt: str = "csv",
                   single_file: bool = False, mode: str = "overwrite") -> None:
    """Write the forecast.  ``single_file`` funnels through one task — only for small outputs."""
    out = forecast_frame(preds, yhat)
    if single_file:
        out = out.coalesce(1)
    w = out.write.mode(mode)
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.format(fmt).save(path)


def forecast_quality(fc: DataFrame, expected: DataFrame | None = None, yhat: str = "predicted_quantity",
                     required=FORECAST_COLUMNS) -> DataFrame:
    """Output contract as rows (check, ok, value).

    ``expected``: the cells (date, store_id, item_id) that must be there, such as the future skeleton.  Rows, dates,
    stores and items are then held against it, and missing and unexpected cells are counted by anti joins.  One
    aggregate by cell serves all; a count of distinct values is a group by of its own, so no row is copied for it.
    """
    keys = list(FORECAST_COLUMNS[:3])
    cells = fc.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"), F.count_if(F.col(yhat).isNull()).alias("__null"),
                                  F.count_if(F.col(yhat) < 0).alias("__neg"))
    none = F.lit(0).cast("long")
    stats = cells.agg(F.coalesce(F.sum("__n"), none).alias("rows"), F.count(F.lit(1)).alias("distinct_keys"),
                      F.coalesce(F.sum("__null"), none).alias("null_preds"), F.coalesce(F.sum("__neg"), none).alias("negative_preds"))

    def levels(df, col):
        return df.select(col).distinct().agg(F.count(col)).scalar()

    stats = stats.withColumns({n: levels(fc, c) for n, c in (("dates", "date"), ("stores", "store_id"), ("items", "item_id"))})
    want = {}
    if expected is not None:
        exp = expected.select(fn.date_text("date").alias("date") if dict(expected.dtypes)["date"] == "date" else F.col("date"),
                              "store_id", "item_id")
        want = {"rows": exp.agg(F.count(F.lit(1))).scalar(), "dates": levels(exp, "date"),
                "stores": levels(exp, "store_id"), "items": levels(exp, "item_id")}
        stats = stats.withColumns({
            "missing": exp.join(cells, keys, "left_anti").agg(F.count(F.lit(1))).scalar(),
            "unexpected": cells.join(exp, keys, "left_anti").agg(F.count(F.lit(1))).scalar()})
        stats = stats.withColumns({f"want_{k}": v for k, v in want.items()})
    has_cols = all(c in fc.columns for c in required) and len(fc.columns) == len(required)

    def chk(name, ok, value):
        return F.struct(F.lit(name).alias("check"), ok.alias("ok"), value.cast("double").alias("value"))

    def held(c):
        return F.col(c) == F.col(f"want_{c}") if want else F.lit(True)

    checks = [
        chk("row_count", held("rows"), F.col("rows")),
        chk("non_negative", F.col("negative_preds") == 0, F.col("negative_preds")),
        chk("no_nulls", F.col("null_preds") == 0, F.col("null_preds")),
        chk("unique_keys", F.col("distinct_keys") == F.col("rows"), F.col("distinct_keys")),
        chk("date_coverage", held("dates"), F.col("dates")),
        chk("store_coverage", held("stores"), F.col("stores")),
        chk("item_coverage", held("items"), F.col("items")),
        chk("exact_columns", F.lit(has_cols), F.lit(float(len(fc.columns)))),
    ]
    if want:
        checks += [chk("missing_cells", F.col("missing") == 0, F.col("missing")),
                   chk("unexpected_cells", F.col("unexpected") == 0, F.col("unexpected"))]
    return stats.select(F.explode(F.array(*checks)).alias("c")).select("c.*")


def forecast_summary(fc: DataFrame, yhat: str = "predicted_quantity") -> DataFrame:
    """Rows, date range, distinct stores and items, mean prediction."""
    return fc.agg(
        F.count(F.lit(1)).alias("rows"),
        F.min("date").alias("first_date"), F.max("date").alias("last_date"),
        F.count_distinct("store_id").alias("stores"), F.count_distinct("item_id").alias("items"),
        F.avg(yhat).alias("mean_pred"),
    )


def forecast_preview(fc: DataFrame, n: int = 10) -> DataFrame:
    """First ``n`` rows in output order (a top-k, not a full sort)."""
    return fc.orderBy("date", "store_id", "item_id").limit(n)
