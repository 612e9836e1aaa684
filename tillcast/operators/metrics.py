"""Weighted MAPE, accuracy, MAE — as aggregate expressions and an MLlib evaluator."""

from __future__ import annotations

from pyspark.ml.evaluation import Evaluator
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillcast import functions as fn


def wmape_expr(y: str = "quantity", yhat: str = "predicted", positive_only: bool = True) -> Column:
    """sum|y - yhat| / sum y over rows with y > 0 (or all rows with a known y, T18).

    NULL when one of these rows has no prediction: its volume can't be scored.
    """
    keep = (F.col(y) > 0) if positive_only else F.col(y).isNotNull()
    err = F.sum(F.when(keep, F.abs(F.col(y) - F.col(yhat))))
    vol = F.sum(F.when(keep, F.col(y)))
    return F.when(F.count_if(keep & F.col(yhat).isNull()) == 0, fn.safe_div(err, vol))


def wmape(df: DataFrame, y: str = "quantity", yhat: str = "predicted", by=None,
          positive_only: bool = True) -> DataFrame:
    """wMAPE and accuracy (1 - wMAPE), overall or per ``by``."""
    by = [by] if isinstance(by, str) else list(by or [])
    w = wmape_expr(y, yhat, positive_only)
    return df.groupBy(*by).agg(w.alias("wmape"), (F.lit(1.0) - w).alias("accuracy"))


def mae(df: DataFrame, y: str = "quantity", yhat: str = "predicted", by=None) -> DataFrame:
    by = [by] if isinstance(by, str) else list(by or [])
    return df.groupBy(*by).agg(F.avg(F.abs(F.col(y) - F.col(yhat))).alias("mae"))


class WmapeEvaluator(Evaluator):
    """MLlib evaluator for wMAPE (smaller is better)."""

    labelCol = Param(Params._dummy(), "labelCol", "label column", TypeConverters.toString)
    predictionCol = Param(Params._dummy(), "predictionCol", "prediction column", TypeConverters.toString)
    positiveOnly = Param(Params._dummy(), "positiveOnly", "score only y > 0", TypeConverters.toBoolean)

    def __init__(self, labelCol: str = "label", predictionCol: str = "prediction", positiveOnly: bool = True):
        super().__init__()
        self._setDefault(labelCol="label", predictionCol="prediction", positiveOnly=True)
        self._set(labelCol=labelCol, predictionCol=predictionCol, positiveOnly=positiveOnly)

    def _evaluate(self, dataset: DataFrame) -> float:
        y, yhat = self.getOrDefault(self.labelCol), self.getOrDefault(self.predictionCol)
        row = dataset.agg(wmape_expr(y, yhat, self.getOrDefault(self.positiveOnly)).alias("w")).first()
        return float("nan") if row["w"] is None else float(row["w"])

    def isLargerBetter(self) -> bool:
        return False
