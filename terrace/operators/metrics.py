"""Regression metrics as single-pass aggregates, plus an ML Evaluator.

Predictions and labels are columns of the same row (never two frames
zipped by position), so every metric is one aggregation.
"""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.config import MAPE_EPS, PRICE_BANDS
from terrace.functions.exprs import band_order, col


def log_clip(c: Column) -> Column:
    """log1p(max(c, 0)) -- NULL stays NULL."""
    return F.log1p(F.when(c < 0, F.lit(0.0)).otherwise(c.cast("double")))


def rmse_log(y: Column, p: Column) -> Column:
    return F.sqrt(F.avg(F.pow(log_clip(y) - log_clip(p), 2)))


def mape(y: Column, p: Column) -> Column:
    """Mean |y-p| / max(|y|, eps) as a fraction."""
    return F.avg(F.abs(y - p) / F.greatest(F.abs(y), F.lit(MAPE_EPS)))


def r2(y: Column, p: Column) -> Column:
    """1 - SS_res / SS_tot in one pass (SS_tot = n * var_pop(y))."""
    return 1.0 - F.sum(F.pow(y - p, 2)) / (F.var_pop(y) * F.count(y))


def regression_metrics(df: DataFrame, label: str, pred: str) -> DataFrame:
    y, p = col(label).cast("double"), col(pred).cast("double")
    m = mape(y, p)
    return df.agg(
        F.count(F.lit(1)).cast("bigint").alias("n"),
        rmse_log(y, p).alias("rmse_log"),
        F.avg(F.abs(y - p)).alias("mae"),
        F.sqrt(F.avg(F.pow(y - p, 2))).alias("rmse"),
        m.alias("mape"),
        (m * 100.0).alias("mape_pct"),
        r2(y, p).alias("r2_dollar"),
        r2(F.log1p(y), F.log1p(p)).alias("r2_log"),
        (100.0 - m * 100.0).alias("accuracy_pct"),
    )


def metrics_by_band(df: DataFrame, label: str, pred: str, bands=PRICE_BANDS) -> DataFrame:
    """Count, MAE and MAPE (percent) per fixed band; empty bands report 0."""
    y, p = col(label).cast("double"), col(pred).cast("double")
    g = (df.select(band_order(y, bands).alias("band_order"), y.alias("y"), p.alias("p"))
         .groupBy("band_order")
         .agg(F.count(F.lit(1)).cast("bigint").alias("count"),
              F.avg(F.abs(F.col("y") - F.col("p"))).alias("mae"),
              (mape(F.col("y"), F.col("p")) * 100.0).alias("mape")))
    dim = df.sparkSession.createDataFrame([(i, b[0]) for i, b in enumerate(bands)],
                                          "band_order int, band string")
    return dim.join(g, "band_order", "left").select(
        "band_order", "band", F.coalesce("count", F.lit(0)).cast("bigint").alias("count"),
        F.coalesce("mae", F.lit(0.0)).alias("mae"), F.coalesce("mape", F.lit(0.0)).alias("mape")
    ).orderBy("band_order")


def metrics_multi(df: DataFrame, label: str, preds: dict[str, str]) -> DataFrame:
    """Metrics for several prediction columns in one pass: unpivot to
    (model, y, p) and aggregate per model."""
    arr = F.array(*[F.struct(F.lit(m).alias("model"), col(c).cast("double").alias("p"))
                    for m, c in preds.items()])
    long = df.select(col(label).cast("double").alias("y"), F.explode(arr).alias("s")) \
        .select("s.model", "y", "s.p")
    y, p = F.col("y"), F.col("p")
    return long.groupBy("model").agg(
        F.count(F.lit(1)).cast("bigint").alias("n"), rmse_log(y, p).alias("rmse_log"),
        F.avg(F.abs(y - p)).alias("mae"), (mape(y, p) * 100.0).alias("mape_pct"))


class RmseLogEvaluator(Evaluator):
    """RMSE on the log1p scale (predictions clipped at 0); smaller is better."""

    labelCol = Param(Params._dummy(), "labelCol", "label column", typeConverter=TypeConverters.toString)
    predictionCol = Param(Params._dummy(), "predictionCol", "prediction column",
                          typeConverter=TypeConverters.toString)

    @keyword_only
    def __init__(self, labelCol: str = "label", predictionCol: str = "prediction"):
        super().__init__()
        self._setDefault(labelCol="label", predictionCol="prediction")
        self._set(**self._input_kwargs)

    def _evaluate(self, dataset: DataFrame) -> float:
        y = col(self.getOrDefault(self.labelCol)).cast("double")
        p = col(self.getOrDefault(self.predictionCol)).cast("double")
        return float(dataset.agg(rmse_log(y, p)).first()[0])

    def isLargerBetter(self) -> bool:
        return False
