"""Regressors on a log target, built from ``pyspark.ml`` stages.

* ``LogLabel`` / ``ExpPrediction`` wrap any regressor so it is fitted on
  log1p(y) and predicts expm1 of its output (predictions clipped at 0 by the
  metrics, as the original scorer does).
* ``PenalisedLinear`` maps the textbook (sklearn-style) penalties onto
  Spark's ``LinearRegression``: Spark divides the L2 part by the label's
  standard deviation, so for penalty alpha, l1-ratio rho, label std s and n
  rows:  regParam = alpha*rho + s*alpha*(1-rho), elasticNetParam = alpha*rho /
  regParam; ridge (objective ||r||^2 + alpha||w||^2) is regParam = s*alpha/n.
  n and s come from one aggregate over the training rows.
* ``GroupMedianRegressor`` is the deterministic baseline (median label per
  group) whose predictions an SQL engine can replay exactly.
* Trees: ``RandomForestRegressor`` and ``GBTRegressor`` presets.
"""

from __future__ import annotations

import json

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline, Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrace.config import DROP_AFTER, DROP_COLS
from terrace.functions.exprs import col
from terrace.operators.state import attach, free_name, group_state


class _IO(Params):
    inputCol = Param(Params._dummy(), "inputCol", "", typeConverter=TypeConverters.toString)
    outputCol = Param(Params._dummy(), "outputCol", "", typeConverter=TypeConverters.toString)


class LogLabel(Transformer, _IO, DefaultParamsReadable, DefaultParamsWritable):
    """outputCol = log1p(inputCol); NULL when the label is absent (scoring)."""

    @keyword_only
    def __init__(self, inputCol: str = "SalePrice", outputCol: str = "label"):
        super().__init__()
        self._setDefault(inputCol="SalePrice", outputCol="label")
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        src, dst = self.getOrDefault(self.inputCol), self.getOrDefault(self.outputCol)
        val = F.log1p(col(src).cast("double")) if src in df.columns else F.lit(None).cast("double")
        return df.withColumn(dst, val)


class ExpPrediction(Transformer, _IO, DefaultParamsReadable, DefaultParamsWritable):
    """outputCol = expm1(inputCol): back to the price scale."""

    @keyword_only
    def __init__(self, inputCol: str = "log_prediction", outputCol: str = "prediction"):
        super().__init__()
        self._setDefault(inputCol="log_prediction", outputCol="prediction")
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn(self.getOrDefault(self.outputCol),
                             F.expm1(col(self.getOrDefault(self.inputCol))))


class PenalisedLinear(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Ridge / Lasso / ElasticNet with textbook penalties on Spark's solver."""

    kind = Param(Params._dummy(), "kind", "ridge|lasso|elasticnet", typeConverter=TypeConverters.toString)
    alpha = Param(Params._dummy(), "alpha", "penalty strength", typeConverter=TypeConverters.toFloat)
    l1Ratio = Param(Params._dummy(), "l1Ratio", "L1 share", typeConverter=TypeConverters.toFloat)
    featuresCol = Param(Params._dummy(), "featuresCol", "", typeConverter=TypeConverters.toString)
    labelCol = Param(Params._dummy(), "labelCol", "", typeConverter=TypeConverters.toString)
    predictionCol = Param(Params._dummy(), "predictionCol", "", typeConverter=TypeConverters.toString)
    maxIter = Param(Params._dummy(), "maxIter", "", typeConverter=TypeConverters.toInt)
    solver = Param(Params._dummy(), "solver", "normal|l-bfgs", typeConverter=TypeConverters.toString)

    @keyword_only
    def __init__(self, kind: str = "ridge", alpha: float = 1.0, l1Ratio: float = 0.5,
                 featuresCol: str = "features", labelCol: str = "label",
                 predictionCol: str = "log_prediction", maxIter: int = 50_000, solver: str = "normal"):
        super().__init__()
        self._setDefault(kind="ridge", alpha=1.0, l1Ratio=0.5, featuresCol="features",
                         labelCol="label", predictionCol="log_prediction", maxIter=50_000, solver="normal")
        self._set(**self._input_kwargs)

    def spark_params(self, n: float, s: float) -> tuple[float, float]:
        kind, a = self.getOrDefault(self.kind), self.getOrDefault(self.alpha)
        if kind == "ridge":
            return s * a / n, 0.0
        rho = 1.0 if kind == "lasso" else self.getOrDefault(self.l1Ratio)
        reg = a * rho + s * a * (1.0 - rho)
        return reg, (a * rho / reg if reg > 0 else 0.0)

    def _fit(self, df: DataFrame):
        label = self.getOrDefault(self.labelCol)
        feats = self.getOrDefault(self.featuresCol)
        # "normal": ONE distributed pass builds X'X (p x p), the solve is local
        # (Cholesky, or quasi-Newton when L1 is present); Spark allows it up to
        # 4,096 features and says so beyond: then ask for "l-bfgs".
        solver = self.getOrDefault(self.solver)
        std = F.stddev_pop if solver == "normal" else F.stddev_samp
        st = df.agg(F.count(col(label)).alias("n"), std(col(label)).alias("s")).first()
        n, s = float(st["n"] or 1), float(st["s"] or 0.0)
        reg, en = self.spark_params(n, s if s > 0 else 1.0)
        lr = LinearRegression(featuresCol=feats, labelCol=label,
                              predictionCol=self.getOrDefault(self.predictionCol),
                              regParam=reg, elasticNetParam=en, standardization=False,
                              solver=solver, maxIter=self.getOrDefault(self.maxIter), tol=1e-9)
        return lr.fit(df)


def ridge(alpha: float = 10.0) -> PenalisedLinear:
    return PenalisedLinear(kind="ridge", alpha=alpha)


def lasso(alpha: float = 0.0005) -> PenalisedLinear:
    return PenalisedLinear(kind="lasso", alpha=alpha)


def elasticnet(alpha: float = 0.0005, l1_ratio: float = 0.5) -> PenalisedLinear:
    return PenalisedLinear(kind="elasticnet", alpha=alpha, l1Ratio=l1_ratio)


def random_forest(trees: int = 50, depth: int = 8, seed: int = 42) -> RandomForestRegressor:
    return RandomForestRegressor(featuresCol="features", labelCol="label",
                                 predictionCol="log_prediction", numTrees=trees, maxDepth=depth,
                                 seed=seed, featureSubsetStrategy="all")


GBT_PRESETS = {
    # three boosting flavours re-aimed onto one engine: depth, rate, row / column sampling
    "xgboost": dict(maxDepth=3, stepSize=0.1, subsamplingRate=0.85, featureSubsetStrategy="0.33",
                    minInstancesPerNode=4),
    "lightgbm": dict(maxDepth=5, stepSize=0.1, subsamplingRate=0.8, featureSubsetStrategy="0.5",
                     minInstancesPerNode=20),
    "catboost": dict(maxDepth=4, stepSize=0.1, subsamplingRate=1.0, featureSubsetStrategy="all",
                     minInstancesPerNode=1),
}


def gbt(preset: str = "xgboost", rounds: int = 20, seed: int = 42, **overrides) -> GBTRegressor:
    p = dict(GBT_PRESETS[preset])
    p.update(overrides)
    return GBTRegressor(featuresCol="features", labelCol="label", predictionCol="log_prediction",
                        maxIter=rounds, seed=seed, **p)


# ---------------------------------------------------------------- baseline
class GroupMedianRegressor(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Median label per group; unseen / NULL group -> global median."""

    groupCol = Param(Params._dummy(), "groupCol", "", typeConverter=TypeConverters.toString)
    labelCol = Param(Params._dummy(), "labelCol", "", typeConverter=TypeConverters.toString)
    predictionCol = Param(Params._dummy(), "predictionCol", "", typeConverter=TypeConverters.toString)

    @keyword_only
    def __init__(self, groupCol: str = "Neighborhood", labelCol: str = "SalePrice",
                 predictionCol: str = "prediction"):
        super().__init__()
        self._setDefault(groupCol="Neighborhood", labelCol="SalePrice", predictionCol="prediction")
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> "GroupMedianModel":
        from terrace.operators.quantile import column_quantiles, grouped_quantiles
        gname, yname = self.getOrDefault(self.groupCol), self.getOrDefault(self.labelCol)
        q = grouped_quantiles(df.filter(col(gname).isNotNull()), [gname], yname, [0.5])
        sizes = df.groupBy(col(gname).alias("group")).agg(F.count(F.lit(1)).alias("n"))
        state = group_state(q.select(col(gname).alias("group"), F.col("q")[0].alias("value")), sizes)
        glob = (column_quantiles(df, [yname], [0.5])[yname] or [None])[0]
        m = GroupMedianModel(groupCol=self.getOrDefault(self.groupCol),
                             predictionCol=self.getOrDefault(self.predictionCol))
        m._set(stateJson=json.dumps({"groups": state, "global": glob}))
        return m


class GroupMedianModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    groupCol = Param(Params._dummy(), "groupCol", "", typeConverter=TypeConverters.toString)
    predictionCol = Param(Params._dummy(), "predictionCol", "", typeConverter=TypeConverters.toString)
    stateJson = Param(Params._dummy(), "stateJson", "", typeConverter=TypeConverters.toString)

    @keyword_only
    def __init__(self, groupCol: str = "Neighborhood", predictionCol: str = "prediction"):
        super().__init__()
        self._setDefault(groupCol="Neighborhood", predictionCol="prediction", stateJson="{}")
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        st, name = json.loads(self.getOrDefault(self.stateJson)), free_name(df, "_median")
        joined = attach(df, self.getOrDefault(self.groupCol), st.get("groups", {"values": {}}), name)
        p = F.coalesce(F.col(name), F.lit(st.get("global")).cast("double"))
        return joined.withColumn(self.getOrDefault(self.predictionCol), p).drop(name)


# ---------------------------------------------------------------- full model (ENC-9)
def engineered_schema(schema: T.StructType, id_col: str, drop_cols=DROP_COLS,
                      drop_after=DROP_AFTER) -> T.StructType:
    """Schema after impute -> drop -> features, computed without running a job."""
    from pyspark.sql import SparkSession

    from terrace.operators.features import engineer
    spark = SparkSession.active()  # thread-safe: falls back to the default session
    empty = spark.createDataFrame([], schema)
    out = engineer(empty.drop(*[c for c in drop_cols if c != id_col]), list(drop_after))
    return out.schema


def _prep_stages(schema: T.StructType, kind: str, id_col: str, target: str,
                 min_frequency: float, drop_cols, drop_after) -> list:
    from terrace.operators.clean import ColumnDropper, DomainImputer
    from terrace.operators.encode import preprocessing_stages
    from terrace.operators.features import FeatureEngineer

    keep_id = [c for c in drop_cols if c != id_col]  # the key is carried, never a feature
    eng = engineered_schema(schema, id_col, drop_cols, drop_after)
    prep = preprocessing_stages(eng, kind, min_frequency, exclude=[id_col, target, "label"])
    return [DomainImputer(), ColumnDropper(cols=keep_id), FeatureEngineer(dropAfter=list(drop_after)),
            LogLabel(inputCol=target, outputCol="label"), *prep]


def prep_pipeline(schema: T.StructType, kind: str = "tree", id_col: str = "Id",
                  target: str = "SalePrice", min_frequency: float = 0.01,
                  drop_cols=DROP_COLS, drop_after=DROP_AFTER) -> Pipeline:
    """impute -> drop -> features -> log label -> preprocess (no regressor)."""
    return Pipeline(stages=_prep_stages(schema, kind, id_col, target, min_frequency, drop_cols,
                                        drop_after))


def full_model(regressor, schema: T.StructType, kind: str = "tree", id_col: str = "Id",
               target: str = "SalePrice", min_frequency: float = 0.01,
               drop_cols=DROP_COLS, drop_after=DROP_AFTER) -> Pipeline:
    """impute -> drop -> features -> log label -> preprocess -> regressor -> expm1."""
    stages = _prep_stages(schema, kind, id_col, target, min_frequency, drop_cols, drop_after)
    return Pipeline(stages=[*stages, regressor,
                            ExpPrediction(inputCol="log_prediction", outputCol="prediction")])
