"""Log-scale blending of several regressors.

Because the weights sum to one, the blend's squared OOF error on the log
scale is w'Gw with G[i, j] = mean((ly - l_i)(ly - l_j)), l_i the model's
clipped log prediction.  G is ONE aggregation over the OOF frame (K(K+1)/2
sums); the simplex-constrained minimum of w'Gw is then solved exactly on the
K x K matrix by enumerating supports (K is the number of models, <= ~8).
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Sequence

import numpy as np
from pyspark.ml import Estimator, Model
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.functions.exprs import col
from terrace.operators.metrics import log_clip


def gram(df: DataFrame, label: str, preds: Sequence[str]) -> DataFrame:
    """Long (i, j, model_i, model_j, g) for i <= j, one aggregation."""
    ly = F.log1p(col(label).cast("double"))
    res = [ly - log_clip(col(p)) for p in preds]
    pairs = [(i, j) for i in range(len(preds)) for j in range(i, len(preds))]
    one = df.agg(*[F.avg(res[i] * res[j]).alias(f"g{k}") for k, (i, j) in enumerate(pairs)])
    structs = [F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), F.lit(preds[i]).alias("model_i"),
                        F.lit(preds[j]).alias("model_j"), F.col(f"g{k}").alias("g"))
               for k, (i, j) in enumerate(pairs)]
    return one.select(F.explode(F.array(*structs)).alias("s")).select("s.*")


def gram_matrix(g_long: DataFrame, k: int) -> np.ndarray:
    """Collect the K x K matrix (K(K+1)/2 numbers of fitted state)."""
    G = np.zeros((k, k))
    for r in g_long.collect():
        G[r["i"], r["j"]] = G[r["j"], r["i"]] = r["g"]
    return G


def simplex_weights(G: np.ndarray) -> np.ndarray:
    """argmin w'Gw subject to w >= 0, sum(w) = 1, exactly (support enumeration)."""
    k = G.shape[0]
    if k > 16:
        raise ValueError("at most 16 models: the supports are enumerated")
    best, best_w = math.inf, np.ones(k) / k
    for size in range(1, k + 1):
        for supp in itertools.combinations(range(k), size):
            Gs = G[np.ix_(supp, supp)]
            try:
                x = np.linalg.solve(Gs, np.ones(size))
            except np.linalg.LinAlgError:
                x = np.linalg.lstsq(Gs, np.ones(size), rcond=None)[0]
            s = x.sum()
            if not np.isfinite(s) or abs(s) < 1e-300:
                continue
            w_s = x / s
            if (w_s < -1e-12).any():
                continue
            w = np.zeros(k)
            w[list(supp)] = np.clip(w_s, 0.0, None)
            w /= w.sum()
            obj = float(w @ G @ w)
            if obj < best - 1e-15:
                best, best_w = obj, w
    return best_w


def normalise(weights: Sequence[float] | None, k: int) -> list[float]:
    """Normalise to sum 1; none or zero-sum -> equal weights."""
    if weights is None:
        return [1.0 / k] * k
    w = [float(x) for x in weights]
    s = sum(w)
    return [x / s for x in w] if s > 0 else [1.0 / k] * k


def blend_expr(preds: Sequence[str], weights: Sequence[float] | None) -> Column:
    """expm1(sum_i w_i * log1p(max(p_i, 0)))."""
    w = normalise(weights, len(preds))
    acc = None
    for wi, p in zip(w, preds):
        term = F.lit(wi) * log_clip(col(p))
        acc = term if acc is None else acc + term
    return F.expm1(acc)


def rmse_from_gram(G: np.ndarray, w: Sequence[float]) -> float:
    w = np.asarray(w, dtype=float)
    return float(math.sqrt(max(w @ G @ w, 0.0)))


def decision(blend_oof: Column, best_oof: Column, blend_val: Column, best_val: Column,
             margin: float = 0.002) -> Column:
    return F.when((blend_oof < best_oof - margin) & (blend_val <= best_val),
                  F.lit("USE_BLEND")).otherwise(F.lit("USE_SINGLE"))


# ---------------------------------------------------------------- ensemble estimator (EXT-2)
class LogBlendRegressor(Estimator):
    """Fit K pipelines on the same rows and blend them on the log scale.

    ``fit`` returns a :class:`LogBlendModel`.  Scoring runs the K fitted
    pipelines one after another on ONE frame: the input columns travel in a
    struct so every child sees the original record, and each child leaves a
    single prediction column -- no join, no shuffle between the children.
    """

    def __init__(self, estimators: list[tuple[str, object]], weights: Sequence[float] | None = None):
        super().__init__()
        self.estimators = estimators
        self.weights = weights

    def _fit(self, df: DataFrame) -> "LogBlendModel":
        names = [n for n, _ in self.estimators]
        w = normalise(self.weights, len(names))
        return LogBlendModel([(n, est.fit(df)) for n, est in self.estimators], w)


class LogBlendModel(Model):
    """Fitted members and weights; a stage like any other model."""

    def __init__(self, models: list[tuple[str, object]], weights: list[float], prediction_col: str = "prediction"):
        super().__init__()
        self.models, self.weights, self.prediction_col = models, weights, prediction_col

    def _transform(self, df: DataFrame) -> DataFrame:
        cols = df.columns
        cur = df.select(F.struct(*[col(c) for c in cols]).alias("_raw"))
        preds = []
        for name, model in self.models:
            pc = f"_p_{name}"
            out = model.transform(cur.select("_raw", *preds, "_raw.*"))
            cur = out.select("_raw", *preds, F.col("prediction").alias(pc))
            preds.append(pc)
        blended = blend_expr(preds, self.weights)
        return cur.select("_raw.*", *[F.col(p).alias(p[3:]) for p in preds],
                          blended.alias(self.prediction_col))

    def save(self, path: str) -> None:
        import json
        import os
        for name, model in self.models:
            model.write().overwrite().save(os.path.join(path, name))
        spark = _active_session()
        spark.createDataFrame([(json.dumps({"names": [n for n, _ in self.models],
                                            "weights": self.weights}),)], "meta string") \
            .coalesce(1).write.mode("overwrite").text(os.path.join(path, "_meta"))

    @classmethod
    def load(cls, path: str) -> "LogBlendModel":
        import json
        import os

        from pyspark.ml import PipelineModel
        spark = _active_session()
        meta = json.loads(spark.read.text(os.path.join(path, "_meta")).first()[0])
        return cls([(n, PipelineModel.load(os.path.join(path, n))) for n in meta["names"]],
                   meta["weights"])


def _active_session():
    from pyspark.sql import SparkSession
    return SparkSession.active()
