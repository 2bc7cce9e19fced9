"""Ablation: decisions on the published table, and slots instead of refits."""

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from terrace.operators import cv as CV
from terrace.operators import models as M
from terrace.operators import split as S

#: The published ablation table (model, variant, mean, std, validation, delta).
PUBLISHED = [
    ("Lasso", "full", 0.10802764807821003, 0.008498773723713693, 0.11375052253367986, 0.0),
    ("Lasso", "minus_LotRatio", 0.10800700825202367, 0.008492385573432445, 0.1137505225336791, -2.063982618635829e-05),
    ("Lasso", "minus_IsRemodeled", 0.10796831794669302, 0.008506332738767454, 0.11386742570456197, -5.933013151700195e-05),
    ("Lasso", "minus_both_weak", 0.10794726477062373, 0.008499708965102673, 0.11386742570456135, -8.038330758629308e-05),
    ("Lasso", "no_engineered", 0.10910684333532371, 0.008917230385688528, 0.11347740201222592, 0.0010791952571136826),
    ("LightGBM", "full", 0.11506498520176474, 0.007910493921081955, 0.12803117914304166, 0.0),
    ("LightGBM", "minus_LotRatio", 0.11504979796272635, 0.008383129874043875, 0.1263329353557166, -1.5187239038386147e-05),
    ("LightGBM", "minus_IsRemodeled", 0.11510476103267195, 0.008436820436507028, 0.1261338693237313, 3.977583090720993e-05),
    ("LightGBM", "minus_both_weak", 0.11502139535515148, 0.008160358799586948, 0.12518276804693537, -4.358984661326226e-05),
    ("LightGBM", "no_engineered", 0.11893750174237994, 0.009478184900934931, 0.12270101500421109, 0.003872516540615198),
]
COLUMNS = ("model string, variant string, cv_rmse_log_mean double, cv_rmse_log_std double, val_rmse_log double, "
           "delta_vs_full double")


def test_decisions_on_the_published_table(spark):
    table = spark.createDataFrame(PUBLISHED, COLUMNS)
    got = {r["feature"]: (r["max_delta"], r["decision"]) for r in CV.weak_feature_decision(table, ["LotRatio", "IsRemodeled"]).collect()}
    assert got == {"LotRatio": (-1.5187239038386147e-05, "DROP"), "IsRemodeled": (3.977583090720993e-05, "DROP")}
    gain = {r["model"]: r["engineered_gain"] for r in CV.engineered_gain(table).collect()}
    assert gain == {"Lasso": 0.0010791952571136826, "LightGBM": 0.003872516540615198}
    hurt = table.withColumn("delta_vs_full", F.when(F.col("variant") == "minus_LotRatio", 0.002).otherwise(F.col("delta_vs_full")))
    assert {r["feature"]: r["decision"] for r in CV.weak_feature_decision(hurt, ["LotRatio", "IsRemodeled"]).collect()} == {
        "LotRatio": "KEEP", "IsRemodeled": "DROP"}


def test_a_variant_equals_a_refit_without_its_columns(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 3))
    y = np.exp(1 + x @ [0.3, 0.2, 0.0] + rng.normal(0, 0.05, 300)) * 100
    df = spark.createDataFrame([(i, *map(float, r), float(v)) for i, (r, v) in enumerate(zip(x, y))],
                               "Id int, a double, b double, c double, SalePrice double")
    df = df.withColumn("label", F.log1p("SalePrice"))
    train, val = S.kfold(df.filter("Id < 240"), "Id", 3), df.filter("Id >= 240")
    prep = Pipeline(stages=[VectorAssembler(inputCols=["a", "b", "c"], outputCol="features")])
    prepared = {"linear": CV.prepared_folds(train, val, prep, "fold", "SalePrice")}
    out = CV.ablate_features(prepared, {"ridge": (M.ridge(1.0), "linear")}, {"full": [], "minus_b": ["b"], "minus_c": ["c"]}, "SalePrice")
    rows = {r["variant"]: r for r in out.collect()}
    assert rows["minus_b"]["delta_vs_full"] > 0.05 > abs(rows["minus_c"]["delta_vs_full"]) and rows["full"]["delta_vs_full"] == 0
    pipe = Pipeline(stages=[VectorAssembler(inputCols=["a", "c"], outputCol="features"), M.ridge(1.0),
                            M.ExpPrediction(inputCol="log_prediction", outputCol="prediction")])
    again = CV.cross_validate(train, {"ridge": pipe}, "fold", "SalePrice", with_train=False).agg(F.avg("test_rmse_log")).first()[0]
    assert rows["minus_b"]["cv_rmse_log_mean"] == pytest.approx(again, rel=1e-9)
