"""Regressors against closed forms, the full model on synthetic data, CV."""

import numpy as np
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from terrace.operators import cv as CV
from terrace.operators import models as M
from terrace.operators import split as S
from terrace.operators.metrics import regression_metrics
from terrace.sources.synthetic import synthetic_sales


def _data(spark, n=400, seed=3):
    rng = np.random.default_rng(seed)
    X = rng.normal(size=(n, 4)) * [1.0, 2.0, 0.5, 3.0]
    y = 1.5 + X @ [0.5, -0.2, 0.0, 0.1] + rng.normal(scale=0.3, size=n)
    df = spark.createDataFrame([tuple(map(float, r)) + (float(t),) for r, t in zip(X, y)],
                               "a double, b double, c double, d double, label double")
    df = VectorAssembler(inputCols=["a", "b", "c", "d"], outputCol="features").transform(df)
    return df, X, y


def test_ridge_matches_closed_form(spark):
    df, X, y = _data(spark)
    alpha = 25.0
    m = M.ridge(alpha).fit(df)
    Xc, yc = X - X.mean(0), y - y.mean()
    w = np.linalg.solve(Xc.T @ Xc + alpha * np.eye(4), Xc.T @ yc)
    assert np.allclose(m.coefficients.toArray(), w, atol=1e-5)
    assert abs(m.intercept - (y.mean() - X.mean(0) @ w)) < 1e-5


def _cd_enet(X, y, alpha, rho, iters=5000):
    n, p = X.shape
    Xc, yc = X - X.mean(0), y - y.mean()
    w = np.zeros(p)
    for _ in range(iters):
        for j in range(p):
            r = yc - Xc @ w + Xc[:, j] * w[j]
            z = Xc[:, j] @ r / n
            w[j] = np.sign(z) * max(abs(z) - alpha * rho, 0) / (Xc[:, j] @ Xc[:, j] / n + alpha * (1 - rho))
    return w


def test_lasso_and_elasticnet_match_coordinate_descent(spark):
    df, X, y = _data(spark)
    for est, rho in ((M.lasso(0.05), 1.0), (M.elasticnet(0.05, 0.5), 0.5)):
        m = est.fit(df)
        assert np.allclose(m.coefficients.toArray(), _cd_enet(X, y, 0.05, rho), atol=2e-4)


def test_group_median_regressor_unseen(spark):
    tr = spark.createDataFrame([("A", 1.0), ("A", 3.0), ("B", 10.0)], "g string, y double")
    te = spark.createDataFrame([("A",), ("C",), (None,)], "g string")
    m = M.GroupMedianRegressor(groupCol="g", labelCol="y").fit(tr)
    assert [r["prediction"] for r in m.transform(te).collect()] == [2.0, 3.0, 3.0]


def test_full_model_on_synthetic(spark, tmp_path):
    from pyspark.ml import PipelineModel
    df = synthetic_sales(spark, 1500).cache()
    train, test = df.filter(F.col("Id") <= 1200), df.filter(F.col("Id") > 1200)
    pipe = M.full_model(M.ridge(10.0), df.schema, "tree")
    model = pipe.fit(train)
    pred = model.transform(test.drop("SalePrice")).join(test.select("Id", "SalePrice"), "Id")
    assert regression_metrics(pred, "SalePrice", "prediction").first()["rmse_log"] < 0.25
    model.write().overwrite().save(str(tmp_path / "model"))
    again = PipelineModel.load(str(tmp_path / "model"))
    a = {r["Id"]: r["prediction"] for r in model.transform(test).collect()}
    b = {r["Id"]: r["prediction"] for r in again.transform(test).collect()}
    assert all(abs(a[k] - b[k]) < 1e-9 for k in a)


def test_linear_kind_and_unseen_level(spark):
    df = synthetic_sales(spark, 800).cache()
    train = df.filter(F.col("Id") <= 700)
    test = df.filter(F.col("Id") > 700).withColumn(
        "Neighborhood", F.when(F.col("Id") % 2 == 0, F.lit("Nowhere")).otherwise(F.col("Neighborhood")))
    model = M.full_model(M.lasso(0.0005), df.schema, "linear").fit(train)
    out = model.transform(test)
    assert out.filter(F.col("prediction").isNull()).count() == 0


def test_cross_validate_and_summary(spark):
    df = S.kfold(synthetic_sales(spark, 600), "Id", 3).cache()
    pipes = {"ridge": M.full_model(M.ridge(10.0), df.drop("fold").schema, "tree")}
    scores = CV.cross_validate(df, pipes, "fold", "SalePrice", parallelism=3)
    assert scores.count() == 3
    s = CV.cv_summary(scores).first()
    assert s["n_folds"] == 3 and s["cv_rmse_log"] < 0.3 and s["cv_std"] >= 0


def test_log_blend_model(spark, tmp_path):
    from terrace.operators.blend import LogBlendModel, LogBlendRegressor
    df = synthetic_sales(spark, 600).cache()
    train, test = df.filter(F.col("Id") <= 500), df.filter(F.col("Id") > 500)
    a = M.full_model(M.ridge(10.0), df.schema, "tree")
    b = M.full_model(M.lasso(0.001), df.schema, "linear")
    blend = LogBlendRegressor([("a", a), ("b", b)], [1.0, 0.0]).fit(train)
    out = blend.transform(test).collect()
    assert all(abs(r["prediction"] - r["a"]) < 1e-6 * r["a"] for r in out)
    blend.save(str(tmp_path / "blend"))
    again = LogBlendModel.load(str(tmp_path / "blend"))
    assert again.weights == [1.0, 0.0]


def test_linear_search_trial_table(spark):
    import json

    from terrace.operators import cv as CV
    df = S.kfold(synthetic_sales(spark, 600), "Id", 3)
    folds = CV.prepared_folds(df, None, M.prep_pipeline(df.drop("fold").schema, "linear"), "fold", "SalePrice")
    space = {"alpha": ("log", 1e-4, 1e-2)}
    trials = CV.linear_search(folds, lambda p: M.lasso(p["alpha"]), space, 5, "SalePrice")
    rows = trials.collect()
    assert len(rows) == 5 and all(0 < r["cv_rmse_log"] < 0.3 for r in rows)
    assert [json.loads(r["params"]) for r in rows] == [json.loads(r["params"]) for r in CV.linear_search(
        folds, lambda p: M.lasso(p["alpha"]), space, 5, "SalePrice").collect()]
    alone = CV.ablate_features({"linear": folds}, {"lasso": (M.lasso(json.loads(rows[2]["params"])["alpha"]), "linear")}, {"full": []},
                               "SalePrice").first()
    assert abs(alone["cv_rmse_log_mean"] - rows[2]["cv_rmse_log"]) < 1e-9
    named = trials.withColumn("model", F.lit("lasso"))
    best = CV.best_trial(named).first()
    assert best["best_cv_rmse_log"] == min(r["cv_rmse_log"] for r in rows)
    history = [r["best_so_far"] for r in CV.trial_history(named).orderBy("trial").collect()]
    assert history == list(np.minimum.accumulate([r["cv_rmse_log"] for r in rows]))




def test_prepared_repeats_equal_full_refits(spark):
    from pyspark.ml import Pipeline
    df = _data(spark, 200)[0].select("a", "b", F.col("label"), F.expm1("label").alias("SalePrice"), F.monotonically_increasing_id().alias("Id"))
    df = spark.createDataFrame(df.collect(), df.schema).coalesce(1)
    train, val = df.filter("Id % 5 <> 0"), df.filter("Id % 5 = 0")
    prep = VectorAssembler(inputCols=["a", "b"], outputCol="features")
    prepared = {"linear": CV.prepared_repeats(train, val, Pipeline(stages=[prep]), "Id", 3, 2, "SalePrice")}
    models = {"ridge": (M.ridge(10.0), "linear")}
    scores = CV.cross_validate_prepared(prepared, models, "SalePrice")
    pipe = Pipeline(stages=[prep, M.ridge(10.0), M.ExpPrediction(inputCol="log_prediction", outputCol="prediction")])
    again = CV.cross_validate(S.repeated_kfold(train, "Id", 3, 2), {"ridge": pipe}, "fold", "SalePrice", "repeat")
    key = ["model", "repeat", "fold", "test_rmse_log", "train_rmse_log"]
    got, want = (sorted(tuple(r) for r in x.select(key).collect()) for x in (scores, again))
    assert [r[:3] for r in got] == [("ridge", r, f) for r in range(2) for f in range(3)] and np.allclose(
        [r[3:] for r in got], [r[3:] for r in want])
    table = CV.comparison_table(scores, CV.validate_prepared(prepared, models, "SalePrice")).first().asDict()
    m = regression_metrics(pipe.fit(train).transform(val), "SalePrice", "prediction").first()
    assert len(table) == 11 and np.allclose([table[c] for c in ("val_rmse_log", "val_mae", "val_r2", "val_mape")],
                                            [m[c] for c in ("rmse_log", "mae", "r2_log", "mape")])
    assert np.isclose(table["overfit_gap"], np.mean([r[3] - r[4] for r in want]))


def test_registered_models_do_the_published_job(spark):
    from terrace.plans import q_model as q
    from terrace.config import CV_REPEATS, PUBLISHED_BEST, SEARCH_TRIALS
    from terrace.plans.registry import FULL_SIZE, QUERIES
    assert list(q._CV_MODELS) == ["Ridge", "Lasso", "ElasticNet", "RandomForest", "XGBoost", "LightGBM", "CatBoost"]
    forest = q._CV_MODELS["RandomForest"][0]()
    assert (forest.getNumTrees(), forest.getMaxDepth(), forest.getFeatureSubsetStrategy()) == (300, 30, "all")
    assert (q.K, CV_REPEATS) == (5, 3)
    for name, rate, depth in (("XGBoost", 0.03, 4), ("LightGBM", 0.03, 4), ("CatBoost", 0.05, 6)):
        m = q._CV_MODELS[name][0]()
        assert (m.getMaxIter(), m.getStepSize(), m.getMaxDepth()) == (1000, rate, depth)
    assert SEARCH_TRIALS == {"Lasso": 60, "ElasticNet": 60, "XGBoost": 40, "CatBoost": 25}
    assert list(PUBLISHED_BEST) == list(q._SEARCHES) and q._tuned_xgboost(PUBLISHED_BEST["XGBoost"]).getMaxIter() == 1476
    assert {"cv_scores_ridge", "cv_scores_lasso", "cv_scores_elasticnet", "cv_scores_linear", "tune_linear_search"} <= set(QUERIES)
    assert {"fit_gbt", "cv_scores_models", "tune_search", "blend_models_predict"} <= set(FULL_SIZE) and not set(FULL_SIZE) & set(QUERIES)
