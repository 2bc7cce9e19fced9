"""Cross-validation, out-of-fold predictions, ablation and hyper-parameter
search.

* Folds are a column of the data (hash assignment), never index lists.
* Every fold re-fits the whole pipeline on its training rows (no leakage).
* Folds x models are independent Spark jobs submitted concurrently from a
  small thread pool (the ``CrossValidator(parallelism=...)`` pattern), so
  the cluster works on several fits at once.
* For the group-median baseline the per-fold state of ALL folds comes from
  one job over (group, fold) counts: a fold's training medians are those of
  the other folds' counts added up, no row is repeated per fold.
"""

from __future__ import annotations

import math
import random
import time
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml import Pipeline
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.functions.exprs import col
from terrace.operators.metrics import rmse_log


# ---------------------------------------------------------------- baseline, one job for all folds
def fold_group_medians(df: DataFrame, fold_col: str, k: int, group: str, label: str) -> DataFrame:
    """(_f, _g, _gm): medians per group over the rows outside fold ``_f``."""
    from terrace.operators.quantile import grouped_quantiles
    return grouped_quantiles(df.filter(col(group).isNotNull()), [group], label, [0.5], (fold_col, k)).select(
        F.col("held_out").alias("_f"), col(group).alias("_g"), F.col("q")[0].alias("_gm"))


def fold_medians(df: DataFrame, fold_col: str, k: int, label: str) -> DataFrame:
    """(_f, _glob): medians over all rows outside fold ``_f``."""
    from terrace.operators.quantile import grouped_quantiles
    return grouped_quantiles(df, [], label, [0.5], (fold_col, k)).select(
        F.col("held_out").alias("_f"), F.col("q")[0].alias("_glob"))


def fold_train_scores(df: DataFrame, fold_col: str, k: int, group: str, label: str,
                      medians: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """(fold, train_rmse_log) of the group-median model of every fold on its own
    training rows, from one sum table per (group, fold): no row is repeated.
    ``medians`` are those of the two functions above, if already there."""
    gm, glob = medians or (fold_group_medians(df, fold_col, k, group, label), fold_medians(df, fold_col, k, label))
    ly = F.log1p(F.greatest(col(label).cast("double"), F.lit(0.0)))
    sums = df.groupBy(col(group).alias("_g"), col(fold_col).cast("int").alias("_fold")).agg(
        F.count(ly).alias("_n"), F.sum(ly).alias("_s"), F.sum(ly * ly).alias("_q"))
    every = F.sequence(F.lit(0), F.lit(k - 1))
    sums = sums.withColumn("_f", F.explode(F.filter(every, lambda f: f != F.col("_fold")))).groupBy("_f", "_g").agg(
        *[F.sum(c).alias(c) for c in ("_n", "_s", "_q")])
    lp = F.log1p(F.greatest(F.coalesce("_gm", "_glob"), F.lit(0.0)))
    error = F.col("_q") - 2 * lp * F.col("_s") + F.col("_n") * lp * lp
    return sums.join(gm, ["_f", "_g"], "left").join(glob, "_f").groupBy(F.col("_f").alias("fold")).agg(
        F.sqrt(F.sum(error) / F.sum("_n")).alias("train_rmse_log"))


def fold_group_median_predictions(df: DataFrame, fold_col: str, k: int, group: str, label: str,
                                  name: str = "prediction",
                                  medians: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """Out-of-fold group-median predictions for every row (unseen group ->
    that fold's global median), computed for all folds at once."""
    gm, glob = medians or (fold_group_medians(df, fold_col, k, group, label), fold_medians(df, fold_col, k, label))
    # (#folds x #groups) and #folds rows of fitted state; AQE broadcasts by measured size
    out = (df.join(gm, (col(fold_col) == F.col("_f")) & (col(group) == F.col("_g")), "left")
           .drop("_f", "_g")
           .join(glob, col(fold_col) == F.col("_f"), "left").drop("_f"))
    return out.withColumn(name, F.coalesce("_gm", "_glob")).drop("_gm", "_glob")


def fold_scores_from_predictions(df: DataFrame, fold_col: str, label: str, pred: str) -> DataFrame:
    return df.groupBy(col(fold_col).alias("fold")).agg(
        rmse_log(col(label), col(pred)).alias("test_rmse_log"))


def cv_summary(scores: DataFrame, model_col: str = "model") -> DataFrame:
    """mean, population std, train mean and overfit gap per model."""
    return scores.groupBy(model_col).agg(
        F.avg("test_rmse_log").alias("cv_rmse_log"),
        F.stddev_pop("test_rmse_log").alias("cv_std"),
        F.avg("train_rmse_log").alias("train_rmse_log"),
        (F.avg("test_rmse_log") - F.avg("train_rmse_log")).alias("overfit_gap"),
        F.count(F.lit(1)).cast("bigint").alias("n_folds"))


# ---------------------------------------------------------------- general pipelines
def _score(pred: DataFrame, label: str) -> float:
    v = pred.agg(rmse_log(col(label), F.col("prediction"))).first()[0]
    return float(v) if v is not None else math.nan


def cross_validate(df: DataFrame, pipelines: dict[str, Pipeline], fold_col: str = "fold",
                   label: str = "SalePrice", repeat_col: str | None = None,
                   parallelism: int = 4, with_train: bool = True) -> DataFrame:
    """One row per (model, repeat, fold): test / train RMSE(log), fit seconds."""
    spark = df.sparkSession
    base = df.cache()
    keys = [r[0] for r in base.select(col(fold_col)).distinct().collect()]
    repeats = ([r[0] for r in base.select(col(repeat_col)).distinct().collect()]
               if repeat_col else [None])
    tasks = [(m, r, f) for m in pipelines for r in repeats for f in sorted(keys)]

    def run(task):
        m, r, f = task
        part = base if r is None else base.filter(col(repeat_col) == r)
        tr, te = part.filter(col(fold_col) != f), part.filter(col(fold_col) == f)
        t0 = time.time()
        model = pipelines[m].fit(tr)
        fit_s = time.time() - t0
        test = _score(model.transform(te), label)
        train = _score(model.transform(tr), label) if with_train else math.nan
        return (m, r if r is not None else 0, int(f), test, train, fit_s)

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as ex:
        rows = list(ex.map(run, tasks))
    return spark.createDataFrame(rows, "model string, repeat int, fold int, test_rmse_log double, "
                                       "train_rmse_log double, fit_seconds double")


def oof_predictions(df: DataFrame, pipelines: dict[str, Pipeline], id_col: str,
                    fold_col: str = "fold", label: str = "SalePrice",
                    parallelism: int = 4) -> DataFrame:
    """(id, label, <model>...) with each model's out-of-fold prediction.

    Per-fold predictions are unioned long and pivoted with ONE groupBy(id)."""
    base = df.cache()
    folds = sorted(r[0] for r in base.select(col(fold_col)).distinct().collect())
    tasks = [(m, f) for m in pipelines for f in folds]

    def run(task):
        m, f = task
        model = pipelines[m].fit(base.filter(col(fold_col) != f))
        return (model.transform(base.filter(col(fold_col) == f))
                .select(col(id_col).alias("_id"), F.lit(m).alias("_m"),
                        F.col("prediction").alias("_p")))

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as ex:
        parts = list(ex.map(run, tasks))
    long = parts[0]
    for p in parts[1:]:
        long = long.unionByName(p)
    wide = long.groupBy("_id").agg(*[F.max(F.when(F.col("_m") == m, F.col("_p"))).alias(m)
                                     for m in pipelines])
    return base.select(col(id_col).alias("_id"), col(label)).join(wide, "_id") \
        .withColumnRenamed("_id", id_col)


# ---------------------------------------------------------------- prepared folds
def prepared_folds(train: DataFrame, holdout: DataFrame | None, prep: Pipeline, fold_col: str, label: str,
                   parallelism: int = 4) -> dict[object, tuple[list[str], DataFrame, DataFrame]]:
    """Feature names, training rows and test rows of every fold, with ``prep``
    fitted on the fold's training rows once for all models and variants that
    use it; under ``None`` the whole of ``train`` against ``holdout``.  The
    prepared rows (label, features, target) are written to the shared folder."""
    from terrace.session import scratch_path
    spark = train.sparkSession
    folds: list = sorted(r[0] for r in train.select(col(fold_col)).distinct().collect())

    def one(f):
        tr = train.drop(fold_col) if f is None else train.filter(col(fold_col) != f).drop(fold_col)
        te = holdout if f is None else train.filter(col(fold_col) == f).drop(fold_col)
        model = prep.fit(tr)
        frames = []
        for part in (tr, te):
            path = scratch_path(spark, "fold")
            model.transform(part).select("label", "features", col(label)).write.parquet(path)
            frames.append(spark.read.parquet(path))
        return f, (model.stages[-1].getInputCols(), *frames)

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as ex:
        return dict(ex.map(one, [*folds, *([None] if holdout is not None else [])]))


def prepared_repeats(train: DataFrame, holdout: DataFrame | None, prep: Pipeline, id_col: str, k: int, repeats: int,
                     label: str, seed: int = 42, parallelism: int = 4) -> dict:
    """:func:`prepared_folds` of every repeat under (repeat, fold), and of the
    whole of ``train`` against ``holdout`` under ``None``."""
    from terrace.operators.split import repeated_kfold
    rows, out = repeated_kfold(train, id_col, k, repeats, seed), {}
    for r in range(repeats):
        got = prepared_folds(rows.filter(F.col("repeat") == r).drop("repeat"), holdout if r == 0 else None, prep,
                             "fold", label, parallelism)
        out |= {None if f is None else (r, f): v for f, v in got.items()}
    return out


def _fit_prepared(regressor, tr: DataFrame, te: DataFrame) -> tuple[float, list[DataFrame]]:
    """Seconds of the fit, and both frames with ``prediction``."""
    t0 = time.time()
    model = regressor.fit(tr)
    seconds = time.time() - t0
    return seconds, [model.transform(x).withColumn("prediction", F.expm1("log_prediction")) for x in (tr, te)]


def cross_validate_prepared(prepared: dict[str, dict], models: dict[str, tuple], label: str, parallelism: int = 4) -> DataFrame:
    """:func:`cross_validate` of (regressor, kind) on :func:`prepared_repeats`
    of each kind; the seconds are those of the regressor's fit."""
    def one(task):
        name, (r, f) = task
        regressor, kind = models[name]
        seconds, (tr, te) = _fit_prepared(regressor, *prepared[kind][r, f][1:])
        return name, r, int(f), _score(te, label), _score(tr, label), seconds

    tasks = [(m, key) for m, (_, kind) in models.items() for key in prepared[kind] if key is not None]
    spark = next(iter(next(iter(prepared.values())).values()))[1].sparkSession
    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as ex:
        rows = list(ex.map(one, tasks))
    return spark.createDataFrame(rows, "model string, repeat int, fold int, test_rmse_log double, "
                                       "train_rmse_log double, fit_seconds double")


def validate_prepared(prepared: dict[str, dict], models: dict[str, tuple], label: str, parallelism: int = 4) -> DataFrame:
    """(model, kind, val_rmse_log, val_mae, val_r2, val_mape) of each model
    fitted on all training rows; R^2 on the log scale, MAPE as a fraction."""
    from terrace.operators.metrics import regression_metrics

    def one(name):
        regressor, kind = models[name]
        _, (_, te) = _fit_prepared(regressor, *prepared[kind][None][1:])
        m = regression_metrics(te, label, "prediction").first()
        return name, kind, m["rmse_log"], m["mae"], m["r2_log"], m["mape"]

    spark = next(iter(next(iter(prepared.values())).values()))[1].sparkSession
    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as ex:
        rows = list(ex.map(one, models))
    return spark.createDataFrame(rows, "model string, kind string, val_rmse_log double, val_mae double, "
                                       "val_r2 double, val_mape double")


def comparison_table(scores: DataFrame, validation: DataFrame) -> DataFrame:
    """The published comparison: CV, overfit, validation and fit time per model."""
    cv = scores.groupBy("model").agg(
        F.avg("test_rmse_log").alias("cv_rmse_log_mean"), F.stddev_pop("test_rmse_log").alias("cv_rmse_log_std"),
        F.avg("train_rmse_log").alias("train_rmse_log_mean"),
        (F.avg("test_rmse_log") - F.avg("train_rmse_log")).alias("overfit_gap"),
        F.avg("fit_seconds").alias("fit_time_mean"))
    return validation.join(cv, "model").select(
        "model", "kind", "cv_rmse_log_mean", "cv_rmse_log_std", "train_rmse_log_mean", "overfit_gap",
        "val_rmse_log", "val_mae", "val_r2", "val_mape", "fit_time_mean").orderBy("cv_rmse_log_mean")


# ---------------------------------------------------------------- ablation (MOD-11..13)
def ablate_features(prepared: dict[str, dict], models: dict[str, tuple], variants: dict[str, list[str]], label: str,
                    parallelism: int = 4) -> DataFrame:
    """One row per (model, variant): CV mean and standard deviation, validation
    error, and the change of the mean against the ``full`` variant.

    ``prepared`` holds :func:`prepared_folds` per kind of preprocessing and
    ``models`` maps names to (regressor, kind).  Preprocessing treats every
    column alone, so a variant only leaves out its columns' vector slots."""
    from pyspark.ml.feature import VectorSlicer
    some = next(iter(next(iter(prepared.values())).values()))[1]
    spark = some.sparkSession

    def one(task):
        name, variant, fold = task
        regressor, kind = models[name]
        names, tr, te = prepared[kind][fold]
        keep = [i for i, n in enumerate(names) if n not in variants[variant]]
        cut = VectorSlicer(inputCol="features", outputCol="kept", indices=keep)
        model = regressor.copy({regressor.featuresCol: "kept"}).fit(cut.transform(tr))
        scored = model.transform(cut.transform(te)).withColumn("prediction", F.expm1("log_prediction"))
        return name, variant, fold, _score(scored, label)

    tasks = [(m, v, f) for m, (_, kind) in models.items() for v in variants for f in prepared[kind]]
    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as ex:
        got = list(ex.map(one, tasks))
    rows = []
    for m in models:
        mean = {}
        for v in variants:
            cv = [s for a, b, f, s in got if (a, b) == (m, v) and f is not None]
            mean[v] = sum(cv) / len(cv)
            std = math.sqrt(sum((x - mean[v]) ** 2 for x in cv) / len(cv))
            val = next((s for a, b, f, s in got if (a, b, f) == (m, v, None)), None)
            rows.append((m, v, mean[v], std, val, mean[v] - mean["full"]))
    return spark.createDataFrame(rows, "model string, variant string, cv_rmse_log_mean double, cv_rmse_log_std double, "
                                       "val_rmse_log double, delta_vs_full double")


def weak_feature_decision(table: DataFrame, features: Sequence[str], keep_margin: float = 0.001) -> DataFrame:
    """KEEP a weak feature when leaving it out hurts some model by more than the margin."""
    names = {f"minus_{f}": f for f in features}
    worst = table.filter(F.col("variant").isin(list(names))).groupBy("variant").agg(F.max("delta_vs_full").alias("max_delta"))
    return worst.select(F.expr("substring(variant, 7)").alias("feature"), "max_delta",
                        F.when(F.col("max_delta") > keep_margin, "KEEP").otherwise("DROP").alias("decision"))


def engineered_gain(table: DataFrame, variant: str = "no_engineered") -> DataFrame:
    """How much worse each model is without the engineered features."""
    return table.filter(F.col("variant") == variant).select("model", F.col("delta_vs_full").alias("engineered_gain"))


# ---------------------------------------------------------------- search (MOD-14..16)
def sample_space(space: dict[str, tuple], rng: random.Random) -> dict:
    """space: name -> ("log", lo, hi) | ("uniform", lo, hi) | ("int", lo, hi)."""
    out = {}
    for name, (kind, lo, hi) in space.items():
        if kind == "log":
            out[name] = math.exp(rng.uniform(math.log(lo), math.log(hi)))
        elif kind == "int":
            out[name] = rng.randint(int(lo), int(hi))
        else:
            out[name] = rng.uniform(lo, hi)
    return out


def linear_search(prepared: dict, build: Callable[[dict], object], space: dict[str, tuple], trials: int, label: str,
                  seed: int = 42, parallelism: int = 8) -> DataFrame:
    """Seeded random search over a regressor's parameters: (trial, params,
    cv_rmse_log).  ``prepared`` are :func:`prepared_folds`; every trial is one
    fit per fold over the fold's cached rows (one pass for a linear model), many
    of them at a time, and one pass per fold scores all trials."""
    import json
    rng = random.Random(seed)
    params = [sample_space(space, rng) for _ in range(trials)]
    folds = [f for f in prepared if f is not None]
    spark = prepared[folds[0]][1].sparkSession
    total = [0.0] * trials
    for f in folds:
        _, tr, te = prepared[f]
        tr = tr.select("label", "features").persist()
        try:
            with ThreadPoolExecutor(max_workers=max(1, parallelism)) as ex:
                models = list(ex.map(lambda p: build(p).fit(tr), params))
        finally:
            tr.unpersist()
        scored = te
        for t, m in enumerate(models):
            scored = m.setPredictionCol(f"_p{t}").transform(scored)
        row = scored.agg(*[rmse_log(col(label), F.expm1(F.col(f"_p{t}"))).alias(f"e{t}") for t in range(trials)]).first()
        total = [a + row[f"e{t}"] for t, a in enumerate(total)]
    rows = [(t, json.dumps(p, sort_keys=True), total[t] / len(folds)) for t, p in enumerate(params)]
    return spark.createDataFrame(rows, "trial int, params string, cv_rmse_log double")


def best_trial(trials: DataFrame) -> DataFrame:
    """The best trial of every model (ties: the earlier one)."""
    at = F.struct("cv_rmse_log", "trial")
    return trials.groupBy("model").agg(F.min_by("trial", at).alias("best_trial"), F.min("cv_rmse_log").alias("best_cv_rmse_log"),
                                       F.min_by("params", at).alias("best_params"))


def trial_history(trials: DataFrame) -> DataFrame:
    """Running best over the trial number of every model (optimisation history)."""
    from pyspark.sql.window import Window
    w = Window.partitionBy("model").orderBy("trial").rowsBetween(Window.unboundedPreceding, 0)
    return trials.withColumn("best_so_far", F.min("cv_rmse_log").over(w))


def tuning_before_after(tuned: DataFrame, baseline: DataFrame) -> DataFrame:
    """Tuned vs baseline CV per model; baseline missing -> NULL."""
    return tuned.join(baseline, "model", "left").withColumn(
        "improvement", F.col("baseline_cv_rmse_log") - F.col("tuned_cv_rmse_log"))

