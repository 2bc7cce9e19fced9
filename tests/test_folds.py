"""All fold complements at once: equal to separate fits; compressed rows equal
to all rows; one scan for out-of-fold predictions."""

import json

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from terrace.operators import folds as FO
from terrace.operators import models as M
from terrace.operators import split as S
from terrace.plans.fixtures import houses

K = 3
FOLDS = FO.Folds(("_f0", "_f1"), K)


@pytest.fixture(scope="module")
def train(spark):
    df = S.kfold(houses(spark, "/root/testdata/sf0.001"), "Id", K, 42, "a", "_f0")
    return S.kfold(df, "Id", K, 42, "b", "_f1").cache()


@pytest.fixture(scope="module")
def prep(train):
    return FO.fit_complements(train, FOLDS)


@pytest.fixture(scope="module")
def compressed(prep, train):
    return FO.CompressedFolds(prep, train)


def _part(train, j):
    part = train if j == FOLDS.whole else train.filter(F.col(FOLDS.cols[j // K]) != j % K)
    return part.drop(*FOLDS.cols)


def _leaves(x, path=()):
    if isinstance(x, (dict, list)):
        for k, v in (x.items() if isinstance(x, dict) else enumerate(x)):
            yield from _leaves(v, (*path, k))
    else:
        yield path, x


@pytest.mark.parametrize("j", [5])
def test_states_and_features_equal_a_separate_fit(train, prep, j):
    part = _part(train, j)
    alone, mine = M.prep_pipeline(part.schema, "linear").fit(part), prep.pipeline(j)
    assert alone.stages[-1].getInputCols() == mine.stages[-1].getInputCols()
    for a, b in zip(alone.stages, mine.stages):
        assert type(a) is type(b)
        if hasattr(a, "stateJson"):
            x, y = (dict(_leaves(json.loads(s.getOrDefault(s.stateJson)))) for s in (a, b))
            assert set(x) == set(y)
            for path, value in x.items():
                assert value == (pytest.approx(y[path], rel=1e-5, abs=1e-5) if isinstance(value, float) else y[path])
    names = prep.names(j)
    want = {r["Id"]: r["f"] for r in mine.transform(part).select("Id", vector_to_array("features").alias("f")).collect()}
    out = prep.transform(part.withColumn("_j", F.lit(j)), ["Id"]).collect()
    at = [prep.all_names.index(n) for n in names]
    other = [i for i in range(len(prep.all_names)) if i not in at]
    assert len(out) == len(want)
    for r in out:
        f = np.array(r["features"])
        assert f[at] == pytest.approx(want[r["Id"]], rel=1e-9, abs=1e-9) and not f[other].any()


def test_compressed_rows_give_the_closed_form_and_sparks_own_fit(train, prep, compressed):
    j = 4
    rows, keep = compressed.rows(j)
    assert rows.count() <= len(keep) + 2
    x = np.array([r["features"] for r in prep.transform(_part(train, j).withColumn("_j", F.lit(j))).orderBy("label").collect()])[:, keep]
    y = np.array([r["label"] for r in prep.transform(_part(train, j).withColumn("_j", F.lit(j))).orderBy("label").collect()])
    z, t = x - x.mean(axis=0), y - y.mean()
    size = z.std(axis=0)
    q = z / size
    want = np.linalg.solve(q.T @ q + np.diag(10.0 / size ** 2), q.T @ t) / size
    got = compressed.fit(j, M.ridge(10.0))
    assert got[:-1][keep] * size == pytest.approx(want * size, abs=1e-8)
    assert got[-1] == pytest.approx(y.mean() - x.mean(axis=0) @ want, abs=1e-6)


@pytest.mark.parametrize("make", [lambda: M.ridge(3.0), lambda: M.lasso(0.01), lambda: M.elasticnet(0.01, 0.4)])
def test_compressed_fit_equals_the_fit_on_all_rows(spark, make):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 6)) * [1, 2, 0.5, 1, 3, 1] + 2
    y = x @ [0.5, 0, -1.0, 0.2, 0, 0.1] + rng.normal(0, 0.3, 400) + 12
    z = np.column_stack([x, y])
    c = FO.CompressedFolds.__new__(FO.CompressedFolds)
    c.spark, c._rows, c.names = spark, {}, list("abcdef")
    c.prep = type("P", (), {"names": staticmethod(lambda j: list("abcdef"))})
    centred = z - z.mean(axis=0)
    c.moments = {0: FO.Moments(400.0, z.mean(axis=0), centred.T @ centred)}
    from pyspark.ml.linalg import Vectors
    df = spark.createDataFrame([(Vectors.dense(r), float(v)) for r, v in zip(x, y)], ["features", "label"])
    full = make().fit(df)
    got = c.fit(0, make())
    assert got[:-1] == pytest.approx(full.coefficients.toArray(), abs=1e-8) and got[-1] == pytest.approx(full.intercept, abs=1e-7)
    without = c.fit(0, make(), ["c"])
    assert without[2] == 0 and abs(without[0] - got[0]) > 1e-9


def test_dispatch_and_errors_equal_fold_by_fold(train, prep, compressed):
    models = {j: compressed.fit(j, M.lasso(0.001)) for j in range(K)}
    out = FO.FoldLinearModel(prep, "_f0", {"lasso": models}).transform(train)
    plan = out._jdf.queryExecution().optimizedPlan().toString().split("InMemoryRelation")[0]
    assert {line.strip(" +-:").split(" ")[0] for line in plan.splitlines() if line.strip(" +-:")} == {"Project"}
    got = {r["Id"]: r["lasso"] for r in out.select("Id", "lasso").collect()}
    errors = FO.fold_errors(prep, train, {j: models[j][None, :] for j in models})
    names = prep.all_names
    for f in range(K):
        stage = prep.pipeline(f)
        held = train.filter(F.col("_f0") == f).drop(*FOLDS.cols)
        at = [names.index(n) for n in prep.names(f)]
        rows = stage.transform(held).select("Id", "label", vector_to_array("features").alias("f")).collect()
        log = [float(np.array(r["f"]) @ models[f][at] + models[f][-1]) for r in rows]
        assert [got[r["Id"]] for r in rows] == pytest.approx(np.expm1(log), rel=1e-9)
        assert errors[f, False][0] == pytest.approx(np.sqrt(np.mean([(p - r["label"]) ** 2 for p, r in zip(log, rows)])), rel=1e-9)
    assert set(errors) == {(f, side) for f in range(K) for side in (False, True)}


def test_weighted_quantiles_equal_repeated_rows(spark):
    from terrace.operators.quantile import grouped_quantiles
    rows = [("a", 1.0, 3), ("a", 2.0, 1), ("a", 9.5, 2), ("b", -1.0, 1), ("b", 4.0, 1)]
    probs = [0.25, 0.5, 0.9]
    df = spark.createDataFrame(rows, "g string, x double, n long")
    got = {r["g"]: r["q"] for r in grouped_quantiles(df, ["g"], "x", probs, weight="n").collect()}
    pairs = {r["g"]: r["q"] for r in grouped_quantiles(df, ["g"], "x", probs, weight="n", pairs=True).collect()}
    for g in got:
        all_ = [x for h, x, n in rows if h == g for _ in range(n)]
        assert got[g] == pytest.approx(np.quantile(all_, probs))
        assert [(1 - p["share"]) * p["low"] + p["share"] * p["high"] for p in pairs[g]] == pytest.approx(np.quantile(all_, probs))


def test_quantiles_of_members_without_a_row_per_member(spark):
    from terrace.operators.quantile import member_quantiles
    rng = np.random.default_rng(5)
    rows, want = [], {}
    for c, xs in (("wide", rng.normal(size=300) * 1e5), ("few", rng.integers(-2, 3, 6).astype(float)), ("one", np.array([7.0])), ("flat", 1e9 + rng.random(50) * 1e-3)):
        for x in xs:
            n = [int(v) or None for v in rng.integers(0, 4, 3)]
            rows.append((c, float(x), n))
            for j, v in enumerate(n):
                want.setdefault((c, j), []).extend([float(x)] * (v or 0))
    rows += [("wide", None, [5, 5, 5]), ("wide", float("nan"), [5, 5, 5]), ("few", 9.0, [None, None, None])]
    probs = [0.0, 0.25, 0.5, 0.75, 1.0]
    df = spark.createDataFrame(rows, "column string, x double, _all array<bigint>")
    got = member_quantiles(df, "column", "x", 3, probs)
    assert set(got) == {k for k, v in want.items() if v}
    for k, q in got.items():
        assert q == pytest.approx(np.quantile(want[k], probs), rel=1e-12)
    pairs = member_quantiles(df, "column", "x", 3, [0.5], pairs=True)
    for k, (p,) in pairs.items():
        x, at = sorted(want[k]), (len(want[k]) - 1) * 0.5
        assert (p["low"], p["high"], p["share"]) == (x[int(np.floor(at))], x[int(np.ceil(at))], at - np.floor(at))


def test_counted_values_are_one_row_for_all_complements(train, monkeypatch):
    saved, save = [], FO._save

    def spied(df, name):
        out = save(df, name)
        saved.append((name, out))
        return out

    monkeypatch.setattr(FO, "_save", spied)
    FO.fit_complements(train, FOLDS)
    counted = [df for name, df in saved if name == "fold-counts" and "column" in df.columns]
    assert len(counted) == 2
    for df in counted:
        assert df.count() == df.select("column", "x").distinct().count()


def test_tuned_and_untuned_models_are_scored_in_one_pass(spark, monkeypatch):
    from terrace.plans import q_model as q
    calls = []

    def scored(spark, sf, regressors):
        calls.append(list(regressors))
        at = {n: (0.1 if n.startswith("tuned_") else 0.2) + i / 1000 for i, n in enumerate(regressors)}
        scores = spark.createDataFrame([(n, 0, 0, v, v, 1.0) for n, v in at.items()], "model string, repeat int, fold int, "
                                       "test_rmse_log double, train_rmse_log double, fit_seconds double")
        return scores, spark.createDataFrame([(n, "linear", v, 1.0, 1.0, 1.0) for n, v in at.items()], "model string, kind string, "
                                             "val_rmse_log double, val_mae double, val_r2 double, val_mape double")

    monkeypatch.setattr(q, "_MEMO", {})
    monkeypatch.setattr(q, "_scored", scored)
    monkeypatch.setattr(q, "_linear_best", lambda *_: {"Lasso": {"alpha": 0.1}, "ElasticNet": {"alpha": 0.1, "l1_ratio": 0.5}})
    sf = "/root/testdata/sf0.001"
    first = {r["model"]: r for r in q.tuning_linear_before_after(spark, sf).collect()}
    assert len(calls) == 1 and set(first) == {"Lasso", "ElasticNet"}
    assert all(r["tuned_cv_rmse"] < 0.11 and r["baseline_cv_rmse"] > 0.19 for r in first.values())
    assert {r["model"] for r in q.cv_scores_linear(spark, sf).collect()} == set(q._LINEAR) and len(calls) == 1
    again = {r["model"]: r for r in q.tuning_linear_before_after(spark, sf).collect()}  # the untuned scores are there
    assert calls[1] == ["tuned_Lasso", "tuned_ElasticNet"] and set(again) == set(first)


def test_complements_are_counted_without_a_row_per_combination(spark):
    rows = [("a", 1.0, 0, 0, -1), ("a", 1.0, 1, 2, -1), ("a", 2.0, 2, 1, -1), ("a", None, 0, 1, -1), ("a", 1.0, 0, 0, 4), ("a", 1.0, None, 1, -1)]
    long = spark.createDataFrame(rows, "column string, x double, _f0 int, _f1 int, _j int").withColumn("_sig", FOLDS.code()).drop("_f0", "_f1")
    got = FO._counted(long, FOLDS, ["column", "x"])
    want: dict = {}
    for _, x, a, b, j in rows:
        own = (None, None) if a is None or b is None else (a, b)
        for i in FOLDS.numbers:
            if i == j or (j < 0 and (i == FOLDS.whole or own[i // K] != i % K)):
                want[x, i] = want.get((x, i), 0) + 1
    assert {(r["x"], r["_j"]): r["n"] for r in got.collect()} == want
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate") < plan.index("Aggregate")  # rows multiply after the last sum


def test_houses_of_one_file_are_derived_by_all_cores(spark, tmp_path):
    from terrace.plans import fixtures as fx
    sf = "/root/testdata/sf0.001"
    for t in ("customer", "nation"):
        spark.read.parquet(f"{sf}/{t}.parquet").write.parquet(str(tmp_path / f"{t}.parquet"))
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    many = orders.crossJoin(spark.range(40)).withColumn("o_orderkey", F.col("o_orderkey") * 40 + F.col("id")).drop("id")
    many.select(*orders.columns).coalesce(1).write.parquet(str(tmp_path / "orders.parquet"))
    rows = fx.houses(spark, str(tmp_path))
    assert len(rows.inputFiles()) > 1 and rows.count() == 40 * orders.count()


def test_rows_are_repeated_only_for_fills_that_differ(spark):
    """A row without a fill, or whose fill all complements agree on, is engineered
    once: before, every row with a learnt fill came once per complement."""
    data = spark.createDataFrame([(1, "a", None, "x"), (2, "b", None, "x"), (3, "b", 1.0, "x"), (4, "c", None, "x"), (5, "a", None, None),
                                  (6, "b", None, None)], "Id int, Neighborhood string, LotFrontage double, Kind string")
    fills = [{"medians": {}, "modes": {"Kind": "p" if j % 2 else "q"}, "global_median": 1.0,
              "group_medians": {"a": 3.0, "b": 5.0 if j < 3 else 6.0}} for j in FOLDS.numbers]
    classes = FO._fill_classes(data, FOLDS, fills, "Neighborhood", "LotFrontage", ["Id"])
    got = {r["Id"]: r["c"] for r in data.select("Id", classes.alias("c")).collect()}
    bits = {i: [{j for j in FOLDS.numbers if part[FOLDS.words[0]] >> j & 1} for part in parts] for i, parts in got.items()}
    everything = set(FOLDS.numbers)
    assert bits[1] == bits[3] == bits[4] == [everything]
    assert bits[2] == [{0, 1, 2}, everything - {0, 1, 2}]
    assert bits[5] == [{j for j in everything if j % 2 == 0}, {j for j in everything if j % 2}]
    assert bits[6] == [{j} for j in sorted(everything)]
    assert all(part["_j"] in has for i in got for part, has in zip(got[i], bits[i]))


def test_nulls_that_a_rule_fills_read_no_learnt_value(spark):
    """Before, a null pool quality ("None" by rule, in nearly every row) counted
    as a learnt fill, so rows were engineered once per differing mode."""
    data = spark.createDataFrame([(1, None, None, 0, None, 1.0), (2, None, None, 5, None, 1.0), (3, None, None, 5, "Av", None),
                                  (4, None, None, None, None, 1.0)],
                                 "Id int, PoolQC string, GarageQual string, TotalBsmtSF int, BsmtExposure string, GarageYrBlt double")
    data = data.withColumn("YearBuilt", F.lit(1990))
    fills = [{"medians": {"GarageYrBlt": 1980.0 + j, "TotalBsmtSF": 3.0 + j}, "modes": {c: "Gd" if j % 2 else "No" for c in (
        "PoolQC", "GarageQual", "BsmtExposure")}, "global_median": 1.0, "group_medians": {}} for j in FOLDS.numbers]
    classes = FO._fill_classes(data, FOLDS, fills, "Neighborhood", "LotFrontage", ["Id"])
    assert {r["Id"]: len(r["c"]) for r in data.select("Id", classes.alias("c")).collect()} == {1: 1, 2: 2, 3: 1, 4: 1}


def _odd(train):
    """Nulls where a complement's fill matters, in features and label."""
    gap = lambda c, m: F.when(F.col("Id") % m != 1, F.col(c)).alias(c)
    odd = {"GrLivArea": 5, "Neighborhood": 7, "LotArea": 4, "YearRemodAdd": 6, "MoSold": 9, "SalePrice": 11, "HalfBath": 3}
    return train.select(*[gap(c, odd[c]) if c in odd else F.col(f"`{c}`") for c in train.columns])


def test_moments_equal_those_of_each_complement_s_rows(train):
    rows = _odd(train).cache()
    prep = FO.fit_complements(rows, FOLDS)
    got = FO.moments(prep, rows)
    assert set(got) == set(FOLDS.numbers)
    for j in (1, 4, FOLDS.whole):
        part = rows if j == FOLDS.whole else rows.filter(F.col(FOLDS.cols[j // K]) != j % K)
        out = prep.transform(part.drop(*FOLDS.cols).withColumn("_j", F.lit(j))).where("label is not null").collect()
        z = np.array([[*r["features"], r["label"]] for r in out])
        centred = z - z.mean(axis=0)
        assert got[j].n == len(z) and got[j].mean == pytest.approx(z.mean(axis=0), rel=1e-9, abs=1e-9)
        assert got[j].scatter == pytest.approx(centred.T @ centred, rel=1e-7, abs=1e-7)


def test_moments_and_errors_send_a_row_once_per_distinct_fill(train, prep):
    """Before, each row was sent once per complement (7 here)."""
    plain = train.select("*", *[F.lit(2 ** len(FOLDS.numbers) - 1).cast("bigint").alias(w) for w in FOLDS.words])
    cells = prep.cells(plain, ["Id"])
    assert cells.count() < 3 * train.count()
    bits = F.bit_count(F.col(FOLDS.words[0]))
    assert {r["n"] for r in cells.groupBy("Id").agg(F.sum(bits).alias("n")).collect()} == {len(FOLDS.numbers)}


def test_powers_of_a_column():
    x = np.array([-3.0, -0.5, 0.0, 0.5, 40.0])
    for lam in (-1.5, 0.0, 0.7, 2.0, 3.1):
        assert FO._powers(x, lam) == pytest.approx([FO._power(v, lam) for v in x], rel=1e-12, abs=1e-12)
