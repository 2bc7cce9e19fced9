"""Encoders, scaling, skew correction, metrics and blending against NumPy."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from terrace.functions.exprs import adjusted_skew
from terrace.operators import blend as B
from terrace.operators import encode as E
from terrace.operators import metrics as MET


def test_ordinal_unknown(spark):
    df = spark.createDataFrame([("Ex",), ("Zz",), (None,)], "ExterQual string")
    out = [r[0] for r in E.OrdinalEncoder(cols=["ExterQual"]).transform(df).collect()]
    assert out == [5.0, -1.0, None]


def test_onehot_rare_and_unseen(spark):
    fit = spark.createDataFrame([("a",)] * 60 + [("b",)] * 39 + [("c",)], "x string")
    m = E.RareOneHotEncoder(cols=["x"], minFrequency=0.05).fit(fit)
    assert m.output_columns() == ["x_a", "x_b", "x_infrequent_sklearn"]
    new = spark.createDataFrame([("a",), ("c",), ("zz",)], "x string")
    rows = m.transform(new).collect()
    assert [tuple(r) for r in rows] == [(1.0, 0.0, 0.0), (0.0, 0.0, 1.0), (0.0, 0.0, 1.0)]
    m2 = E.RareOneHotEncoder(cols=["x"], minFrequency=0.0).fit(fit)
    z = m2.transform(spark.createDataFrame([("zz",)], "x string")).first()
    assert sum(z) == 0.0  # unseen and no infrequent column -> all zeros


def test_robust_scaler(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, 5.0), (4.0, 5.0), (100.0, 5.0)],
                               "a double, k double")
    out = E.RobustScaler(cols=["a", "k"]).fit(df).transform(df).collect()
    q1, med, q3 = np.percentile([1, 2, 3, 4, 100], [25, 50, 75])
    assert abs(out[4]["a"] - (100 - med) / (q3 - q1)) < 1e-12
    assert out[0]["k"] == 0.0  # constant column: IQR 0 -> divide by 1


def test_adjusted_skew_matches_pandas(spark):
    vals = [1.0, 2.0, 2.0, 3.0, 10.0, 25.0, 4.0]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = df.agg(adjusted_skew(F.col("x"))).first()[0]
    assert abs(got - pd.Series(vals).skew()) < 1e-12
    const = spark.createDataFrame([(1.0,)] * 5, "x double").agg(adjusted_skew(F.col("x"))).first()[0]
    assert const == 0.0


def _np_yj(x, lam):
    x = np.asarray(x, float)
    out = np.empty_like(x)
    p = x >= 0
    out[p] = np.log1p(x[p]) if abs(lam) < 1e-12 else ((x[p] + 1) ** lam - 1) / lam
    out[~p] = -np.log1p(-x[~p]) if abs(lam - 2) < 1e-12 else \
        -((-x[~p] + 1) ** (2 - lam) - 1) / (2 - lam)
    return out


def _best_lambda(x):
    """Golden-section search of the log-likelihood far beyond [-2, 2]."""
    def ll(lam):
        with np.errstate(over="ignore", invalid="ignore"):
            var = _np_yj(x, lam).var()
        if not (math.isfinite(var) and var > 0):  # beyond what doubles hold
            return -math.inf
        return -len(x) / 2 * math.log(var) + (lam - 1) * np.sum(np.sign(x) * np.log1p(np.abs(x)))

    grid = np.linspace(-60, 60, 1201)
    c = grid[int(np.argmax([ll(g) for g in grid]))]
    a, b, r = c - 0.2, c + 0.2, (math.sqrt(5) - 1) / 2
    while b - a > 1e-8:
        p, q = b - r * (b - a), a + r * (b - a)
        a, b = (a, q) if ll(p) > ll(q) else (p, b)
    return (a + b) / 2


def test_yeo_johnson_fit_matches_bruteforce(spark):
    rng = np.random.default_rng(0)
    mixed = np.concatenate([rng.lognormal(0, 1, 300), -rng.lognormal(0, 0.3, 20)])
    inflated = np.where(rng.random(320) < 0.04, rng.lognormal(1.0, 0.7, 320), 0.0)  # mostly zero
    left = 30 - rng.lognormal(1.5, 0.9, 320).clip(0, 29)
    df = spark.createDataFrame([tuple(map(float, r)) for r in zip(mixed, inflated, left)], "v double, z double, w double")
    lam = E.fit_yeo_johnson(df, ["v", "z", "w"])
    want = {"v": _best_lambda(mixed), "z": _best_lambda(inflated), "w": _best_lambda(left)}
    assert want["z"] < -2 and want["w"] > 2  # outside the first bracket
    for c in want:
        assert lam[c] == pytest.approx(want[c], abs=2e-5)
    out = E.SkewCorrector(cols=["v"], threshold=0.75).fit(df).transform(df).toPandas()["v"]
    assert np.allclose(out.to_numpy(), _np_yj(mixed, lam["v"]), atol=1e-9)


def test_yeo_johnson_without_a_maximum(spark):
    df = spark.createDataFrame([(0.0, None)] * 30 + [(1.0, None)] * 2, "two double, none double")
    lam = E.fit_yeo_johnson(df, ["two", "none"])
    assert set(lam) == {"two"} and math.isfinite(lam["two"])


def test_metrics_against_numpy(spark):
    y = np.array([100000.0, 200000.0, 350000.0, 500000.0])
    p = np.array([110000.0, 190000.0, 300000.0, -5.0])
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(y, p)], "y double, p double")
    r = MET.regression_metrics(df, "y", "p").first()
    assert abs(r["rmse_log"] - np.sqrt(np.mean((np.log1p(y) - np.log1p(np.clip(p, 0, None))) ** 2))) < 1e-12
    assert abs(r["mae"] - np.mean(np.abs(y - p))) < 1e-9
    assert abs(r["mape"] - np.mean(np.abs(y - p) / np.abs(y))) < 1e-12
    assert abs(r["r2_dollar"] - (1 - np.sum((y - p) ** 2) / np.sum((y - y.mean()) ** 2))) < 1e-12
    bands = {b["band"]: b for b in MET.metrics_by_band(df, "y", "p").collect()}
    assert bands["<$150k"]["count"] == 1 and bands[">$450k"]["count"] == 1
    assert bands["$300-450k"]["count"] == 1
    empty = MET.metrics_by_band(df.filter("y < 150000"), "y", "p").collect()
    assert [b["count"] for b in empty] == [1, 0, 0, 0] and empty[1]["mae"] == 0.0


def test_blend_weight_one_equals_member(spark):
    df = spark.createDataFrame([(1, 100.0, 110.0, 90.0), (2, 200.0, 190.0, 230.0)],
                               "id int, y double, a double, b double")
    out = df.select(B.blend_expr(["a", "b"], [1.0, 0.0]).alias("m"), "a").collect()
    assert all(abs(r["m"] - r["a"]) < 1e-9 for r in out)
    assert B.normalise([0.0, 0.0], 2) == [0.5, 0.5] and B.normalise(None, 4) == [0.25] * 4


def test_simplex_weights_vs_grid(spark):
    rng = np.random.default_rng(1)
    e = rng.normal(size=(200, 3)) * [0.1, 0.12, 0.3] + rng.normal(size=(200, 1)) * 0.05
    G = e.T @ e / 200
    w = B.simplex_weights(G)
    assert abs(w.sum() - 1) < 1e-12 and (w >= 0).all()
    best = min(((a, b, 1 - a - b) for a in np.linspace(0, 1, 101) for b in np.linspace(0, 1, 101)
                if a + b <= 1 + 1e-12), key=lambda v: np.array(v) @ G @ np.array(v))
    assert w @ G @ w <= np.array(best) @ G @ np.array(best) + 1e-12


def test_gram_matches_numpy(spark):
    y = np.array([100.0, 200.0, 300.0])
    a = np.array([110.0, 180.0, 330.0])
    b = np.array([90.0, 250.0, 280.0])
    df = spark.createDataFrame([tuple(map(float, r)) for r in zip(y, a, b)], "y double, a double, b double")
    G = B.gram_matrix(B.gram(df, "y", ["a", "b"]), 2)
    ra, rb = np.log1p(y) - np.log1p(a), np.log1p(y) - np.log1p(b)
    assert np.allclose(G, [[np.mean(ra * ra), np.mean(ra * rb)], [np.mean(ra * rb), np.mean(rb * rb)]])
