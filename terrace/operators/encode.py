"""Encoding and scaling stages (ordinal, rare-aware one-hot, robust scaling,
Yeo-Johnson skew correction) and the tree / linear preprocessors.

Every fit is a bounded number of aggregate jobs whose result is small
fitted state (level lists, quantiles, lambdas) kept in ML Params; every
transform is a single projection of native Column expressions.
"""

from __future__ import annotations

import json
import math
from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrace.config import ORDINAL_LEVELS
from terrace.functions.exprs import adjusted_skew, col, is_numeric, yeo_johnson


# ---------------------------------------------------------------- column selectors (PRJ-6)
def select_ordinal(schema: T.StructType) -> list[str]:
    names = {f.name for f in schema.fields}
    return [c for c in ORDINAL_LEVELS if c in names]


def select_nominal(schema: T.StructType) -> list[str]:
    return [f.name for f in schema.fields
            if isinstance(f.dataType, T.StringType) and f.name not in ORDINAL_LEVELS]


def select_numeric(schema: T.StructType) -> list[str]:
    return [f.name for f in schema.fields if is_numeric(f.dataType)]


class _Cols(Params):
    cols = Param(Params._dummy(), "cols", "input columns", typeConverter=TypeConverters.toListString)
    stateJson = Param(Params._dummy(), "stateJson", "fitted state", typeConverter=TypeConverters.toString)


# ---------------------------------------------------------------- ENC-1
def ordinal_code(c: Column, levels: Sequence[str], unknown: float = -1.0) -> Column:
    kv = []
    for i, lv in enumerate(levels):
        kv += [F.lit(lv), F.lit(float(i))]
    return F.when(c.isNull(), F.lit(None).cast("double")).otherwise(
        F.coalesce(F.create_map(*kv)[c], F.lit(unknown)))


class OrdinalEncoder(Transformer, _Cols, DefaultParamsReadable, DefaultParamsWritable):
    """Fixed level order -> 0..k-1 (double); unknown -> -1; NULL stays NULL."""

    @keyword_only
    def __init__(self, cols: list[str] | None = None):
        super().__init__()
        self._setDefault(cols=[], stateJson="{}")
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        enc = {c: ordinal_code(col(c), ORDINAL_LEVELS[c]) for c in self.getOrDefault(self.cols)
               if c in df.columns}
        return df.select(*[(enc[c] if c in enc else col(c)).alias(c) for c in df.columns])


# ---------------------------------------------------------------- ENC-2/3
def onehot_vocabulary(df: DataFrame, cols: Sequence[str], min_frequency: float) -> DataFrame:
    """(column, level, n, infrequent) for all nominal columns in ONE job."""
    from terrace.operators.profile import level_counts
    counts = level_counts(df, cols)
    # every column's counts sum to the row count: a #columns-row totals table
    totals = counts.groupBy("column").agg(F.sum("n").alias("total"))
    return counts.join(totals, "column").select(
        "column", F.col("value").alias("level"), "n",
        (F.col("n") < F.lit(float(min_frequency)) * F.col("total")).alias("infrequent"))


class RareOneHotEncoder(Estimator, _Cols, DefaultParamsReadable, DefaultParamsWritable):
    """One-hot with sorted levels; levels rarer than ``minFrequency`` of the
    rows share one trailing ``<col>_infrequent_sklearn`` column; an unseen
    level maps to that column when it exists, else to all zeros."""

    minFrequency = Param(Params._dummy(), "minFrequency", "rare share",
                         typeConverter=TypeConverters.toFloat)

    @keyword_only
    def __init__(self, cols: list[str] | None = None, minFrequency: float = 0.01):
        super().__init__()
        self._setDefault(cols=[], minFrequency=0.01, stateJson="{}")
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> "RareOneHotModel":
        cols = [c for c in self.getOrDefault(self.cols) if c in df.columns]
        vocab: dict[str, dict] = {c: {"frequent": [], "rare": False} for c in cols}
        if cols:
            # per column its frequent levels (1 / minFrequency at most) and one flag
            levels = onehot_vocabulary(df, cols, self.getOrDefault(self.minFrequency)).filter(F.col("level").isNotNull())
            for r in levels.groupBy("column", F.when(~F.col("infrequent"), F.col("level")).alias("level")).agg(
                    F.count(F.lit(1))).collect():
                if r["level"] is None:
                    vocab[r["column"]]["rare"] = True
                else:
                    vocab[r["column"]]["frequent"].append(r["level"])
        for v in vocab.values():
            v["frequent"].sort()
        m = RareOneHotModel()
        m._set(cols=cols, stateJson=json.dumps(vocab))
        return m


class RareOneHotModel(Model, _Cols, DefaultParamsReadable, DefaultParamsWritable):
    def __init__(self):
        super().__init__()
        self._setDefault(cols=[], stateJson="{}")

    def vocabulary(self) -> dict:
        return json.loads(self.getOrDefault(self.stateJson))

    def output_columns(self) -> list[str]:
        out = []
        for c, v in self.vocabulary().items():
            out += [f"{c}_{lv}" for lv in v["frequent"]]
            if v["rare"]:
                out.append(f"{c}_infrequent_sklearn")
        return out

    def _transform(self, df: DataFrame) -> DataFrame:
        vocab = self.vocabulary()
        new = []
        for c, v in vocab.items():
            x = col(c)
            for lv in v["frequent"]:
                new.append(F.coalesce((x == F.lit(lv)).cast("double"), F.lit(0.0))
                           .alias(f"{c}_{lv}"))
            if v["rare"]:
                known = F.array(*[F.lit(lv) for lv in v["frequent"]]) if v["frequent"] else \
                    F.array().cast("array<string>")
                new.append(F.when(x.isNotNull() & ~F.array_contains(known, x), F.lit(1.0))
                           .otherwise(F.lit(0.0)).alias(f"{c}_infrequent_sklearn"))
        return df.select(*[col(c) for c in df.columns if c not in vocab], *new)


# ---------------------------------------------------------------- ENC-6
class RobustScaler(Estimator, _Cols, DefaultParamsReadable, DefaultParamsWritable):
    """(x - median) / IQR with exact interpolated quartiles; IQR 0 -> 1."""

    @keyword_only
    def __init__(self, cols: list[str] | None = None):
        super().__init__()
        self._setDefault(cols=[], stateJson="{}")
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> "RobustScalerModel":
        cols = [c for c in self.getOrDefault(self.cols) if c in df.columns]
        st = {}
        if cols:
            from terrace.operators.quantile import column_quantiles
            qs = column_quantiles(df, cols, [0.25, 0.5, 0.75])
            for c in cols:
                q = qs.get(c)
                if q is None or q[0] is None:
                    st[c] = [0.0, 1.0]
                    continue
                iqr = q[2] - q[0]
                st[c] = [q[1], iqr if iqr != 0 else 1.0]
        m = RobustScalerModel()
        m._set(cols=cols, stateJson=json.dumps(st))
        return m


class RobustScalerModel(Model, _Cols, DefaultParamsReadable, DefaultParamsWritable):
    def __init__(self):
        super().__init__()
        self._setDefault(cols=[], stateJson="{}")

    def _transform(self, df: DataFrame) -> DataFrame:
        st = json.loads(self.getOrDefault(self.stateJson))
        return df.select(*[((col(c).cast("double") - F.lit(st[c][0])) / F.lit(st[c][1])).alias(c)
                           if c in st else col(c) for c in df.columns])


# ---------------------------------------------------------------- ENC-4/5
def _yj_numpy(x, lam: float):
    """NumPy twin of :func:`terrace.functions.exprs.yeo_johnson` (same formula)."""
    import numpy as np
    out = np.empty_like(x)
    pos = x >= 0
    lp, ln = np.log1p(x[pos]), np.log1p(-x[~pos])
    out[pos] = lp if abs(lam) < 1e-12 else (np.exp(lam * lp) - 1.0) / lam
    out[~pos] = -ln if abs(lam - 2.0) < 1e-12 else -(np.exp((2.0 - lam) * ln) - 1.0) / (2.0 - lam)
    return out


def yeo_johnson_loglik(df: DataFrame, cols: Sequence[str], lambdas: dict[str, list[float]]
                       ) -> DataFrame:
    """(column, lambda, loglik) for candidate lambdas of each column.

    loglik = -n/2 * ln(var_pop(T_lambda(x))) + (lambda - 1) * sum(sign(x) ln(1+|x|)).
    Each task reduces its rows to one (n, mean, M2) per (column, lambda) with
    NumPy (Arrow batches, batch partials merged by Chan's formula), so rows
    are never exploded against the grid; the #tasks x #cols x #grid partials
    are merged exactly by one small ``groupBy(column, lambda)``.  Columns
    without a non-NULL value yield no rows.
    """
    import numpy as np
    import pandas as pd
    from pyspark.sql.window import Window

    cols = list(cols)
    grid = {c: [float(l) for l in lambdas[c]] for c in cols}

    def moments(batches):
        acc = {}  # (column, j) -> [n, mean, m2]; column -> sum sign(x) ln(1+|x|)
        sl = {}
        for pdf in batches:
            for c in cols:
                x = pd.to_numeric(pdf[c], errors="coerce").to_numpy(dtype="float64", na_value=np.nan)
                x = x[~np.isnan(x)]
                if x.size == 0:
                    continue
                sl[c] = sl.get(c, 0.0) + float(np.sum(np.sign(x) * np.log1p(np.abs(x))))
                for j, lam in enumerate(grid[c]):
                    t = _yj_numpy(x, lam)
                    nb, mb = float(t.size), float(t.mean())
                    m2b = float(np.sum((t - mb) ** 2))
                    if (c, j) in acc:
                        na, ma, m2a = acc[(c, j)]
                        n = na + nb
                        d = mb - ma
                        acc[(c, j)] = [n, ma + d * nb / n, m2a + m2b + d * d * na * nb / n]
                    else:
                        acc[(c, j)] = [nb, mb, m2b]
        rows = [(c, grid[c][j], n, m, m2, sl[c]) for (c, j), (n, m, m2) in acc.items()]
        if rows:
            yield pd.DataFrame(rows, columns=["column", "lambda", "n", "mean", "m2", "sl"])

    part = df.select(*[col(c).cast("double").alias(c) for c in cols]).mapInPandas(
        moments, "column string, lambda double, n double, mean double, m2 double, sl double")
    w = Window.partitionBy("column", "lambda")
    part = part.withColumn("gmean", F.sum(F.col("n") * F.col("mean")).over(w) / F.sum("n").over(w))
    g = part.groupBy("column", "lambda").agg(
        F.sum("n").alias("n"),
        F.sum(F.col("m2") + F.col("n") * (F.col("mean") - F.col("gmean")) ** 2).alias("m2"),
        F.sum("sl").alias("sl"))
    v = F.col("m2") / F.col("n")
    return g.select("column", "lambda",
                    (-F.col("n") / 2.0 * F.when(v > 0, F.log(v)) + (F.col("lambda") - 1.0) * F.col("sl"))
                    .alias("loglik"))


def _vertex(points: list[tuple[float, float]]) -> float:
    """Abscissa of the top of the parabola through three (x, y) points."""
    (x0, y0), (x1, y1), (x2, y2) = points
    a, b = (x1 - x0) * (y1 - y2), (x1 - x2) * (y1 - y0)
    return x1 if a == b else x1 - 0.5 * ((x1 - x0) * a - (x1 - x2) * b) / (a - b)


def search_lambdas(keys: Sequence, loglik, start: float = 2.0, limit: float = 128.0) -> dict:
    """Max-likelihood lambda per key, to about 1e-6; ``loglik`` gives the (key,
    lambda, log-likelihood) rows of a grid (key -> lambdas) in one pass.

    The search starts on [-start, start]; a key whose best point lies at an
    end is searched on beyond it, each time twice as far, until the best point
    is interior (a column of two values has no maximum and stops at ``limit``,
    where the likelihood is flat in doubles).  Then two finer grids around the
    best point, each closed by the parabola through its top: four passes for a
    usual column, one more for every doubling.
    """
    known: dict = {c: {} for c in keys}

    def ask(grid: dict) -> None:
        grid = {c: sorted(set(g)) for c, g in grid.items() if g}
        if grid:
            for key, lam, value in loglik(grid):
                if value is not None and math.isfinite(value):
                    known[key][lam] = value

    def top(c) -> float:
        return max(known[c], key=lambda x: (known[c][x], -abs(x - 1.0)))

    def around(c, step: float, many: int) -> list[float]:
        return [round(top(c) + i * step, 10) for i in range(-many, many + 1)]

    def peak(c) -> float:
        xs = sorted(known[c])
        i = xs.index(top(c))
        return _vertex([(x, known[c][x]) for x in xs[i - 1:i + 2]]) if 0 < i < len(xs) - 1 else xs[i]

    ask({c: [i * start / 8 for i in range(-8, 9)] for c in keys})
    reach = start
    while reach < limit:
        edge = {c: 1.0 if top(c) >= reach else -1.0 for c in keys if known[c] and abs(top(c)) >= reach}
        if not edge:
            break
        ask({c: [sign * reach * (1 + i / 8) for i in range(1, 9)] for c, sign in edge.items()})
        reach *= 2
    live = [c for c in keys if known[c]]
    width = {c: max(start, abs(top(c))) / 8 for c in live}  # a coarse step there
    ask({c: around(c, width[c] / 20, 20) for c in live})
    for share in (1e-2, 1e-4):
        centre = {c: peak(c) for c in live}
        known = {c: {} for c in keys}
        ask({c: [centre[c] + i * width[c] * share / 20 for i in range(-20, 21)] for c in live})
    return {c: float(peak(c)) for c in live}


def fit_yeo_johnson(df: DataFrame, cols: Sequence[str], start: float = 2.0, limit: float = 128.0) -> dict[str, float]:
    """Max-likelihood lambda per column (see :func:`search_lambdas`)."""
    def loglik(grid):  # (#cols x #grid) rows
        return [(r["column"], r["lambda"], r["loglik"]) for r in yeo_johnson_loglik(df, list(grid), grid).collect()]

    return search_lambdas(cols, loglik, start, limit)


class SkewCorrector(Estimator, _Cols, DefaultParamsReadable, DefaultParamsWritable):
    """Yeo-Johnson (no standardising) on numeric columns with |G1| > threshold."""

    threshold = Param(Params._dummy(), "threshold", "abs skew threshold",
                      typeConverter=TypeConverters.toFloat)

    @keyword_only
    def __init__(self, cols: list[str] | None = None, threshold: float = 0.75):
        super().__init__()
        self._setDefault(cols=[], threshold=0.75, stateJson="{}")
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> "SkewCorrectorModel":
        from pyspark import StorageLevel
        cols = [c for c in self.getOrDefault(self.cols) if c in df.columns]
        skewed: list[str] = []
        lambdas: dict[str, float] = {}
        if cols:
            # four passes (skew + three grid rounds) over the numeric columns only:
            # persist that projection for the fit, as iterative Spark ML estimators do
            x = df.select(*[col(c).cast("double").alias(c) for c in cols])
            x = x.persist(StorageLevel.MEMORY_AND_DISK) if not df.is_cached else x
            try:
                row = x.agg(*[adjusted_skew(col(c)).alias(f"s{i}") for i, c in enumerate(cols)]).first()
                thr = self.getOrDefault(self.threshold)
                skewed = [c for i, c in enumerate(cols)
                          if row[f"s{i}"] is not None and abs(row[f"s{i}"]) > thr]
                lambdas = fit_yeo_johnson(x, skewed) if skewed else {}
            finally:
                if x.is_cached:
                    x.unpersist()
        m = SkewCorrectorModel()
        m._set(cols=skewed, stateJson=json.dumps(lambdas))
        return m


class SkewCorrectorModel(Model, _Cols, DefaultParamsReadable, DefaultParamsWritable):
    def __init__(self):
        super().__init__()
        self._setDefault(cols=[], stateJson="{}")

    def lambdas(self) -> dict[str, float]:
        return json.loads(self.getOrDefault(self.stateJson))

    def _transform(self, df: DataFrame) -> DataFrame:
        lam = self.lambdas()
        return df.select(*[yeo_johnson(col(c), lam[c]).alias(c) if c in lam else col(c)
                           for c in df.columns])


# ---------------------------------------------------------------- ENC-7 / preprocessors
def preprocessing_stages(schema: T.StructType, kind: str = "tree", min_frequency: float = 0.01,
                         skew_threshold: float = 0.75, exclude: Sequence[str] = (),
                         output: str = "features") -> list:
    """Stages of the tree / linear preprocessor for an input ``schema``.

    Column roles are read from the schema at build time (a driver-side
    operation); the assembled vector keeps plain column names as ML
    attributes.  The one-hot output names are only known after fitting, so the
    assembler is created by :class:`AssembleAll` at fit time.
    """
    from terrace.operators.clean import MedianImputer

    if kind not in ("tree", "linear"):
        raise ValueError(f"Unknown kind '{kind}'. Expected 'tree' or 'linear'.")
    fields = T.StructType([f for f in schema.fields if f.name not in exclude])
    ordinal, nominal, numeric = select_ordinal(fields), select_nominal(fields), select_numeric(fields)
    stages: list = [OrdinalEncoder(cols=ordinal)]
    if kind == "linear":
        stages.append(RobustScaler(cols=ordinal))
    stages.append(RareOneHotEncoder(cols=nominal, minFrequency=min_frequency))
    stages.append(MedianImputer(cols=numeric))
    if kind == "linear":
        stages += [SkewCorrector(cols=numeric, threshold=skew_threshold), RobustScaler(cols=numeric)]
    stages.append(AssembleAll(ordinal=ordinal, nominal=nominal, numeric=numeric, outputCol=output))
    return stages


class AssembleAll(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Fit-time VectorAssembler over ordinal + one-hot + numeric columns."""

    ordinal = Param(Params._dummy(), "ordinal", "", typeConverter=TypeConverters.toListString)
    nominal = Param(Params._dummy(), "nominal", "", typeConverter=TypeConverters.toListString)
    numeric = Param(Params._dummy(), "numeric", "", typeConverter=TypeConverters.toListString)
    outputCol = Param(Params._dummy(), "outputCol", "", typeConverter=TypeConverters.toString)

    @keyword_only
    def __init__(self, ordinal=None, nominal=None, numeric=None, outputCol="features"):
        super().__init__()
        self._setDefault(ordinal=[], nominal=[], numeric=[], outputCol="features")
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame):
        nominal = set(self.getOrDefault(self.nominal))
        onehot = [c for c in df.columns if any(c.startswith(n + "_") for n in nominal)
                  and c not in nominal]
        inputs = (self.getOrDefault(self.ordinal) + onehot + self.getOrDefault(self.numeric))
        inputs = [c for c in inputs if c in df.columns]
        return VectorAssembler(inputCols=inputs, outputCol=self.getOrDefault(self.outputCol),
                               handleInvalid="keep")
