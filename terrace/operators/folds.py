"""Preprocessing of all fold complements at once, least squares from
compressed folds, and fitted folds applied in one scan.

A *complement* is what a fold's model is trained on: all rows outside fold
``h`` of repeat ``r`` (number ``r * k + h``), or all rows (the last number).

* :func:`fit_complements` counts (column, value) once, with a number per
  complement; only skewed columns get a row per value and complement.
  Values that need a learnt fill differ between complements, so only rows with
  such a fill are counted per complement.  Medians, modes, quartiles, level
  frequencies, skewness and Yeo-Johnson likelihoods of every complement are
  read from these counts: the number of jobs does not depend on the folds.
* :func:`moments` reduces the rows of every complement to the moments of
  (features, label).  A row is engineered once per distinct fill and sent to
  the task once; what a complement learnt of levels, medians, powers and scales
  is applied to columns of an Arrow batch.  :class:`CompressedFolds` turns them into at most p + 2
  rows with the same moments, on which Spark's own solver is fitted, so
  searches and variants never read the data again.
* :class:`FoldLinearModel` holds the fitted models of all folds and applies to
  each row that of its fold: one projection, no join, no exchange.
"""

from __future__ import annotations

import json
import math
import sys
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import numpy as np
from pyspark import cloudpickle
from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.config import DROP_AFTER, DROP_COLS, NONE_COLS, ORDINAL_LEVELS, ZERO_COLS
from terrace.functions.exprs import col, is_numeric, yeo_johnson
from terrace.operators import clean as C
from terrace.operators import encode as E
from terrace.operators import models as M
from terrace.operators.features import FeatureEngineer, engineer
from terrace.operators.quantile import grouped_quantiles, member_quantiles
from terrace.session import scratch_path


# the helpers of the tasks travel with them: workers need not find the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Complements per bigint of a row's set of complements.
WORD = 62


@dataclass(frozen=True)
class Folds:
    """Fold columns (one per repeat) with ``k`` folds each."""

    cols: tuple[str, ...]
    k: int

    @property
    def whole(self) -> int:
        return len(self.cols) * self.k

    @property
    def numbers(self) -> range:
        return range(self.whole + 1)

    def number(self, repeat: int, fold: int) -> int:
        return repeat * self.k + fold

    @property
    def words(self) -> list[str]:
        """Columns whose bits are the complements of a row."""
        return [f"_in{w}" for w in range(self.whole // WORD + 1)]

    def code(self) -> Column:
        return sum((col(c).cast("int") * self.k ** i for i, c in enumerate(self.cols)), F.lit(0))

    def own(self, code: Column, repeat: int) -> Column:
        """The fold of a repeat in this combination of folds."""
        return F.pmod(F.floor(code / self.k ** repeat), F.lit(self.k)).cast("int")



def _save(df: DataFrame, name: str) -> DataFrame:
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _long(rows: DataFrame, cols: Sequence[str], kind: str, *carried: str) -> DataFrame:
    cells = F.array(*[F.struct(F.lit(c).alias("column"), col(c).cast(kind).alias("x")) for c in cols])
    return rows.select(*carried, F.explode(cells).alias("s")).select(*carried, "s.*")


def _members(folds: Folds, also=None) -> list[Column]:
    """The complements that a row (with ``_sig``) belongs to, as bits of the
    words :attr:`Folds.words`; ``also`` (complement -> condition) restricts them."""
    own = [folds.own(F.col("_sig"), i) for i in range(len(folds.cols))]
    words = []
    for w, name in enumerate(folds.words):
        bits = F.lit(0).cast("bigint")
        for j in folds.numbers[w * WORD:(w + 1) * WORD]:
            here = F.lit(True) if j == folds.whole else ~F.coalesce(own[j // folds.k] == j % folds.k, F.lit(False))
            here = here if also is None else also(j, here)
            bits = bits + F.when(here, F.lit(1 << j % WORD).cast("bigint")).otherwise(F.lit(0).cast("bigint"))
        words.append(bits.alias(name))
    return words


def _counted_wide(long: DataFrame, folds: Folds, keys: Sequence[str]) -> DataFrame:
    """(keys, _all) from rows with the words of their complements: how often each
    complement has the keys (NULL: never).  One sum per complement, combined
    before the shuffle: neither rows nor counts multiply."""
    member = lambda j: F.col(folds.words[j // WORD]).bitwiseAND(F.lit(1 << j % WORD).cast("bigint")) != 0
    sums = [F.sum(F.when(member(j), F.lit(1).cast("bigint"))) for j in folds.numbers]
    return long.groupBy(*keys).agg(F.array(*sums).alias("_all"))


def _counted(long: DataFrame, folds: Folds, keys: Sequence[str]) -> DataFrame:
    """(keys, _j, n) from rows with the words of their complements, or with
    ``_sig`` (their combination of folds) and ``_j`` (their complement, or -1:
    all that their folds belong to)."""
    if folds.words[0] not in long.columns:
        long = long.select(*keys, *_members(folds, lambda j, here: (F.col("_j") == j) | (F.col("_j") < 0) & here))
    return _counted_wide(long, folds, keys).select(*keys, F.posexplode("_all").alias("_j", "n")).where("n is not null")


def _first_equal(values: Sequence) -> list[int]:
    """Per complement the first one with the same value."""
    return [list(values).index(v) for v in values]


def _parts(folds: Folds, same: Sequence[int]) -> Column:
    """The classes of equal entries of ``same`` (complement -> first complement
    alike) as a literal array of (_j, bits of the words)."""
    rows = []
    for first in sorted(set(same)):
        bits = [sum(1 << j % WORD for j in folds.numbers[w * WORD:(w + 1) * WORD] if same[j] == first) for w in range(len(folds.words))]
        rows.append(f"named_struct('_j', {first}, " + ", ".join(f"'{n}', bigint({b})" for n, b in zip(folds.words, bits)) + ")")
    return F.expr(f"array({', '.join(rows)})")


def _fill_classes(data: DataFrame, folds: Folds, fills: list[dict], group: str, frontage: str, skip: Sequence[str]) -> Column:
    """Per row the classes of complements that fill it alike: one, where no fill
    that it reads differs between them; where more than one differs, each
    complement for itself.  A null that the rules of :func:`terrace.operators.clean.apply_rules`
    fill without a learnt value reads none."""
    differs = lambda same: any(same)
    basement = C._in_basement(data)
    given = {*NONE_COLS, *ZERO_COLS, "Functional"}
    reads: list[Column] = []  # per learnt fill that differs: its classes in rows that read it, else NULL
    for c in data.columns:
        if c in skip:
            continue
        if c == frontage:
            overall = [float(s["global_median"]) for s in fills]
            names = sorted({g for s in fills for g in s["group_medians"]}) if group in data.columns else []
            by = {g: _first_equal([s["group_medians"].get(g, o) for s, o in zip(fills, overall)]) for g in names}
            rest = _first_equal(overall)
            arms = [(col(group) == F.lit(g), same) for g, same in by.items() if differs(same)]
            if differs(rest):
                known = F.coalesce(col(group).isin(names), F.lit(False)) if names else F.lit(False)
                arms.append((~known, rest))
            picked = None
            for cond, same in arms:
                picked = F.when(cond, _parts(folds, same)) if picked is None else picked.when(cond, _parts(folds, same))
            if picked is not None:
                reads.append(F.when(col(c).isNull(), picked))
            continue
        missing = col(c).isNull()
        if c in basement:
            missing = missing & F.coalesce(col("TotalBsmtSF") > 0, F.lit(False))
        elif c in given:
            continue
        elif c == "GarageYrBlt" and "YearBuilt" in data.columns:
            missing = missing & col("YearBuilt").isNull()
        same = _first_equal([s["medians" if is_numeric(data.schema[c].dataType) else "modes"].get(c) for s in fills])
        if differs(same):
            reads.append(F.when(missing, _parts(folds, same)))
    one = _parts(folds, [0] * len(folds.numbers))
    if not reads:
        return one
    many = sum((r.isNotNull().cast("int") for r in reads), F.lit(0)) > 1
    return F.when(many, _parts(folds, list(folds.numbers))).otherwise(F.coalesce(*reads, one))


def _by_fill(rows: DataFrame, folds: Folds, fills: list[dict], group: str, frontage: str, skip: Sequence[str]) -> DataFrame:
    """A row (with the words of its complements) once per class of complements
    that fill it alike: the words then hold the class, ``_j`` one complement of it."""
    words = folds.words
    rest = [c for c in rows.columns if c not in words]
    out = rows.withColumn("_class", F.explode(_fill_classes(rows, folds, fills, group, frontage, skip)))
    out = out.select(F.col("_class._j"), *[F.col(w).bitwiseAND(F.col(f"_class.{w}")).alias(w) for w in words], *[col(c) for c in rest])
    return out.where(" or ".join(f"{w} <> 0" for w in words))


def _sql(value, kind: str) -> str:
    if value is None:
        return f"cast(null as {kind})"
    if kind == "string":
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return str(bool(value)).lower() if kind == "boolean" else f"double('{float(value)!r}')"


def _table(values: Sequence, kind: str) -> Column:
    """The values of all complements as one array literal."""
    return F.expr(f"array({', '.join(_sql(v, kind) for v in values)})")


def _pick(values: Sequence, j: Column, kind: str) -> Column:
    """The value of complement ``j``: a literal where all agree."""
    if all(v == values[0] for v in values):
        return F.expr(_sql(values[0], kind))
    return F.get(_table(values, kind), j)


class _Fills:
    """Learnt fills of all complements, for :func:`terrace.operators.clean.apply_rules`."""

    def __init__(self, states: list[dict], j: Column):
        self.states, self.j = states, j

    def _of(self, what: str, c: str, kind: str) -> Column | None:
        values = [s[what].get(c) for s in self.states]
        return None if all(v is None for v in values) else _pick(values, self.j, kind)

    def median(self, c: str) -> Column | None:
        return self._of("medians", c, "double")

    def mode(self, c: str) -> Column | None:
        return self._of("modes", c, "string")

    def frontage(self, group: Column | None) -> Column:
        fill = _pick([float(s["global_median"]) for s in self.states], self.j, "double")
        names = sorted({g for s in self.states for g in s["group_medians"]})
        if group is None or not names:
            return fill
        table = F.create_map(*[x for g in names for x in (F.lit(g), _table([s["group_medians"].get(g) for s in self.states], "double"))])
        return F.coalesce(F.get(table[group], self.j), fill)


@dataclass
class FoldPreprocessor:
    """The fitted linear (and tree) preprocessing of every complement."""

    folds: Folds
    id_col: str
    target: str
    drop_cols: list[str]
    drop_after: list[str]
    ordinal: list[str]
    nominal: list[str]
    numeric: list[str]
    fills: list[dict] = field(default_factory=list)        # per complement: state of DomainImputer
    levels: list[dict] = field(default_factory=list)       # per complement: state of RareOneHotModel
    medians: list[dict] = field(default_factory=list)      # per complement: state of MedianImputer
    lambdas: list[dict] = field(default_factory=list)      # per complement: state of SkewCorrectorModel
    scales: list[dict] = field(default_factory=list)       # per complement: column -> [centre, width]

    # ------------------------------------------------------------- one fold as ML stages
    def pipeline(self, j: int) -> PipelineModel:
        """The complement's fitted stages, as a fit on its rows would give them."""
        imputer = C.DomainImputerModel()
        imputer._set(stateJson=json.dumps(self.fills[j]))
        ordinal = E.RobustScalerModel()
        ordinal._set(cols=self.ordinal, stateJson=json.dumps({c: self.scales[j][c] for c in self.ordinal}))
        onehot = E.RareOneHotModel()
        onehot._set(cols=self.nominal, stateJson=json.dumps(self.levels[j]))
        median = C.MedianImputerModel()
        median._set(cols=self.numeric, stateJson=json.dumps(self.medians[j]))
        skew = E.SkewCorrectorModel()
        skew._set(cols=list(self.lambdas[j]), stateJson=json.dumps(self.lambdas[j]))
        scale = E.RobustScalerModel()
        scale._set(cols=self.numeric, stateJson=json.dumps({c: self.scales[j][c] for c in self.numeric}))
        return PipelineModel([imputer, C.ColumnDropper(cols=self.drop_cols), FeatureEngineer(dropAfter=self.drop_after),
                              M.LogLabel(inputCol=self.target, outputCol="label"), E.OrdinalEncoder(cols=self.ordinal), ordinal, onehot,
                              median, skew, scale, VectorAssembler(inputCols=self.names(j), outputCol="features", handleInvalid="keep")])

    def names(self, j: int) -> list[str]:
        onehot = E.RareOneHotModel()
        onehot._set(cols=self.nominal, stateJson=json.dumps(self.levels[j]))
        return [*self.ordinal, *onehot.output_columns(), *self.numeric]

    # ------------------------------------------------------------- all folds in one projection
    @property
    def all_names(self) -> list[str]:
        """Feature names of all complements; where one lacks a level its feature is 0."""
        known = []
        for c in self.nominal:
            levels = sorted({lv for s in self.levels for lv in s[c]["frequent"]})
            known += [f"{c}_{lv}" for lv in levels] + [f"{c}_infrequent_sklearn"] * any(s[c]["rare"] for s in self.levels)
        return [*self.ordinal, *known, *self.numeric]

    def transform(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """``features`` (array over :attr:`all_names`), ``label`` and the columns
        ``keep`` of ``df``, each row as complement ``_j`` of the row treats it."""
        j = F.col("_j")
        kept = {c: f"_keep{i}" for i, c in enumerate(keep)}
        df = df.select("*", *[col(c).alias(n) for c, n in kept.items()])
        out = C.apply_rules(df, "Neighborhood", "LotFrontage", _Fills(self.fills, j))
        out = engineer(out.drop(*self.drop_cols), self.drop_after)
        out = M.LogLabel(inputCol=self.target, outputCol="label").transform(out)
        cells = [self._scaled(c, E.ordinal_code(col(c), ORDINAL_LEVELS[c]), j) for c in self.ordinal]
        for c in self.nominal:
            known = F.lit(False)
            for lv in sorted({lv for s in self.levels for lv in s[c]["frequent"]}):
                here = F.coalesce(col(c) == F.lit(lv), F.lit(False)) & _pick([lv in s[c]["frequent"] for s in self.levels], j, "boolean")
                cells.append(here.cast("double"))
                known = known | here
            if any(s[c]["rare"] for s in self.levels):
                cells.append((col(c).isNotNull() & ~known & _pick([s[c]["rare"] for s in self.levels], j, "boolean")).cast("double"))
        for c in self.numeric:
            x = F.coalesce(col(c).cast("double"), _pick([m[c] for m in self.medians], j, "double"))
            lam = [s.get(c) for s in self.lambdas]
            if any(v is not None for v in lam):
                power = _pick(lam, j, "double")
                x = F.when(power.isNotNull(), yeo_johnson(x, power)).otherwise(x)
            cells.append(self._scaled(c, x, j))
        return out.select("_j", *[F.col(n).alias(c) for c, n in kept.items()], "label", F.array(*cells).alias("features"))

    # ------------------------------------------------------------- many complements of a row
    def cells(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """``label`` and ``cells`` (array over :attr:`all_names`) of each row of
        ``df``, once per class of its complements (bits of the words) that fill
        it alike.  Cells hold what :class:`_Completed` finishes for a complement:
        codes and numbers not filled, powered or scaled, a flag per level that any
        complement knows, and for a column's rare levels a flag that it has a value."""
        words = self.folds.words
        kept = {c: f"_keep{i}" for i, c in enumerate(keep)}
        df = df.select("*", *[col(c).alias(n) for c, n in kept.items()])
        df = _by_fill(df, self.folds, self.fills, "Neighborhood", "LotFrontage", [self.id_col, *self.drop_cols])
        out = C.apply_rules(df, "Neighborhood", "LotFrontage", _Fills(self.fills, F.col("_j")))
        out = engineer(out.drop(*self.drop_cols), self.drop_after)
        out = M.LogLabel(inputCol=self.target, outputCol="label").transform(out)
        cells = [E.ordinal_code(col(c), ORDINAL_LEVELS[c]).cast("double") for c in self.ordinal]
        for c in self.nominal:
            cells += [F.coalesce(col(c) == F.lit(lv), F.lit(False)).cast("double") for lv in sorted({lv for s in self.levels for lv in s[c]["frequent"]})]
            if any(s[c]["rare"] for s in self.levels):
                cells.append(col(c).isNotNull().cast("double"))
        cells += [col(c).cast("double") for c in self.numeric]
        return out.select(*words, *[F.col(n).alias(c) for c, n in kept.items()], "label", F.array(*cells).alias("cells"))

    def _scaled(self, c: str, x: Column, j: Column) -> Column:
        return (x - _pick([s[c][0] for s in self.scales], j, "double")) / _pick([s[c][1] for s in self.scales], j, "double")


def _powers(x: np.ndarray, lam: float) -> np.ndarray:
    """Yeo-Johnson of a column."""
    up = x >= 0
    log = np.log1p(np.abs(x))
    with np.errstate(over="ignore", invalid="ignore"):
        pos = log if abs(lam) < 1e-12 else (np.exp(lam * log) - 1.0) / lam
        if up.all():
            return pos
        neg = -log if abs(lam - 2.0) < 1e-12 else -(np.exp((2.0 - lam) * log) - 1.0) / (2.0 - lam)
    return np.where(up, pos, neg)


class _Completed:
    """Rows of :meth:`FoldPreprocessor.cells` as a complement treats them: the
    features of :meth:`FoldPreprocessor.transform`, for columns of an Arrow batch."""

    def __init__(self, prep: FoldPreprocessor, numbers: Sequence[int]):
        names = prep.all_names
        self.p, first = len(names), len(names) - len(prep.numeric)
        groups = []  # per nominal column with rare levels: its flag's position, those of its levels
        known = len(prep.ordinal)
        for c in prep.nominal:
            levels = sorted({lv for s in prep.levels for lv in s[c]["frequent"]})
            rare = any(s[c]["rare"] for s in prep.levels)
            groups.append((c, levels, known, known + len(levels) if rare else None))
            known += len(levels) + rare
        self.state = {}
        for j in numbers:
            on = np.ones(self.p)
            rest = []
            for c, levels, at, flag in groups:
                on[at:at + len(levels)] = [lv in prep.levels[j][c]["frequent"] for lv in levels]
                if flag is not None:
                    on[flag] = prep.levels[j][c]["rare"]
                    rest.append((flag, at, at + len(levels)))
            centre, width = np.zeros(self.p), np.ones(self.p)
            for i, c in [*enumerate(prep.ordinal), *enumerate(prep.numeric, first)]:
                centre[i], width[i] = prep.scales[j][c]
            fill = {i: np.nan if prep.medians[j][c] is None else prep.medians[j][c] for i, c in enumerate(prep.numeric, first)}
            power = {i: prep.lambdas[j][c] for i, c in enumerate(prep.numeric, first) if prep.lambdas[j].get(c) is not None}
            self.state[j] = on, rest, centre, width, fill, power

    def read(self, column) -> tuple[np.ndarray, dict[int, np.ndarray]]:
        """The cells of a batch, and per column that has any which of them are null."""
        flat = column.flatten()
        x = flat.to_numpy(zero_copy_only=False).reshape(len(column), self.p)
        if not flat.null_count:
            return x, {}
        null = flat.is_null().to_numpy(zero_copy_only=False).reshape(len(column), self.p)
        return x, {int(i): null[:, i] for i in np.flatnonzero(null.any(axis=0))}

    def features(self, j: int, x: np.ndarray, null: dict[int, np.ndarray], at: np.ndarray) -> np.ndarray:
        """Features of the rows ``at`` (mask) as complement ``j`` treats them."""
        on, rest, centre, width, fill, power = self.state[j]
        out = x[at] * on
        for flag, low, high in rest:
            out[:, flag] -= out[:, low:high].sum(axis=1) * on[flag]
        for i, missing in null.items():
            if i in fill:
                out[missing[at], i] = fill[i]
        for i, lam in power.items():
            out[:, i] = _powers(out[:, i], lam)
        out -= centre
        out /= width
        return out


def _with_bit(batch, words: Sequence[str], j: int) -> np.ndarray:
    """Which rows of an Arrow batch belong to complement ``j``."""
    return batch.column(words[j // WORD]).to_numpy() >> (j % WORD) & 1 == 1


def fit_complements(train: DataFrame, folds: Folds, id_col: str = "Id", target: str = "SalePrice", min_frequency: float = 0.01,
                    skew_threshold: float = 0.75, drop_cols: Sequence[str] = DROP_COLS,
                    drop_after: Sequence[str] = DROP_AFTER) -> FoldPreprocessor:
    """The preprocessing of every complement of ``folds`` (columns of ``train``),
    equal to a fit on each complement's rows alone."""
    group, frontage = "Neighborhood", "LotFrontage"
    data = train.drop(*folds.cols)
    eng = M.engineered_schema(data.schema, id_col, drop_cols, drop_after)
    fields = [f for f in eng.fields if f.name not in (id_col, target, "label")]
    roles = type(eng)(fields)
    out = FoldPreprocessor(folds, id_col, target, [c for c in drop_cols if c != id_col], list(drop_after), E.select_ordinal(roles),
                           E.select_nominal(roles), E.select_numeric(roles))
    rows = train.withColumn("_sig", folds.code()).drop(*folds.cols)
    words = folds.words
    plain = rows.select(*_members(folds), *[col(c) for c in data.columns])

    # the imputer: medians, modes, medians by group
    number = [f.name for f in data.schema.fields if is_numeric(f.dataType)]
    other = [f.name for f in data.schema.fields if not is_numeric(f.dataType)]
    members = len(folds.numbers)
    counts = _save(_counted_wide(_long(plain, number, "double", *words).where("x is not null"), folds, ["column", "x"]), "fold-counts")
    medians = {k: q[0] for k, q in member_quantiles(counts, "column", "x", members, [0.5]).items()}
    modes = {}
    if other:
        levels = _counted(_long(plain, other, "string", *words).where("x is not null"), folds, ["column", "x"])
        best = levels.groupBy("column", "_j").agg(F.min(F.struct((-F.col("n")).alias("m"), "x")).alias("b"))
        modes = {(r["column"], r["_j"]): r["b"]["x"] for r in best.collect()}
    by_group: dict = {}
    if C.has(data, frontage, group):
        cells = plain.select(*words, col(group).alias("g"), col(frontage).cast("double").alias("x")).where("g is not null and x is not null")
        counts = _save(_counted(cells, folds, ["g", "x"]), "fold-counts")  # written: every round reads it
        q = grouped_quantiles(counts, ["g", "_j"], "x", [0.5], weight="n")
        by_group = {(r["g"], r["_j"]): r["q"][0] for r in q.collect()}  # fitted state: a value a group
    for j in folds.numbers:
        med = {c: float(medians[c, j]) for c in number if medians.get((c, j)) is not None}
        out.fills.append({"medians": med, "modes": {c: modes[c, j] for c in other if (c, j) in modes},
                          "group_medians": {g: v for (g, i), v in by_group.items() if i == j},
                          "global_median": med.get(frontage, 0.0) if frontage in data.columns else 0.0})

    # the encoded columns: a row once per distinct fill that its complements learnt
    shared = _by_fill(plain, folds, out.fills, group, frontage, [id_col, target, *out.drop_cols])
    eng_rows = engineer(C.apply_rules(shared, group, frontage, _Fills(out.fills, F.col("_j"))).drop(*out.drop_cols), out.drop_after)
    # written: both counts read it, and their sums stay short enough to be compiled
    eng_rows = _save(eng_rows.select(*words, *[E.ordinal_code(col(c), ORDINAL_LEVELS[c]).alias(c) for c in out.ordinal],
                                     *[col(c) for c in (*out.nominal, *out.numeric)]), "fold-rows")
    vocab = [{c: {"frequent": [], "rare": False} for c in out.nominal} for _ in folds.numbers]
    if out.nominal:
        levels = _counted(_long(eng_rows, out.nominal, "string", *words), folds, ["column", "x"])
        total = F.expr("sum(n) over (partition by column, _j)")
        level = F.when(F.col("n") >= F.lit(float(min_frequency)) * F.col("total"), F.col("x"))
        seen = levels.withColumn("total", total).where("x is not null").select("column", "_j", level.alias("level")).distinct()
        for r in seen.collect():  # 1 / min_frequency levels of a column at most, and one flag
            if r["level"] is None:
                vocab[r["_j"]][r["column"]]["rare"] = True
            else:
                vocab[r["_j"]][r["column"]]["frequent"].append(r["level"])
    for s in vocab:
        for v in s.values():
            v["frequent"].sort()
    out.levels = vocab

    # numbers: medians fill what is still null, then quartiles, skewness, lambdas
    values = [*out.ordinal, *out.numeric]
    counts = _save(_counted_wide(_long(eng_rows, values, "double", *words), folds, ["column", "x"]), "fold-counts")
    fill = {k: q[0] for k, q in member_quantiles(counts.where(F.col("column").isin(out.numeric)), "column", "x", members, [0.5]).items()}
    out.medians = [{c: fill.get((c, j)) for c in out.numeric} for j in folds.numbers]
    spark = train.sparkSession
    filled = []  # the nulls of a column and complement, counted under its median
    for r in counts.where("x is null").collect():  # a row a column
        filled += [(r["column"], fill[r["column"], j], [n if i == j else None for i in folds.numbers])
                   for j, n in enumerate(r["_all"]) if n and (r["column"], j) in fill]
    counts = counts.where("x is not null").unionByName(spark.createDataFrame(filled, "column string, x double, _all array<bigint>"))
    order = member_quantiles(counts, "column", "x", members, [0.25, 0.5, 0.75], pairs=True)
    n = [F.get("_all", F.lit(j)).cast("double") for j in folds.numbers]
    sums = {r["column"]: r for r in counts.groupBy("column").agg(
        F.array(*[F.sum(w) for w in n]).alias("m0"), F.array(*[F.sum(w * F.col("x")) for w in n]).alias("m1")).collect()}  # a row a column
    mean = spark.createDataFrame([(c, [b / a if a else None for a, b in zip(r["m0"], r["m1"])]) for c, r in sums.items()],
                                 "column string, mean array<double>")
    d = [F.col("x") - F.get("mean", F.lit(j)) for j in folds.numbers]
    central = counts.join(F.broadcast(mean), "column").groupBy("column").agg(
        F.array(*[F.sum(w * x * x) for w, x in zip(n, d)]).alias("m2"), F.array(*[F.sum(w * x * x * x) for w, x in zip(n, d)]).alias("m3"))
    skewed = []
    for r in central.collect():
        c = r["column"]
        for j, (m0, m2, m3) in enumerate(zip(sums[c]["m0"], r["m2"], r["m3"])):
            if c in out.numeric and m0 is not None and m0 >= 3 and m2 > 0:
                g1 = math.sqrt(m0) * m3 / m2 ** 1.5
                if abs(g1 * math.sqrt(m0 * (m0 - 1)) / (m0 - 2)) > skew_threshold:
                    skewed.append(values.index(c) * members + j)
    lam = {}
    if skewed:  # only their values become a row per complement
        some = sorted({values[key // members] for key in skewed})
        number_of = F.create_map(*[x for c in some for x in (F.lit(c), F.lit(values.index(c)))])
        state = counts.where(F.col("column").isin(some)).select("column", "x", F.posexplode("_all").alias("_j", "n")).where("n is not null")
        state = state.select((number_of[F.col("column")] * members + F.col("_j")).cast("int").alias("key"), "x", "n").where(F.col("key").isin(skewed))
        state = _save(state.repartition("key", F.pmod(F.xxhash64("x"), F.lit(64))).sortWithinPartitions("key"), "fold-state")
        lam = E.search_lambdas(skewed, lambda grid: _loglik(state, grid))
    out.lambdas = [{} for _ in folds.numbers]
    for key in sorted(lam):
        out.lambdas[key % len(folds.numbers)][values[key // len(folds.numbers)]] = lam[key]
    for j in folds.numbers:
        scales = {}
        for c in values:
            got = order.get((c, j))
            if got is None or got[0]["low"] is None:
                scales[c] = [0.0, 1.0]
                continue
            # the transform is increasing, so it takes order statistics to order statistics
            power = out.lambdas[j].get(c)
            q = []
            for p in got:
                a, b = (v if power is None else _power(v, power) for v in (p["low"], p["high"]))
                q.append(a if p["share"] == 0 or a == b else (1 - p["share"]) * a + p["share"] * b)
            scales[c] = [q[1], q[2] - q[0] if q[2] != q[0] else 1.0]
        out.scales.append(scales)
    return out


def _power(x: float, lam: float) -> float:
    """Yeo-Johnson of one number."""
    if x >= 0:
        return math.log1p(x) if abs(lam) < 1e-12 else (math.exp(lam * math.log1p(x)) - 1.0) / lam
    return -math.log1p(-x) if abs(lam - 2.0) < 1e-12 else -(math.exp((2.0 - lam) * math.log1p(-x)) - 1.0) / (2.0 - lam)


def _loglik(counts: DataFrame, grid: dict[int, list[float]]) -> list[tuple[int, float, float]]:
    """(key, lambda, log-likelihood) from counted values: each task reduces its
    rows to (n, mean, M2) per (key, lambda)."""
    points = {k: np.array(v) for k, v in grid.items()}

    def partials(batches):
        import pyarrow as pa

        def powers(x, lam):
            out = np.empty((len(lam), len(x)))
            up = x >= 0
            lp, ln = np.log1p(x[up]), np.log1p(-x[~up])
            with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
                out[:, up] = np.where(np.abs(lam)[:, None] < 1e-12, lp, (np.exp(lam[:, None] * lp) - 1) / lam[:, None])
                two = 2 - lam[:, None]
                out[:, ~up] = np.where(np.abs(two) < 1e-12, -ln, -(np.exp(two * ln) - 1) / two)
            return out

        acc: dict = {}
        for b in batches:
            key, x, n = b.column(0).to_numpy(), b.column(1).to_numpy(), b.column(2).to_numpy().astype(float)
            order = np.argsort(key, kind="stable")
            cuts = np.flatnonzero(np.diff(key[order], prepend=-1, append=-1))
            for s, e in zip(cuts, cuts[1:]):
                at = order[s:e]
                k = int(key[at[0]])
                if k not in points:
                    continue
                xs, ws = x[at], n[at]
                with np.errstate(over="ignore", invalid="ignore"):
                    t = powers(xs, points[k])
                    nb = ws.sum()
                    mb = t @ ws / nb
                    m2b = ((t - mb[:, None]) ** 2) @ ws
                    sb = float((np.sign(xs) * np.log1p(np.abs(xs))) @ ws)
                    if k in acc:
                        na, ma, m2a, sa = acc[k]
                        d = mb - ma
                        acc[k] = na + nb, ma + d * nb / (na + nb), m2a + m2b + d * d * na * nb / (na + nb), sa + sb
                    else:
                        acc[k] = nb, mb, m2b, sb
        rows = [(k, float(lam), nn, float(mean[i]), float(m2[i]), sl) for k, (nn, mean, m2, sl) in acc.items() for i, lam in enumerate(points[k])]
        if rows:
            names = ["key", "lam", "n", "mean", "m2", "sl"]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.int32() if i == 0 else pa.float64()) for i, c in enumerate(zip(*rows))], names)

    part = counts.where(F.col("key").isin(list(grid))).select("key", "x", "n").mapInArrow(
        partials, "key int, lam double, n double, mean double, m2 double, sl double")
    part = part.withColumn("gmean", F.expr("sum(n * mean) over (partition by key, lam) / sum(n) over (partition by key, lam)"))
    g = part.groupBy("key", "lam").agg(F.sum("n").alias("n"), F.sum(F.col("m2") + F.col("n") * (F.col("mean") - F.col("gmean")) ** 2).alias("m2"),
                                       F.sum("sl").alias("sl"))
    v = F.col("m2") / F.col("n")
    rows = g.select("key", "lam", (-F.col("n") / 2.0 * F.when(v > 0, F.log(v)) + (F.col("lam") - 1.0) * F.col("sl")).alias("ll")).collect()
    return [(r["key"], r["lam"], r["ll"]) for r in rows]


# ---------------------------------------------------------------- compressed least squares
@dataclass
class Moments:
    """Rows, mean and centred scatter of (features..., label) of one complement."""

    n: float
    mean: np.ndarray
    scatter: np.ndarray


def moments(prep: FoldPreprocessor, train: DataFrame) -> dict[int, Moments]:
    """Moments of every complement in one pass.  Each task adds up its Arrow
    batches (partials merged by Chan's formula); partials meet in two rounds, so
    no task merges those of all others.  The driver gets one p x p matrix per
    complement; Spark's normal-equation solver allows 4,096 features."""
    folds = prep.folds
    rows = train.withColumn("_sig", folds.code()).drop(*folds.cols).select("*", *_members(folds)).drop("_sig")
    rows = prep.cells(rows).where("label is not null")
    p = len(prep.all_names)
    completed, words, numbers = _Completed(prep, folds.numbers), folds.words, list(folds.numbers)
    schema = "_j int, part int, n double, mean binary, scatter binary"

    def merge(a, b):
        n = a[0] + b[0]
        d = b[1] - a[1]
        return n, a[1] + d * (b[0] / n), a[2] + b[2] + np.outer(d, d) * (a[0] * b[0] / n)

    def emit(acc, part):
        import pyarrow as pa
        return pa.RecordBatch.from_arrays(
            [pa.array(list(acc), pa.int32()), pa.array([part] * len(acc), pa.int32()), pa.array([a[0] for a in acc.values()], pa.float64()),
             pa.array([a[1].tobytes() for a in acc.values()], pa.binary()), pa.array([a[2].tobytes() for a in acc.values()], pa.binary())],
            ["_j", "part", "n", "mean", "scatter"])

    def add(batches):
        from pyspark import TaskContext
        acc: dict = {}
        for b in batches:
            if b.num_rows == 0:
                continue
            x, null = completed.read(b.column("cells"))
            y = b.column("label").to_numpy()
            for k in numbers:
                at = _with_bit(b, words, k)
                if not at.any():
                    continue
                part = np.column_stack([completed.features(k, x, null, at), y[at]])
                mean = part.mean(axis=0)
                part = part - mean
                got = (float(len(part)), mean, part.T @ part)
                acc[k] = merge(acc[k], got) if k in acc else got
        if acc:
            yield emit(acc, TaskContext.get().partitionId() % 64)

    def fold(t):
        import pyarrow as pa
        acc = None
        for n, mean, scatter in zip(*(t.column(c).to_pylist() for c in ("n", "mean", "scatter"))):
            got = (n, np.frombuffer(mean), np.frombuffer(scatter).reshape(p + 1, p + 1))
            acc = merge(acc, got) if acc else got
        return pa.Table.from_batches([emit({t.column("_j")[0].as_py(): acc}, 0)])

    partial = rows.mapInArrow(add, schema).groupBy("_j", "part").applyInArrow(fold, schema)
    out = {}
    for r in partial.groupBy("_j").applyInArrow(fold, schema).collect():
        out[r["_j"]] = Moments(r["n"], np.frombuffer(r["mean"]), np.frombuffer(r["scatter"]).reshape(p + 1, p + 1))
    return out


class CompressedFolds:
    """Linear models on the complements' moments: at most p + 2 rows that have
    the same mean and covariance as all rows, fitted by Spark's solver."""

    def __init__(self, prep: FoldPreprocessor, train: DataFrame):
        self.prep, self.spark = prep, train.sparkSession
        self.moments = moments(prep, train)
        self.names = prep.all_names
        self._rows: dict = {}

    def rows(self, j: int, without: Sequence[str] = ()) -> tuple[DataFrame, list[int]]:
        """The compressed rows of complement ``j`` and the features that they
        hold (those that the complement knows, less ``without``)."""
        key = (j, tuple(without))
        if key not in self._rows:
            own = set(self.prep.names(j)) - set(without)
            m = self.moments[j]
            # a constant feature has no coefficient, and would make the solver's matrix singular
            variance = np.diag(m.scatter) / m.n
            keep = [i for i, n in enumerate(self.names) if n in own and variance[i] > 1e-20 * m.mean[i] ** 2]
            at = [*keep, len(self.names)]
            scale = np.sqrt(variance[at])
            scale[-1] = scale[-1] or 1.0
            # factorised as correlations: scales of the features differ by many magnitudes
            value, vector = np.linalg.eigh(m.scatter[np.ix_(at, at)] / m.n / np.outer(scale, scale))
            some = value > value.max(initial=0) * 1e-15
            root = scale[:, None] * vector[:, some] * np.sqrt(value[some])
            k = root.shape[1]
            # k + 1 points with mean 0 and unit covariance: an orthonormal basis beside the ones
            basis = np.linalg.qr(np.column_stack([np.ones(k + 1), np.eye(k + 1)[:, :k]]))[0][:, 1:]
            z = m.mean[at] + math.sqrt(k + 1) * basis @ root.T
            frame = self.spark.createDataFrame([(Vectors.dense(r[:-1]), float(r[-1])) for r in z], ["features", "label"])
            self._rows[key] = frame.coalesce(1).cache(), keep
        return self._rows[key]

    def fit(self, j: int, regressor: M.PenalisedLinear, without: Sequence[str] = ()) -> np.ndarray:
        """Coefficients over :attr:`names`, then the intercept."""
        frame, keep = self.rows(j, without)
        m = self.moments[j]
        std = math.sqrt(m.scatter[-1, -1] / m.n)
        reg, en = regressor.spark_params(m.n, std if std > 0 else 1.0)
        model = LinearRegression(featuresCol="features", labelCol="label", regParam=reg, elasticNetParam=en, standardization=False,
                                 solver="normal", maxIter=regressor.getOrDefault(regressor.maxIter), tol=1e-9).fit(frame)
        out = np.zeros(len(self.names) + 1)
        out[keep] = model.coefficients.toArray()
        out[-1] = model.intercept
        return out

    def fit_all(self, tasks: Sequence[tuple], parallelism: int = 8) -> list[np.ndarray]:
        """:meth:`fit` of many (complement, regressor, features left out), several at a time."""
        for j, without in {(t[0], tuple(t[2]) if len(t) > 2 else ()) for t in tasks}:
            self.rows(j, without)
        with ThreadPoolExecutor(max_workers=max(1, parallelism)) as ex:
            return list(ex.map(lambda t: self.fit(*t), tasks))

    def close(self) -> None:
        for frame, _ in self._rows.values():
            frame.unpersist()
        self._rows.clear()


def fold_errors(prep: FoldPreprocessor, rows: DataFrame, models: dict[int, np.ndarray], held: bool = True) -> dict:
    """Per complement the RMSE on the log scale of every model of ``models``
    (complement -> one row of coefficients and intercept per model), in one
    pass: {(complement, True): errors on its training rows, (complement, False):
    on the rows it leaves out}.  With ``held=False`` every row counts as left
    out (a hold-out table without fold columns).  Prices under 0 count as 0."""
    folds = prep.folds
    own = [f"_own{w}" for w in range(len(folds.words))]  # the complements that a row is trained on
    if held:
        rows = rows.withColumn("_sig", folds.code()).drop(*folds.cols)
        rows = rows.select("*", *[m.alias(n) for m, n in zip(_members(folds), own)]).drop("_sig")
    else:
        rows = rows.select("*", *[F.lit(0).cast("bigint").alias(n) for n in own])
    some = [sum(1 << j % WORD for j in models if j // WORD == w) for w in range(len(own))]
    scored = prep.cells(rows.select("*", *[F.lit(bits).cast("bigint").alias(w) for bits, w in zip(some, folds.words)]), own)
    weights = {j: np.atleast_2d(w) for j, w in models.items()}
    completed, words = _Completed(prep, sorted(weights)), folds.words

    def add(batches):
        import pyarrow as pa
        acc: dict = {}
        for b in batches:
            if b.num_rows == 0:
                continue
            x, null = completed.read(b.column("cells"))
            y = b.column("label").to_numpy()
            for k, w in weights.items():
                here = _with_bit(b, words, k)
                if not here.any():
                    continue
                log = np.maximum(completed.features(k, x, null, here) @ w[:, :-1].T + w[:, -1], 0.0)
                square, inside = (log - y[here][:, None]) ** 2, _with_bit(b, own, k)[here]
                for flag in (False, True):
                    at = inside == flag
                    if at.any():
                        got = float(at.sum()), square[at].sum(axis=0)
                        old = acc.get((k, flag))
                        acc[k, flag] = (old[0] + got[0], old[1] + got[1]) if old else got
        rows_ = [(k, flag, i, n, float(e)) for (k, flag), (n, sse) in acc.items() for i, e in enumerate(sse)]
        if rows_:
            kinds = [pa.int32(), pa.bool_(), pa.int32(), pa.float64(), pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows_), kinds)], ["j", "inside", "model", "n", "sse"])

    out = scored.where("label is not null").mapInArrow(
        add, "j int, inside boolean, model int, n double, sse double").groupBy("j", "inside", "model").agg(
        F.sqrt(F.sum("sse") / F.sum("n")).alias("rmse"))
    errors: dict = {}
    for r in out.collect():  # a row per complement, side and model
        errors.setdefault((r["j"], r["inside"]), {})[r["model"]] = r["rmse"]
    return {k: [v[i] for i in range(len(v))] for k, v in errors.items()}


# ---------------------------------------------------------------- fold dispatch
class FoldLinearModel(Transformer):
    """The fitted linear models of all folds of one repeat behind one
    transformer: each row is preprocessed and predicted by the model of its own
    fold (rows without a fold by that of all rows), for several models at once.
    One projection over the input: no join, no exchange."""

    def __init__(self, prep: FoldPreprocessor, fold_col: str, models: dict[str, dict[int, np.ndarray]]):
        super().__init__()
        self.prep, self.fold_col, self.models = prep, fold_col, models

    def _transform(self, df: DataFrame) -> DataFrame:
        folds = self.prep.folds
        own = F.lit(folds.whole)
        if self.fold_col in df.columns and self.fold_col in folds.cols:
            own = F.coalesce(col(self.fold_col).cast("int") + folds.cols.index(self.fold_col) * folds.k, own)
        out = self.prep.transform(df.withColumn("_j", own), df.columns)
        preds = []
        for name, by_fold in self.models.items():
            rows = [f"array({', '.join(_sql(v, 'double') for v in by_fold[j])})" if j in by_fold else "cast(null as array<double>)"
                    for j in folds.numbers]
            table = F.expr(f"array({', '.join(rows)})")
            dot = F.aggregate(F.zip_with("features", F.get(table, F.col("_j")), lambda x, w: x * w), F.lit(0.0),
                              lambda a, x: a + F.coalesce(x, F.lit(0.0)))
            last = _pick([float(by_fold[j][-1]) if j in by_fold else None for j in folds.numbers], F.col("_j"), "double")
            preds.append(F.expm1(dot + last).alias(name))
        return out.select(*[col(c) for c in df.columns], *preds)
