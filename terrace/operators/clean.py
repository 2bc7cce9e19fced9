"""Cleaning: outlier filter, column droppers and the leak-free domain imputer.

Fit = one aggregate job (medians / modes of every column) plus one grouped
median; the fitted state is a handful of scalars and a per-group map kept as
ML Params, so it persists with ``DefaultParamsWritable`` and is applied as a
pure column expression (no join, no shuffle) at transform time.  With more
groups than a literal should hold, the group medians are a written table that
transform joins (``terrace.operators.state``).
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.config import NONE_COLS, ZERO_COLS
from terrace.functions.exprs import col, has, is_numeric, not_true
from terrace.operators.state import attach, free_name, group_state

# ---------------------------------------------------------------- FLT-1/2


def outlier_condition(area: str = "GrLivArea", price: str = "SalePrice",
                      area_max: float = 4000.0, price_min: float = 300000.0) -> Column:
    return (col(area) > area_max) & (col(price) < price_min)


def remove_outliers(df: DataFrame, area: str = "GrLivArea", price: str = "SalePrice",
                    area_max: float = 4000.0, price_min: float = 300000.0) -> DataFrame:
    """Drop rows with area > max AND price < min.  NULL-safe: a row whose
    comparison is NULL is kept.  No-op if either column is absent."""
    if not has(df, area, price):
        return df
    return df.filter(not_true(outlier_condition(area, price, area_max, price_min)))


def outlier_summary(df: DataFrame, area: str = "GrLivArea", price: str = "SalePrice",
                    area_max: float = 4000.0, price_min: float = 300000.0) -> DataFrame:
    """(n_in, n_removed, n_out) in one pass -- no second scan for the count."""
    cond = F.coalesce(outlier_condition(area, price, area_max, price_min), F.lit(False))
    return df.agg(F.count(F.lit(1)).cast("bigint").alias("n_in"),
                  F.count_if(cond).cast("bigint").alias("n_removed"),
                  F.count_if(~cond).cast("bigint").alias("n_out"))


def list_outliers(df: DataFrame, detail: Sequence[str], area: str = "GrLivArea",
                  price: str = "SalePrice", area_max: float = 4000.0,
                  price_min: float = 300000.0) -> DataFrame:
    return df.filter(outlier_condition(area, price, area_max, price_min)).select(
        *[col(c) for c in detail])


# ---------------------------------------------------------------- PRJ-2/3


class _HasCols(Params):
    cols = Param(Params._dummy(), "cols", "column names", typeConverter=TypeConverters.toListString)


class ColumnDropper(Transformer, _HasCols, DefaultParamsReadable, DefaultParamsWritable):
    """Drop the listed columns; absent names are ignored (``df.drop`` semantics)."""

    @keyword_only
    def __init__(self, cols: list[str] | None = None):
        super().__init__()
        self._setDefault(cols=[])
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.drop(*self.getOrDefault(self.cols))


# Ablation drop: identical semantics, kept as its own name for the ablation grid.
DropColumns = ColumnDropper


# ---------------------------------------------------------------- IMP-1..10


def column_stats(df: DataFrame, exact: bool = True) -> tuple[dict, dict]:
    """Median of every numeric column and mode of every other column.

    Medians come from :func:`column_quantiles`, modes from the (column, value)
    counts of :func:`level_counts`, so no task holds all levels of a column
    (ties -> smallest value, NULLs skipped).  An all-NULL column has no entry.
    """
    from terrace.operators.profile import level_counts
    from terrace.operators.quantile import column_quantiles
    num = [f.name for f in df.schema.fields if is_numeric(f.dataType)]
    other = [f.name for f in df.schema.fields if not is_numeric(f.dataType)]
    medians, modes = {}, {}
    if num:
        if exact:
            q = column_quantiles(df, num, [0.5])
            medians = {c: float(v[0]) for c, v in q.items() if v and v[0] is not None}
        else:
            row = df.agg(*[F.percentile_approx(col(c).cast("double"), 0.5, 10000).alias(f"m{i}")
                           for i, c in enumerate(num)]).first()
            medians = {c: float(row[f"m{i}"]) for i, c in enumerate(num) if row[f"m{i}"] is not None}
    if other:
        best = level_counts(df, other, drop_null=True).groupBy("column").agg(
            F.min(F.struct((-F.col("n")).alias("neg_n"), "value")).alias("b"))
        modes = {r["column"]: r["b"]["value"] for r in best.collect()}  # one row per column
    return medians, modes


def group_medians(df: DataFrame, group: str, value: str) -> DataFrame:
    """Median of ``value`` per non-NULL group (pandas drops NULL group keys)."""
    from terrace.operators.quantile import grouped_quantiles
    q = grouped_quantiles(df.filter(col(group).isNotNull()), [group], value, [0.5])
    return q.select(col(group).alias("group"), F.col("q")[0].alias("median"))


def lookup(key: Column, mapping: dict, value_type: str = "double") -> Column:
    """Per-row dictionary lookup as a literal map expression (no join)."""
    if not mapping:
        return F.lit(None).cast(value_type)
    kv = []
    for k, v in sorted(mapping.items()):
        kv += [F.lit(k), F.lit(v).cast(value_type)]
    return F.create_map(*kv)[key]


class _ImputerParams(Params):
    group = Param(Params._dummy(), "group", "grouping column for the frontage median",
                  typeConverter=TypeConverters.toString)
    frontage = Param(Params._dummy(), "frontage", "column imputed by group median",
                     typeConverter=TypeConverters.toString)
    exact = Param(Params._dummy(), "exact", "exact medians", typeConverter=TypeConverters.toBoolean)


class DomainImputer(Estimator, _ImputerParams, DefaultParamsReadable, DefaultParamsWritable):
    """Learn medians/modes and group medians on the fit data; apply rules a-f."""

    @keyword_only
    def __init__(self, group: str = "Neighborhood", frontage: str = "LotFrontage",
                 exact: bool = True):
        super().__init__()
        self._setDefault(group="Neighborhood", frontage="LotFrontage", exact=True)
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> "DomainImputerModel":
        g, lf = self.getOrDefault(self.group), self.getOrDefault(self.frontage)
        medians, modes = column_stats(df, self.getOrDefault(self.exact))
        gmed: dict = {"values": {}}
        if has(df, lf, g):
            sizes = df.groupBy(col(g).alias("group")).agg(F.count(F.lit(1)).alias("n"))
            gmed = group_state(group_medians(df, g, lf).withColumnRenamed("median", "value"), sizes)
        global_med = medians.get(lf, 0.0) if lf in df.columns else 0.0
        m = DomainImputerModel(group=g, frontage=lf)
        state = {"medians": medians, "modes": modes, "group_medians": gmed.get("values", {}), "global_median": global_med}
        if "table" in gmed:
            state["group_table"] = gmed
        m._set(stateJson=json.dumps(state))
        return m


class DomainImputerModel(Model, _ImputerParams, DefaultParamsReadable, DefaultParamsWritable):
    stateJson = Param(Params._dummy(), "stateJson", "fitted state", typeConverter=TypeConverters.toString)

    @keyword_only
    def __init__(self, group: str = "Neighborhood", frontage: str = "LotFrontage"):
        super().__init__()
        self._setDefault(group="Neighborhood", frontage="LotFrontage", exact=True, stateJson="{}")
        self._set(**self._input_kwargs)

    @property
    def state(self) -> dict:
        return json.loads(self.getOrDefault(self.stateJson))

    def _transform(self, df: DataFrame) -> DataFrame:
        state, g, lf = self.state, self.getOrDefault(self.group), self.getOrDefault(self.frontage)
        if "group_table" not in state or not has(df, g, lf):
            return apply_rules(df, g, lf, LearntFills(state))
        name = free_name(df, "_fill")
        joined = attach(df, g, state["group_table"], name)
        return apply_rules(joined, g, lf, LearntFills(state, F.col(name))).drop(name)


class LearntFills:
    """What the rules read from one fitted state, as column expressions;
    ``joined`` is the column that holds a table-backed group median."""

    def __init__(self, state: dict, joined: Column | None = None):
        self.joined = joined
        self.medians, self.modes = state.get("medians", {}), state.get("modes", {})
        self.groups, self.overall = state.get("group_medians", {}), state.get("global_median", 0.0)

    def median(self, c: str) -> Column | None:
        return F.lit(self.medians[c]) if c in self.medians else None

    def mode(self, c: str) -> Column | None:
        return F.lit(self.modes[c]) if c in self.modes else None

    def frontage(self, group: Column | None) -> Column:
        fill = F.lit(float(self.overall))
        if group is None:
            return fill
        return F.coalesce(lookup(group, self.groups) if self.joined is None else self.joined, fill)


def _in_basement(df: DataFrame) -> list[str]:
    return [c for c in ("BsmtExposure", "BsmtFinType2") if c in df.columns] if "TotalBsmtSF" in df.columns else []


def apply_rules(df: DataFrame, group: str, frontage: str, learnt) -> DataFrame:
    """The imputation rules a-f with the fills of ``learnt``."""
    types = {f.name: f.dataType for f in df.schema.fields}
    expr: dict[str, Column] = {c: col(c) for c in df.columns}

    # a) basement present but exposure / finish type missing -> learnt mode
    for c in _in_basement(df):
        mode = learnt.mode(c)
        if mode is not None:
            has_b = F.coalesce(col("TotalBsmtSF") > 0, F.lit(False))
            expr[c] = F.when(has_b & expr[c].isNull(), mode).otherwise(expr[c])
    # b) structural absence -> "None" / 0
    for c in NONE_COLS:
        if c in expr:
            expr[c] = F.coalesce(expr[c], F.lit("None"))
    for c in ZERO_COLS:
        if c in expr:
            expr[c] = F.coalesce(expr[c], F.lit(0).cast(types[c]))
    # c) garage year <- year built of the same row
    if "GarageYrBlt" in expr and "YearBuilt" in expr:
        expr["GarageYrBlt"] = F.coalesce(expr["GarageYrBlt"],
                                         col("YearBuilt").cast(types["GarageYrBlt"]))
    # d) frontage <- group median, else global median
    if frontage in expr:
        fill = learnt.frontage(col(group) if group in expr else None)
        expr[frontage] = F.coalesce(expr[frontage], fill.cast(types[frontage]))
    # e) functional -> typical
    if "Functional" in expr:
        expr["Functional"] = F.coalesce(expr["Functional"], F.lit("Typ"))
    # f) everything left -> learnt median / mode (unseen columns stay NULL)
    for c in df.columns:
        fill = learnt.median(c) if is_numeric(types[c]) else learnt.mode(c)
        if fill is not None:
            expr[c] = F.coalesce(expr[c], fill.cast(types[c]) if is_numeric(types[c]) else fill)
    return df.select(*[expr[c].alias(c) for c in df.columns])


def reads_learnt(df: DataFrame, frontage: str, skip: Sequence[str] = ()) -> Column:
    """Whether a row gets any learnt fill from :func:`apply_rules`."""
    given = {*NONE_COLS, *ZERO_COLS, "Functional", *skip}
    hit = F.lit(False)
    for c in _in_basement(df):
        hit = hit | (col(c).isNull() & F.coalesce(col("TotalBsmtSF") > 0, F.lit(False)))
    for c in df.columns:
        if c == "GarageYrBlt" and "YearBuilt" in df.columns:
            hit = hit | (col(c).isNull() & col("YearBuilt").isNull())
        elif c not in given or c == frontage:
            hit = hit | col(c).isNull()
    return hit


class MedianImputer(Estimator, _HasCols, DefaultParamsReadable, DefaultParamsWritable):
    """Exact-median ``SimpleImputer`` for numeric columns (Spark's Imputer is
    approximate)."""

    @keyword_only
    def __init__(self, cols: list[str] | None = None):
        super().__init__()
        self._setDefault(cols=[])
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> "MedianImputerModel":
        from terrace.operators.quantile import column_quantiles
        cols = self.getOrDefault(self.cols) or [f.name for f in df.schema.fields
                                                if is_numeric(f.dataType)]
        q = column_quantiles(df, cols, [0.5])
        med = {c: (q[c][0] if q.get(c) else None) for c in cols}
        m = MedianImputerModel()
        m._set(cols=cols, stateJson=json.dumps(med))
        return m


class MedianImputerModel(Model, _HasCols, DefaultParamsReadable, DefaultParamsWritable):
    stateJson = Param(Params._dummy(), "stateJson", "medians", typeConverter=TypeConverters.toString)

    def __init__(self):
        super().__init__()
        self._setDefault(cols=[], stateJson="{}")

    def _transform(self, df: DataFrame) -> DataFrame:
        med = json.loads(self.getOrDefault(self.stateJson))
        out = []
        for c in df.columns:
            if c in med and med[c] is not None:
                out.append(F.coalesce(col(c).cast("double"), F.lit(float(med[c]))).alias(c))
            elif c in med:
                out.append(col(c).cast("double").alias(c))
            else:
                out.append(col(c))
        return df.select(*out)


def quality_gate(df: DataFrame) -> DataFrame:
    """Per column: NULL, NaN and +/-inf counts in one pass (all must be 0)."""
    aggs = []
    for f in df.schema.fields:
        c = col(f.name)
        bad = c.isNull()
        if is_numeric(f.dataType):
            d = c.cast("double")
            bad = bad | F.isnan(d) | (F.abs(d) == float("inf"))
        aggs.append(F.count_if(bad).cast("bigint").alias(f.name))
    return df.agg(*aggs)
