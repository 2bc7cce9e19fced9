"""Row-level feature engineering: all features are native Column expressions
computed in a single projection (one ``select``; no Python per row)."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrace.config import CODE_COLS, QUAL_MAP
from terrace.functions.exprs import clip_low, code_string, col, flag, is_numeric, safe_ratio

NEW_FEATURES = ["TotalSF", "TotalBath", "HouseAge", "RemodAge", "IsRemodeled", "IsNew",
                "TotalPorchSF", "QualxArea", "OverallScore", "QualSum", "HasPool",
                "HasGarage", "HasBsmt", "Has2ndFlr", "HasFireplace", "LotRatio"]

PORCH_COLS = ["OpenPorchSF", "EnclosedPorch", "3SsnPorch", "ScreenPorch", "WoodDeckSF"]
QUAL_COLS = ["ExterQual", "KitchenQual", "BsmtQual", "GarageQual"]


def quality_score(c: Column) -> Column:
    """Rating -> score via a literal map; unmapped / NULL -> 0."""
    kv = []
    for k, v in QUAL_MAP.items():
        kv += [F.lit(k), F.lit(v)]
    return F.coalesce(F.create_map(*kv)[c], F.lit(0))


def feature_exprs(schema: T.StructType) -> dict[str, Column]:
    """Engineered feature name -> expression, for the inputs present."""
    types = {f.name: f.dataType for f in schema.fields}
    present = lambda *cs: all(c in types for c in cs)

    def num(c: str) -> Column:
        # to_numeric(errors="coerce"): numeric columns pass through unchanged
        return col(c) if is_numeric(types[c]) else col(c).try_cast("double")

    out: dict[str, Column] = {}
    if present("TotalBsmtSF", "1stFlrSF", "2ndFlrSF"):
        out["TotalSF"] = col("TotalBsmtSF") + col("1stFlrSF") + col("2ndFlrSF")
    if present("FullBath", "HalfBath", "BsmtFullBath", "BsmtHalfBath"):
        out["TotalBath"] = (col("FullBath") + 0.5 * col("HalfBath") + col("BsmtFullBath")
                            + 0.5 * col("BsmtHalfBath"))
    if present("YrSold", "YearBuilt"):
        out["HouseAge"] = clip_low(num("YrSold") - num("YearBuilt"), 0)
    if present("YrSold", "YearRemodAdd"):
        out["RemodAge"] = clip_low(num("YrSold") - num("YearRemodAdd"), 0)
    if present("YearRemodAdd", "YearBuilt"):
        out["IsRemodeled"] = flag(col("YearRemodAdd") != col("YearBuilt"), null_as=1)
    if present("YrSold", "YearBuilt"):
        out["IsNew"] = flag(num("YrSold") == num("YearBuilt"), null_as=0)
    if present(*PORCH_COLS):
        total = None
        for c in PORCH_COLS:
            total = col(c) if total is None else total + col(c)
        out["TotalPorchSF"] = total
    if present("OverallQual", "GrLivArea"):
        out["QualxArea"] = col("OverallQual") * col("GrLivArea")
    if present("OverallQual", "OverallCond"):
        out["OverallScore"] = col("OverallQual") * col("OverallCond")
    if present(*QUAL_COLS):
        total = None
        for c in QUAL_COLS:
            total = quality_score(col(c)) if total is None else total + quality_score(col(c))
        out["QualSum"] = total.cast("int")
    for name, src in [("HasPool", "PoolArea"), ("HasGarage", "GarageCars"),
                      ("HasBsmt", "TotalBsmtSF"), ("Has2ndFlr", "2ndFlrSF"),
                      ("HasFireplace", "Fireplaces")]:
        if present(src):
            out[name] = flag(col(src) > 0, null_as=0)
    if present("GrLivArea", "LotArea"):
        out["LotRatio"] = safe_ratio(col("GrLivArea"), col("LotArea"), 0.0)
    return out


def engineer(df: DataFrame, drop_after: list[str] | None = None) -> DataFrame:
    """Add features, turn codes into strings (after the ages), drop columns."""
    feats = feature_exprs(df.schema)
    cols = []
    for c in df.columns:
        if c in feats:
            continue  # recomputed below (idempotent re-application)
        cols.append(code_string(col(c)).alias(c) if c in CODE_COLS else col(c))
    cols += [e.alias(n) for n, e in feats.items()]
    out = df.select(*cols)
    return out.drop(*(drop_after or []))


class FeatureEngineer(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    dropAfter = Param(Params._dummy(), "dropAfter", "columns dropped after engineering",
                      typeConverter=TypeConverters.toListString)

    @keyword_only
    def __init__(self, dropAfter: list[str] | None = None):
        super().__init__()
        self._setDefault(dropAfter=[])
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        return engineer(df, self.getOrDefault(self.dropAfter))
