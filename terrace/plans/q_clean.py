"""Registered cleaning / imputation queries (FLT-*, PRJ-2/3, IMP-*, JOIN-1)."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from terrace.config import DROP_AFTER, DROP_COLS
from terrace.functions.exprs import col, round_doubles
from terrace.operators import clean as C
from terrace.operators.features import FeatureEngineer
from terrace.operators.quantile import column_quantiles
from terrace.plans.fixtures import houses
from terrace.plans.registry import register
from terrace.plans.sqlgen import (FEATURE_SQL, H, HOUSE_COLS, HOUSE_DOUBLE, HOUSE_NUM, HOUSE_STR,
                                  dq, features_select, imputer_select, mode_sql)

R = round_doubles
AREA_MAX = 3000.0  # the fixture's living areas top out at 3600; 3000 marks the outliers
PRICE_MIN = 300000.0
OLD = "YrSold <= 1995"  # temporal fit/apply split: fit on older sales, apply to newer


def _older(spark, sf):
    return houses(spark, sf).filter(col("YrSold") <= 1995)


def _newer(spark, sf):
    return houses(spark, sf).filter(col("YrSold") > 1995)


# ---------------------------------------------------------------- FLT-1/2
@register("remove_outliers", f"""{H}
select count(*)::bigint as n_in,
  count_if(coalesce(GrLivArea > 3000 and SalePrice < 300000, false))::bigint as n_removed,
  count_if(not coalesce(GrLivArea > 3000 and SalePrice < 300000, false))::bigint as n_out
from houses""")
def remove_outliers(spark, sf):
    return C.outlier_summary(houses(spark, sf), area_max=AREA_MAX, price_min=PRICE_MIN)


@register("list_outliers", f"""{H}
select Id, GrLivArea, SalePrice, Neighborhood from houses
where GrLivArea > 3000 and SalePrice < 300000""")
def list_outliers(spark, sf):
    return C.list_outliers(houses(spark, sf), ["Id", "GrLivArea", "SalePrice", "Neighborhood"],
                           area_max=AREA_MAX, price_min=PRICE_MIN)


# ---------------------------------------------------------------- PRJ-2/3
@register("drop_columns_safe", f"""{H}
select {', '.join(dq(c) for c in HOUSE_COLS if c not in DROP_COLS)} from houses""")
def drop_columns_safe(spark, sf):
    # the default list names several columns the table does not have: ignored
    return C.ColumnDropper(cols=DROP_COLS).transform(houses(spark, sf))


_ABLATE = ["LotRatio", "IsRemodeled"]


@register("ablate_columns", f"""{H}, f as ({features_select('houses')})
select * exclude (LotRatio, IsRemodeled) from f""")
def ablate_columns(spark, sf):
    feats = FeatureEngineer().transform(houses(spark, sf))
    return C.DropColumns(cols=_ABLATE).transform(feats)


# ---------------------------------------------------------------- IMP-1/12
def _stats_long_sql(src: str, cols: list[str]) -> str:
    parts = []
    for c in cols:
        if c in HOUSE_STR:
            parts.append(f"select '{c}' as \"column\", 'mode' as stat, null::double as num_value, "
                         f"{mode_sql(src, c)} as str_value")
        else:
            parts.append(f"select '{c}' as \"column\", 'median' as stat, "
                         f"round((select median({dq(c)}::double) from {src}), 4) as num_value, "
                         f"null::varchar as str_value")
    return " union all ".join(parts)


def _stats_frame(spark, df):
    medians, modes = C.column_stats(df)
    rows = [(c, "median", float(v), None) for c, v in medians.items()]
    rows += [(c, "mode", None, str(v)) for c, v in modes.items()]
    return R(spark.createDataFrame(rows, "column string, stat string, num_value double, "
                                         "str_value string"))


@register("fit_column_stats", f"{H}\n{_stats_long_sql('houses', HOUSE_COLS)}")
def fit_column_stats(spark, sf):
    # the fitted state (one value per column) is the result here
    return _stats_frame(spark, houses(spark, sf))


_RAW_INPUTS = [c for c in HOUSE_COLS if c not in ("Id", "SalePrice")]


@register("input_defaults", f"""{H},
clean as (select * from houses where not coalesce(GrLivArea > 3000 and SalePrice < 300000, false))
{_stats_long_sql('clean', _RAW_INPUTS)}""")
def input_defaults(spark, sf):
    df = C.remove_outliers(houses(spark, sf), area_max=AREA_MAX, price_min=PRICE_MIN)
    return _stats_frame(spark, df.select(*[col(c) for c in _RAW_INPUTS]))


# ---------------------------------------------------------------- IMP-2
@register("fit_group_median", f"""{H}
select Neighborhood as group_key, round(median(LotFrontage), 4) as median from houses
where Neighborhood is not null group by Neighborhood
union all select '__global__', round(coalesce(median(LotFrontage), 0.0), 4) from houses""")
def fit_group_median(spark, sf):
    h = houses(spark, sf)
    g = C.group_medians(h, "Neighborhood", "LotFrontage").select(
        F.col("group").alias("group_key"), "median")
    median = column_quantiles(h, ["LotFrontage"], [0.5])["LotFrontage"]
    glob = spark.createDataFrame([("__global__", median[0] if median else 0.0)], "group_key string, median double")
    return R(g.unionByName(glob))


# ---------------------------------------------------------------- IMP-3..10
def _imputed(spark, sf, fit=None, apply=None):
    fit = fit if fit is not None else houses(spark, sf)
    apply = apply if apply is not None else houses(spark, sf)
    return C.DomainImputer().fit(fit).transform(apply)


_IMP_ALL = f"{H}, {imputer_select('houses', 'houses')}"
_IMP_OLD_NEW = (f"{H}, older as (select * from houses where {OLD}), "
                f"newer as (select * from houses where not ({OLD})), "
                f"{imputer_select('older', 'newer')}")


def _sel(cols):
    return ", ".join(f"round({dq(c)}, 4) as {dq(c)}" if c in HOUSE_DOUBLE else dq(c) for c in cols)


_COND = ["Id", "TotalBsmtSF", "BsmtExposure", "BsmtFinType2"]
_CONST = ["Id", "PoolQC", "GarageQual", "GarageType", "BsmtQual", "Functional", "GarageArea"]


@register("impute_conditional_mode", _IMP_ALL + f"\nselect {_sel(_COND)} from imputed")
def impute_conditional_mode(spark, sf):
    return R(_imputed(spark, sf).select(*[col(c) for c in _COND]))


@register("impute_constant", _IMP_ALL + f"\nselect {_sel(_CONST)} from imputed")
def impute_constant(spark, sf):
    return R(_imputed(spark, sf).select(*[col(c) for c in _CONST]))


@register("impute_from_column", _IMP_ALL + "\nselect Id, YearBuilt, GarageYrBlt from imputed")
def impute_from_column(spark, sf):
    return _imputed(spark, sf).select("Id", "YearBuilt", "GarageYrBlt")


@register("impute_group_median", _IMP_OLD_NEW
          + "\nselect Id, Neighborhood, round(LotFrontage, 4) as LotFrontage from imputed")
def impute_group_median(spark, sf):
    out = _imputed(spark, sf, _older(spark, sf), _newer(spark, sf))
    return R(out.select("Id", "Neighborhood", "LotFrontage"))


@register("impute_all", _IMP_ALL + f"\nselect {_sel(HOUSE_COLS)} from imputed")
def impute_all(spark, sf):
    return R(_imputed(spark, sf))


@register("impute_fit_apply", _IMP_OLD_NEW + f"\nselect {_sel(HOUSE_COLS)} from imputed")
def impute_fit_apply(spark, sf):
    return R(_imputed(spark, sf, _older(spark, sf), _newer(spark, sf)))


# ---------------------------------------------------------------- IMP-11
_NUM = [c for c in HOUSE_NUM if c != "Id"]


@register("impute_median_numeric", f"""{H}
select Id, {', '.join(f"round(coalesce({dq(c)}::double, (select median({dq(c)}::double) from houses)), 4) as {dq(c)}" for c in _NUM)}
from houses""")
def impute_median_numeric(spark, sf):
    h = houses(spark, sf)
    m = C.MedianImputer(cols=_NUM).fit(h)
    return R(m.transform(h).select("Id", *[col(c) for c in _NUM]))


# ---------------------------------------------------------------- IMP-13 / ENC-8
def _clean_stages():
    return Pipeline(stages=[C.DomainImputer(), C.ColumnDropper(cols=DROP_COLS),
                            FeatureEngineer(dropAfter=DROP_AFTER)])


_CLEAN_COLS = [c for c in HOUSE_COLS if c not in DROP_COLS]
_CLEAN_SQL = (f"{_IMP_ALL}, cleaned as ({features_select('imputed', _CLEAN_COLS, DROP_AFTER)})")
_OUT_COLS = ([c for c in _CLEAN_COLS if c not in DROP_AFTER]
             + [f for f in FEATURE_SQL if f not in DROP_AFTER])
_OUT_DOUBLE = set(HOUSE_DOUBLE) | {"TotalBath", "LotRatio"}


def _bad(c: str) -> str:
    x = f"{dq(c)} is null"
    if c in _OUT_DOUBLE:
        x += f" or isnan({dq(c)}) or isinf({dq(c)})"
    return f"count_if({x})::bigint as {dq(c)}"


@register("quality_gate", _CLEAN_SQL + f"\nselect {', '.join(_bad(c) for c in _OUT_COLS)} from cleaned")
def quality_gate(spark, sf):
    h = houses(spark, sf)
    return C.quality_gate(_clean_stages().fit(h).transform(h))


@register("clean_stages", _CLEAN_SQL + "\nselect "
          + ", ".join(f"round({dq(c)}, 4) as {dq(c)}" if c in _OUT_DOUBLE else dq(c) for c in _OUT_COLS)
          + " from cleaned")
def clean_stages(spark, sf):
    h = houses(spark, sf)
    return R(_clean_stages().fit(h).transform(h))
