"""Registered feature / encoding queries (EXP-*, PRJ-4, ENC-1..6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from terrace.config import CODE_COLS, DROP_AFTER, ORDINAL_LEVELS
from terrace.functions.exprs import col, quantile_bin, round_doubles
from terrace.operators import encode as E
from terrace.operators.features import NEW_FEATURES, engineer, feature_exprs
from terrace.plans.fixtures import events, houses
from terrace.plans.q_split import lit, probs, qbin
from terrace.plans.registry import register
from terrace.plans.sqlgen import FEATURE_SQL, H, HOUSE_COLS, HOUSE_DOUBLE, dq, features_select

R = round_doubles

# ---------------------------------------------------------------- EXP-1..17 / PRJ-4
_ENG_COLS = ([c for c in HOUSE_COLS if c not in DROP_AFTER]
             + [f for f in FEATURE_SQL if f not in DROP_AFTER])
_ENG_DOUBLE = (set(HOUSE_DOUBLE) | {"TotalBath", "LotRatio"}) - set(CODE_COLS)


def _round_sel(cols, doubles):
    return ", ".join(f"round({dq(c)}, 4) as {dq(c)}" if c in doubles else dq(c) for c in cols)


@register("engineer_features", f"""{H}, f as ({features_select('houses', HOUSE_COLS, DROP_AFTER)})
select {_round_sel(_ENG_COLS, _ENG_DOUBLE)} from f""")
def engineer_features(spark, sf):
    return R(engineer(houses(spark, sf), list(DROP_AFTER)))


_KEYS = {
    "TotalSF": "feat_total_sf", "TotalBath": "feat_total_bath", "HouseAge": "feat_house_age",
    "RemodAge": "feat_remod_age", "IsRemodeled": "feat_is_remodeled", "IsNew": "feat_is_new",
    "TotalPorchSF": "feat_total_porch_sf", "QualxArea": "feat_qualx_area",
    "OverallScore": "feat_overall_score", "QualSum": "map_quality_sum",
    "HasPool": "feat_has_pool", "HasGarage": "feat_has_garage", "HasBsmt": "feat_has_bsmt",
    "Has2ndFlr": "feat_has_2nd_flr", "HasFireplace": "feat_has_fireplace",
    "LotRatio": "safe_ratio",
}


def _feature_query(name: str):
    def run(spark, sf):
        h = houses(spark, sf)
        # one IEEE operation per row: identical in any engine, so no rounding
        return h.select("Id", feature_exprs(h.schema)[name].alias(name))
    run.__name__ = _KEYS[name]
    return run


for _f in NEW_FEATURES:
    _expr = FEATURE_SQL[_f]
    register(_KEYS[_f], f"{H}\nselect Id, {_expr} as {dq(_f)} from houses")(_feature_query(_f))


@register("cast_codes", f"""{H}
select Id, {', '.join(f"cast(cast(cast({dq(c)} as double) as bigint) as varchar) as {dq(c)}" for c in CODE_COLS)},
  {FEATURE_SQL['HouseAge']} as HouseAge from houses""")
def cast_codes(spark, sf):
    # ages are computed from the numeric year BEFORE the codes become strings
    out = engineer(houses(spark, sf))
    return out.select("Id", *CODE_COLS, "HouseAge")


# ---------------------------------------------------------------- EXP-18
@register("log_target_roundtrip", f"""{H}
select Id, round(ln(1 + greatest(SalePrice, 0)), 4) as log_target,
  round(exp(ln(1 + greatest(SalePrice, 0))) - 1, 4) as back from houses""")
def log_target_roundtrip(spark, sf):
    from terrace.operators.metrics import log_clip
    lt = log_clip(col("SalePrice"))
    return R(houses(spark, sf).select("Id", lt.alias("log_target"), F.expm1(lt).alias("back")))


# ---------------------------------------------------------------- EXP-21
@register("quantile_bins", f"""{H},
e as (select quantile_cont(SalePrice::double, {probs(10)}) as e from houses)
select Id, {qbin('SalePrice', 'e.e')}::int as bin from houses, e""")
def quantile_bins(spark, sf):
    h = houses(spark, sf)
    from terrace.operators.split import quantile_edges
    edges = quantile_edges(h, "SalePrice", 10)
    arr = F.array(*[F.lit(x) for x in edges])
    return h.select("Id", quantile_bin(col("SalePrice").cast("double"), arr).cast("int").alias("bin"))


# ---------------------------------------------------------------- ENC-1
_ORD = ["ExterQual", "KitchenQual", "BsmtQual", "GarageQual", "BsmtExposure", "BsmtFinType2",
        "Functional"]


def _ord_sql(c: str) -> str:
    arms = " ".join(f"when '{lv}' then {float(i)}" for i, lv in enumerate(ORDINAL_LEVELS[c]))
    return (f"cast(case when {dq(c)} is null then null else coalesce(case {dq(c)} {arms} end, -1.0)"
            f" end as double) as {dq(c)}")


@register("encode_ordinal", f"{H}\nselect Id, {', '.join(_ord_sql(c) for c in _ORD)} from houses")
def encode_ordinal(spark, sf):
    return E.OrdinalEncoder(cols=_ORD).transform(houses(spark, sf).select("Id", *_ORD))


# ---------------------------------------------------------------- ENC-2/3
_NOM = ["Neighborhood", "MSZoning", "SaleCondition", "GarageType", "PoolQC", "Electrical",
        "Street", "Exterior1st"]


def _vocab_sql(src: str) -> str:
    u = " union all ".join(f"select '{c}' as col, {dq(c)} as level from {src}" for c in _NOM)
    return (f"lv as (select col, level, count(*) as n from ({u}) x group by col, level), "
            f"vt as (select col, level, n, n < 0.01 * sum(n) over (partition by col) as infrequent "
            f"from lv)")


@register("encode_onehot_rare", f"""{H}, {_vocab_sql('houses')}
select col as "column", level, n::bigint as n, infrequent,
  case when infrequent then col || '_infrequent_sklearn' else col || '_' || level end as out_column
from vt where level is not null""")
def encode_onehot_rare(spark, sf):
    v = E.onehot_vocabulary(houses(spark, sf), _NOM, 0.01).filter(F.col("level").isNotNull())
    return v.select("column", "level", "n", "infrequent",
                    F.when(F.col("infrequent"), F.concat(F.col("column"), F.lit("_infrequent_sklearn")))
                    .otherwise(F.concat(F.col("column"), F.lit("_"), F.col("level")))
                    .alias("out_column"))


@register("encode_unseen", f"""{H},
fitset as (select * from houses where YrSold <= 1993),
applyset as (select * from houses where YrSold > 1993),
lv as (select Exterior1st as level, count(*) as n from fitset group by 1),
vt as (select level, n < 0.01 * sum(n) over () as infrequent from lv),
freq as (select level from vt where not infrequent and level is not null),
has_inf as (select count_if(infrequent and level is not null) > 0 as h from vt)
select a.Id, a.Exterior1st,
  case when a.Exterior1st is null then null
       when a.Exterior1st in (select level from freq) then 'Exterior1st_' || a.Exterior1st
       when (select h from has_inf) then 'Exterior1st_infrequent_sklearn' end as active_column
from applyset a""")
def encode_unseen(spark, sf):
    h = houses(spark, sf).select("Id", "YrSold", "Exterior1st")
    model = E.RareOneHotEncoder(cols=["Exterior1st"], minFrequency=0.01).fit(
        h.filter(col("YrSold") <= 1993))
    out = model.transform(h.filter(col("YrSold") > 1993).withColumn("_x", col("Exterior1st")))
    outs = model.output_columns()
    # the active one-hot column per row (none -> all zeros)
    active = F.coalesce(*[F.when(F.col(f"`{c}`") == 1.0, F.lit(c)) for c in outs]) \
        if outs else F.lit(None).cast("string")
    return out.select("Id", F.col("_x").alias("Exterior1st"), active.alias("active_column"))


# ---------------------------------------------------------------- ENC-6
_RS = ["LotArea", "GrLivArea", "LotFrontage"]


def _rs_sql(c: str) -> str:
    q1 = f"(select quantile_cont({dq(c)}::double, 0.25e0) from houses)"
    q2 = f"(select quantile_cont({dq(c)}::double, 0.5e0) from houses)"
    q3 = f"(select quantile_cont({dq(c)}::double, 0.75e0) from houses)"
    return (f"round(({dq(c)}::double - {q2}) / (case when {q3} - {q1} = 0 then 1.0 "
            f"else {q3} - {q1} end), 4) as {dq(c)}")


@register("robust_scale", f"{H}\nselect Id, {', '.join(_rs_sql(c) for c in _RS)} from houses")
def robust_scale(spark, sf):
    h = houses(spark, sf).select("Id", *_RS)
    return R(E.RobustScaler(cols=_RS).fit(h).transform(h))


# ---------------------------------------------------------------- ENC-4/5 (events.value)
_LAM = 0.2


def _yj_sql(x: str, lam: str) -> str:
    return (f"case when {x} >= 0 then (case when abs({lam}) < 1e-12 then ln(1 + {x}) "
            f"else (exp({lam} * ln(1 + {x})) - 1) / {lam} end) "
            f"else (case when abs({lam} - 2) < 1e-12 then -ln(1 - {x}) "
            f"else -(exp((2 - {lam}) * ln(1 - {x})) - 1) / (2 - {lam}) end) end")


@register("yeo_johnson_apply", f"""
select event_id, round({_yj_sql('value', lit(_LAM))}, 4) as value_yj from events""")
def yeo_johnson_apply(spark, sf):
    from terrace.functions.exprs import yeo_johnson
    return R(events(spark, sf).select("event_id", yeo_johnson(col("value"), _LAM).alias("value_yj")))


_GRID = [round(-2.0 + i * 0.1, 10) for i in range(41)]


@register("yeo_johnson_loglik", f"""
with grid as (select unnest([{', '.join(lit(x) for x in _GRID)}]) as lam),
t as (select lam, value as x, {_yj_sql('value', 'lam')} as y from events, grid where value is not null)
select 'value' as "column", lam as lambda,
  round(-count(*) / 2.0 * ln(var_pop(y)) + (lam - 1) * sum(sign(x) * ln(1 + abs(x))), 4) as loglik
from t group by lam""")
def yeo_johnson_loglik(spark, sf):
    return R(E.yeo_johnson_loglik(events(spark, sf), ["value"], {"value": _GRID}))


# the fitted lambda lies nearest to the best point of SQL's grid of step 0.01, and no point of it is more likely
@register("yeo_johnson_fit", f"""
with grid as (select i / 100.0 as lam from range(-600, 601) r(i)),
t as (select lam, value as x, {_yj_sql('value', 'lam')} as y from events, grid where value is not null),
l as (select lam, -count(*) / 2.0 * ln(var_pop(y)) + (lam - 1) * sum(sign(x) * ln(1 + abs(x))) as ll
      from t group by lam)
select 'value' as "column", arg_max(lam, ll)::double as lambda_2dp, true as is_maximum from l where isfinite(ll)""")
def yeo_johnson_fit(spark, sf):
    ev = events(spark, sf)
    lam = E.fit_yeo_johnson(ev, ["value"])
    grid = [round(-6 + i / 10, 10) for i in range(121)]
    ll = E.yeo_johnson_loglik(ev, ["value"], {"value": [*grid, lam["value"]]})
    best = ll.groupBy("column").agg(F.max(F.when(F.isnan("loglik"), None).otherwise(F.col("loglik"))).alias("best"),
                                    F.max(F.when(F.col("lambda") == lam["value"], F.col("loglik"))).alias("own"))
    return best.select("column", F.lit(round(lam["value"], 2)).alias("lambda_2dp"), (F.col("own") >= F.col("best")).alias("is_maximum"))
