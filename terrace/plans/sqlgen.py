"""DuckDB text builders shared by the oracle strings."""

from __future__ import annotations

from terrace.plans.fixtures import houses_cte

H = houses_cte()


def dq(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def r4(expr: str, alias: str) -> str:
    return f"round({expr}, 4) as {dq(alias)}"


HOUSE_COLS = [
    "Id", "Neighborhood", "MSZoning", "SaleCondition", "YrSold", "MoSold", "MSSubClass",
    "OverallQual", "OverallCond", "YearBuilt", "YearRemodAdd", "TotalBsmtSF", "1stFlrSF",
    "2ndFlrSF", "GrLivArea", "FullBath", "HalfBath", "BsmtFullBath", "BsmtHalfBath",
    "Fireplaces", "GarageCars", "GarageArea", "WoodDeckSF", "OpenPorchSF", "EnclosedPorch",
    "3SsnPorch", "ScreenPorch", "PoolArea", "MiscVal", "ExterQual", "KitchenQual", "BsmtQual",
    "GarageQual", "GarageType", "GarageYrBlt", "PoolQC", "BsmtExposure", "BsmtFinType2",
    "Functional", "Electrical", "Street", "Exterior1st", "LotFrontage", "LotArea", "SalePrice",
]
HOUSE_STR = ["Neighborhood", "MSZoning", "SaleCondition", "ExterQual", "KitchenQual",
             "BsmtQual", "GarageQual", "GarageType", "PoolQC", "BsmtExposure", "BsmtFinType2",
             "Functional", "Electrical", "Street", "Exterior1st"]
HOUSE_DOUBLE = ["GarageYrBlt", "LotFrontage", "LotArea", "SalePrice"]
HOUSE_NUM = [c for c in HOUSE_COLS if c not in HOUSE_STR]
HOUSE_NUM_NO_ID = [c for c in HOUSE_NUM if c != "Id"]


# ---------------------------------------------------------------------------
# imputer and feature projection, DuckDB dialect (oracle side)
# ---------------------------------------------------------------------------
from terrace.config import CODE_COLS, NONE_COLS, QUAL_MAP, ZERO_COLS  # noqa: E402

HOUSE_INT = [c for c in HOUSE_NUM if c not in HOUSE_DOUBLE and c != "Id"] + ["Id"]


def _sqltype(c: str) -> str:
    if c in HOUSE_STR:
        return "varchar"
    if c in HOUSE_DOUBLE:
        return "double"
    return "bigint" if c == "Id" else "integer"


def mode_sql(src: str, c: str) -> str:
    return (f"(select v from (select {dq(c)} as v, count(*) as n from {src} where {dq(c)} is not null"
            f" group by 1 order by n desc, v asc limit 1))")


def stats_cte(src: str, cols: list[str] = None) -> str:
    """One row: med_<c> for numeric, mode_<c> for string columns of ``src``."""
    cols = cols or HOUSE_COLS
    parts = []
    for c in cols:
        if c in HOUSE_STR:
            parts.append(f"{mode_sql(src, c)} as {dq('mode_' + c)}")
        else:
            parts.append(f"(select median({dq(c)}::double) from {src}) as {dq('med_' + c)}")
    return f"st as (select {', '.join(parts)})"


def imputer_select(fit_src: str, apply_src: str, cols: list[str] = None) -> str:
    """CTEs st, gm + a SELECT applying the domain imputation rules a-f."""
    cols = cols or HOUSE_COLS
    e = {c: f"a.{dq(c)}" for c in cols}
    mode = lambda c: dq("mode_" + c)
    med = lambda c: dq("med_" + c)
    if "TotalBsmtSF" in e:
        for c in ("BsmtExposure", "BsmtFinType2"):
            if c in e:
                e[c] = (f"case when coalesce(a.TotalBsmtSF > 0, false) and {e[c]} is null "
                        f"and {mode(c)} is not null then {mode(c)} else {e[c]} end")
    for c in NONE_COLS:
        if c in e:
            e[c] = f"coalesce({e[c]}, 'None')"
    for c in ZERO_COLS:
        if c in e:
            e[c] = f"coalesce({e[c]}, cast(0 as {_sqltype(c)}))"
    if "GarageYrBlt" in e and "YearBuilt" in e:
        e["GarageYrBlt"] = f"coalesce({e['GarageYrBlt']}, cast(a.YearBuilt as double))"
    if "LotFrontage" in e:
        e["LotFrontage"] = f"coalesce({e['LotFrontage']}, gm.gmed, coalesce({med('LotFrontage')}, 0.0))"
    if "Functional" in e:
        e["Functional"] = f"coalesce({e['Functional']}, 'Typ')"
    for c in cols:
        if c in HOUSE_STR:
            e[c] = f"coalesce({e[c]}, {mode(c)})"
        elif c in HOUSE_DOUBLE:
            e[c] = f"coalesce({e[c]}, {med(c)})"
        else:
            e[c] = f"coalesce({e[c]}, cast(trunc({med(c)}) as {_sqltype(c)}))"
    sel = ", ".join(f"{v} as {dq(c)}" for c, v in e.items())
    return (f"{stats_cte(fit_src, cols)}, gm as (select Neighborhood as g, median(LotFrontage) as gmed "
            f"from {fit_src} where Neighborhood is not null group by 1), "
            f"imputed as (select {sel} from {apply_src} a left join gm on a.Neighborhood = gm.g, st)")


def _qual(c: str) -> str:
    arms = " ".join(f"when '{k}' then {v}" for k, v in QUAL_MAP.items())
    return f"coalesce(case {dq(c)} {arms} end, 0)"


FEATURE_SQL = {
    "TotalSF": 'TotalBsmtSF + "1stFlrSF" + "2ndFlrSF"',
    "TotalBath": "FullBath + 0.5e0 * HalfBath + BsmtFullBath + 0.5e0 * BsmtHalfBath",
    "HouseAge": "case when YrSold - YearBuilt < 0 then 0 else YrSold - YearBuilt end",
    "RemodAge": "case when YrSold - YearRemodAdd < 0 then 0 else YrSold - YearRemodAdd end",
    "IsRemodeled": "coalesce((YearRemodAdd <> YearBuilt)::int, 1)",
    "IsNew": "coalesce((YrSold = YearBuilt)::int, 0)",
    "TotalPorchSF": 'OpenPorchSF + EnclosedPorch + "3SsnPorch" + ScreenPorch + WoodDeckSF',
    "QualxArea": "OverallQual * GrLivArea",
    "OverallScore": "OverallQual * OverallCond",
    "QualSum": "(" + " + ".join(_qual(c) for c in ["ExterQual", "KitchenQual", "BsmtQual",
                                                    "GarageQual"]) + ")::int",
    "HasPool": "coalesce((PoolArea > 0)::int, 0)",
    "HasGarage": "coalesce((GarageCars > 0)::int, 0)",
    "HasBsmt": "coalesce((TotalBsmtSF > 0)::int, 0)",
    "Has2ndFlr": 'coalesce(("2ndFlrSF" > 0)::int, 0)',
    "HasFireplace": "coalesce((Fireplaces > 0)::int, 0)",
    "LotRatio": "coalesce(GrLivArea::double / nullif(LotArea::double, 0.0), 0.0)",
}


def features_select(src: str, cols: list[str] = None, drop_after: list[str] = ()) -> str:
    """SELECT of the engineered table over ``src`` (codes cast, drop_after applied)."""
    cols = cols or HOUSE_COLS
    out = []
    for c in cols:
        if c in drop_after:
            continue
        if c in CODE_COLS:
            out.append(f"cast(cast(cast({dq(c)} as double) as bigint) as varchar) as {dq(c)}")
        else:
            out.append(dq(c))
    for n, x in FEATURE_SQL.items():
        if n not in drop_after:
            out.append(f"{x} as {dq(n)}")
    return f"select {', '.join(out)} from {src}"


def round_select(cols_types: list[tuple[str, bool]], src: str) -> str:
    """select with doubles rounded to 4 places: (name, is_double) pairs."""
    return "select " + ", ".join(f"round({dq(c)}, 4) as {dq(c)}" if d else dq(c)
                                 for c, d in cols_types) + f" from {src}"
