"""Registered profiling queries (PROF-*, EXP-19/20, SRT-1..3, PRJ-5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from terrace.config import ABSENT_PATTERNS
from terrace.functions.exprs import col, round_doubles
from terrace.operators import profile as P
from terrace.plans.fixtures import houses, read_table
from terrace.plans.registry import register
from terrace.plans.sqlgen import (H, HOUSE_COLS, HOUSE_NUM, HOUSE_NUM_NO_ID, HOUSE_STR, dq, r4)

R = round_doubles
TARGET = "SalePrice"


# ---------------------------------------------------------------- PROF-14
@register("group_stats_by_year", f"""{H}
select YrSold, count(SalePrice)::bigint as count, {r4('median(SalePrice)', 'median')},
       {r4('avg(SalePrice)', 'mean')}
from houses group by YrSold""")
def group_stats_by_year(spark, sf):
    return R(P.group_stats(houses(spark, sf), "YrSold", TARGET).select("YrSold", "count", "median",
                                                                        "mean"))


# ---------------------------------------------------------------- PROF-1 / PRJ-5
@register("overview_profile", f"""{H}
select count(*)::bigint as n_rows, {len(HOUSE_COLS)}::bigint as n_cols,
       {len(HOUSE_NUM)}::bigint as n_numeric, {len(HOUSE_STR)}::bigint as n_object from houses""")
def overview_profile(spark, sf):
    return P.overview(houses(spark, sf))


# ---------------------------------------------------------------- PROF-2
@register("duplicate_rows", """
select sum(n)::bigint as n_rows, count(*)::bigint as n_distinct, sum(n - 1)::bigint as n_duplicates
from (select count(*) as n from lineitem group by l_orderkey, l_linenumber) g""")
def duplicate_rows(spark, sf):
    return P.duplicate_rows(read_table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@register("duplicate_rows_full", """
select sum(n)::bigint as n_rows, count(*)::bigint as n_distinct, sum(n - 1)::bigint as n_duplicates
from (select count(*) as n from lineitem group by all_cols) g""".replace(
    "all_cols", "l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, "
    "l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate"))
def duplicate_rows_full(spark, sf):
    return P.duplicate_rows(read_table(spark, sf, "lineitem"))


# ---------------------------------------------------------------- PROF-3
@register("target_profile", f"""{H}
select count(SalePrice)::bigint as n, {r4('avg(SalePrice)', 'mean')},
       {r4('median(SalePrice)', 'median')}, {r4('skewness(SalePrice)', 'skew')},
       {r4('avg(ln(1 + SalePrice))', 'log_mean')}, {r4('median(ln(1 + SalePrice))', 'log_median')},
       {r4('skewness(ln(1 + SalePrice))', 'log_skew')}
from houses""")
def target_profile(spark, sf):
    return R(P.target_profile(houses(spark, sf), TARGET))


# ---------------------------------------------------------------- PROF-4 / EXP-19
def _meaning_sql(name_expr: str) -> str:
    cond = " or ".join(f"contains({name_expr}, '{p}')" for p in ABSENT_PATTERNS)
    return f"case when {cond} then 'absent' else 'unknown' end"


_MISSING_SQL = f"""{H},
m as ({' union all '.join(f"select '{c}' as col, (count(*) - count({dq(c)}))::bigint as missing_count, count(*) as n from houses" for c in HOUSE_COLS)}),
p as (select col as "column", missing_count, round(missing_count * 100.0 / n, 2) as missing_pct,
      {_meaning_sql('col')} as na_meaning from m where missing_count > 0)"""


@register("missing_profile", _MISSING_SQL + "\nselect * from p")
def missing_profile(spark, sf):
    return P.missing_profile(houses(spark, sf))


@register("missing_totals", _MISSING_SQL + """
select na_meaning, count(*)::bigint as n_columns, sum(missing_count)::bigint as n_missing
from p group by na_meaning""")
def missing_totals(spark, sf):
    return P.missing_totals(P.missing_profile(houses(spark, sf)))


# ---------------------------------------------------------------- PROF-5 / SRT-1
@register("skew_table", f"""{H},
s as ({' union all '.join(f"select '{c}' as col, skewness({dq(c)}) as skew from houses" for c in HOUSE_NUM)})
select col as "column", round(skew, 4) as skew from s where abs(skew) > 0.75""")
def skew_table(spark, sf):
    return R(P.skew_table(houses(spark, sf), HOUSE_NUM, 0.75))


# ---------------------------------------------------------------- PROF-6..9
CORR_COLS = HOUSE_NUM_NO_ID


def _corr_sql(cols: list[str]) -> str:
    aggs, structs = [], []
    k = 0
    for i, a in enumerate(cols):
        for j in range(i, len(cols)):
            aggs.append(f"corr({dq(a)}, {dq(cols[j])}) as r{k}")
            r = f"case when r{k} is not null and {i} = {j} then 1.0 else r{k} end"
            structs.append(f"{{'col_a': '{a}', 'col_b': '{cols[j]}', 'pos_a': {i}, 'pos_b': {j}, "
                           f"'r': {r}}}")
            k += 1
    return (f"c as (select {', '.join(aggs)} from houses), "
            f"tri as (select unnest([{', '.join(structs)}], recursive := true) from c), "
            "full_m as (select col_a, col_b, pos_a, pos_b, r from tri union all "
            "select col_b, col_a, pos_b, pos_a, r from tri where pos_a <> pos_b)")


_CORR = f"{H}, {_corr_sql(CORR_COLS)}"


def _corr_spark(spark, sf):
    return P.correlation_matrix(houses(spark, sf), CORR_COLS)


@register("correlation_matrix", _CORR + "\nselect col_a, col_b, round(r, 4) as r from full_m")
def correlation_matrix(spark, sf):
    return R(_corr_spark(spark, sf).select("col_a", "col_b", "r"))


_TOP = """top as (select case when col_a = 'SalePrice' then col_b else col_a end as feature, r
  from full_m where (col_a = 'SalePrice' or col_b = 'SalePrice') and col_a <> col_b
    and r is not null and col_a = 'SalePrice'
  order by abs(r) desc, feature limit {k})"""


@register("top_correlations", _CORR + ", " + _TOP.format(k=15)
          + "\nselect feature, round(r, 4) as r from top")
def top_correlations(spark, sf):
    full = _corr_spark(spark, sf).filter(F.col("col_a") == TARGET)
    return R(P.top_correlations(full, TARGET, 15))


@register("top_corr_submatrix", _CORR + ", " + _TOP.format(k=10) + """
select col_a, col_b, round(r, 4) as r from full_m
where (col_a in (select feature from top) or col_a = 'SalePrice')
  and (col_b in (select feature from top) or col_b = 'SalePrice')""")
def top_corr_submatrix(spark, sf):
    full = _corr_spark(spark, sf).cache()
    top = P.top_correlations(full.filter(F.col("col_a") == TARGET), TARGET, 10)
    keep = [r["feature"] for r in top.collect()] + [TARGET]  # k names: fitted state
    return R(full.filter(F.col("col_a").isin(keep) & F.col("col_b").isin(keep))
             .select("col_a", "col_b", "r"))


@register("collinear_pairs", _CORR + """
select col_a as feature_1, col_b as feature_2, round(r, 4) as r from full_m
where pos_a < pos_b and col_a <> 'SalePrice' and col_b <> 'SalePrice' and abs(r) > 0.85""")
def collinear_pairs(spark, sf):
    return R(P.collinear_pairs(P.correlation_long(houses(spark, sf), CORR_COLS), TARGET, 0.85))


# ---------------------------------------------------------------- PROF-10..12
def _levels_sql(table: str, cols: list[str], drop_null: bool) -> str:
    where = " where value is not null" if drop_null else ""
    u = " union all ".join(f"select '{c}' as col, cast({dq(c)} as varchar) as value from {table}"
                           for c in cols)
    return f"lv as (select col, value, count(*)::bigint as n from ({u}) x{where} group by col, value)"


@register("near_constant", f"""{H}, {_levels_sql('houses', HOUSE_STR, False)},
ranked as (select col, value, n, sum(n) over (partition by col) as total,
  row_number() over (partition by col order by n desc, value is null, value) as rk from lv)
select col as "column", coalesce(value, 'nan') as dominant_value,
  round(n * 100.0 / total, 2) as share_pct, (n * 100.0 / total > 95) as near_constant
from ranked where rk = 1""")
def near_constant(spark, sf):
    return P.near_constant(houses(spark, sf), HOUSE_STR, 95.0)


@register("rare_levels", f"""{H}, {_levels_sql('houses', HOUSE_STR, True)}
select col as "column", value as level, n as count from lv where n < 10""")
def rare_levels(spark, sf):
    return P.rare_levels(houses(spark, sf), HOUSE_STR, 10)


@register("rare_level_summary", f"""{H}, {_levels_sql('houses', HOUSE_STR, True)}
select count(distinct col)::bigint as n_columns, count(*)::bigint as n_levels,
  sum(n)::bigint as n_rows from lv where n < 10""")
def rare_level_summary(spark, sf):
    r = P.rare_levels(houses(spark, sf), HOUSE_STR, 10)
    return r.agg(F.count_distinct("column").cast("bigint").alias("n_columns"),
                 F.count(F.lit(1)).cast("bigint").alias("n_levels"),
                 F.sum("count").cast("bigint").alias("n_rows"))


@register("value_counts", f"""{H}
select GarageQual as level, count(*)::bigint as n,
  round(count(*) * 1.0 / (select count(*) from houses), 4) as share,
  round(case when GarageQual is null then null
        else count(*) * 1.0 / (select count(GarageQual) from houses) end, 4) as share_non_null
from houses group by GarageQual""")
def value_counts(spark, sf):
    return R(P.value_counts(houses(spark, sf), "GarageQual"))


# ---------------------------------------------------------------- PROF-13 / EXP-20
_BAND_CASE = ("case when SalePrice < 150000 then 0 when SalePrice >= 150000 and SalePrice < 300000 "
              "then 1 when SalePrice >= 300000 and SalePrice < 450000 then 2 "
              "when SalePrice >= 450000 then 3 end")
_BAND_DIM = ("bands as (select * from (values (0, '<$150k'), (1, '$150-300k'), (2, '$300-450k'), "
             "(3, '>$450k')) t(band_order, band))")


@register("band_counts", f"""{H}, {_BAND_DIM},
g as (select {_BAND_CASE} as band_order, count(*) as c from houses group by 1),
j as (select b.band_order, b.band, coalesce(g.c, 0)::bigint as count from bands b
      left join g on b.band_order = g.band_order)
select band_order::int as band_order, band, count,
  round(count * 100.0 / (select sum(count) from j), 2) as pct from j""")
def band_counts(spark, sf):
    return P.band_counts(houses(spark, sf), TARGET)


# ---------------------------------------------------------------- PROF-15..18
@register("group_stats_share", f"""{H}
select SaleCondition, count(SalePrice)::bigint as count, {r4('median(SalePrice)', 'median')},
  {r4('avg(SalePrice)', 'mean')},
  round(count(SalePrice) * 100.0 / (select count(SalePrice) from houses), 4) as share_pct
from houses group by SaleCondition""")
def group_stats_share(spark, sf):
    return R(P.group_stats_share(houses(spark, sf), "SaleCondition", TARGET))


@register("premium_vs_base", f"""{H},
g as (select SaleCondition, count(SalePrice)::bigint as count, median(SalePrice) as median
      from houses group by SaleCondition),
b as (select median as base_median from g where SaleCondition = 'Normal')
select SaleCondition, count, round(median, 4) as median, round(base_median, 4) as base_median,
  round((median / base_median - 1.0) * 100.0, 4) as premium_pct from g, b""")
def premium_vs_base(spark, sf):
    return R(P.premium_vs_base(houses(spark, sf), "SaleCondition", TARGET, "Normal"))


_GSTATS = ("g as (select Neighborhood, count(SalePrice)::bigint as count, median(SalePrice) as median, "
           "min(SalePrice) as min, max(SalePrice) as max from houses group by Neighborhood)")


@register("group_extremes", f"""{H}, {_GSTATS},
t as (select *, 'top' as tag from g order by median desc, Neighborhood limit 3),
b as (select *, 'bottom' as tag from g order by median asc, Neighborhood limit 3)
select Neighborhood, count, round(median, 4) as median, round(min, 4) as min,
  round(max, 4) as max, tag from (select * from t union all select * from b)""")
def group_extremes(spark, sf):
    return R(P.group_extremes(houses(spark, sf), "Neighborhood", TARGET, 3))


@register("group_median_ratio", f"""{H}, {_GSTATS}
select round(max(median), 4) as highest_median, round(min(median), 4) as lowest_median,
  round(max(median) / min(median), 4) as ratio from g""")
def group_median_ratio(spark, sf):
    return R(P.group_median_ratio(houses(spark, sf), "Neighborhood", TARGET))


# ---------------------------------------------------------------- PROF-20
def _hist_sql(expr: str, label: str) -> str:
    return f"""select '{label}' as scale, b.bin::int as bin, round(lo + b.bin * w, 4) as bin_lo,
  round(lo + (b.bin + 1) * w, 4) as bin_hi, count(x.bin)::bigint as count
  from (select min({expr}) as lo, (max({expr}) - min({expr})) / 40 as w from houses) s
  cross join range(40) b(bin)
  left join (select least(floor(({expr} - lo) / w), 39)::int as bin from houses,
    (select min({expr}) as lo, (max({expr}) - min({expr})) / 40 as w from houses) where {expr} is not null) x on x.bin = b.bin
  group by b.bin, lo, w"""


@register("histogram_bins", f"""{H}
{_hist_sql('SalePrice', 'raw')} union all {_hist_sql('ln(1 + SalePrice)', 'log')}""")
def histogram_bins(spark, sf):
    h = houses(spark, sf).select(col(TARGET).cast("double").alias("y")).cache()
    raw = P.histogram(h, F.col("y"), 40, "raw")
    log = P.histogram(h, F.log1p(F.col("y")), 40, "log")
    return R(raw.unionByName(log))


# ---------------------------------------------------------------- PROF-21
@register("boxplot_stats", f"""{H},
q as (select Neighborhood, quantile_cont(SalePrice, 0.25) as q1, quantile_cont(SalePrice, 0.5) as median,
      quantile_cont(SalePrice, 0.75) as q3 from houses group by Neighborhood),
f as (select *, q1 - 1.5 * (q3 - q1) as lo_f, q3 + 1.5 * (q3 - q1) as hi_f from q)
select h.Neighborhood, count(*)::bigint as count, round(any_value(q1), 4) as q1,
  round(any_value(median), 4) as median, round(any_value(q3), 4) as q3,
  round(min(case when SalePrice between lo_f and hi_f then SalePrice end), 4) as whisker_lo,
  round(max(case when SalePrice between lo_f and hi_f then SalePrice end), 4) as whisker_hi,
  count_if(not (SalePrice between lo_f and hi_f))::bigint as n_outliers
from houses h join f on h.Neighborhood = f.Neighborhood group by h.Neighborhood""")
def boxplot_stats(spark, sf):
    return R(P.boxplot_stats(houses(spark, sf), "Neighborhood", TARGET))


# ---------------------------------------------------------------- PROF-19
def _ftc_sql() -> str:
    from terrace.config import DROP_AFTER
    from terrace.operators.features import NEW_FEATURES
    from terrace.plans.q_clean import _CLEAN_SQL
    feats = [f for f in NEW_FEATURES if f not in DROP_AFTER]
    u = " union all ".join(f"select '{f}' as feature, case when stddev_pop({dq(f)}) > 0 then corr({dq(f)}, ln(1 + SalePrice)) end as r "
                           "from cleaned" for f in feats)
    return _CLEAN_SQL + f"\nselect feature, round(r, 4) as r from ({u}) x"


@register("feature_target_corr", _ftc_sql())
def feature_target_corr(spark, sf):
    from terrace.operators.features import NEW_FEATURES
    from terrace.plans.q_clean import _clean_stages
    h = houses(spark, sf)
    cleaned = _clean_stages().fit(h).transform(h)
    return R(P.feature_target_corr(cleaned, NEW_FEATURES, TARGET))
