"""Registered split / fold / set queries (SPL-*, JOIN-4, SET-*, FLT-4, PROF-24, SRC-3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from terrace.functions.exprs import col, round_doubles
from terrace.operators import clean as C
from terrace.operators import split as S
from terrace.operators.quantile import grouped_quantiles
from terrace.plans.fixtures import houses
from terrace.plans.registry import register
from terrace.plans.sqlgen import H
from terrace.session import scratch_path

R = round_doubles
SEED = 42
AREA_MAX, PRICE_MIN = 3000.0, 300000.0
OUTLIER = "coalesce(GrLivArea > 3000 and SalePrice < 300000, false)"


def h32(salt: str, key: str = "Id") -> str:
    return f"cast(('0x'||substr(md5('{salt}:'||cast({key} as varchar)),1,8)) as bigint)"


def lit(x: float) -> str:
    return repr(float(x)) + "e0" if "e" not in repr(float(x)) else repr(float(x))


def probs(q: int) -> str:
    return "[" + ", ".join(lit(i / q) for i in range(1, q)) + "]"


def qbin(value: str, edges: str) -> str:
    return f"len(list_filter(list_distinct({edges}), lambda x: {value} > x))"


_BERNOULLI = f"""{H},
e1 as (select quantile_cont(SalePrice::double, {probs(10)}) as e from houses),
d as (select Id, SalePrice, {qbin('SalePrice', 'e1.e')}::int as stratum,
        case when {h32(f'{SEED}:s1')} / 4294967296e0 < {lit(0.7)} then 'train' else 'rest' end as st1
      from houses, e1),
e2 as (select quantile_cont(SalePrice::double, {probs(5)}) as e from d where st1 = 'rest'),
sp as (select Id, stratum,
        case when st1 = 'train' then 'train'
             when {h32(f'{SEED}:s2')} / 4294967296e0 < {lit(0.5)} then 'val' else 'test' end as split,
        case when st1 = 'rest' then {qbin('SalePrice', 'e2.e')} end::int as stratum2
      from d, e2)"""


@register("bernoulli_split", _BERNOULLI + "\nselect Id, stratum, split, stratum2 from sp")
def bernoulli_split(spark, sf):
    return S.bernoulli_split(houses(spark, sf), "Id", "SalePrice", SEED).select(
        "Id", "stratum", "split", "stratum2")


def _exact_sql(seed: int) -> str:
    return f"""{H},
e1 as (select quantile_cont(SalePrice::double, {probs(10)}) as e from houses),
d as (select Id, SalePrice, GrLivArea, {qbin('SalePrice', 'e1.e')}::int as stratum from houses, e1),
r1 as (select *, row_number() over (partition by stratum order by {h32(f'{seed}:x1')}, Id) as rk,
         count(*) over (partition by stratum) as n from d),
rest as (select * from r1 where rk <= floor(n * {lit(1.0 - 0.7)} + 0.5e0)),
e2 as (select quantile_cont(SalePrice::double, {probs(5)}) as e from rest),
r2 as (select Id, SalePrice, GrLivArea, stratum, {qbin('SalePrice', 'e2.e')}::int as stratum2 from rest, e2),
r3 as (select *, row_number() over (partition by stratum2 order by {h32(f'{seed}:x2')}, Id) as rk2,
         count(*) over (partition by stratum2) as n2 from r2),
sp as (select Id, SalePrice, GrLivArea, stratum, 'train' as split, null::int as stratum2
         from r1 where rk > floor(n * {lit(1.0 - 0.7)} + 0.5e0)
       union all
       select Id, SalePrice, GrLivArea, stratum,
         case when rk2 <= floor(n2 * {lit(0.5)} + 0.5e0) then 'test' else 'val' end, stratum2 from r3)"""


_EXACT = _exact_sql(SEED)


@register("stratified_split", _exact_sql(7) + "\nselect Id, stratum, split, stratum2 from sp")
def stratified_split(spark, sf):
    return S.stratified_split(houses(spark, sf), "Id", "SalePrice", 7).select(
        "Id", "stratum", "split", "stratum2")


def _exact(spark, sf):
    return S.stratified_split_exact(houses(spark, sf), "Id", "SalePrice", SEED)


@register("stratified_split_exact", _EXACT + "\nselect Id, stratum, split, stratum2 from sp")
def stratified_split_exact(spark, sf):
    return _exact(spark, sf).select("Id", "stratum", "split", "stratum2")


@register("split_overlap_check", _EXACT + """
select count(*)::bigint as n_ids, count_if(k > 1)::bigint as n_overlap
from (select Id, count(distinct split) as k from sp group by Id)""")
def split_overlap_check(spark, sf):
    return S.overlap_check(_exact(spark, sf), "Id")


@register("split_summary", _EXACT + f"""
select split, count_if(not (split = 'train' and {OUTLIER}))::bigint as n_rows,
  round(median(case when not (split = 'train' and {OUTLIER}) then SalePrice end), 4) as median_price,
  count_if(split = 'train' and {OUTLIER})::bigint as n_removed
from sp group by split""")
def split_summary(spark, sf):
    sp = _exact(spark, sf)
    cond = F.coalesce(C.outlier_condition(area_max=AREA_MAX, price_min=PRICE_MIN), F.lit(False))
    drop = (F.col("split") == "train") & cond
    counts = sp.groupBy("split").agg(F.count_if(~drop).cast("bigint").alias("n_rows"),
                                     F.count_if(drop).cast("bigint").alias("n_removed"))
    medians = grouped_quantiles(sp.filter(~drop), ["split"], "SalePrice", [0.5])
    return R(counts.join(medians, "split", "left").select(
        "split", "n_rows", F.col("q")[0].alias("median_price"), "n_removed"))


@register("removed_ids", _EXACT + f"\nselect Id from sp where split = 'train' and {OUTLIER}")
def removed_ids(spark, sf):
    train = _exact(spark, sf).filter(F.col("split") == "train")
    kept = C.remove_outliers(train, area_max=AREA_MAX, price_min=PRICE_MIN)
    return train.select("Id").join(kept.select("Id"), "Id", "left_anti")


@register("union_splits", _EXACT + f"""
select Id, split from sp where split = 'train' and not {OUTLIER}
union all select Id, split from sp where split = 'val'""")
def union_splits(spark, sf):
    sp = _exact(spark, sf)
    train = C.remove_outliers(sp.filter(F.col("split") == "train"), area_max=AREA_MAX,
                              price_min=PRICE_MIN)
    return train.select("Id", "split").unionByName(
        sp.filter(F.col("split") == "val").select("Id", "split"))


@register("split_write_roundtrip", _EXACT + """
select split, count(*)::bigint as n_rows, sum(Id)::bigint as id_sum from sp group by split""")
def split_write_roundtrip(spark, sf):
    path = scratch_path(spark, "splits")
    # one write partitioned by split instead of three files
    _exact(spark, sf).write.mode("overwrite").partitionBy("split").parquet(path)
    back = spark.read.parquet(path)
    return back.groupBy("split").agg(F.count(F.lit(1)).cast("bigint").alias("n_rows"),
                                     F.sum("Id").cast("bigint").alias("id_sum"))


@register("kfold_assign", f"{H}\nselect Id, ({h32(f'{SEED}:fold')} % 5)::int as fold from houses")
def kfold_assign(spark, sf):
    return S.kfold(houses(spark, sf).select("Id"), "Id", 5, SEED)


@register("kfold_exact_assign", f"""{H}
select Id, ((row_number() over (order by {h32(f'{SEED}:kx')}, Id) - 1) % 5)::int as fold from houses""")
def kfold_exact_assign(spark, sf):
    return S.kfold_exact(houses(spark, sf).select("Id"), "Id", 5, SEED).select("Id", "fold")


@register("repeated_kfold_assign", f"{H}\n" + " union all ".join(
    f"select Id, {r} as repeat, ({h32(f'{SEED}:r{r}')} % 5)::int as fold from houses"
    for r in range(3)))
def repeated_kfold_assign(spark, sf):
    return S.repeated_kfold(houses(spark, sf).select("Id"), "Id", 5, 3, SEED)


@register("ordered_cut", f"""{H}
select Id, case when Id <= (select quantile_cont(Id::double, 0.8e0) from houses) then 'head'
  else 'tail' end as part from houses""")
def ordered_cut(spark, sf):
    return S.ordered_cut(houses(spark, sf).select("Id"), "Id", 0.8)

