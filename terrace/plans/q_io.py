"""Registered source / sink queries (SRC-1, SRC-4, SRC-8, SRC-9)."""

from __future__ import annotations

from terrace.functions.exprs import round_doubles
from terrace.operators import cv as CV
from terrace.plans.fixtures import houses, read_table
from terrace.plans.q_model import _GRAM, _TR, _cv_scores, _ensemble_rows, _rl, blend_decision
from terrace.plans.registry import register
from terrace.plans.sqlgen import H, HOUSE_COLS, HOUSE_DOUBLE, dq
from terrace.session import scratch_path
from terrace.sources import io as IO

R = round_doubles
_FP_FIELDS = {"o_orderkey": "cast(o_orderkey as varchar)", "o_custkey": "cast(o_custkey as varchar)",
              "o_orderstatus": "o_orderstatus", "o_totalprice": "printf('%.6f', o_totalprice)",
              "o_orderdate": "cast(epoch_us(o_orderdate) as varchar)", "o_orderpriority": "o_orderpriority"}
_FP_ROW = "concat_ws('|', " + ", ".join(
    f"case when {c} is null then '~' else concat(length({x}), '=', {x}) end" for c, x in _FP_FIELDS.items()) + ")"
_FP_SQL = ("(select " + " || '-' || ".join(
    f"cast(coalesce(sum(cast('0x'||substr(h,{at},15) as bigint)), 0) as varchar)" for at in (1, 17))
    + f" from (select md5({_FP_ROW}) as h from orders))")


@register("read_csv_na_tokens", f"{H}\nselect "
          + ", ".join(f"round({dq(c)}, 4) as {dq(c)}" if c in HOUSE_DOUBLE else dq(c)
                      for c in HOUSE_COLS) + " from houses")
def read_csv_na_tokens(spark, sf):
    h = houses(spark, sf)
    path = scratch_path(spark, "csv")
    IO.write_csv(h, path, na_rep="NA")
    return R(IO.read_csv_na(spark, path, h.schema))


@register("result_csv_roundtrip", f"""{H}
select YrSold, count(SalePrice)::bigint as count, round(median(SalePrice), 4) as median,
  round(avg(SalePrice), 4) as mean from houses group by YrSold""")
def result_csv_roundtrip(spark, sf):
    from terrace.operators import profile as P
    res = R(P.group_stats(houses(spark, sf), "YrSold", "SalePrice").select(
        "YrSold", "count", "median", "mean"))
    path = scratch_path(spark, "result-csv")
    res.coalesce(1).write.mode("overwrite").option("header", True).csv(path)  # a small report
    return IO.read_csv(spark, path, res.schema)


@register("dataset_fingerprint", f"""
select count(*)::bigint as n_rows, {_FP_SQL} as fingerprint from orders""")
def dataset_fingerprint(spark, sf):
    return IO.table_fingerprint(read_table(spark, sf, "orders"))


@register("file_fingerprint")
def file_fingerprint(spark, sf):
    return IO.file_fingerprint(spark, f"{sf.rstrip('/')}/orders.parquet")


_SUMM = _TR + f""",
s as (select 'nbhd_median' as model, fold, {_rl('SalePrice', 'nbhd_median')} as te from oof group by fold
      union all select 'zoning_median', fold, {_rl('SalePrice', 'zoning_median')} from oof group by fold),
summ as (select model, avg(te) as cv, stddev_pop(te) as sd from s group by model),
fp as (select {_FP_SQL} as f)"""


@register("run_log_table", _SUMM + """
select 'compare_' || model as run, 'compare' as stage, 'param' as kind, 'group_col' as key,
  null::double as value_num,
  case model when 'nbhd_median' then 'Neighborhood' else 'MSZoning' end as value_str from summ
union all select 'compare_' || model, 'compare', 'metric', 'cv_rmse_log', round(cv, 4), null from summ
union all select 'compare_' || model, 'compare', 'metric', 'cv_std', round(sd, 4), null from summ
union all select 'compare_' || model, 'compare', 'tag', 'data_fingerprint', null,
  f from summ, fp""")
def run_log_table(spark, sf):
    groups = {"nbhd_median": "Neighborhood", "zoning_median": "MSZoning"}
    summ = CV.cv_summary(_cv_scores(spark, sf)).collect()  # one row per model
    fp = IO.table_fingerprint(read_table(spark, sf, "orders")).first()["fingerprint"]
    path = scratch_path(spark, "runs")
    for r in summ:  # one append per run, as a tracking store would receive them
        IO.append_run_log(IO.run_log_rows(
            spark, f"compare_{r['model']}", "compare", params={"group_col": groups[r["model"]]},
            metrics={"cv_rmse_log": round(r["cv_rmse_log"], 4), "cv_std": round(r["cv_std"], 4)},
            tags={"data_fingerprint": str(fp)}), path)
    return R(spark.read.schema(IO.RUN_LOG_SCHEMA).parquet(path))



@register("run_log_stages", _SUMM.replace(_TR, _TR + _GRAM, 1) + """
select 'compare_' || model as run, 'compare' as stage, 'metric' as kind, 'cv_rmse_log' as key,
  round(cv, 4) as value_num, null::varchar as value_str from summ
union all select 'compare_' || model, 'compare', 'metric', 'cv_std', round(sd, 4), null from summ
union all select 'ensemble', 'ensemble', 'metric', 'oof_rmse_log_' || model, round(oof_rmse_log, 4), null from ens
union all select 'ensemble', 'ensemble', 'metric', 'val_rmse_log_' || model, round(val_rmse_log, 4), null from ens
union all select 'ensemble', 'ensemble', 'param', 'weight_' || model, round(weight, 4), null from ens
union all select 'final', 'evaluate', 'tag', 'decision', null, decision from dec
union all select 'final', 'evaluate', 'tag', 'final_model_name', null,
  case when decision = 'USE_BLEND' then 'blend' else best_single end from dec
union all select 'final', 'evaluate', 'tag', 'data_fingerprint', null, f from fp""")
def run_log_stages(spark, sf):
    """Comparison, ensemble and final evaluation in one log.  The comparison is
    appended twice, as by a stage that runs again: one copy counts."""
    path = scratch_path(spark, "runs")

    def log(run, stage, **kinds):
        IO.append_run_log(IO.run_log_rows(spark, run, stage, **kinds), path)

    summ = CV.cv_summary(_cv_scores(spark, sf)).collect()  # one row per model
    for r in [*summ, *summ]:
        log(f"compare_{r['model']}", "compare", metrics={"cv_rmse_log": r["cv_rmse_log"], "cv_std": r["cv_std"]})
    ens = _ensemble_rows(spark, sf).collect()  # one row per model
    log("ensemble", "ensemble", params={f"weight_{r['model']}": r["weight"] for r in ens},
        metrics={f"{m}_{r['model']}": r[m] for r in ens for m in ("oof_rmse_log", "val_rmse_log")})
    d = blend_decision(spark, sf).first()
    log("final", "evaluate", tags={
        "decision": d["decision"], "final_model_name": "blend" if d["decision"] == "USE_BLEND" else d["best_single"],
        "data_fingerprint": IO.table_fingerprint(read_table(spark, sf, "orders")).first()["fingerprint"]})
    return R(IO.read_run_log(spark, path))
