"""Registered scoring queries (SRV-*, PRJ-7/8, JOIN-6, SRC-6)."""

from __future__ import annotations

import time

from pyspark.sql import functions as F

from terrace.config import NEIGHBORHOODS, NUMERIC_RANGES, REQUIRED_FIELDS, ALLOWED_SETS
from terrace.functions.exprs import col, round_doubles
from terrace.operators import clean as C
from terrace.operators import models as M
from terrace.operators import score as SC
from terrace.plans.fixtures import houses, requests, requests_sql
from terrace.plans.registry import register
from terrace.plans.sqlgen import H, HOUSE_COLS, HOUSE_DOUBLE, HOUSE_STR, dq, mode_sql
from terrace.session import scratch_path

R = round_doubles
AREA_MAX, PRICE_MIN = 3000.0, 300000.0
RAW = [c for c in HOUSE_COLS if c not in ("Id", "SalePrice")]
# raw columns a request can carry (after alias normalisation)
_REQ_RAW = ("OverallQual", "GrLivArea", "Neighborhood", "OverallCond", "YearBuilt",
            "YearRemodAdd", "TotalBsmtSF", "1stFlrSF", "2ndFlrSF", "GarageCars", "FullBath",
            "HalfBath", "BsmtFullBath", "BsmtHalfBath", "Fireplaces", "LotArea", "LotFrontage",
            "YrSold", "MoSold", "MSZoning", "SaleCondition", "KitchenQual", "ExterQual", "BsmtQual")


def _sqltype(c: str) -> str:
    return "varchar" if c in HOUSE_STR else "double"


_REQ = f"{H}, requests as ({requests_sql('duckdb')})"
_NORM = _REQ + """,
norm as (select * exclude (first_flr_sf, second_flr_sf, "1stFlrSF", "2ndFlrSF", GarageCars),
  try_cast(GarageCars as integer) as GarageCars,
  GarageCars is not null and try_cast(GarageCars as integer) is null as wrong_GarageCars,
  coalesce(first_flr_sf, "1stFlrSF") as "1stFlrSF", coalesce(second_flr_sf, "2ndFlrSF") as "2ndFlrSF"
  from requests)"""


def _train(spark, sf):
    return C.remove_outliers(houses(spark, sf), area_max=AREA_MAX, price_min=PRICE_MIN)


def _defaults(spark, sf):
    t = _train(spark, sf)
    medians, modes = C.column_stats(t.select(*[col(c) for c in RAW]))  # fitted state
    d = dict(medians)
    d.update(modes)
    types = {f.name: f.dataType for f in t.schema.fields}
    return d, types


def _records(spark, sf):
    """Requests with canonical names and declared types."""
    types = {f.name: f.dataType for f in houses(spark, sf).schema.fields}
    return SC.coerce_types(SC.normalise(requests(spark, sf)), types)


# ---------------------------------------------------------------- PRJ-8 / SRV-2
@register("request_normalise", _NORM + """
select request_id, "1stFlrSF", "2ndFlrSF" from norm""")
def request_normalise(spark, sf):
    return SC.normalise(requests(spark, sf)).select("request_id", "1stFlrSF", "2ndFlrSF")


# ---------------------------------------------------------------- SRV-1
def _err_sql() -> str:
    present = set(_REQ_RAW) | {"CentralAir"}
    parts = [f"case when {dq(f)} is null then '{f}: field required' end" for f in REQUIRED_FIELDS]
    for f, (lo, hi) in NUMERIC_RANGES.items():
        if f not in present:
            continue
        parts.append(f"case when {dq(f)}::double < {lo} or {dq(f)}::double > {hi} then "
                     f"'{f}: out of range [{SC._fmt(lo)}, {SC._fmt(hi)}]' end")
    sets = dict(ALLOWED_SETS)
    sets["Neighborhood"] = NEIGHBORHOODS
    for f, allowed in sets.items():
        if f not in present:
            continue
        vals = ", ".join("'" + v + "'" for v in allowed)
        parts.append(f"case when {dq(f)} is not null and {dq(f)} not in ({vals}) then "
                     f"'{f}: not an allowed value' end")
    parts.append("case when wrong_GarageCars then 'GarageCars: wrong type' end")
    return f"list_filter([{', '.join(parts)}], lambda x: x is not null)"


_VALID = _NORM + f""",
val as (select *, {_err_sql()} as errs from norm)"""


@register("validate_records", _VALID + """
select request_id, len(errs)::int as n_errors, array_to_string(errs, '; ') as errors,
  len(errs) = 0 as is_valid from val""")
def validate_records(spark, sf):
    v = SC.validate(_records(spark, sf))
    return v.select("request_id", F.size("errors").alias("n_errors"),
                    F.array_join("errors", "; ").alias("errors"), "is_valid")


# ---------------------------------------------------------------- SRV-3 / JOIN-6
def _default_sql(c: str) -> str:
    if c in HOUSE_STR:
        return mode_sql("train", c)
    return f"(select median({dq(c)}::double) from train)"


_FILL = _VALID + f""",
train as (select * from houses where not coalesce(GrLivArea > 3000 and SalePrice < 300000, false)),
filled as (select request_id, endpoint, errs,
  ({len(RAW)} - ({' + '.join(f"(case when {dq(c)} is not null then 1 else 0 end)"
                             for c in RAW if c in _REQ_RAW)}))::int as fields_defaulted,
  {', '.join(f"coalesce(cast({dq(c)} as {_sqltype(c)}), {_default_sql(c)}) as {dq(c)}"
             if c in _REQ_RAW else f"{_default_sql(c)} as {dq(c)}" for c in RAW)}
  from val)"""


def _filled(spark, sf):
    d, types = _defaults(spark, sf)
    v = SC.validate(_records(spark, sf))
    return SC.fill_defaults(v, d, RAW, types)


_FILL_OUT = ["request_id", "fields_defaulted"] + RAW


@register("request_fill_defaults", _FILL + "\nselect "
          + ", ".join(f"round({dq(c)}, 4) as {dq(c)}" if c in RAW and c not in HOUSE_STR else dq(c)
                      for c in _FILL_OUT) + " from filled")
def request_fill_defaults(spark, sf):
    return R(_filled(spark, sf).select(*[col(c) for c in _FILL_OUT]))


# ---------------------------------------------------------------- SRV-4
_WARN_SQL = (f"list_filter([case when coalesce(YearBuilt > 2010, false) or coalesce(YearRemodAdd > 2010, false)"
             f" then '{SC.WARN_YEAR}' end, case when YrSold < 2006 or YrSold > 2010 then "
             f"'{SC.WARN_SOLD}' end], lambda x: x is not null)")


@register("record_warnings", _FILL + f"""
select request_id, len({_WARN_SQL})::int as n_warnings,
  array_to_string({_WARN_SQL}, ' | ') as warnings from filled""")
def record_warnings(spark, sf):
    w = SC.record_warnings(_filled(spark, sf))
    f = _filled(spark, sf).withColumn("_w", w)
    return f.select("request_id", F.size("_w").alias("n_warnings"),
                    F.array_join("_w", " | ").alias("warnings"))


# ---------------------------------------------------------------- SRC-6 / SRV-9 (baseline model)
_LOGGED = _FILL + f""",
nm as (select Neighborhood as g, median(SalePrice) as m from train where Neighborhood is not null group by 1),
gmed as (select median(SalePrice) as m from train),
scored as (select f.request_id, f.endpoint, f.fields_defaulted,
  round(coalesce(nm.m, gmed.m), 2) as predicted_price, {_WARN_SQL} as warns
  from filled f left join nm on nm.g = f.Neighborhood, gmed where len(f.errs) = 0)"""


def _write_log(spark, sf) -> str:
    """Score the valid records with the group-median model and append one log
    row per record, one append per endpoint (two writes to the same log).  The
    latency is the time of the scoring write per record."""
    filled = _filled(spark, sf).filter(F.col("is_valid"))
    model = M.GroupMedianRegressor(groupCol="Neighborhood", labelCol="SalePrice",
                                   predictionCol="_p").fit(_train(spark, sf))
    scored = model.transform(filled).withColumn("predicted_price", F.round("_p", 2)) \
        .withColumn("warnings", SC.record_warnings(filled)).drop("_p", "errors")
    path = scratch_path(spark, "request-log")
    for ep in ("/predict", "/predict/batch"):
        out = scratch_path(spark, "scored")
        t0 = time.time()
        scored.filter(F.col("endpoint") == ep).write.parquet(out)
        took = (time.time() - t0) * 1000.0
        done = spark.read.schema(scored.schema).parquet(out)
        rows = SC.log_rows(done, ep, ["fields_defaulted"] + RAW, took / max(done.count(), 1))
        rows.write.mode("append").json(path)
    return path


_LOG_SCHEMA = ("timestamp timestamp, endpoint string, input_fields string, prediction double, "
               "warnings array<string>, request_id bigint, latency_ms double")


@register("request_log_append", _LOGGED + """
select endpoint, count(*)::bigint as n_rows, count(distinct request_id)::bigint as n_requests
from scored group by endpoint""")
def request_log_append(spark, sf):
    log = spark.read.schema(_LOG_SCHEMA).json(_write_log(spark, sf))
    return log.groupBy("endpoint").agg(F.count(F.lit(1)).cast("bigint").alias("n_rows"),
                                       F.count_distinct("request_id").cast("bigint").alias("n_requests"))


@register("request_log_stats", _LOGGED + """
select endpoint, count(*)::bigint as n_requests, round(avg(predicted_price), 4) as mean_prediction,
  round(avg(case when len(warns) > 0 then 1.0 else 0.0 end), 4) as warning_rate,
  count(*)::bigint as n_timed from scored group by endpoint""")
def request_log_stats(spark, sf):
    log = spark.read.schema(_LOG_SCHEMA).json(_write_log(spark, sf))
    return R(log.groupBy("endpoint").agg(
        F.count(F.lit(1)).cast("bigint").alias("n_requests"),
        F.avg("prediction").alias("mean_prediction"),
        F.avg(F.when(F.size("warnings") > 0, 1.0).otherwise(0.0)).alias("warning_rate"),
        F.count_if(F.col("latency_ms") > 0).cast("bigint").alias("n_timed")))


@register("request_log_running", _LOGGED + """
select endpoint, count(*)::bigint as n_requests, round(avg(predicted_price), 4) as mean_prediction,
  round(avg(case when len(warns) > 0 then 1.0 else 0.0 end), 4) as warning_rate,
  count(*)::bigint as n_timed, true as latency_in_order from scored group by endpoint""")
def request_log_running(spark, sf):
    """The log's statistics from the stream's partials; the latency differs from
    run to run, so only the order of its quantiles is returned."""
    from terrace.streaming import log_stats as LS
    base = scratch_path(spark, "log-stats")
    LS.run_log_stats(spark, _write_log(spark, sf), base)
    out = LS.report(LS.last_partials(spark, base))
    p50, p95, p99 = (F.col(f"latency_p{q}") for q in (50, 95, 99))
    return R(out.select("endpoint", "n_requests", "mean_prediction", "warning_rate", "n_timed",
                        ((p50 > 0) & (p50 <= p95) & (p95 <= p99)).alias("latency_in_order")))


# ---------------------------------------------------------------- SRV-5/6 / PRJ-7 (fitted model)
@register("score_batch")
def score_batch(spark, sf):
    from terrace.plans.q_model import served_model
    served = served_model(spark, sf)
    good = _filled(spark, sf).filter(F.col("is_valid"))
    raw = good.select("request_id", "fields_defaulted", *[col(c) for c in RAW])  # trained order
    raw = raw.withColumn("warnings", SC.record_warnings(raw))
    scored = served["model"].transform(raw.withColumn("Id", F.col("request_id")))
    p, lo, hi = SC.price_interval(F.col("prediction"), served["mape"])
    return scored.select("request_id", p.alias("predicted_price"), lo.alias("price_range_low"),
                         hi.alias("price_range_high"), F.lit(served["type"]).alias("model_type"),
                         F.lit(served["version"]).alias("model_version"), "fields_defaulted",
                         F.array_join("warnings", " | ").alias("warnings"))


@register("score_stream")
def score_stream(spark, sf):
    from terrace.plans.q_model import served_model
    from terrace.streaming.score_stream import run_score_stream
    served = served_model(spark, sf)
    d, types = _defaults(spark, sf)
    return run_score_stream(spark, requests(spark, sf), served["model"], d, RAW, types, served["mape"])
