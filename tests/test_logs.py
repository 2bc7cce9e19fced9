"""Run log with attempts, running request-log statistics, streams without records."""

import datetime as dt

from pyspark.ml import Pipeline
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrace.sources import io as IO
from terrace.streaming import log_stats as LS


def _values(spark, path):
    return {(r["run"], r["stage"], r["kind"], r["key"]): (r["value_num"], r["value_str"])
            for r in IO.read_run_log(spark, path).collect()}


def test_retried_and_torn_stages_leave_one_copy(spark, tmp_path):
    path = str(tmp_path / "runs")
    first = IO.run_log_rows(spark, "r1", "compare", {"alpha": 0.1}, {"rmse": 0.12}, {"note": None})
    IO.append_run_log(first, path, attempt="a")
    IO.append_run_log(first, path, attempt="a")  # the same attempt written twice
    IO.append_run_log(IO.run_log_rows(spark, "r1", "tune", {"alpha": 3}), path)
    want = {("r1", "compare", "param", "alpha"): (0.1, None), ("r1", "compare", "metric", "rmse"): (0.12, None),
            ("r1", "compare", "tag", "note"): (None, None), ("r1", "tune", "param", "alpha"): (3.0, None)}
    assert _values(spark, path) == want and IO.read_run_log(spark, path).count() == 4
    IO.append_run_log(IO.run_log_rows(spark, "r1", "compare", {"alpha": 0.2}), path)  # a later attempt takes its place
    later = {("r1", "compare", "param", "alpha"): (0.2, None), ("r1", "tune", "param", "alpha"): (3.0, None)}
    assert _values(spark, path) == later
    torn = IO.run_log_rows(spark, "r1", "compare", {"alpha": 0.9, "beta": 1.0}).withColumns(
        {"attempt": F.lit("torn"), "attempt_rows": F.lit(2).cast("bigint"), "at": F.current_timestamp()})
    torn.filter("key = 'alpha'").write.mode("append").parquet(path)  # one of two rows arrived
    assert _values(spark, path) == later


def _log(spark, rows):
    return spark.createDataFrame([(dt.datetime(2024, 1, 1) + dt.timedelta(minutes=m), e, None, p, w, i, ms)
                                  for i, (m, e, p, w, ms) in enumerate(rows)], LS.LOG_SCHEMA)


def test_running_statistics_equal_the_batch_after_a_restart(spark, tmp_path):
    path, base = str(tmp_path / "log"), str(tmp_path / "stats")
    rows = [(m, "/a" if m % 3 else "/b", float(m), ["w"] if m % 4 == 0 else [], 1.0 + m % 50) for m in range(200)]
    rows += [(10, "/none", None, None, None), (11, "/none", None, [], None)]
    _log(spark, rows[:90]).repartition(3).write.mode("append").json(path)
    LS.run_log_stats(spark, path, base, max_files=1)
    seen = LS.report(LS.last_partials(spark, base)).agg(F.sum("n_requests")).first()[0]
    assert seen == 90
    _log(spark, rows[90:]).repartition(2).write.mode("append").json(path)
    for _ in range(2):  # a restart, and one with nothing new
        LS.run_log_stats(spark, path, base, max_files=1)
    got = {r["endpoint"]: r for r in LS.report(LS.last_partials(spark, base)).collect()}
    want = {r["endpoint"]: r for r in LS.report(LS.partials(_log(spark, rows), "1 hour")).collect()}
    assert set(got) == set(want) == {"/a", "/b", "/none"}
    for e in got:
        for c in ("n_requests", "warning_rate", "n_timed", "mean_prediction"):
            assert got[e][c] == want[e][c], (e, c)
    values = sorted(r[4] for r in rows if r[1] == "/a")
    for q in (50, 95, 99):  # within the sketch's rank error of the exact quantile
        at = got["/a"][f"latency_p{q}"]
        below, upto = sum(v < at for v in values), sum(v <= at for v in values)
        assert below <= (q / 100 + 0.03) * len(values) and upto >= (q / 100 - 0.03) * len(values)
    assert got["/none"]["latency_p50"] is None and got["/none"]["mean_prediction"] is None


def test_report_before_any_row(spark, tmp_path):
    assert LS.report(LS.last_partials(spark, str(tmp_path / "none"))).count() == 0


def test_stream_without_records(spark):
    from terrace.operators.models import GroupMedianRegressor
    from terrace.streaming.score_stream import run_score_stream
    types = {"Neighborhood": T.StringType(), "YearBuilt": T.IntegerType(), "YearRemodAdd": T.IntegerType(), "YrSold": T.IntegerType()}
    train = spark.createDataFrame([("NAmes", 100.0)], "Neighborhood string, SalePrice double")
    model = Pipeline(stages=[GroupMedianRegressor(groupCol="Neighborhood", labelCol="SalePrice")]).fit(train)
    none = spark.createDataFrame([], "request_id long, endpoint string, Neighborhood string")
    assert run_score_stream(spark, none, model, {}, list(types), types, 0.1).count() == 0


def test_stream_parses_records_once(spark, monkeypatch):
    """The outputs of a batch read the validated records, not the landed text."""
    from pyspark.sql import functions as F

    from terrace.operators import models as M
    from terrace.streaming import score_stream as SS
    train = spark.createDataFrame([(i, "NAmes", 7, 100.0 + i) for i in range(9)], "Id bigint, Neighborhood string, OverallQual int, SalePrice double")
    model = M.GroupMedianRegressor().fit(train)
    types = {f.name: f.dataType for f in train.schema.fields}
    raw, defaults, plans, plain = ["Neighborhood", "OverallQual"], {"Neighborhood": "NAmes", "OverallQual": 5}, [], SS.scored_batch

    def spied(v, *rest):
        plans.append(v._jdf.queryExecution().optimizedPlan().toString())
        return plain(v, *rest)

    monkeypatch.setattr(SS, "scored_batch", spied)
    monkeypatch.setattr(SS.SC, "record_warnings", lambda df: F.array().cast("array<string>"))
    records = spark.createDataFrame([(1, "/predict", "NAmes", "8"), (2, "/predict", "Nowhere", "8"), (3, "/predict", "NAmes", "ten")],
                                    "request_id bigint, endpoint string, Neighborhood string, OverallQual string")
    got = {r["request_id"]: r["errors"] for r in SS.run_score_stream(spark, records, model, defaults, raw, types, 0.1).collect()}
    want = SS.validated_batch(records, types).collect()
    assert got == {r["request_id"]: "; ".join(r["errors"]) or None for r in want}
    assert set(got) == {1, 2, 3} and got[3] is not None
    assert plans and all("json" not in p for p in plans)
