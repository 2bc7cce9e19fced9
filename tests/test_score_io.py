"""Record scoring operators and I/O helpers."""

from pyspark.sql import Row

from terrace.operators import score as SC
from terrace.sources import io as IO


def test_validation_messages(spark):
    df = spark.createDataFrame(
        [Row(request_id=1, OverallQual=None, GrLivArea=200.0, Neighborhood="Nowhere",
             MSZoning="RL", CentralAir="Y"),
         Row(request_id=2, OverallQual=5, GrLivArea=1500.0, Neighborhood="NAmes",
             MSZoning="XX", CentralAir="Y")])
    out = {r["request_id"]: r for r in SC.validate(df).collect()}
    assert out[1]["errors"] == ["OverallQual: field required",
                                "GrLivArea: out of range [300, 6000]",
                                "Neighborhood: not an allowed value"]
    assert out[2]["errors"] == ["MSZoning: not an allowed value"] and not out[2]["is_valid"]


def test_normalise_aliases_and_extra_keys(spark):
    df = spark.createDataFrame([Row(first_flr_sf=800.0, second_flr_sf=None, extra="x")],
                               "first_flr_sf double, second_flr_sf double, extra string")
    out = SC.normalise(df)
    assert set(out.columns) == {"1stFlrSF", "2ndFlrSF", "extra"}
    assert out.first()["1stFlrSF"] == 800.0


def test_fill_defaults_and_warnings(spark):
    from pyspark.sql import types as T
    df = spark.createDataFrame([Row(YearBuilt=2015, YrSold=2012, LotArea=None)],
                               "YearBuilt int, YrSold int, LotArea double")
    types = {"YearBuilt": T.IntegerType(), "YrSold": T.IntegerType(), "LotArea": T.DoubleType(),
             "YearRemodAdd": T.IntegerType()}
    out = SC.fill_defaults(df, {"LotArea": 9000.0, "YearRemodAdd": 1990.6}, list(types), types)
    r = out.first()
    assert r["fields_defaulted"] == 2 and r["LotArea"] == 9000.0 and r["YearRemodAdd"] == 1990.6
    w = out.select(SC.record_warnings(out).alias("w")).first()["w"]
    assert w == [SC.WARN_YEAR, SC.WARN_SOLD]


def test_read_csv_token_set(spark, tmp_path):
    p = tmp_path / "t.csv"
    p.write_text("a,b,c\n1,None,x\nNA,2.5,NaN\n,nan,null\n")
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.DoubleType()),
                           T.StructField("c", T.StringType())])
    rows = IO.read_csv_na(spark, str(p), schema).collect()
    assert [tuple(r) for r in rows] == [(1, None, "x"), (None, 2.5, None), (None, None, None)]


def test_fingerprint_partition_invariant(spark):
    df = spark.range(0, 500).selectExpr("id", "cast(id % 7 as string) as s")
    a = IO.table_fingerprint(df.repartition(1)).first()
    b = IO.table_fingerprint(df.repartition(9)).first()
    assert a == b and a["n_rows"] == 500


def test_fingerprint_sees_every_change(spark):
    rows = [("a", None, 1.5), (None, "a", 1.5), ("a|1=", "", 1.5), ("a", "|1=", 1.5), ("a", None, 1.6), ("", None, 1.5)]
    prints = {IO.table_fingerprint(spark.createDataFrame([r], "x string, y string, z double")).first()["fingerprint"] for r in rows}
    assert len(prints) == len(rows)
    empty = IO.table_fingerprint(spark.createDataFrame([], "x string")).first()
    assert (empty["n_rows"], empty["fingerprint"]) == (0, "0-0")


def test_wrong_types_are_reported(spark):
    from pyspark.sql import types as T
    df = spark.createDataFrame([("big", "7", "NAmes", "1500"), ("1.5", "7.0", "NAmes", "1500"), (None, "x", "NAmes", None)],
                               "LotArea string, OverallQual string, Neighborhood string, GrLivArea string")
    types = {"LotArea": T.IntegerType(), "OverallQual": T.IntegerType(), "GrLivArea": T.DoubleType(), "Neighborhood": T.StringType()}
    out = SC.validate(SC.coerce_types(df, types)).collect()
    assert out[0]["errors"] == ["LotArea: wrong type"] and out[0]["LotArea"] is None
    assert out[1]["errors"] == ["LotArea: wrong type"] and out[1]["OverallQual"] == 7
    assert out[2]["errors"] == ["GrLivArea: field required", "OverallQual: wrong type"]


def test_stream_scores_and_quarantines(spark, tmp_path):
    from pyspark.ml import Pipeline
    from pyspark.sql import types as T

    from terrace.operators.models import GroupMedianRegressor
    from terrace.streaming.score_stream import run_score_stream, scoring_batch
    types = {"LotArea": T.IntegerType(), "OverallQual": T.IntegerType(), "GrLivArea": T.DoubleType(), "Neighborhood": T.StringType(),
             "YearBuilt": T.IntegerType(), "YearRemodAdd": T.IntegerType(), "YrSold": T.IntegerType()}
    train = spark.createDataFrame([("NAmes", 100.0), ("NAmes", 120.0), ("Gilbert", 300.0)], "Neighborhood string, SalePrice double")
    model = Pipeline(stages=[GroupMedianRegressor(groupCol="Neighborhood", labelCol="SalePrice")]).fit(train)
    rows = [(1, "/p", "9000", 7, 1500.0, "NAmes"), (2, "/p", "big", 7, 1500.0, "NAmes"), (3, "/p", None, 7, 1500.0, "Gilbert"),
            (4, "/p", "9000", None, 1500.0, "NAmes")]
    records = spark.createDataFrame(rows, "request_id long, endpoint string, LotArea string, OverallQual int, GrLivArea double, Neighborhood string")
    defaults = {"LotArea": 9000.5, "YearBuilt": 1990.0, "YearRemodAdd": 1990.0, "YrSold": 2008.0}
    out = {r["request_id"]: r for r in run_score_stream(spark, records, model, defaults, list(types), types, 0.1, max_files=1).collect()}
    assert {i: r["status"] for i, r in out.items()} == {1: "scored", 2: "quarantined", 3: "scored", 4: "quarantined"}
    assert out[1]["predicted_price"] == 110.0 and out[1]["price_range_high"] == 121.0 and out[3]["fields_defaulted"] == 4
    assert out[2]["errors"] == "LotArea: wrong type" and out[4]["errors"] == "OverallQual: field required"
    again, bad = scoring_batch(records, model, defaults, list(types), types, 0.1)  # a replay gives the same rows
    assert {r["request_id"]: r["predicted_price"] for r in again.collect()} == {1: 110.0, 3: 300.0} and bad.count() == 2


def test_stream_broadcasts_no_input_texts(spark, tmp_path):
    """A few bytes of a file can be many rows of text: their join is a shuffle at any size."""
    from pyspark.sql import types as T

    from terrace.operators.models import GroupMedianRegressor
    from terrace.streaming.score_stream import scored_batch
    types = {"Neighborhood": T.StringType(), "YearBuilt": T.IntegerType(), "YearRemodAdd": T.IntegerType(), "YrSold": T.IntegerType()}
    train = spark.createDataFrame([("NAmes", 100.0), ("Gilbert", 300.0)], "Neighborhood string, SalePrice double")
    path = str(tmp_path / "validated")
    spark.range(1000).selectExpr("id as request_id", "'/p' as endpoint", "if(id % 2 = 0, 'NAmes', 'Gilbert') as Neighborhood",
                                 "if(id % 10 = 0, array('wrong'), array()) as errors", "id % 10 <> 0 as is_valid").write.parquet(path)
    scored, bad = scored_batch(spark.read.parquet(path), GroupMedianRegressor().fit(train), {}, list(types), types, 0.1)
    assert "Broadcast" not in scored._jdf.queryExecution().executedPlan().toString()
    rows = scored.collect()
    assert len(rows) == 900 and bad.count() == 100
    assert all(r["predicted_price"] == (300.0 if r["request_id"] % 2 else 100.0) for r in rows)
    assert all(r["inputs"] == '{"Neighborhood":"%s"}' % ("Gilbert" if r["request_id"] % 2 else "NAmes") for r in rows)


def test_run_log_widen(spark, tmp_path):
    path = str(tmp_path / "runs")
    IO.append_run_log(IO.run_log_rows(spark, "r1", "compare", {"alpha": 0.1}, {"rmse": 0.12},
                                      {"data": "abc"}), path)
    w = IO.widen_run_log(spark.read.parquet(path)).first()
    assert w["metrics"]["rmse"] == "0.12" and w["tags"]["data"] == "abc"


def test_the_decided_model_is_fitted(spark, monkeypatch):
    from terrace.plans import q_model as q
    sf = "/root/testdata/sf0.001"
    monkeypatch.setattr(q, "_MEMO", {})
    rows = [("nbhd_median", 0.3, 0.3, 0.25), ("zoning_median", 0.3, 0.3, 0.75), ("blend", 0.1, 0.1, 1.0)]
    ens = spark.createDataFrame(rows, "model string, oof_rmse_log double, val_rmse_log double, weight double")
    monkeypatch.setattr(q, "_ensemble_rows", lambda *_: ens)
    served = q.served_model(spark, sf)
    assert served["type"] == "blend" and served["model"].weights == [0.25, 0.75]
    assert [n for n, _ in served["model"].models] == ["nbhd_median", "zoning_median"]
    assert q.metrics_json_doc(spark, sf).first()["final_model_type"] == "blend"
    info = q.model_info(spark, sf).first()
    assert (info["model_type"], info["model_name"], info["weight_nbhd_median"], info["weight_zoning_median"]) == ("blend", "blend", 0.25, 0.75)
    doc = q.final_metrics_document(spark, sf)
    got = doc.first()
    assert len(doc.columns) == 15 and got["final_model_weights"] == {"nbhd_median": 0.25, "zoning_median": 0.75}
    tr, va, te = q._frames(spark, sf)
    frame, _ = q._final_frame(spark, sf)
    blend = frame.withColumn("p", q.B.blend_expr(["nbhd_median", "zoning_median"], [0.25, 0.75]))
    want = q.MET.regression_metrics(blend, "SalePrice", "p").first()
    assert abs(got["rmse_log"] - want["rmse_log"]) < 1e-9 and got["n_test"] == want["n"]
    assert info["rmse_log"] == round(want["rmse_log"], 4) == q.metrics_json_doc(spark, sf).first()["rmse_log"]
