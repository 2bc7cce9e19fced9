"""Imputation rules, droppers and the outlier filter on literal frames."""

from pyspark.sql import Row

from terrace.operators import clean as C


def test_constant_imputation(spark):
    df = spark.createDataFrame([("Gd", 100.0), (None, None)], "PoolQC string, GarageArea double")
    out = C.DomainImputer().fit(df).transform(df).collect()
    assert out[1]["PoolQC"] == "None" and out[1]["GarageArea"] == 0.0


def test_row_wise_imputation(spark):
    df = spark.createDataFrame([(None, 1990), (2001.0, 2000)], "GarageYrBlt double, YearBuilt int")
    out = C.DomainImputer().fit(df).transform(df).collect()
    assert out[0]["GarageYrBlt"] == 1990.0 and out[1]["GarageYrBlt"] == 2001.0


def test_group_median_fit_apply(spark):
    a = spark.createDataFrame([("A", 60.0), ("A", 80.0), ("B", 100.0)],
                              "Neighborhood string, LotFrontage double")
    b = spark.createDataFrame([(1, "A", None), (2, "B", None), (3, "Z", None)],
                              "id int, Neighborhood string, LotFrontage double")
    out = {r["id"]: r["LotFrontage"] for r in C.DomainImputer().fit(a).transform(b).collect()}
    assert out == {1: 70.0, 2: 100.0, 3: 80.0}  # unseen group -> global median


def test_conditional_mode_before_none(spark):
    df = spark.createDataFrame(
        [(100.0, "Gd"), (100.0, "Gd"), (100.0, "No"), (100.0, None), (0.0, None)],
        "TotalBsmtSF double, BsmtExposure string")
    out = [r["BsmtExposure"] for r in C.DomainImputer().fit(df).transform(df).collect()]
    assert out[3] == "Gd" and out[4] == "None"


def test_mode_tie_smallest_and_leftovers(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,)], "Electrical string")
    out = [r["Electrical"] for r in C.DomainImputer().fit(df).transform(df).collect()]
    assert out[4] == "a"


def test_column_dropper_ignores_absent(spark):
    df = spark.createDataFrame([Row(Id=1, SalePrice=1.0, LotArea=2.0)])
    out = C.ColumnDropper(cols=["Id", "Utilities", "Street"]).transform(df)
    assert out.columns == ["SalePrice", "LotArea"]


def test_remove_outliers_null_safe(spark):
    df = spark.createDataFrame([(1, 5000.0, 100000.0), (2, 5000.0, None), (3, 1000.0, 1.0)],
                               "Id int, GrLivArea double, SalePrice double")
    kept = sorted(r["Id"] for r in C.remove_outliers(df).collect())
    assert kept == [2, 3]  # the NULL comparison row is kept
    s = C.outlier_summary(df).first()
    assert (s["n_in"], s["n_removed"], s["n_out"]) == (3, 1, 2)
    no_cols = spark.createDataFrame([Row(a=1)])
    assert C.remove_outliers(no_cols).count() == 1


def test_quality_gate_counts(spark):
    df = spark.createDataFrame([(1.0, "a"), (float("inf"), None), (float("nan"), "b")],
                               "x double, s string")
    r = C.quality_gate(df).first()
    assert r["x"] == 2 and r["s"] == 1


def test_imputer_persistence(spark, tmp_path):
    from pyspark.ml import Pipeline, PipelineModel
    df = spark.createDataFrame([("A", 60.0), ("A", None)], "Neighborhood string, LotFrontage double")
    m = Pipeline(stages=[C.DomainImputer()]).fit(df)
    m.write().overwrite().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m"))
    assert again.transform(df).collect() == m.transform(df).collect()
