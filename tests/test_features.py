"""Feature engineering on literal frames (row values checked one by one)."""

from pyspark.sql import Row

from terrace.operators.features import FeatureEngineer, engineer


def _frame(spark):
    rows = [
        dict(Id=1, TotalBsmtSF=800.0, **{"1stFlrSF": 1000, "2ndFlrSF": 500}, FullBath=2, HalfBath=1,
             BsmtFullBath=1.0, BsmtHalfBath=0.0, YrSold=2008, YearBuilt=2000, YearRemodAdd=2005,
             OpenPorchSF=10, EnclosedPorch=0, **{"3SsnPorch": 0}, ScreenPorch=5, WoodDeckSF=100,
             OverallQual=7, OverallCond=5, GrLivArea=1500, ExterQual="Gd", KitchenQual="TA",
             BsmtQual=None, GarageQual="Xx", PoolArea=0, GarageCars=2.0, Fireplaces=1,
             LotArea=10000.0, MSSubClass=50.0, MoSold=6),
        dict(Id=2, TotalBsmtSF=0.0, **{"1stFlrSF": 900, "2ndFlrSF": 0}, FullBath=1, HalfBath=0,
             BsmtFullBath=None, BsmtHalfBath=0.0, YrSold=2006, YearBuilt=2008, YearRemodAdd=None,
             OpenPorchSF=0, EnclosedPorch=0, **{"3SsnPorch": 0}, ScreenPorch=0, WoodDeckSF=0,
             OverallQual=5, OverallCond=6, GrLivArea=900, ExterQual="TA", KitchenQual="Fa",
             BsmtQual="None", GarageQual=None, PoolArea=100, GarageCars=0.0, Fireplaces=0,
             LotArea=0.0, MSSubClass=20.0, MoSold=11),
    ]
    schema = ("Id long, TotalBsmtSF double, `1stFlrSF` int, `2ndFlrSF` int, FullBath int, "
              "HalfBath int, BsmtFullBath double, BsmtHalfBath double, YrSold int, YearBuilt int, "
              "YearRemodAdd int, OpenPorchSF int, EnclosedPorch int, `3SsnPorch` int, "
              "ScreenPorch int, WoodDeckSF int, OverallQual int, OverallCond int, GrLivArea int, "
              "ExterQual string, KitchenQual string, BsmtQual string, GarageQual string, "
              "PoolArea int, GarageCars double, Fireplaces int, LotArea double, "
              "MSSubClass double, MoSold int")
    cols = [f.split()[0].strip("`") for f in schema.split(", ")]
    return spark.createDataFrame([tuple(r[c] for c in cols) for r in rows], schema)


def test_engineered_values(spark):
    out = {r["Id"]: r for r in engineer(_frame(spark)).collect()}
    a, b = out[1], out[2]
    assert a["TotalSF"] == 2300.0 and b["TotalSF"] == 900.0
    assert a["TotalBath"] == 3.5 and b["TotalBath"] is None  # NULL propagates
    assert a["HouseAge"] == 8 and b["HouseAge"] == 0          # negative age clipped
    assert a["RemodAge"] == 3 and b["RemodAge"] is None
    assert a["IsRemodeled"] == 1 and b["IsRemodeled"] == 1    # NULL != x -> 1
    assert a["IsNew"] == 0 and b["IsNew"] == 0
    assert a["TotalPorchSF"] == 115
    assert a["QualxArea"] == 10500 and a["OverallScore"] == 35
    assert a["QualSum"] == 4 + 3 + 0 + 0                      # NULL / unmapped -> 0
    assert b["QualSum"] == 3 + 2 + 0 + 0
    assert (a["HasPool"], a["HasGarage"], a["HasBsmt"], a["Has2ndFlr"], a["HasFireplace"]) == \
        (0, 1, 1, 1, 1)
    assert (b["HasPool"], b["HasGarage"], b["HasBsmt"], b["Has2ndFlr"]) == (1, 0, 0, 0)
    assert abs(a["LotRatio"] - 0.15) < 1e-12 and b["LotRatio"] == 0.0  # lot 0 -> 0.0


def test_codes_cast_after_ages(spark):
    out = {r["Id"]: r for r in engineer(_frame(spark)).collect()}
    assert out[1]["MSSubClass"] == "50"  # integral double -> "50", not "50.0"
    assert out[1]["YrSold"] == "2008" and out[1]["HouseAge"] == 8


def test_missing_column_safe(spark):
    df = spark.createDataFrame([Row(OverallQual=5, GrLivArea=1000, LotArea=5000.0)])
    out = engineer(df)
    assert set(out.columns) == {"OverallQual", "GrLivArea", "LotArea", "QualxArea", "LotRatio"}
    porch = spark.createDataFrame([Row(OpenPorchSF=1, EnclosedPorch=2, ScreenPorch=3, WoodDeckSF=4)])
    assert "TotalPorchSF" not in engineer(porch).columns


def test_drop_after_and_stage(spark):
    out = FeatureEngineer(dropAfter=["LotRatio", "IsRemodeled", "Absent"]).transform(_frame(spark))
    assert "LotRatio" not in out.columns and "IsRemodeled" not in out.columns
    assert "TotalSF" in out.columns
