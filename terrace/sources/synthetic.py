"""Seeded synthetic housing table of any size (for tests and scaling runs).

Built from ``spark.range(n)``: every random draw is an md5 hash of
(seed, draw name, row id), so the table is identical however it is
partitioned (unlike ``rand()``), and normal noise uses Box-Muller on two
hash uniforms.  Price is log-linear in quality, living area, basement area
and build year plus a neighbourhood effect and N(0, 0.1) noise; about 5 %
NULLs are injected in four columns.  Not registered as a query: it reads no
driver table.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.config import NEIGHBORHOODS
from terrace.functions.exprs import hash_uniform


def _u(seed: int, name: str) -> Column:
    return hash_uniform(f"{seed}:{name}", F.col("id"))


def _int(seed: int, name: str, lo: int, hi: int) -> Column:
    return (F.lit(lo) + F.floor(_u(seed, name) * (hi - lo + 1))).cast("int")


def _choice(seed: int, name: str, levels: list[str]) -> Column:
    arr = F.array(*[F.lit(v) for v in levels])
    return arr[F.floor(_u(seed, name) * len(levels)).cast("int")]


def _normal(seed: int, name: str) -> Column:
    u1 = (_u(seed, name + "_a") * 4294967296.0 + 1.0) / 4294967297.0
    u2 = _u(seed, name + "_b")
    return F.sqrt(-2.0 * F.log(u1)) * F.cos(2.0 * math.pi * u2)


def _with_nulls(seed: int, name: str, c: Column, share: float = 0.05) -> Column:
    return F.when(_u(seed, "na_" + name) < share, F.lit(None)).otherwise(c)


def synthetic_sales(spark: SparkSession, n: int, seed: int = 42,
                    partitions: int | None = None) -> DataFrame:
    base = spark.range(0, n, 1, partitions) if partitions else spark.range(n)
    q = ["Ex", "Gd", "TA", "Fa", "Po"]
    df = base.select(
        (F.col("id") + 1).alias("Id"),
        _choice(seed, "nb", NEIGHBORHOODS).alias("Neighborhood"),
        _choice(seed, "zone", ["RL", "RM", "FV", "RH", "C (all)"]).alias("MSZoning"),
        _choice(seed, "cond", ["Normal", "Partial", "Abnorml", "Family"]).alias("SaleCondition"),
        _int(seed, "qual", 1, 10).alias("OverallQual"),
        _int(seed, "ocond", 1, 10).alias("OverallCond"),
        _int(seed, "built", 1900, 2008).alias("YearBuilt"),
        _int(seed, "gap", 0, 30).alias("_gap"),
        _int(seed, "sold", 2006, 2010).alias("YrSold"),
        _int(seed, "mo", 1, 12).alias("MoSold"),
        (F.lit(20) + F.lit(10) * _int(seed, "sub", 0, 16)).alias("MSSubClass"),
        _int(seed, "bsmt", 0, 2000).cast("double").alias("TotalBsmtSF"),
        _int(seed, "f1", 400, 2400).alias("1stFlrSF"),
        F.when(_u(seed, "has2") < 0.4, _int(seed, "f2", 200, 1200)).otherwise(F.lit(0))
        .alias("2ndFlrSF"),
        _int(seed, "fb", 0, 3).alias("FullBath"), _int(seed, "hb", 0, 2).alias("HalfBath"),
        _int(seed, "bfb", 0, 2).cast("double").alias("BsmtFullBath"),
        _int(seed, "bhb", 0, 1).cast("double").alias("BsmtHalfBath"),
        _int(seed, "fire", 0, 3).alias("Fireplaces"),
        _int(seed, "cars", 0, 3).cast("double").alias("GarageCars"),
        _int(seed, "wd", 0, 300).alias("WoodDeckSF"), _int(seed, "op", 0, 150).alias("OpenPorchSF"),
        _int(seed, "enc", 0, 80).alias("EnclosedPorch"), _int(seed, "ss", 0, 40).alias("3SsnPorch"),
        _int(seed, "scr", 0, 60).alias("ScreenPorch"),
        F.lit(0).alias("PoolArea"), F.lit(0).alias("MiscVal"),
        _choice(seed, "eq", q).alias("ExterQual"), _choice(seed, "kq", q).alias("KitchenQual"),
        _choice(seed, "bq", q).alias("BsmtQual"), _choice(seed, "gq", q).alias("GarageQual"),
        (F.lit(1000.0) + F.exp(F.lit(8.0) + 0.6 * F.abs(_normal(seed, "lot")))).alias("LotArea"),
        (F.lit(20.0) + F.floor(_u(seed, "lf") * 180)).alias("LotFrontage"),
        _normal(seed, "noise").alias("_z"),
        F.floor(_u(seed, "nb") * len(NEIGHBORHOODS)).alias("_nb"),
    )
    df = df.withColumn("YearRemodAdd", F.col("YearBuilt") + F.col("_gap")) \
        .withColumn("GrLivArea", F.col("1stFlrSF") + F.col("2ndFlrSF"))
    log_price = (10.5 + 0.12 * F.col("OverallQual") + 0.0004 * F.col("GrLivArea")
                 + 0.0002 * F.col("TotalBsmtSF") + 0.003 * (F.col("YearBuilt") - 1950)
                 + (F.col("_nb") - 12.5) * 0.02 + 0.1 * F.col("_z"))
    df = df.withColumn("SalePrice", F.round(F.exp(log_price), 2))
    for c in ("LotFrontage", "BsmtQual", "GarageQual", "TotalBsmtSF"):
        df = df.withColumn(c, _with_nulls(seed, c, F.col(f"`{c}`")))
    return df.drop("_gap", "_z", "_nb")
