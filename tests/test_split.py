"""Splits and folds: exact sizes, no overlap, repartition invariance, ranks."""

import numpy as np
from pyspark.sql import functions as F

from terrace.operators import split as S
from terrace.sources.synthetic import synthetic_sales


def test_hash_rank_matches_bruteforce(spark):
    df = spark.range(0, 3000).withColumn("g", (F.col("id") % 3).cast("int"))
    r = {(x["id"]): x["rank"] for x in S.hash_rank(df, "id", "s", ["g"]).collect()}
    from terrace.functions.exprs import hash_u32
    u = df.select("id", "g", hash_u32("s", "id").alias("u")).toPandas()
    u = u.sort_values(["g", "u", "id"])
    u["rk"] = u.groupby("g").cumcount() + 1
    assert all(r[i] == k for i, k in zip(u["id"], u["rk"]))


def test_exact_split_sizes_and_overlap(spark):
    df = synthetic_sales(spark, 2000)
    sp = S.stratified_split_exact(df, "Id", "SalePrice").cache()
    counts = {r["split"]: r["count"] for r in sp.groupBy("split").count().collect()}
    assert sum(counts.values()) == 2000
    per = sp.groupBy("stratum").agg(F.count("*").alias("n"),
                                    F.count_if(F.col("split") != "train").alias("rest")).collect()
    for r in per:
        assert r["rest"] == int(r["n"] * 0.30000000000000004 + 0.5)
    assert S.overlap_check(sp, "Id").first()["n_overlap"] == 0


def test_split_repartition_invariant(spark):
    df = synthetic_sales(spark, 1500)
    a = {r["Id"]: r["split"] for r in S.stratified_split_exact(df.repartition(1), "Id", "SalePrice").collect()}
    b = {r["Id"]: r["split"] for r in S.stratified_split_exact(df.repartition(7), "Id", "SalePrice").collect()}
    assert a == b


def test_kfold_exact_balanced(spark):
    df = spark.range(0, 1003)
    sizes = sorted(r["count"] for r in S.kfold_exact(df, "id", 5).groupBy("fold").count().collect())
    assert sizes == [200, 200, 201, 201, 201]
    rep = S.repeated_kfold(df, "id", 5, 3)
    assert rep.count() == 3009 and rep.select("repeat").distinct().count() == 3


def test_exact_quantiles_match_percentile(spark):
    from terrace.operators.quantile import column_quantiles, grouped_quantiles
    rng = np.random.default_rng(0)
    values = {"even": rng.random(400), "tail": np.exp(rng.normal(0, 12, 300)), "ties": rng.integers(-3, 4, 500).astype(float),
              "narrow": 1.0 + rng.random(300) * 1e-12, "far": np.append(rng.normal(0, 1, 50), [1e308, -1e308, 1e18]),
              "one": np.array([7.5]), "negative": -np.exp(rng.normal(3, 4, 201))}
    rows = [(None if g == "ties" else g, float(x)) for g, xs in values.items() for x in xs]
    rows += [("even", None), ("even", float("nan")), ("nothing", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(4)
    probs = [0.0, 0.1, 0.25, 0.5, 0.975, 1.0]
    got = {r["g"]: r["q"] for r in grouped_quantiles(df, ["g"], "v", probs).collect()}
    clean = df.filter("v is not null and not isnan(v)")
    want = {r["g"]: r["q"] for r in clean.groupBy("g").agg(F.percentile("v", probs).alias("q")).collect()}
    assert got == want and len(got) == len(values)
    whole = grouped_quantiles(df, [], "v", [0.5]).collect()
    assert len(whole) == 1 and whole[0]["q"] == [clean.agg(F.median("v")).first()[0]]
    two = df.withColumn("w", F.lit(None).cast("double"))
    assert column_quantiles(two, ["v", "w"], [0.5]) == {"v": whole[0]["q"], "w": None}
    assert column_quantiles(two, [], [0.5]) == {}

