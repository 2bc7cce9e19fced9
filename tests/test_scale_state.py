"""Table-backed group state, digest-first duplicates, tiled correlations, file digests."""

import hashlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from terrace.operators import clean as C
from terrace.operators import models as M
from terrace.operators import profile as P
from terrace.operators import state as S
from terrace.sources import io as IO


def _spied(monkeypatch):
    """Rows that ``collect`` brought to the driver, by call."""
    from pyspark.sql.classic.dataframe import DataFrame
    sizes, real = [], DataFrame.collect

    def collect(self):
        rows = real(self)
        sizes.append(len(rows))
        return rows
    monkeypatch.setattr(DataFrame, "collect", collect)
    return sizes


def test_a_million_groups_without_a_driver_collect(spark, monkeypatch, tmp_path):
    n = 1_000_000
    df = spark.range(2 * n).select(F.concat(F.lit("g"), (F.col("id") % n).cast("string")).alias("g"),
                                   (F.col("id") % n + F.floor(F.col("id") / n) * 10).cast("double").alias("y"))
    sizes = _spied(monkeypatch)
    model = M.GroupMedianRegressor(groupCol="g", labelCol="y", predictionCol="p").fit(df)
    assert max(sizes) <= S.LITERAL + 1
    assert "table" in model.getOrDefault(model.stateJson)
    out = model.transform(df)
    wrong = out.filter(F.col("p") != F.substring("g", 2, 10).cast("double") + 5.0).count()
    assert wrong == 0 and out.columns == ["g", "y", "p"]
    model.write().overwrite().save(str(tmp_path / "m"))
    again = M.GroupMedianModel.load(str(tmp_path / "m")).transform(df.limit(100)).collect()
    assert all(r["p"] == float(r["g"][1:]) + 5.0 for r in again)


@pytest.mark.parametrize("way", ["literal", "broadcast", "salted"])
def test_state_ways_agree(spark, monkeypatch, way):
    rows = [("hot", float(i % 9)) for i in range(900)] + [(f"g{i}", float(i)) for i in range(40)] + [(None, 3.0)] * 50
    df = spark.createDataFrame(rows, "g string, y double").repartition(5)
    sizes = df.groupBy(F.col("g").alias("group")).agg(F.count(F.lit(1)).alias("n"))
    state = S.group_state(C.group_medians(df, "g", "y").withColumnRenamed("median", "value"), sizes,
                          literal=1000 if way == "literal" else 10)
    assert ("table" in state) == (way != "literal")
    if way != "literal":
        assert state["hot"]["hot"] > 100
    if way == "salted":
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    clash = df.withColumn("_group", F.lit(1)).withColumn("_salt", F.lit(2))
    got = S.attach(clash, "g", state, "fill", broadcast=0 if way == "salted" else 1 << 20)
    assert got.columns == ["g", "y", "_group", "_salt", "fill"] and got.count() == len(rows)
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    fills = {(r["g"], r["fill"]) for r in got.collect()}
    assert fills == {("hot", 4.0), (None, None)} | {(f"g{i}", float(i)) for i in range(40)}
    assert ("Join" in S.attach(clash, "g", state, "fill")._jdf.queryExecution().optimizedPlan().toString()) == (way != "literal")


def test_imputer_with_a_table_equals_the_literal(spark, monkeypatch):
    rows = [(f"n{i % 30}", float(i) if i % 3 else None) for i in range(300)] + [(None, None), ("unseen", None)]
    df = spark.createDataFrame(rows, "Neighborhood string, LotFrontage double")
    train = df.filter(F.col("Neighborhood") != "unseen")
    want = sorted(map(str, C.DomainImputer().fit(train).transform(df).collect()))
    literal = S.group_state
    monkeypatch.setattr(C, "group_state", lambda v, s: literal(v, s, literal=5))
    model = C.DomainImputer().fit(train)
    assert "group_table" in model.state and model.state["group_medians"] == {}
    assert sorted(map(str, model.transform(df).collect())) == want


def _duplicates(pdf):
    return len(pdf), len(pdf.drop_duplicates()), int(pdf.duplicated().sum())


@pytest.mark.parametrize("broadcast_rows", [1_000_000, 0])
def test_duplicates_by_digest(spark, broadcast_rows):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"a": rng.integers(0, 4, 400), "b": rng.integers(0, 3, 400).astype(str), "h1": rng.integers(0, 9, 400)})
    df = spark.createDataFrame(pdf)
    assert tuple(P.duplicate_rows(df, broadcast_rows=broadcast_rows).first()) == _duplicates(pdf)
    assert tuple(P.duplicate_rows(df, ["a", "b"], broadcast_rows).first()) == _duplicates(pdf[["a", "b"]])


def test_duplicates_with_nulls_zeros_and_no_rows(spark):
    rows = [(None, 1, 0.0), (1, None, 0.0), (None, 1, -0.0), (None, None, float("nan")), (None, None, float("nan"))]
    df = spark.createDataFrame(rows, "a int, b int, x double")
    assert tuple(P.duplicate_rows(df).first()) == (5, 3, 2)
    assert tuple(P.duplicate_rows(df.limit(0)).first()) == (0, 0, 0)
    assert tuple(P.duplicate_rows(df.limit(1)).first()) == (1, 1, 0)


def test_a_digest_collision_changes_nothing(spark, monkeypatch):
    df = spark.createDataFrame([(i % 5, "x" * (i % 3)) for i in range(60)], "a int, b string")
    monkeypatch.setattr(P.F, "xxhash64", lambda *_: P.F.lit(1))
    assert tuple(P.duplicate_rows(df).first()) == (60, 15, 45)


def test_tiles_equal_one_block_and_numpy(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, 23)) + np.arange(23) * 50
    x[:, 4] = x[:, 3] * 2 + rng.normal(size=300) * 0.01
    x[:, 9] = 7.0
    x[rng.random(x.shape) < 0.2] = np.nan
    pdf = pd.DataFrame(x, columns=[f"v{i}" for i in range(23)])
    df = spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None), ", ".join(f"v{i} double" for i in range(23))).repartition(3)
    one, tiled = ({(r["pos_a"], r["pos_b"]): r["r"] for r in P.correlation_long(df, pdf.columns, block=b).collect()} for b in (256, 5))
    want = pdf.corr(min_periods=2).to_numpy()
    assert set(one) == set(tiled) == {(i, j) for i in range(23) for j in range(i, 23)}
    for key, r in tiled.items():
        if r is None:
            assert one[key] is None and 9 in key  # the constant column
        else:
            assert abs(r - one[key]) < 1e-12 and abs(r - want[key]) < 1e-9


def test_a_tile_reads_its_own_columns(spark, tmp_path):
    wide = spark.range(200).select(*[(F.col("id") * (i + 1) % 97).cast("double").alias(f"w{i}") for i in range(240)])
    wide.write.parquet(str(tmp_path / "w"))
    df = spark.read.parquet(str(tmp_path / "w"))
    out = P.correlation_long(df, df.columns, block=80)
    scans = [line for line in out._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Project [" in line]
    assert max(line.count("cast") + line.count(" AS c") for line in scans) <= 320  # two blocks' columns
    assert out.count() == 240 * 241 // 2
    pair = out.filter("pos_a = 10 and pos_b = 222").first()["r"]
    pdf = df.select("w10", "w222").toPandas()
    assert abs(pair - pdf["w10"].corr(pdf["w222"])) < 1e-9


def test_file_digests_of_any_size(spark, tmp_path):
    rng = np.random.default_rng(1)
    (tmp_path / "sub").mkdir()
    bodies = {"empty": b"", "small": b"abc", "block": rng.bytes(4096), "large": rng.bytes(50_000), "sub/deep": rng.bytes(4097)}
    for name, body in bodies.items():
        (tmp_path / name).write_bytes(body)
    (tmp_path / "_SUCCESS").write_bytes(b"")
    got = {r["file"]: (r["length"], r["md5"]) for r in IO.file_fingerprint(spark, str(tmp_path), block=4096).collect()}
    assert got == {n.split("/")[-1]: (len(b), hashlib.md5(b).hexdigest()) for n, b in bodies.items()}
    one = IO.file_fingerprint(spark, "file:" + str(tmp_path / "large"), block=1000).collect()
    assert [(r["file"], r["md5"]) for r in one] == [("large", hashlib.md5(bodies["large"]).hexdigest())]
    with pytest.raises(Exception):
        IO.file_fingerprint(spark, str(tmp_path / "nowhere")).collect()


def test_column_quantiles_move_no_value_outside_the_wanted_ranges(spark, monkeypatch):
    import numpy as np
    from pyspark.sql.classic.dataframe import DataFrame as Frame

    from terrace.operators.quantile import column_quantiles
    rng = np.random.default_rng(5)
    a, b = rng.normal(size=3000).tolist(), rng.integers(0, 4, 3000).tolist()
    rows = [(x, y if i % 7 else None, float("nan") if i % 5 == 0 else -x * 1e-9, None) for i, (x, y) in enumerate(zip(a, b))]
    df = spark.createDataFrame(rows, "a double, b int, `c.d` double, none double")
    probs, plans, collect = [0.0, 0.1, 0.5, 1.0], [], Frame.collect
    monkeypatch.setattr(Frame, "collect", lambda self: plans.append(self._jdf.queryExecution().executedPlan().toString()) or collect(self))
    got = column_quantiles(df, df.columns, probs)
    assert got["a"] == pytest.approx(np.quantile(a, probs).tolist(), rel=1e-12)
    assert got["b"] == pytest.approx(np.quantile([r[1] for r in rows if r[1] is not None], probs).tolist())
    assert got["c.d"] == pytest.approx(np.quantile([r[2] for r in rows if r[2] == r[2]], probs).tolist(), rel=1e-12)
    assert got["none"] is None and column_quantiles(df.limit(0), ["a"], probs) == {"a": None}
    assert plans and not any("SortMergeJoin" in p or "ShuffledHashJoin" in p for p in plans)  # the rows of a column met the ranges by shuffle
