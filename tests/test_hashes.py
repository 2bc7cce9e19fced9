"""Hashes of many names per key, and the houses derived from them."""

from __future__ import annotations

import hashlib

from pyspark.sql import functions as F

from terrace.functions.md5 import hashes_u32, md5_u32
from terrace.plans.fixtures import houses_plan, houses_sql


def _want(name: str, key: str) -> int:
    return int(hashlib.md5(f"{name}:{key}".encode()).hexdigest()[:8], 16)


def test_first_bits_of_md5():
    names = ["a", "MoSold", "na_LotFrontage"]
    keys = ["", "1", "-5", "9" * 20, "x" * 80, *map(str, range(0, 30000, 7))]
    got = md5_u32(names, [k.encode() for k in keys])
    assert got.tolist() == [[_want(n, k) for n in names] for k in keys]


def test_null_keys_have_no_hashes(spark):
    rows = spark.createDataFrame([(None,), (7,), (7,), (None,), (123456,)], "k bigint").coalesce(1)
    got = [r["h"] for r in rows.select("k", hashes_u32(["a", "b"], F.col("k")).alias("h")).collect()]
    assert got == [None if k is None else [_want("a", str(k)), _want("b", str(k))] for k in (None, 7, 7, None, 123456)]


def test_houses_take_each_hash_once(spark, tmp_path):
    sf = str(tmp_path)
    spark.sql("""select if(id % 9 = 0, null, id * 7919) as o_orderkey, id % 5 as o_custkey, element_at(array('F', 'O', 'P'), int(id % 3) + 1)
        as o_orderstatus, date_add(date'1992-01-01', int(id)) as o_orderdate from range(200)""").write.parquet(f"{sf}/orders.parquet")
    spark.sql("select id as c_custkey, 'BUILDING' as c_mktsegment, int(id) as c_nationkey from range(5)").write.parquet(f"{sf}/customer.parquet")
    spark.sql("select int(id) as n_nationkey from range(5)").write.parquet(f"{sf}/nation.parquet")
    plan = houses_plan(spark, sf)
    for name in ("orders", "customer", "nation"):
        spark.read.parquet(f"{sf}/{name}.parquet").createOrReplaceTempView(name)
    plain = spark.sql(houses_sql("spark"))
    assert plan.schema == plain.schema
    assert plan.exceptAll(plain).count() == 0 and plain.exceptAll(plan).count() == 0
    assert "md5(" not in plan._jdf.queryExecution().optimizedPlan().toString()
