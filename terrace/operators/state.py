"""Fitted state of one value per group, of any number of groups.

Up to ``LITERAL`` groups the state is a dictionary, applied as a literal map:
no join.  Above, it is a Parquet table in the shared folder and is joined:
broadcast if its written size is at most ``BROADCAST`` bytes, else by a
shuffled join in which the rows of hot groups (known from the fit, at most
``1 / HOT`` of them) are dealt to several salts.  The three ways give the same
values.  The driver receives at most ``LITERAL + 1`` groups and the hot ones.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrace.functions.exprs import col
from terrace.session import scratch_path

LITERAL = 1000
BROADCAST = 64 << 20
#: A group with more than this share of the rows is salted ...
HOT = 0.001
#: ... so that one salt holds about this share.
PER_SALT = 0.0005


def group_state(values: DataFrame, sizes: DataFrame, literal: int = LITERAL) -> dict:
    """State of ``values`` (group, value).  ``sizes`` (group, n) counts the rows of
    the groups and is read only when the state becomes a table.  A NULL group
    or value has no entry."""
    values = values.filter(F.col("group").isNotNull() & F.col("value").isNotNull())
    few = values.limit(literal + 1).collect()
    if len(few) <= literal:
        return {"values": {r["group"]: r["value"] for r in few}}
    spark = values.sparkSession
    path = scratch_path(spark, "state")
    values.select("group", "value").write.parquet(path)
    total = sizes.agg(F.sum("n")).first()[0] or 0
    hot = {r["group"]: math.ceil(r["n"] / (total * PER_SALT))
           for r in sizes.filter((F.col("n") > F.lit(total * HOT)) & F.col("group").isNotNull()).collect()}
    return {"table": path, "bytes": folder_bytes(spark, path), "hot": hot}


def folder_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of a written folder, from the file system that holds it."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(p).getLength()


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def _salts(group: Column, hot: dict) -> Column:
    """Salts of a group: its own number for a hot one, else 1."""
    pairs = [F.lit(x) for k, v in sorted(hot.items()) for x in (str(k), v)]
    return F.coalesce(F.create_map(*pairs)[group.cast("string")], F.lit(1)) if pairs else F.lit(1)


def attach(df: DataFrame, key: str, state: dict, name: str, broadcast: int = BROADCAST) -> DataFrame:
    """``df`` with column ``name``: the value of its row's group, NULL without one.
    ``name`` must be free (see :func:`free_name`).

    A salt is a function of the row and its task, so a task that runs again
    deals its rows the same way; a NULL key is dealt like a hot group, since all
    such rows would meet in one task."""
    if "table" not in state:
        from terrace.operators.clean import lookup
        return df.withColumn(name, lookup(col(key), state["values"]))
    g, s, mine = (free_name(df, n) for n in ("_group", "_salt", "_mine"))
    table = df.sparkSession.read.parquet(state["table"]).select(F.col("group").alias(g), F.col("value").alias(name))
    if state["bytes"] <= broadcast:
        return df.join(F.broadcast(table), col(key) == F.col(g), "left").drop(g)
    hot = state["hot"]
    right = table.withColumn(s, F.explode(F.sequence(F.lit(0), _salts(F.col(g), hot) - 1)))
    atoms = [col(f.name) for f in df.schema.fields if isinstance(f.dataType, T.AtomicType)]
    deal = F.xxhash64(F.spark_partition_id(), *atoms)
    salts = F.when(col(key).isNull(), F.lit(100_000)).otherwise(_salts(col(key), hot))
    left = df.withColumn(mine, F.pmod(deal, salts.cast("bigint")).cast("int"))
    return left.join(right, (col(key) == F.col(g)) & (F.col(mine) == F.col(s)), "left").drop(g, s, mine)
