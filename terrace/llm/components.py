"""Connected components of an edge table by alternating large-star and
small-star steps (Kiveris et al., 2014), each written to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.llm.common import save


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("x"), F.least("a", "m").alias("m"))
    return both.join(least, F.col("a") == F.col("x")).where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("x"), "m")
    moved = down.join(least, F.col("a") == F.col("x")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select(F.col("x").alias("a"), F.col("m").alias("b"))).where("a <> b")


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node that has an edge in ``edges`` (a, b); the
    label is the smallest node of the component.  Rows with ``a = b`` count as no
    edge.  Each step is a few joins whatever the component sizes, and the
    steps end when every edge leads straight to a root."""
    now = save(edges.select("a", "b").where("a <> b").distinct(), "edges")
    while not now.isEmpty():
        now = save(_small_star(_large_star(now)).distinct(), "edges")
        deep = now.join(now.select(F.col("a").alias("x")), F.col("b") == F.col("x"), "left_semi")
        if deep.isEmpty() and now.groupBy("a").count().where("count > 1").isEmpty():
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("label")).union(
        now.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())
