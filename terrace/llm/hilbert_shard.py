"""Sharding along a Hilbert curve.

Several metadata dimensions are quantised to ``2**bits`` bins of nearly equal
mass, the bins become a Hilbert curve index, rows are ordered by that index
and the order is cut into runs.  A run covers a compact box of the metadata
space, so min/max statistics of the shard files prune on every dimension.

Nulls: a null dimension value sorts before all others (bin 0); a null text has
no bytes.  Ties on the curve are broken by text hash and ``doc_id``; repeated
rows take neighbouring slots.  An empty table gives no rows.  Columns of the
input that clash with computed ones are not carried.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.llm.common import positions, save


def hilbert_index(coords: list[np.ndarray], bits: int) -> np.ndarray:
    """Position on the Hilbert curve of points with ``bits`` bits a dimension
    (Skilling, 2004: transposed axes, Gray decoding, interleaved bits)."""
    x = [np.asarray(c, np.int64).copy() for c in coords]
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        low = q - 1
        for i in range(n):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(high, x[0] ^ low, x[0] ^ swap)
            x[i] = x[i] ^ swap
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        flip = np.where((x[n - 1] & q) != 0, flip ^ (q - 1), flip)
        q >>= 1
    out = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            out = (out << 1) | (((x[i] ^ flip) >> b) & 1)
    return out


def bin_edges(rows: DataFrame, dims: list[str], bits: int) -> dict[str, list[str]]:
    """Lower edges of the bins of each (string) dimension: bins follow the
    order of the values and hold nearly equal mass.  Counts cover all rows;
    the driver gets at most ``2**bits`` edges a dimension."""
    pairs = rows.select(F.explode(F.array(*[
        F.struct(F.lit(d).alias("dim"), F.col(d).alias("value")) for d in dims])).alias("p")).select("p.*")
    counts = pairs.where("value is not null").groupBy("dim", "value").agg(F.count("*").alias("n"))
    ranked, _ = positions(counts, ["dim", "value"], "hilbert-values")
    ranked = save(ranked, "hilbert-ranks")
    # running mass from the distinct values' order: totals of coarse runs, then inside a run
    run = F.floor(F.col("_rank") / 4096).cast("long")
    runs = ranked.groupBy("dim", run.alias("run")).agg(F.sum("n").alias("mass"))
    before = F.expr("coalesce(sum(mass) over (partition by dim order by run rows between unbounded preceding and 1 preceding), 0)")
    total = F.expr("sum(mass) over (partition by dim)")
    runs = runs.select("dim", "run", before.alias("before"), total.alias("total"))
    inside = F.expr("coalesce(sum(n) over (partition by dim, run order by value rows between unbounded preceding and 1 preceding), 0)")
    cells = (ranked.withColumn("run", run).withColumn("inside", inside).join(runs, ["dim", "run"])
             .withColumn("bin", F.floor((F.col("before") + F.col("inside") + F.col("n") / 2) / F.col("total") * (1 << bits)).cast("int")))
    edges: dict[str, list[str]] = {d: [] for d in dims}
    for r in cells.groupBy("dim", "bin").agg(F.min("value").alias("edge")).orderBy("dim", "bin").collect():
        edges[r["dim"]].append((r["bin"], r["edge"]))
    return edges


def _bin(column: Column, edges: list[tuple[int, str]]) -> Column:
    """Bin of a value: that of the last edge at or below it; null gives 0."""
    if not edges:
        return F.lit(0)
    table = F.array(*[F.struct(F.lit(b).alias("b"), F.lit(e).alias("e")) for b, e in edges])
    return F.coalesce(F.array_max(F.transform(F.filter(table, lambda x: x["e"] <= column), lambda x: x["b"])), F.lit(0))


def hilbert_shards(docs: DataFrame, dims: dict[str, Column], n_shards: int, bits: int = 6,
                   law: str = "rows", text: str = "text", key: str = "doc_id") -> DataFrame:
    """Assigns every row a shard and a gapless slot in it.

    ``dims`` maps names to string-valued expressions whose order is the
    dimension's order.  ``law="rows"`` cuts runs whose counts differ by one at
    most, ``law="bytes"`` cuts at equal shares of ``size`` (text bytes + 16).
    Returns doc_id, the dimensions, size, text_crc32, hilbert, shard, slot.
    """
    if law not in ("rows", "bytes") or len(dims) * bits > 62:
        raise ValueError("law is rows or bytes, and dims * bits at most 62")
    raw = F.coalesce(F.col(text), F.lit(""))
    names = [f"_d{i}" for i in range(len(dims))]
    narrow = docs.select(
        F.col(key).alias("doc_id"), *[e.cast("string").alias(n) for n, e in zip(names, dims.values())],
        (F.octet_length(raw) + 16).cast("long").alias("size"), F.crc32(F.encode(raw, "UTF-8")).alias("text_crc32"),
        F.md5(raw).alias("_same"))
    narrow = save(narrow, "hilbert-rows")
    edges = bin_edges(narrow, names, bits)

    @F.pandas_udf("long")
    def curve(*bins: pd.Series) -> pd.Series:
        return pd.Series(hilbert_index([b.to_numpy() for b in bins], bits))

    placed = narrow.withColumn("hilbert", curve(*[_bin(F.col(n), edges[n]) for n in names]))
    ranked, total = positions(placed, ["hilbert", "_same", "doc_id"], "hilbert-order")
    if law == "rows":
        shard = F.expr(f"cast(_rank * {n_shards} div {max(total, 1)} as int)")
        start = F.expr(f"(shard * {total} + {n_shards - 1}) div {n_shards}")
        out = ranked.withColumn("shard", shard).withColumn("slot", F.col("_rank") - start)
    else:
        out = _by_bytes(save(ranked, "hilbert-ranked"), n_shards)
    return out.select("doc_id", *[F.col(n).alias(d) for n, d in zip(names, dims)], "size", "text_crc32", "hilbert",
                      F.lit(law).alias("law"), F.col("shard").cast("int").alias("shard"), F.col("slot").cast("long").alias("slot"))


def _by_bytes(ranked: DataFrame, n_shards: int) -> DataFrame:
    run = F.expr("_rank div 65536")
    runs = ranked.groupBy(run.alias("_run")).agg(F.sum("size").alias("mass"))
    # one row per 65,536 documents, range-ordered: the window is over that summary only
    runs = runs.select("_run", F.expr("coalesce(sum(mass) over (order by _run rows between unbounded preceding and 1 preceding), 0)").alias("_before"),
                       F.expr("sum(mass) over ()").alias("_total"))
    inside = F.expr("coalesce(sum(size) over (partition by _run order by _rank rows between unbounded preceding and 1 preceding), 0)")
    cut = (ranked.withColumn("_run", run).withColumn("_inside", inside).join(runs, "_run")
           .withColumn("shard", F.expr(f"cast(least({n_shards - 1}, floor((_before + _inside + size / 2) / _total * {n_shards})) as int)")))
    first = F.broadcast(cut.groupBy("shard").agg(F.min("_rank").alias("_first")))  # n_shards rows
    return cut.join(first, "shard").withColumn("slot", F.col("_rank") - F.col("_first"))


def write_shards(docs: DataFrame, assigned: DataFrame, path: str, key: str = "doc_id") -> DataFrame:
    """Writes the rows of ``docs`` as one folder per shard in slot order and
    returns the manifest: rows, bytes and min/max of every dimension a shard.
    ``key`` must be unique in both tables."""
    place = assigned.select(F.col("doc_id").alias(key), F.col("shard").alias("_shard"), F.col("slot").alias("_slot"))
    (docs.join(place, key).repartitionByRange("_shard", "_slot").sortWithinPartitions("_shard", "_slot")
     .withColumnRenamed("_shard", "shard").drop("_slot").write.partitionBy("shard").parquet(path))
    dims = [c for c in assigned.columns if c not in ("doc_id", "size", "text_crc32", "hilbert", "law", "shard", "slot")]
    return assigned.groupBy("shard").agg(
        F.count("*").alias("rows"), F.sum("size").alias("bytes"),
        *[f(d).alias(f"{f.__name__}_{d}") for d in dims for f in (F.min, F.max)])
