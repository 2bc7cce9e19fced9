"""Helpers shared by the operators of this subpackage: tables written to the
cluster's shared folder, exact running totals over a range-sorted table, and
per-key statistics attached without a hot reducer."""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.session import scratch_path

#: A key that holds at least one row in this many counts as hot; so there are
#: at most this many hot keys, whatever the input.
HOT_ONE_IN = 1000


#: Bytes of an Arrow batch between Spark and its Python workers, about: texts may
#: be long, and a batch lies in memory several times.
BATCH = 4 << 20


def on_workers(spark: SparkSession) -> None:
    """Python workers of this session look for the package where the driver has
    it (a cluster without that path gets it by ``--py-files``), and get batches
    bounded in bytes."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH))
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *paths])


def save(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage and
    survives a lost executor."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def save_bucketed(df: DataFrame, name: str, key: str) -> DataFrame:
    """As :func:`save`, as a table bucketed by ``key``: a later join on ``key``
    moves the other side only.  A task whose rows share one key writes one file."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    table = "terrace_" + os.path.basename(path).replace("-", "_")
    df.write.bucketBy(partitions(spark), key).option("path", path).saveAsTable(table)
    return spark.table(table)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, made longer where ``df`` has them already (case aside)."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def token_count(text: Column) -> Column:
    """Number of words ``[^\\x20\\x09-\\x0D]+`` of a text; null counts as empty."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def positions(df: DataFrame, order: list[str], name: str) -> tuple[DataFrame, int]:
    """Adds ``_rank`` (0-based position in the order of ``order``), returns the
    row count too.  Range partitioning splits ties over many rows as long as
    ``order`` ends in a nearly unique column; the running index inside a sorted
    partition comes from the row's own partition index, the driver only sees
    one count per partition."""
    spark = df.sparkSession
    ranged = (df.repartitionByRange(partitions(spark), *order)
              .sortWithinPartitions(*order).withColumn("_mid", F.monotonically_increasing_id()))
    table = save(ranged, name)
    part = F.shiftright("_mid", 33)
    counts = sorted((r[0], r[1]) for r in table.groupBy(part.alias("p")).count().collect())
    starts, total = [], 0
    for p, n in counts:
        starts.append((p, total))
        total += n
    base = spark.createDataFrame(starts or [(0, 0)], "_part long, _start long")
    ranked = (table.withColumn("_part", part).join(F.broadcast(base), "_part")
              .withColumn("_rank", F.col("_start") + F.col("_mid").bitwiseAND((1 << 33) - 1)))
    return ranked.drop("_part", "_start", "_mid"), total


def attach(rows: DataFrame, stats: DataFrame, key: str, size: str, total: int) -> DataFrame:
    """Left join of a written ``rows`` table with one ``stats`` row per key.
    Keys with ``size * HOT_ONE_IN >= total`` (at most HOT_ONE_IN of them) go by
    broadcast, so that no task gets all rows of a hot key; the rest by shuffle."""
    hot = stats.where(F.col(size) * HOT_ONE_IN >= total)
    cold = stats.where(F.col(size) * HOT_ONE_IN < total)
    mark = F.broadcast(hot.select(key).withColumn("_hot", F.lit(True)))
    marked = rows.join(mark, key, "left")
    first = marked.where("_hot").drop("_hot").join(F.broadcast(hot), key)
    second = marked.where("_hot is null").drop("_hot").join(cold, key, "left")
    return first.unionByName(second)


def meet(rows: DataFrame, stats: DataFrame, key: str, size: str, total: int) -> DataFrame:
    """Inner join of a written ``rows`` table with a written ``stats`` table of
    one row per (integer) key: rows of hot keys, HOT_ONE_IN at most, by broadcast,
    so that no task gets all of them; the others by shuffle."""
    hot = stats.where(F.col(size) * HOT_ONE_IN >= total)
    names = [r[0] for r in hot.select(key).collect()]  # HOT_ONE_IN keys at most
    cold = stats.where(F.col(size) * HOT_ONE_IN < total)
    return rows.where(F.col(key).isin(names)).join(F.broadcast(hot), key).unionByName(
        rows.where(~F.col(key).isin(names)).join(cold, key))


# --- numpy helpers used inside tasks -------------------------------------

def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column and its offsets (n + 1); null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string()) if column.type != pa.large_string() else column
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    if len(offs) == 0:
        offs = np.zeros(1, np.int64)
    return raw[offs[0]:offs[-1]], offs - offs[0]


def slices(batches, column: str, limit: int = 4 << 20):
    """Cuts record batches so that a piece holds about ``limit`` bytes of text
    (one longer text stays whole)."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        _, offs = utf8(batch.column(batch.schema.get_field_index(column)))
        start = 0
        while start < batch.num_rows:
            end = int(np.searchsorted(offs, offs[start] + limit, "right")) - 1
            end = min(max(end, start + 1), batch.num_rows)
            yield batch.slice(start, end - start)
            start = end


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser of splitmix64 (constants are fixed values)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = 0x9E3779B97F4A7C15 | 1
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = 1 << max(12, int(n).bit_length())
    if size not in _POWERS:
        _POWERS.clear()
        up = np.ones(size, np.uint64)
        down = np.ones(size, np.uint64)
        up[1:] = np.uint64(_BASE)
        down[1:] = np.uint64(pow(_BASE, -1, 1 << 64))
        _POWERS[size] = np.multiply.accumulate(up), np.multiply.accumulate(down)
    return _POWERS[size]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte range: equal bytes give equal hashes."""
    up, down = _powers(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:len(data)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts])


def words(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash (64 bits) and text number of every word ``[^\\x20\\x09-\\x0D]+`` of
    the texts, A-Z in lower case, in order."""
    n = len(data)
    if n == 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    low = _LOWER[data]
    solid = ~_SPACE[data]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    inner = offs[1:-1][(offs[1:-1] < n)]
    first[inner] = solid[inner]
    starts = np.flatnonzero(first)
    if len(starts) == 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    up, down = _powers(n + 1)
    terms = (low.astype(np.uint64) + np.uint64(1)) * up[:n]
    terms[~solid] = 0
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(terms, out=total[1:])
    ends = np.append(starts[1:], n)
    hashes = mix((total[ends] - total[starts]) * down[starts])
    texts = np.searchsorted(offs, starts, "right") - 1
    return hashes, texts


def word_spans(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start, end, hash and text number of every word (A-Z in lower case)."""
    n = len(data)
    solid = ~_SPACE[data]
    first, last = solid.copy(), solid.copy()
    first[1:] &= ~solid[:-1]
    last[:-1] &= ~solid[1:]
    edge = offs[1:-1][(offs[1:-1] < n) & (offs[1:-1] > 0)]
    first[edge] = solid[edge]
    last[edge - 1] = solid[edge - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, span_hashes(_LOWER[data], starts, ends), np.searchsorted(offs, starts, "right") - 1


def lower(data: np.ndarray) -> np.ndarray:
    """The bytes with A-Z in lower case."""
    return _LOWER[data]


def keep_rows(docs: DataFrame, kept: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` whose (id, text hash) is in ``kept``, with the columns
    of ``docs``, whatever their names.  Of rows with one id and one text the one
    with the least hash of all its columns stays."""
    i, h, order = unused(docs, "_keep_id", "_keep_hash", "_keep_order")
    none = F.lit(-(1 << 63))
    rows = [F.col(f"`{c}`") for c in docs.columns]
    marked = docs.select("*", F.coalesce(F.col(key).cast("long"), none).alias(i), F.coalesce(F.xxhash64(text), F.lit(0)).alias(h))
    wanted = kept.select(F.coalesce("doc_id", none).alias(i), F.coalesce("text_hash", F.lit(0)).alias(h)).distinct()
    left = marked.join(wanted, [i, h], "left_semi")
    one = left.groupBy(i, h).agg(F.min_by(F.struct(*rows), F.xxhash64(*rows)).alias(order))
    return one.select(f"{order}.*")
