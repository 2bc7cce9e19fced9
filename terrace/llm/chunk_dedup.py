"""Exact deduplication by recipes of content-defined chunks.

Each normalised text is cut where a rolling gear hash of the last 32 bytes
meets a mask, so equal texts get equal chunks and texts that share passages
share most chunks.  A chunk is shipped once per task, deduplicated by its
bytes, and gets a verified identifier: its 128-bit digest, plus a number where
two different chunks have the same digest.  Texts are then equal when their
ordered identifier lists are; only the lists move, never the texts again.

Nulls count as empty texts, and all empty texts are one group.  Repeated rows
(same id and text) are told apart by an internal row number, so exactly one
row of a group stays.  An empty table gives no rows.  Other input columns are
not read, so their names cannot clash.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terrace.llm.common import attach, mix, save

#: Characters that do not count in the comparison.
BLANK = b" \t\n\x0b\x0c\r"
_GEAR = (mix(np.arange(1, 257, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32)


def cuts(data: bytes, mask_bits: int = 11, least: int = 512, most: int = 16384) -> list[int]:
    """End positions of the content-defined chunks of ``data``."""
    n = len(data)
    if n <= least:
        return [n] if n else []
    h = _GEAR[np.frombuffer(data, np.uint8)]
    for width in (1, 2, 4, 8, 16):  # sum over 32 bytes of gear << age, by doubling
        shifted = h[:-width] << np.uint32(width)
        h = h.copy()
        h[width:] += shifted
    marks = np.flatnonzero((h >> np.uint32(32 - mask_bits)) == 0) + 1
    out, last = [], 0
    for m in marks.tolist():
        while m - last > most:
            last += most
            out.append(last)
        if m - last >= least:
            out.append(m)
            last = m
    while n - last > most:
        last += most
        out.append(last)
    if last < n:
        out.append(n)
    return out


def _digest(chunk: bytes, bits: int) -> bytes:
    d = xxhash.xxh3_128_digest(chunk)
    return d if bits == 128 else (int.from_bytes(d, "big") >> (128 - bits)).to_bytes(16, "big")


def _pieces(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass").translate(None, BLANK)


def _row(counter: int) -> int:
    """Number of a row that a rerun of the same task gives again."""
    return (TaskContext.get().partitionId() << 40) | counter


def recipes(docs: DataFrame, digest_bits: int = 128, text: str = "text", key: str = "doc_id") -> DataFrame:
    """row, doc_id, text_hash, points, sha256 and the recipe (16 bytes a chunk) of every row."""
    def run(batches):
        done = 0
        for b in batches:
            points, hashes, lists = [], [], []
            for t in b.column(1).to_pylist():
                body = _pieces(t)
                ends = cuts(body)
                points.append(len(t or ""))
                hashes.append(hashlib.sha256(body).hexdigest())
                lists.append(b"".join(_digest(body[s:e], digest_bits) for s, e in zip([0] + ends, ends)))
            rows = [_row(done + i) for i in range(len(points))]
            done += len(points)
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), b.column(0), b.column(2), pa.array(points, pa.int64()),
                                              pa.array(hashes, pa.string()), pa.array(lists, pa.binary())],
                                             ["row", "doc_id", "text_hash", "points", "text_sha256", "recipe"])

    source = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"), F.xxhash64(text).alias("text_hash"))
    return source.mapInArrow(run, "row long, doc_id long, text_hash long, points long, text_sha256 string, recipe binary")


def chunks(docs: DataFrame, digest_bits: int = 128, text: str = "text", memory: int = 32 << 20) -> DataFrame:
    """Distinct (digest, chunk) rows.  A task ships a chunk once as long as the
    bytes it remembers fit ``memory``; then it forgets them and may ship again."""
    def run(batches):
        seen: dict[bytes, bytes] = {}
        held = 0
        for b in batches:
            digests, bodies = [], []
            for t in b.column(0).to_pylist():
                body = _pieces(t)
                last = 0
                for end in cuts(body):
                    part, last = body[last:end], end
                    d = _digest(part, digest_bits)
                    if seen.get(d) == part:
                        continue
                    if held > memory:
                        seen, held = {}, 0
                    seen[d] = part
                    held += len(part)
                    digests.append(d)
                    bodies.append(part)
            yield pa.RecordBatch.from_arrays([pa.array(digests, pa.binary()), pa.array(bodies, pa.binary())], ["digest", "chunk"])

    return docs.select(F.col(text).alias("text")).mapInArrow(run, "digest binary, chunk binary").distinct()


def _occurrences(docs: DataFrame, digest_bits: int, text: str, key: str) -> DataFrame:
    """Every chunk of every row with its bytes; only needed after a collision."""
    def run(batches):
        done = 0
        for b in batches:
            out = [[] for _ in range(8)]
            for i, t, h in zip(*[b.column(c).to_pylist() for c in range(3)]):
                body = _pieces(t)
                ends = cuts(body) or [0]
                for pos, (s, e) in enumerate(zip([0] + ends, ends)):
                    one = (_row(done), i, h, len(t or ""), hashlib.sha256(body).hexdigest(), pos, _digest(body[s:e], digest_bits), body[s:e])
                    for column, x in zip(out, one):
                        column.append(x)
                done += 1
            kinds = [pa.int64()] * 4 + [pa.string(), pa.int64(), pa.binary(), pa.binary()]
            names = ["row", "doc_id", "text_hash", "points", "text_sha256", "pos", "digest", "chunk"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names)

    source = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"), F.xxhash64(text).alias("text_hash"))
    return source.mapInArrow(run, "row long, doc_id long, text_hash long, points long, text_sha256 string, pos long, digest binary, chunk binary")


def verified_recipes(docs: DataFrame, digest_bits: int = 128, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Recipes whose identifiers are equal only for equal chunks."""
    digests = chunks(docs, digest_bits, text)
    several = digests.groupBy("digest").agg(F.count("*").alias("n")).where("n > 1").select("digest")
    if several.isEmpty():
        return recipes(docs, digest_bits, text, key)
    number = F.row_number().over(Window.partitionBy("digest").orderBy("chunk"))
    variants = digests.join(several, "digest", "left_semi").withColumn("number", number)
    named = _occurrences(docs, digest_bits, text, key).join(variants, ["digest", "chunk"], "left")
    part = F.struct("pos", F.concat("digest", F.encode(F.coalesce(F.col("number"), F.lit(0)).cast("string"), "UTF-8"), F.lit(b";")).alias("id"))
    return named.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"), F.first("text_hash").alias("text_hash"), F.first("points").alias("points"), F.first("text_sha256").alias("text_sha256"),
        F.array_sort(F.collect_list(part)).alias("parts")).select(
        "row", "doc_id", "text_hash", "points", "text_sha256",
        F.aggregate("parts", F.lit(b""), lambda a, x: F.concat(a, x["id"])).alias("recipe"))


def exact_groups(docs: DataFrame, digest_bits: int = 128, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256, text_hash.
    Of equal texts the row with the most code points, then the smallest id,
    then the first in storage order stays."""
    table = save(verified_recipes(docs, digest_bits, text, key), "recipes")
    groups = save(table.groupBy("recipe").agg(
        F.count("*").alias("group_size"), F.min(F.struct(-F.col("points"), "doc_id", "row")).alias("best")), "recipe-groups")
    rows = table.count()
    out = attach(table, groups, "recipe", "group_size", rows)
    return out.select("doc_id", F.col("best.doc_id").alias("keep_id"), "group_size",
                      (F.col("row") == F.col("best.row")).alias("kept"), "text_sha256", "text_hash")
