"""Near duplicates by weighted minwise hashing with darts (DartMinHash).

A text is the multiset of its five-word shingles; a shingle that occurs c times
owns c unit cells of weight.  Hashed darts fall on every cell as a Poisson
process over rank, so a cell's darts are the same in every text.  A text keeps
the darts below a rank that leaves about ``k ln k + 2k`` of them; each dart
belongs to one of ``k`` coordinates, and the earliest dart of a coordinate is
that coordinate of the signature.  A rank bound that leaves a coordinate empty
is doubled.  Two texts agree in a coordinate with the probability of their
weighted Jaccard similarity.

Signatures are joined by bands.  Texts with the same word sequence are one
class from the start.  Connected components of the links that hold for the
whole shingle sets (32-bit hashes of the cells) are the classes; two passes
find them.  The first verifies each text against the one before it in its
bucket that agrees best, which connects nearly all.  The second takes the buckets that still
hold texts of several components, ships their sets once, and verifies in place
every pair across components whose signatures agree enough; so there is no cap
on partners, and only links leave a bucket.  Large buckets are cut into tiles
of bounded rows and bytes.

A text of fewer than five words is one shingle.  A null text or one without
words is a class of its own.  Repeated rows are in one class, and one row
stays.  An empty table gives no rows.  Other input columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terrace.llm.common import attach, meet, mix, partitions, save, save_bucketed, slices, utf8, words
from terrace.llm.components import components

_ODD = [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD]
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _step(n: int) -> np.uint64:
    return np.uint64(n * 0x9E3779B97F4A7C15 & (1 << 64) - 1)


def shingles(data: np.ndarray, offs: np.ndarray, width: int = 5) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, cell hash) of every unit cell, sorted by both, and a
    128-bit hash of every text's word sequence (n, 2)."""
    texts = len(offs) - 1
    h, doc = words(data, offs)
    count = np.bincount(doc, minlength=texts)
    first = np.cumsum(count) - count
    place = np.arange(len(h)) - first[doc]
    whole = np.zeros((texts, 2), np.uint64)
    for side in range(2):
        np.add.at(whole[:, side], doc, mix(h ^ mix(place.astype(np.uint64) + np.uint64(1 + side * 0x5851F42D))))
    long = np.flatnonzero(place + width <= count[doc])
    acc = np.zeros(len(long), np.uint64)
    for t in range(width):
        acc += h[long + t] * np.uint64(_ODD[t])
    short = (count > 0) & (count < width)
    few = np.flatnonzero(short[doc])
    tail = np.zeros(texts, np.uint64)
    np.add.at(tail, doc[few], h[few] * np.array(_ODD, np.uint64)[place[few]])
    acc = np.concatenate([acc, tail[short] + count[short].astype(np.uint64)])
    of = np.concatenate([doc[long], np.flatnonzero(short)])
    order = np.lexsort((acc, of))
    acc, of = mix(acc[order]), of[order]
    new = np.ones(len(acc), bool)
    new[1:] = (acc[1:] != acc[:-1]) | (of[1:] != of[:-1])
    at = np.arange(len(acc))
    again = at - np.maximum.accumulate(np.where(new, at, 0))
    return of, mix(acc + again.astype(np.uint64) * _STEP), whole


def signatures(of: np.ndarray, cells: np.ndarray, texts: int, k: int) -> np.ndarray:
    """(texts, k) dart identifiers; 0 for texts without cells."""
    weight = np.bincount(of, minlength=texts).astype(float)
    darts = k * np.log(k) + 2 * k
    out = np.zeros(texts * k, np.uint64)
    limit = np.where(weight > 0, darts / np.maximum(weight, 1), 0)
    todo = np.arange(len(of))
    while len(todo):
        key, doc = cells[todo], of[todo]
        rank, turn = np.zeros(len(todo)), 0
        best = np.full(texts * k, np.inf)
        met: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        while len(key):
            u = ((mix(key + _step(2 * turn + 1)) >> np.uint64(11)).astype(float) + 0.5) * 2.0 ** -53
            rank = rank - np.log(u)
            live = rank <= limit[doc]
            key, doc, rank = key[live], doc[live], rank[live]
            name = mix(key ^ mix(np.full(1, 2 * turn + 2, np.uint64)))
            slot = doc * k + ((name >> np.uint64(32)) * np.uint64(k) >> np.uint64(32)).astype(np.int64)
            np.minimum.at(best, slot, rank)
            met.append((slot, rank, name))
            turn += 1
        slot, rank, name = (np.concatenate(x) for x in zip(*met))
        first = rank == best[slot]
        slot, name = slot[first], name[first]
        here = np.zeros(texts, bool)
        here[of[todo]] = True
        full = here & np.isfinite(best.reshape(texts, k)).all(axis=1)
        done = full[slot // k]
        out[slot[done]] = name[done]
        limit = limit * 2
        todo = todo[~full[of[todo]]]
    return out.reshape(texts, k)


def _signed(docs: DataFrame, bands: int, rows: int, text: str, key: str) -> DataFrame:
    k = bands * rows

    def run(batches):
        done = 0
        for b in slices(batches, "text", 2 << 20):
            n = b.num_rows
            of, cells, whole = shingles(*utf8(b.column(1)))
            sig = signatures(of, cells, n, k)
            count = np.bincount(of, minlength=n)
            number = (TaskContext.get().partitionId() << 40) + done + np.arange(n)
            done += n
            empty = count == 0
            whole[empty, 0], whole[empty, 1] = 0, number[empty].astype(np.uint64)  # a class of its own
            keys = np.zeros((n, bands), np.uint64)
            for i in range(bands):
                for t in range(rows):
                    keys[:, i] += sig[:, i * rows + t] * np.uint64(_ODD[t % 5] + 2 * t)
                keys[:, i] = mix(keys[:, i] + _step(i))
            low = (cells >> np.uint64(32)).astype(np.uint32)
            low = low[np.lexsort((low, of))]
            once = np.ones(len(low), bool)
            once[1:] = (low[1:] != low[:-1]) | (of[1:] != of[:-1])
            held = np.bincount(of[once], minlength=n)
            low, ends = low[once], np.cumsum(held)
            sets = [low[e - c:e].tobytes() for c, e in zip(held.tolist(), ends.tolist())]
            band_lists = pa.ListArray.from_arrays(
                pa.array(np.concatenate([[0], np.cumsum(np.where(empty, 0, bands))]), pa.int32()), pa.array(keys[~empty].ravel().view(np.int64)))
            sketch = (sig & np.uint64(255)).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([
                pa.array(number, pa.int64()), b.column(0), b.column(2), pa.array([w.tobytes() for w in whole], pa.binary()),
                band_lists, pa.array([s.tobytes() for s in sketch], pa.binary()), pa.array(sets, pa.binary())],
                ["row", "doc_id", "text_hash", "words", "bands", "sketch", "cells"])

    source = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"), F.xxhash64(text).alias("text_hash"))
    return source.mapInArrow(run, "row long, doc_id long, text_hash long, words binary, bands array<long>, sketch binary, cells binary")


def _linked(left: list[bytes], right: list[bytes], similarity: float) -> np.ndarray:
    """Whether the weighted Jaccard similarity of each pair of cell sets (sorted
    32-bit hashes) reaches ``similarity``."""
    out = np.zeros(len(left), bool)
    for s in range(0, len(left), 512):
        raw = [left[s:s + 512], right[s:s + 512]]
        size = np.array([[len(x) // 4 for x in r] for r in raw])
        n = size.shape[1]
        number = np.repeat(np.tile(np.arange(n), 2), size.ravel()).astype(np.uint64) << np.uint64(32)
        both = np.sort(number | np.frombuffer(b"".join(raw[0] + raw[1]), np.uint32).astype(np.uint64))
        same = both[1:][both[1:] == both[:-1]] >> np.uint64(32)
        inter = np.bincount(same.astype(np.int64), minlength=n)
        out[s:s + n] = inter >= similarity * (size.sum(axis=0) - inter) - 1e-9
    return out


def _agreeing(sketch: np.ndarray, label: np.ndarray, side: np.ndarray, least: int, best: bool):
    """Row pairs (later, earlier) of one tile that agree in ``least``
    coordinates, of different labels and, where the tile has two sides, of
    different sides: all of them, or the ``best`` one of each later row."""
    n, two = len(sketch), bool(side.min() != side.max())
    for s in range(0, n, 128):
        rows = np.arange(s, min(s + 128, n))
        agree = np.empty((len(rows), n), np.int16)
        for c in range(0, n, 512):
            agree[:, c:c + 512] = (sketch[rows, None, :] == sketch[None, c:c + 512, :]).sum(axis=2, dtype=np.int16)
        ok = (agree >= least) & (label[rows, None] != label[None, :]) & (rows[:, None] > np.arange(n)[None, :])
        if two:
            ok &= side[rows, None] != side[None, :]
        if best:
            agree[~ok] = -1
            j = agree.argmax(axis=1)
            i = np.flatnonzero(agree[np.arange(len(rows)), j] >= 0)
            yield rows[i], j[i]
        else:
            i, j = np.nonzero(ok)
            yield rows[i], j


def _pairs(members: DataFrame, least: int, tile: int, similarity: float | None) -> DataFrame:
    """(a, b), a < b, from rows (band, n, bytes, rep, label, sketch, cells) of
    buckets: the best one of each row, to be verified, or with ``similarity``
    all pairs that reach it."""
    blocks = F.greatest(F.ceil(F.col("n") / tile), F.ceil(F.col("bytes") / (tile << 12))).cast("int")
    own = F.pmod(F.xxhash64("rep"), blocks).cast("int")
    tiled = members.select("band", blocks.alias("nb"), own.alias("own"), "rep", "label", "sketch", "cells").select(
        "band", "own", "rep", "label", "sketch", "cells", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)).alias("other")).select(
        "band", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "rep", "label", "sketch", "cells")
    dealt = tiled.repartition(partitions(members.sparkSession), "band", "i", "j").sortWithinPartitions("band", "i", "j", "rep")

    def found(t: pa.Table) -> pa.RecordBatch:
        band, i, j, own, rep, label = (t.column(c).to_numpy() for c in range(6))
        k = len(t.column(6)[0].as_py())
        sketch = np.frombuffer(b"".join(t.column(6).to_pylist()), np.uint8).reshape(-1, k)
        cells = t.column(7).to_pylist() if similarity is not None else None
        new = np.ones(len(band), bool)
        new[1:] = (band[1:] != band[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])
        start = np.flatnonzero(new)
        size = np.diff(np.append(start, len(band)))
        a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]

        def take(x, y):
            if cells is not None and len(x):
                ok = _linked([cells[c] for c in x.tolist()], [cells[c] for c in y.tolist()], similarity)
                x, y = x[ok], y[ok]
            a.append(x)
            b.append(y)

        for n in np.unique(size[(size > 1) & (size <= 8)]).tolist():  # small tiles: all of one size at once
            for c in range(0, int((size == n).sum()), 4096):
                at = start[size == n][c:c + 4096]
                for q in range(1, n):
                    y = at[:, None] + np.arange(q)
                    x = np.broadcast_to(at[:, None] + q, y.shape)
                    agree = (sketch[x] == sketch[y]).sum(axis=2)
                    ok = (agree >= least) & (label[x] != label[y]) & ((i[x] == j[x]) | (own[x] != own[y]))
                    if similarity is None:
                        first = np.where(ok, agree, -1).argmax(axis=1)[:, None] == np.arange(q)
                        ok &= first
                    take(x[ok], y[ok])
        for s, n in zip(start[size > 8].tolist(), size[size > 8].tolist()):
            part = slice(s, s + n)
            side = own[part] if i[s] != j[s] else np.zeros(n, np.int64)
            if (i[s] != j[s] and side.min() == side.max()) or label[part].min() == label[part].max():
                continue
            for x, y in _agreeing(sketch[part], label[part], side, least, similarity is None):
                take(s + x, s + y)
        x, y = rep[np.concatenate(a)], rep[np.concatenate(b)]
        both = np.unique(np.stack([np.minimum(x, y), np.maximum(x, y)], axis=1), axis=0) if len(x) else np.zeros((0, 2), np.int64)
        return pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], ["a", "b"])

    def run(batches):
        kept = None  # the rows of the last tile, which the next batch may go on with
        for batch in batches:
            t = pa.Table.from_batches([batch])
            t = pa.concat_tables([kept, t]) if kept is not None else t
            if t.num_rows == 0:
                continue
            t = t.combine_chunks()
            band, i, j = (t.column(c).to_numpy() for c in range(3))
            other = np.flatnonzero((band != band[-1]) | (i != i[-1]) | (j != j[-1]))
            last = int(other[-1]) + 1 if len(other) else 0
            if last:
                yield found(t.slice(0, last).combine_chunks())
            kept = t.slice(last)
        if kept is not None and kept.num_rows:
            yield found(kept.combine_chunks())

    return dealt.mapInArrow(run, "a long, b long").distinct()


def _verified(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs whose whole cell sets reach the similarity."""
    def run(batches):
        for b in batches:
            ok = pa.array(_linked(b.column(2).to_pylist(), b.column(3).to_pylist(), similarity))
            yield pa.RecordBatch.from_arrays([b.column(0).filter(ok), b.column(1).filter(ok)], ["a", "b"])

    left = sets.select(F.col("row").alias("a"), F.col("cells").alias("x"))
    right = sets.select(F.col("row").alias("b"), F.col("cells").alias("y"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def _relabel(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels after ``links`` too: components of the links between old labels."""
    old = labels.select(F.col("node").alias("n_"), F.col("label").alias("l_"))
    ends = links.join(old, F.col("a") == F.col("n_"), "left").withColumn("a", F.coalesce("l_", "a")).drop("n_", "l_")
    ends = ends.join(old, F.col("b") == F.col("n_"), "left").withColumn("b", F.coalesce("l_", "b")).drop("n_", "l_")
    merged = components(ends).toDF("n_", "l_")
    named = labels.join(merged, F.col("label") == F.col("n_"), "left").select("node", F.coalesce("l_", "label").alias("label"))
    return save(named.unionByName(merged.join(labels.select(F.col("node").alias("x")), F.col("n_") == F.col("x"), "left_anti")
                                  .select(F.col("n_").alias("node"), F.col("l_").alias("label"))), "darts-labels")


def near_classes(docs: DataFrame, similarity: float = 0.8, bands: int = 24, rows: int = 5, margin: float = 0.15,
                 tile: int = 2048, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per input row: doc_id, class_id (smallest id of the class),
    class_size, kept (one row of each class), text_hash."""
    # wide rows stay where they were written: they are bucketed by the task that
    # wrote them, which every row number holds, and the narrow side comes to them
    part = F.shiftright("row", 40).alias("part")
    table = save_bucketed(_signed(docs, bands, rows, text, key).select("*", part), "darts", "part")
    same = save(table.groupBy("words").agg(F.count("*").alias("copies"), F.min(F.struct("row", "bands")).alias("m"))
                .select("words", "copies", F.col("m.row").alias("rep"), F.col("m.bands").alias("bands")), "darts-same")
    band = save(same.select(F.explode("bands").alias("band"), "rep"), "darts-bands")
    counts = band.groupBy("band").agg(F.count("*").alias("n")).where("n > 1")
    members = save(meet(band, save(counts, "darts-counts"), "band", "n", band.count()), "darts-buckets")
    active = members.select(F.shiftright("rep", 40).alias("part"), F.col("rep").alias("row")).distinct()
    sets = save(table.select("part", "row", "sketch", "cells").join(active, ["part", "row"]).drop("part"), "darts-active")
    least = int(bands * rows * (similarity - margin))
    sketches = sets.select(F.col("row").alias("rep"), "sketch", "cells")
    light = members.join(sketches.drop("cells"), "rep").select(
        "band", "n", F.lit(0).alias("bytes"), "rep", F.col("rep").alias("label"), "sketch", F.lit(None).cast("binary").alias("cells"))
    links = save(_verified(_pairs(light, least, tile, None), sets, similarity), "darts-links")
    labels = components(links)
    sizes = sets.select(F.col("row").alias("rep"), F.octet_length("cells").cast("long").alias("size"))
    named = members.join(labels.withColumnRenamed("node", "rep"), "rep", "left").withColumn("label", F.coalesce("label", "rep"))
    named = save(named.join(sizes, "rep"), "darts-members")
    # buckets that hold texts of several components, from narrow rows
    apart = named.groupBy("band").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.sum("size").alias("bytes"),
                                      F.max("n").alias("many")).where("lo <> hi").select("band", "bytes", "many")
    apart = meet(named.select("band", "n", "rep", "label"), save(apart, "darts-apart"), "band", "many", named.count())
    more = save(_pairs(apart.join(sketches, "rep"), least, tile, similarity), "darts-links")
    if not more.isEmpty():
        labels = _relabel(labels, more)
    rows_ = table.select("row", "doc_id", "text_hash", "words")
    total = rows_.count()
    named = attach(rows_, same.select("words", "copies", "rep"), "words", "copies", total)
    named = named.join(labels.withColumnRenamed("node", "rep"), "rep", "left").withColumn("label", F.coalesce("label", "rep"))
    named = save(named.select("row", "doc_id", "text_hash", "label"), "darts-named")
    classes = save(named.groupBy("label").agg(F.count("*").alias("class_size"), F.min(F.struct("doc_id", "row")).alias("best")), "darts-classes")
    out = attach(named, classes, "label", "class_size", total)
    return out.select("doc_id", F.col("best.doc_id").alias("class_id"), "class_size", (F.col("row") == F.col("best.row")).alias("kept"), "text_hash")
