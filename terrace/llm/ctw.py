"""Language-model scores by context-tree weighting over bytes.

A byte is eight binary decisions; the bits before a decision choose one of 255
binary models (``m``, a heap number).  Each model is a context tree over the
bytes before: a node of depth d stands for the last d bytes, counts the zeros
and ones seen there, and weighs its Krichevsky-Trofimov estimate against the
product of its children, down to ``depth``.  So a decision's probability mixes
the estimates of all depths, and the code length of a text is the sum over its
bytes.  A text is preceded by, and closed with, byte 255, which UTF-8 never has.

How it is spread: a chunk of documents ships each distinct gram (context and
byte) once with its training count; grams are dealt by their last two context
bytes, so every subtree below depth 2 is in one bucket; the nodes of depth 1
and 0 (at most 255 * 257, whatever the corpus) are merged on the driver; the
buckets then answer each chunk with the log probabilities of its grams, and
chunks score their documents.  Words are counted and answered the same way for
the unigram base score.

Nulls count as empty texts: they have the closing byte and the end word.  A row
whose id is null is learnt from.  Repeated rows count as often as they occur.
With nothing to learn from, every decision has probability one half.  Other
input columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.llm.common import lower, partitions, save, slices, utf8, word_spans

EDGE = 255
#: Bytes of text in a chunk, about.
CHUNK = 32 << 20
#: Chunks that a bucket's task reads at most before another level of merging.
FAN_IN = 1024


def grams(data: np.ndarray, offs: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Gram of every byte and of the closing one (the latest context byte
    highest, the byte itself lowest), and the number of grams of each text."""
    size = np.diff(offs)
    texts, room = len(size), size + depth + 1
    line = np.full(8 + int(room.sum()), EDGE, np.uint8)  # per text: depth edges, its bytes, one edge
    real = np.zeros(len(line), bool)
    start = 8 + np.cumsum(room) - room + depth
    turn = np.zeros(len(line) + 1, np.int8)
    np.add.at(turn, start, 1)
    np.add.at(turn, start + size, -1)
    inside = np.cumsum(turn[:-1], dtype=np.int8).astype(bool)
    line[inside] = lower(data)
    real[:] = inside
    real[start + size] = True
    eight = np.ndarray((len(line) - 7,), "<u8", line.tobytes(), strides=(1,))[real[7:]]  # the byte highest, then those before it
    context = (eight >> np.uint64(56 - 8 * depth)) & np.uint64((1 << (8 * depth)) - 1)
    return context << np.uint64(8) | eight >> np.uint64(56), size + 1


def distinct(sorted_keys: np.ndarray) -> np.ndarray:
    """First places of equal keys."""
    return np.flatnonzero(np.append(True, sorted_keys[1:] != sorted_keys[:-1])) if len(sorted_keys) else np.zeros(0, np.int64)


class Lookup:
    """Values of known keys: one probe of a table four times their number, the
    keys that collide there by bisection."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.shift = np.uint64(64 - max(4, int(4 * len(keys)).bit_length()))
        self.table = np.zeros(1 << int(64 - self.shift), np.uint64)
        self.value = np.zeros(len(self.table), values.dtype)
        at = self._at(keys)
        self.table[at], self.value[at] = keys, values
        lost = self.table[at] != keys
        self.rest, self.rest_values = keys[lost], values[lost]

    def _at(self, keys):
        return (keys * np.uint64(0x9E3779B97F4A7C15) >> self.shift).astype(np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        at = self._at(keys)
        out = self.value[at]
        lost = np.flatnonzero(self.table[at] != keys)
        if len(lost):
            out[lost] = self.rest_values[np.searchsorted(self.rest, keys[lost])]
        return out


def lgamma(x: np.ndarray) -> np.ndarray:
    """log gamma for x >= 0.5 (Stirling's series after shifting by eight)."""
    shift = np.zeros_like(x)
    for i in range(8):
        shift += np.log(x + i)
    y = x + 8
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + 1 / (12 * y) - 1 / (360 * y ** 3) + 1 / (1260 * y ** 5) - shift


def kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """log of the Krichevsky-Trofimov block probability."""
    return lgamma(zeros + 0.5) + lgamma(ones + 0.5) - lgamma(zeros + ones + 1.0) - np.log(np.pi)


def decisions(gram: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(model, bit) of the eight decisions of each gram's byte, (8, n)."""
    byte = (gram & np.uint64(255)).astype(np.int64)
    j = np.arange(8)[:, None]
    return (1 << j) | (byte >> (8 - j)), (byte >> (7 - j)) & 1


class Nodes:
    """Nodes of one depth: key (context << 8 | model), counts, log of the
    weighted probability and the weight of the node's own estimate."""

    def __init__(self, key, zeros, ones, below):
        self.key, self.zeros, self.ones = key, zeros, ones
        own = kt(zeros, ones)
        self.prob = own if below is None else np.logaddexp(own, below) + np.log(0.5)
        self.weight = np.ones(len(key)) if below is None else np.exp(np.log(0.5) + own - self.prob)

    def find(self, key):
        """Index of each key, and whether it is there."""
        if len(self.key) == 0:
            return np.zeros(len(key), np.int64), np.zeros(len(key), bool)
        at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        return at, self.key[at] == key


def leaves(gram: np.ndarray, count: np.ndarray) -> Nodes:
    model, bit = decisions(gram)
    key, at = np.unique(((gram >> np.uint64(8)) << np.uint64(8) | model.astype(np.uint64)).ravel(), return_inverse=True)
    n = np.tile(count.astype(float), 8)
    ones = np.bincount(at, n * bit.ravel(), len(key))
    return Nodes(key, np.bincount(at, n, len(key)) - ones, ones, None)


def parents(nodes: Nodes) -> Nodes:
    """The nodes with one context byte less."""
    key, at = np.unique((nodes.key >> np.uint64(16)) << np.uint64(8) | (nodes.key & np.uint64(255)), return_inverse=True)
    return Nodes(key, np.bincount(at, nodes.zeros, len(key)), np.bincount(at, nodes.ones, len(key)), np.bincount(at, nodes.prob, len(key)))


def levels(gram: np.ndarray, count: np.ndarray, depth: int, top: int) -> list[Nodes]:
    """Nodes of depth ``depth`` up to ``top``."""
    out = [leaves(gram, count)]
    for _ in range(depth - top):
        out.append(parents(out[-1]))
    return out


def code(gram: np.ndarray, nodes: list[Nodes], depth: int) -> np.ndarray:
    """log10 probability of each gram's byte; ``nodes`` run from ``depth`` to 0."""
    model, bit = decisions(gram)
    total = np.zeros(len(gram))
    for j in range(8):
        p = np.full(len(gram), 0.5)
        for d, level in zip(range(depth, -1, -1), nodes):
            key = (gram >> np.uint64(8 * (depth + 1 - d))) << np.uint64(8) | model[j].astype(np.uint64)
            if d == 0:
                key &= np.uint64(255)
            at, there = level.find(key)
            if not len(level.key):
                continue
            ones, zeros = level.ones[at], level.zeros[at]
            own = (np.where(bit[j] == 1, ones, zeros) + 0.5) / (ones + zeros + 1.0)
            # a node never seen weighs one half against one half: its estimate and all below are 1/2
            p = np.where(there, level.weight[at] * own + (1 - level.weight[at]) * p, 0.5)
        total += np.log10(p)
    return total


def _bytes(x: np.ndarray) -> bytes:
    return np.ascontiguousarray(x).tobytes()


def _pack(sorted_keys: np.ndarray) -> bytes:
    """Sorted keys as their steps, which compress well."""
    return np.diff(sorted_keys, prepend=np.uint64(0)).tobytes()


def _unpack(raw: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(raw, np.uint64), dtype=np.uint64)


def _bucket(gram: np.ndarray, depth: int, buckets: int) -> np.ndarray:
    return (((gram >> np.uint64(8 * (depth - 1))) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)) % np.uint64(buckets)).astype(np.int64)


class _Tables:
    """Distinct grams and words of a chunk with training counts."""

    def __init__(self, depth: int):
        self.depth, self.grams, self.words = depth, [], []

    def add(self, data, offs, train):
        key, size = grams(data, offs, self.depth)
        both = np.sort(key << np.uint64(1) | np.repeat(train, size).astype(np.uint64))
        first = distinct(both >> np.uint64(1))
        count = np.add.reduceat(both & np.uint64(1), first).astype(np.int64) if len(first) else np.zeros(0, np.int64)
        self.grams.append((both[first] >> np.uint64(1), count))
        start, end, h, of = word_spans(data, offs)
        some, first, which = np.unique(h, return_index=True, return_inverse=True)
        raw = lower(data).tobytes()
        names = [raw[s:e] for s, e in zip(start[first].tolist(), end[first].tolist())]
        self.words.append((some, np.bincount(which, train[of], len(some)).astype(np.int64), names))

    def merged(self):
        key, at = np.unique(np.concatenate([g for g, _ in self.grams]), return_inverse=True)
        count = np.bincount(at, np.concatenate([c for _, c in self.grams]), len(key)).astype(np.int64)
        h, first, at = np.unique(np.concatenate([w[0] for w in self.words]), return_index=True, return_inverse=True)
        times = np.bincount(at, np.concatenate([w[1] for w in self.words]), len(h)).astype(np.int64)
        names = [x for w in self.words for x in w[2]]
        return key, count, h, times, [names[i] for i in first.tolist()]


def _known(parts: list[np.ndarray]) -> np.ndarray:
    """The distinct keys of several arrays, in order."""
    keys = np.sort(np.concatenate(parts))
    return keys[distinct(keys)]


def _dealt(values: np.ndarray, buckets: int):
    order = np.argsort(values, kind="stable")
    cut = np.searchsorted(values[order], np.arange(buckets + 1))
    return [order[s:e] for s, e in zip(cut[:-1], cut[1:])]


def _chunked(batches, text: int):
    """(chunk number, slices of it): the same for every run over one split."""
    part, number, held, size = TaskContext.get().partitionId(), 0, [], 0
    for b in slices(batches, "text", 2 << 20):
        held.append(b)
        size += len(utf8(b.column(text))[0])
        if size >= CHUNK:
            yield (part << 24) | number, held
            number, held, size = number + 1, [], 0
    if held:
        yield (part << 24) | number, held


_MODEL = "bucket int, grams binary, counts binary, words binary, times binary"


def score_texts(docs: DataFrame, held_out: Column, depth: int = 5, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens,
    base_score, score, n_bytes and code length in bits per byte.  Learns from
    the rows where ``held_out`` is not true."""
    if not 2 <= depth <= 6:
        raise ValueError("depth must lie between 2 and 6")
    buckets = partitions(docs.sparkSession)
    source = docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"),
                         F.coalesce(held_out, F.lit(False)).alias("held_out"))

    def gather(batches):
        for chunk, parts in _chunked(batches, 1):
            tables = _Tables(depth)
            for b in parts:
                data, offs = utf8(b.column(1))
                tables.add(data, offs, ~b.column(2).to_numpy(zero_copy_only=False).astype(bool))
            gram, count, h, times, names = tables.merged()
            g = _dealt(_bucket(gram, depth, buckets), buckets)
            w = _dealt((h % np.uint64(buckets)).astype(np.int64), buckets)
            full = [r for r in range(buckets) if len(g[r]) or len(w[r])]
            yield pa.RecordBatch.from_arrays([
                pa.array(full, pa.int32()), pa.array([chunk] * len(full), pa.int64()),
                pa.array([_pack(gram[g[r]]) for r in full], pa.binary()), pa.array([_bytes(count[g[r]].astype(np.uint32)) for r in full], pa.binary()),
                pa.array([b" ".join([names[i] for i in w[r].tolist()]) for r in full], pa.binary()),
                pa.array([_bytes(times[w[r]].astype(np.uint32)) for r in full], pa.binary())],
                ["bucket", "chunk", "grams", "counts", "words", "times"])

    def merge(t: pa.Table, narrow) -> pa.Table:
        gram = np.concatenate([_unpack(x) for x in t.column("grams").to_pylist()])
        count = np.frombuffer(b"".join(t.column("counts").to_pylist()), narrow)
        some = count > 0
        gram, at = np.unique(gram[some], return_inverse=True)
        count = np.bincount(at, count[some], len(gram)).astype(np.int64)
        times: dict[bytes, int] = {}
        for names, n in zip(t.column("words").to_pylist(), t.column("times").to_pylist()):
            for x, c in zip(names.split(b" "), np.frombuffer(n, narrow).tolist()):
                if c:
                    times[x] = times.get(x, 0) + c
        return pa.Table.from_arrays([
            pa.array([t.column("bucket")[0].as_py()], pa.int32()), pa.array([_pack(gram)], pa.binary()), pa.array([_bytes(count)], pa.binary()),
            pa.array([b" ".join(times)], pa.binary()), pa.array([_bytes(np.fromiter(times.values(), np.int64, len(times)))], pa.binary())],
            ["bucket", "grams", "counts", "words", "times"])

    def heads(batches):
        """Sums over depth-2 nodes for their parents, and word totals."""
        for b in batches:
            for gram, count, times in zip(*[b.column(c).to_pylist() for c in (1, 2, 4)]):
                gram, count, times = _unpack(gram), np.frombuffer(count, np.int64), np.frombuffer(times, np.int64)
                below = levels(gram, count, depth, 2)[-1]
                node, at = np.unique((below.key >> np.uint64(16)) << np.uint64(8) | (below.key & np.uint64(255)), return_inverse=True)
                sums = [np.bincount(at, x, len(node)) for x in (below.zeros, below.ones, below.prob)]
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.append(node.astype(np.int64), -1)), pa.array(np.append(sums[0], times.sum()).astype(float)),
                    pa.array(np.append(sums[1], len(times)).astype(float)), pa.array(np.append(sums[2], 0.0).astype(float))],
                    ["node", "zeros", "ones", "below"])

    table = save(source.mapInArrow(gather, "bucket int, chunk long, grams binary, counts binary, words binary, times binary"), "ctw-grams")
    chunks = table.agg(F.count_distinct("chunk")).first()[0]
    fan = max(1, -(-chunks // FAN_IN))
    counts = table.withColumn("salt", F.pmod(F.xxhash64("chunk"), F.lit(fan)))
    first = np.uint32
    model = counts.groupBy("bucket", "salt").applyInArrow(lambda t: merge(t, first), _MODEL)
    if fan > 1:
        model = model.groupBy("bucket").applyInArrow(lambda t: merge(t, np.int64), _MODEL)
    model = save(model, "ctw-model")
    upper = model.mapInArrow(heads, "node long, zeros double, ones double, below double").groupBy("node").agg(
        F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"), F.sum("below").alias("below")).toPandas().sort_values("node")  # at most 255 * 256 + 1 rows
    ends = source.where(~F.col("held_out")).count()
    words = upper[upper["node"] < 0]
    tokens = int(words["zeros"].sum()) + ends
    types = int(words["ones"].sum()) + (ends > 0)
    small = tokens < 1 << 32  # then counts travel as 32 bits
    upper = upper[upper["node"] >= 0]
    one = Nodes(upper["node"].to_numpy(np.uint64), upper["zeros"].to_numpy(float), upper["ones"].to_numpy(float), upper["below"].to_numpy(float))
    zero = parents(one)

    def answer(asked: pa.Table, known: pa.Table) -> pa.Table:
        """For each chunk the log probabilities of its grams and the counts of
        its words, in the order in which the chunk holds them."""
        raw = [_unpack(x) for x in asked.column("grams").to_pylist()]
        some = np.unique(np.concatenate(raw)) if raw else np.zeros(0, np.uint64)
        if known.num_rows:
            gram, count = _unpack(known.column("grams")[0].as_py()), np.frombuffer(known.column("counts")[0].as_py(), np.int64)
            times = dict(zip(known.column("words")[0].as_py().split(b" "), np.frombuffer(known.column("times")[0].as_py(), np.int64).tolist()))
        else:
            gram, count, times = np.zeros(0, np.uint64), np.zeros(0, np.int64), {}
        nodes = levels(gram, count, depth, 2) + [one, zero]
        prob = np.concatenate([code(some[s:s + (1 << 18)], nodes, depth) for s in range(0, len(some), 1 << 18)] or [np.zeros(0)])
        lists = [x.split(b" ") if x else [] for x in asked.column("words").to_pylist()]
        return pa.Table.from_arrays([
            asked.column("chunk"), asked.column("bucket"),
            pa.array([_bytes(prob[np.searchsorted(some, g)].astype(np.float32)) for g in raw], pa.binary()),
            pa.array([_bytes(np.array([times.get(x, 0) for x in ws], np.uint32 if small else np.int64)) for ws in lists], pa.binary())],
            ["chunk", "bucket", "probs", "times"])

    def mark(batches):
        for chunk, parts in _chunked(batches, 1):
            for b in parts:
                yield pa.RecordBatch.from_arrays([pa.array([chunk] * b.num_rows, pa.int64()), *b.columns], ["chunk", *b.schema.names])

    def judge(texts: pa.Table, told: pa.Table) -> pa.Table:
        parts = [b for b in slices(texts.to_batches(), "text", 2 << 20)]
        if not parts:
            return pa.Table.from_arrays([pa.array([], f.type) for f in schema], schema=schema)
        gram, h = [], []
        for b in parts:
            data, offs = utf8(b.column(2))
            gram.append(_known([grams(data, offs, depth)[0]]))
            h.append(_known([word_spans(data, offs)[2]]))
        gram, h = _known(gram), _known(h)
        probs, times = np.zeros(len(gram)), np.zeros(len(h), np.int64)
        g, w = _dealt(_bucket(gram, depth, buckets), buckets), _dealt((h % np.uint64(buckets)).astype(np.int64), buckets)
        for r, p, t in zip(*[told.column(c).to_pylist() for c in ("bucket", "probs", "times")]):
            probs[g[r]] = np.frombuffer(p, np.float32)
            times[w[r]] = np.frombuffer(t, np.uint32 if small else np.int64)
        cost = np.log10((times + 0.5) / (tokens + 0.5 * (types + 1)))
        end = np.log10((ends + 0.5) / (tokens + 0.5 * (types + 1)))
        by_gram, by_word = Lookup(gram, probs), Lookup(h, np.where(times > 0, cost, -cost))  # unknown words above zero
        out = []
        for b in parts:
            n = b.num_rows
            data, offs = utf8(b.column(2))
            key, size = grams(data, offs, depth)
            score = np.add.reduceat(by_gram(key), np.cumsum(size) - size)
            _, _, word, of = word_spans(data, offs)
            price = by_word(word)
            out.append(pa.RecordBatch.from_arrays([
                b.column(1), b.column(3), pa.array(np.bincount(of, minlength=n) + 1),
                pa.array(np.bincount(of, price < 0, n).astype(np.int64) + int(ends > 0)), pa.array(np.full(n, tokens, np.int64)),
                pa.array(np.bincount(of, -np.abs(price), n) + end), pa.array(score), pa.array(size - 1),
                pa.array(-score / np.log10(2) / size)], schema=schema))
        return pa.Table.from_batches(out, schema)

    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
                        ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64()), ("n_bytes", pa.int64()),
                        ("bits_per_byte", pa.float64())])
    salted = model.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(fan - 1)).cast("array<long>")))
    asked = counts.select("bucket", "salt", "chunk", "grams", "words")
    answers = asked.groupBy("bucket", "salt").cogroup(salted.select(
        F.col("bucket").alias("bucket_"), F.col("salt").alias("salt_"), "grams", "counts", "words", "times").groupBy("bucket_", "salt_")).applyInArrow(
        answer, "chunk long, bucket int, probs binary, times binary")
    marked = source.mapInArrow(mark, "chunk long, doc_id long, text string, held_out boolean")
    return marked.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(
        judge, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, "
               "n_bytes long, bits_per_byte double")
