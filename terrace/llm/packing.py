"""Mixture-controlled packing by deficit round-robin over source queues.

Every source is a queue of tokenised documents.  Each window of ``window``
ids takes a quantum from every queue in proportion to the target weights; what
a quantum lacks of a whole id is carried as that queue's deficit into the next
window, across tasks too, because a queue's running total after any number of
windows has a closed form.  When a queue runs dry its share goes to the others
and a new phase of the schedule begins.  So a window's content is a pure
function of its number, and tasks cut their documents without seeing others.

More sources than a window can serve directly share queues whose order is a
schedule of its own with small windows, and so on down a tree: every source
keeps its proportion.  What a dry source leaves goes to its own group first.

Nulls: a null text is empty and still gets its end id; a null source is a queue
of its own.  Repeated rows are packed as often as they occur.  An empty table
gives no rows.  Other input columns are not read.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.llm.common import save, slices, span_hashes, utf8

#: Sources with a queue at most: a window of that many ids has no room for one id
#: of more.  Those with fewer tokens share one more queue, in the order of the parts.
MAX_QUEUES = 4096
#: Queues of a schedule inside a queue; its windows hold the square of that.
FAN = 8
#: Fraction bits of a queue's quantum.
FRACTION = 16

#: White space of the tokenizer's rules (fixed values).
_BLANK = re.compile("[\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
# Byte classes of plain texts (ASCII, and the letters U+00C0 to U+00FF but for
# the two signs among them): 0 white space, 1 letter, 2 digit, 3 other, 9 not plain.
_CLASS = np.full(256, 9, np.uint8)
_CLASS[33:127] = 3
_CLASS[[9, 10, 11, 12, 13, 32]] = 0
_CLASS[48:58] = 2
_CLASS[65:91] = _CLASS[97:123] = _CLASS[0x80:0xC0] = _CLASS[0xC3] = 1
_SMALL = np.arange(256, dtype=np.uint8)
_SMALL[65:91] += 32


def _plain(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Small letters, byte classes, and which of the texts are plain: there the
    tokenizer's rules cut between classes and around each digit.  An apostrophe
    before a letter may begin a piece of its own, so such texts are not plain."""
    kind, low = _CLASS[data], _SMALL[data]
    lead = np.zeros(len(data), bool)
    lead[1:] = data[:-1] == 0xC3
    low[lead & (data >= 0x80) & (data <= 0x9E)] += 32
    odd = (kind == 9) | (((data >= 0x80) & (data < 0xC0)) & ~lead) | (lead & ((data == 0x97) | (data == 0xB7)))
    odd[:-1] |= (data[:-1] == 39) & (kind[1:] == 1)
    bad = np.zeros(len(offs), np.int64)
    np.cumsum(np.bincount(np.searchsorted(offs, np.flatnonzero(odd), "right") - 1, minlength=len(offs) - 1), out=bad[1:])
    return low, kind, bad[1:] == bad[:-1]


class PieceTokenizer:
    """Ids of a tokenizer that drops white space and never joins two words,
    with bounded tables of the pieces met so far."""

    def __init__(self, path: str, most: int = 400_000):
        from tokenizers import Tokenizer, normalizers, pre_tokenizers
        self.whole = Tokenizer.from_file(path)
        self.whole.encode_special_tokens = True
        self.bare = Tokenizer.from_file(path)
        self.bare.encode_special_tokens = True
        self.bare.normalizer = normalizers.Sequence([])
        self.bare.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.Split(" ", "removed"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        size = self.whole.get_vocab_size()
        if size > 1 << 16:
            raise ValueError("ids are stored in 16 bits")
        self.ends = np.zeros(size, bool)
        for token, i in self.whole.get_vocab().items():
            self.ends[i] = token.endswith("</w>")
        self.pieces: dict[bytes, bytes] = {}
        self.words: dict[str, bytes] = {}
        self.most = most

    def _learn(self, new: list[bytes]) -> None:
        for i in range(0, len(new), 2000):
            part = new[i:i + 2000]
            ids = np.array(self.bare.encode(b" ".join(part).decode(), add_special_tokens=False).ids, np.int64)
            last = np.flatnonzero(self.ends[ids]) + 1
            if len(last) != len(part):
                raise AssertionError("pieces and ends of words differ")
            raw, start = ids.astype(np.uint16).tobytes(), 0
            for p, e in zip(part, last.tolist()):
                self.pieces[p] = raw[2 * start:2 * e]
                start = e

    def _odd(self, text: str) -> bytes:
        """Ids of a text that is not plain, word by word."""
        out = []
        for w in _BLANK.split(text):
            ids = self.words.get(w)
            if ids is None:
                if len(self.words) >= self.most // 8:
                    self.words = {}
                ids = self.words[w] = np.array(self.whole.encode(w, add_special_tokens=False).ids, np.uint16).tobytes()
            out.append(ids)
        return b"".join(out)

    def encode(self, data: np.ndarray, offs: np.ndarray) -> list[bytes]:
        """Little-endian 16-bit ids of each of the texts."""
        n = len(offs) - 1
        low, kind, plain = _plain(data, offs)
        odd = {int(i): self._odd(data[offs[i]:offs[i + 1]].tobytes().decode("utf-8", "replace")) for i in np.flatnonzero(~plain)}
        first = kind != 0
        if len(data):
            first[1:] &= (kind[1:] != kind[:-1]) | (kind[1:] == 2)
            edge = offs[1:-1][offs[1:-1] < len(data)]
            first[edge] = kind[edge] != 0
        starts = np.flatnonzero(first)
        solid = np.append(kind != 0, False)
        stop = np.zeros(len(data) + 1, bool)
        stop[starts] = True
        stop[offs] = True
        stop[1:] |= solid[:-1] & ~solid[1:]
        stops = np.flatnonzero(stop)
        ends = stops[np.searchsorted(stops, starts, "right")] if len(starts) else starts
        text = np.searchsorted(offs, starts, "right") - 1
        keep = plain[text] if n else np.zeros(0, bool)
        starts, ends, text = starts[keep], ends[keep], text[keep]
        hashes = span_hashes(low, starts, ends)
        _, some, which = np.unique(hashes, return_index=True, return_inverse=True)
        raw = low.tobytes()
        met = [raw[s:e] for s, e in zip(starts[some].tolist(), ends[some].tolist())]
        new = [p for p in met if p not in self.pieces]
        if len(self.pieces) + len(new) > self.most:
            self.pieces = {}  # bounds memory; what this batch needs is learnt again
            new = met
        self._learn(new)
        found = [self.pieces[p] for p in met]
        size = np.fromiter(map(len, found), np.int64, len(found)) // 2
        at = np.cumsum(size) - size
        table = np.frombuffer(b"".join(found), np.uint16)
        lens = size[which]
        base = np.cumsum(lens) - lens
        ids = table[np.repeat(at[which] - base, lens) + np.arange(int(lens.sum()))].tobytes()
        cut = np.zeros(n + 1, np.int64)
        np.cumsum(np.bincount(text, weights=lens, minlength=n).astype(np.int64), out=cut[1:])
        return [odd[i] if i in odd else ids[2 * s:2 * e] for i, (s, e) in enumerate(zip(cut[:-1].tolist(), cut[1:].tolist()))]


_TOKENIZERS: dict[str, PieceTokenizer] = {}


def tokenizer(path: str) -> PieceTokenizer:
    """One tokenizer a worker process, so that its tables last over tasks."""
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = PieceTokenizer(path)
    return _TOKENIZERS[path]


class Schedule:
    """Deficit round-robin over queues of ``totals`` ids with ``weights``.

    Phase ``p`` starts at window ``first[p]``; after ``j`` of its windows queue
    ``s`` has given ``base[p, s] + (quantum[p, s] * j >> FRACTION)`` ids, and the
    queue ``rest[p]`` whatever fills the windows.  The bits below FRACTION are
    the deficit that a queue carries on.
    """

    def __init__(self, totals: list[int], weights: list[float], window: int):
        left = [int(t) for t in totals]
        many = len(left)
        if many * many > window:
            raise ValueError("a window must hold the square of the number of queues")
        first, base, quantum, rest, n = [], [], [], [], 0
        done = [0] * many
        while sum(left) > 0:
            share = [w if r > 0 else 0.0 for w, r in zip(weights, left)]
            if sum(share) <= 0:
                share = [float(r > 0) for r in left]
            whole = sum(share)
            share = [x / whole for x in share]
            big = max(range(many), key=lambda s: share[s])
            q = [int(window * x * (1 << FRACTION)) for x in share]
            rate = (window << FRACTION) - sum(q) + q[big]
            runs = [(((left[s] + 1) << FRACTION) - 1) // q[s] for s in range(many) if s != big and q[s] > 0]
            runs.append(((left[big] - many) << FRACTION) // rate)
            k = min(min(runs), sum(left) // window)
            if k < 1:  # a queue runs dry in this window: its part goes to the others
                k, give = 1, [min(r, int(window * x)) for r, x in zip(left, share)]
                for s in sorted(range(many), key=lambda s: -share[s]):
                    give[s] += min(left[s] - give[s], window - sum(give))
                q = [g << FRACTION for g in give]
            first.append(n)
            base.append(list(done))
            quantum.append(q)
            rest.append(big)
            took = [(x * k) >> FRACTION for x in q]
            if sum(left) >= window * k:
                took[big] = window * k - (sum(took) - took[big])
            done = [d + t for d, t in zip(done, took)]
            left = [r - t for r, t in zip(left, took)]
            n += k
        first.append(n)
        base.append(done)
        quantum.append([0] * many)
        rest.append(0)
        self.window, self.first = window, np.array(first, np.int64)
        self.base = np.array(base, np.int64).reshape(len(first), many)
        self.quantum = np.array(quantum, np.int64).reshape(len(first), many)
        self.rest = np.array(rest, np.int64)
        self.windows, self.total = n, sum(done)

    def _given(self, p: np.ndarray, j: np.ndarray, s: int) -> np.ndarray:
        plain = self.base[p, s] + ((self.quantum[p, s] * j) >> FRACTION)
        fill = np.flatnonzero(self.rest[p] == s)
        if len(fill):
            pf, jf = p[fill], j[fill]
            others = np.zeros(len(fill), np.int64)
            for o in range(self.base.shape[1]):
                if o != s:
                    others += (self.quantum[pf, o] * jf) >> FRACTION
            used = self.base[pf].sum(axis=1)
            # the last window may stay short: never past what there is
            plain[fill] = self.base[pf, s] + np.minimum(self.window * jf, self.total - used) - others
        return plain

    def given(self, n: np.ndarray, s: int) -> np.ndarray:
        """Ids that queue ``s`` has given before window ``n``."""
        p = np.searchsorted(self.first, n, "right") - 1
        return self._given(p, n - self.first[p], s)

    def window_of(self, x: np.ndarray, s: int) -> np.ndarray:
        """The window that takes id ``x`` of queue ``s``."""
        p = np.searchsorted(self.base[:, s], x, "right") - 1
        y = x - self.base[p, s]
        q = self.quantum[p, s]
        j = np.where(q > 0, (((y + 1) << FRACTION) - 1) // np.maximum(q, 1), 0)
        fill = self.rest[p] == s
        if fill.any():
            rate = (self.window << FRACTION) - self.quantum.sum(axis=1) + self.quantum[np.arange(len(self.rest)), self.rest]
            j = np.where(fill, (y << FRACTION) // rate[p], j)
        j = np.clip(j, 0, np.maximum(self.first[np.minimum(p + 1, len(self.first) - 1)] - self.first[p] - 1, 0))
        while True:
            high = self._given(p, j, s) > x
            low = ~high & (self._given(p, j + 1, s) <= x)
            if not (high.any() or low.any()):
                return self.first[p] + j
            j = j - high + low


class Tree:
    """Schedules within queues, for any number of sources.

    Node 0 is the schedule of the windows; the parent of node ``i`` is
    ``up[i]``, a (node, queue) with a smaller number.  ``seat[i]`` is the
    (node, queue) of source ``i``.  A node with more members than queues gives
    half of its queues to the first members and deals the others to the rest;
    sources with weight 0 never share a queue with those that have one.
    """

    def __init__(self, totals: list[int], weights: list[float], window: int):
        self.nodes: list[Schedule] = []
        self.up: list[tuple[int, int]] = []
        self.seat: list[tuple[int, int]] = [(0, 0)] * len(totals)
        order = sorted(range(len(totals)), key=lambda i: weights[i] <= 0)
        todo = [(order, window, (-1, -1))]
        for members, size, up in todo:  # grows while it runs
            most, node = math.isqrt(size), len(self.up)
            if len(members) > most and most < 4:
                raise ValueError("a window must hold 16 ids or the square of the number of queues")
            groups = [[i] for i in members]
            if len(members) > most:
                own, shared = members[:most // 2], most - most // 2
                some = [i for i in members[len(own):] if weights[i] > 0]
                none = [i for i in members[len(own):] if weights[i] <= 0]
                shared -= bool(none)
                groups = [[i] for i in own] + [some[k::shared] for k in range(min(shared, len(some)))] + [none] * bool(none)
            for q, group in enumerate(groups):
                if len(group) == 1:
                    self.seat[group[0]] = (node, q)
                else:
                    todo.append((group, max(16, min(len(group), FAN) ** 2), (node, q)))
            self.up.append(up)
            self.nodes.append(Schedule([sum(totals[i] for i in g) for g in groups], [sum(weights[i] for i in g) for g in groups], size))

    def pieces(self, source: np.ndarray, at: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Cuts runs of ``n`` ids that begin at id ``at`` of their source's queue:
        columns of run, start in it, length, window, offset there."""
        seats = np.array(self.seat, np.int64).reshape(-1, 2)[source]
        open_ = defaultdict(list)  # node -> rows of run, start, place in the queue, length, queue
        for node in np.unique(seats[:, 0]).tolist():
            rows = np.flatnonzero(seats[:, 0] == node)
            open_[node].append(np.stack([rows, np.zeros(len(rows), np.int64), at[rows], n[rows], seats[rows, 1]]))
        while True:
            node = max(open_)
            cut = _cut(self.nodes[node], np.concatenate(open_.pop(node), axis=1))
            if node == 0:
                return cut
            run, start, length, w, offset = cut
            parent, queue = self.up[node]
            open_[parent].append(np.stack([run, start, w * self.nodes[node].window + offset, length, np.full(len(run), queue)]))


def _cut(plan: Schedule, parts: np.ndarray) -> np.ndarray:
    """Parts (run, start, place in the queue, length, queue) cut at the windows
    of ``plan``: run, start, length, window, offset there."""
    out = []
    for s in np.unique(parts[4]).tolist():
        run, start, at, n, _ = parts[:, parts[4] == s]
        lo, hi = plan.window_of(at, s), plan.window_of(at + n - 1, s)
        many = hi - lo + 1
        which = np.repeat(np.arange(len(run)), many)
        w = np.repeat(lo - (np.cumsum(many) - many), many) + np.arange(len(which))
        from_, to = plan.given(w, s), plan.given(w + 1, s)
        begin, stop = np.maximum(at[which], from_), np.minimum(at[which] + n[which], to)
        offset = begin - from_
        for o in range(s):
            offset += plan.given(w + 1, o) - plan.given(w, o)
        full = stop > begin
        out.append(np.stack([run[which], start[which] + begin - at[which], stop - begin, w, offset])[:, full])
    return np.concatenate(out, axis=1)


def _tokenised(docs: DataFrame, path: str, end_id: int, text: str, key: str, source: str) -> DataFrame:
    """Rows with the ids (16 bits each), their number, and the place of the
    document in the part of its source's queue that this task holds."""
    def run(batches):
        tok, part = tokenizer(path), TaskContext.get().partitionId()
        end, places = np.array([end_id], np.uint16).tobytes(), {}
        for b in slices(batches, "text"):
            ids = [x + end for x in tok.encode(*utf8(b.column(1)))]
            starts = []
            for s, x in zip(b.column(2).to_pylist(), ids):
                starts.append(places.get(s, 0))
                places[s] = starts[-1] + len(x) // 2
            yield pa.RecordBatch.from_arrays([
                b.column(0), b.column(2), pa.array([part] * len(ids), pa.int64()), pa.array(starts, pa.int64()),
                pa.array([len(x) // 2 for x in ids], pa.int64()), pa.array(ids, pa.binary())],
                ["doc_id", "source", "part", "place", "n", "ids"])

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"), F.col(source).cast("string").alias("source"))
    return rows.mapInArrow(run, "doc_id long, source string, part long, place long, n long, ids binary")


def pack(docs: DataFrame, tokenizer_path: str, window: int = 4096, end_id: int = 2, weights: dict | None = None,
         text: str = "text", key: str = "doc_id", source: str = "source") -> DataFrame:
    """Packs all documents into windows; one row per piece, with its ids.

    ``weights`` maps sources to target proportions (null: None); a source
    without one takes no part until the others are empty.  Without ``weights``
    the sources' shares of all ids are the target, so every window has them.
    """
    table = save(_tokenised(docs, tokenizer_path, end_id, text, key, source), "packing-ids")
    parts = table.groupBy("part", "source").agg(F.sum("n").alias("n"))
    sums = parts.groupBy("source").agg(F.sum("n").alias("n"))
    top = sums.orderBy(F.desc("n"), F.asc_nulls_first("source")).limit(MAX_QUEUES).collect()  # MAX_QUEUES rows
    everything = sums.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    left = everything - sum(r["n"] for r in top)
    totals = [r["n"] for r in top] + [left] * (left > 0)
    if weights is None:
        target = [float(t) for t in totals]
    else:
        target = [max(float(weights.get(r["source"], 0)), 0.0) for r in top]
        if left:
            target.append(max(float(sum(weights.values())) - sum(target), 0.0))
    plan = Tree(totals, target, window)
    names = docs.sparkSession.createDataFrame([(r["source"], i) for i, r in enumerate(top)], "s string, q int")
    line = parts.join(F.broadcast(names), F.col("source").eqNullSafe(F.col("s")), "left").select(
        "part", "source", "n", F.coalesce("q", F.lit(len(top))).alias("queue"))
    line = line.select(F.col("part").alias("p2"), F.col("source").alias("s2"), "queue", F.expr(
        "coalesce(sum(n) over (partition by queue order by part, source rows between unbounded preceding and 1 preceding), 0)").alias("before"))
    placed = table.join(line, (F.col("part") == F.col("p2")) & F.col("source").eqNullSafe(F.col("s2"))).select(
        "doc_id", "source", "queue", (F.col("before") + F.col("place")).alias("at"), "n", "ids")

    def run(batches):
        for b in batches:
            if b.num_rows == 0:
                continue
            queue, at, n = (b.column(i).to_numpy(zero_copy_only=False) for i in (2, 3, 4))
            which, start, length, w, offset = plan.pieces(queue.astype(np.int64), at, n)
            ids = [np.frombuffer(x, np.uint16).astype("<u4") for x in b.column(5).to_pylist()]
            pieces = [ids[i][s:s + k] for i, s, k in zip(which.tolist(), start.tolist(), length.tolist())]
            take = pa.array(which)
            yield pa.RecordBatch.from_arrays([
                b.column(0).take(take), b.column(1).take(take), pa.array(start), pa.array(length),
                pa.array([zlib.crc32(p.tobytes()) for p in pieces], pa.int64()), pa.array(n[which]), pa.array(w), pa.array(offset),
                pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(length)), pa.int32()),
                                         pa.array(np.concatenate(pieces).astype(np.int32)))],
                ["doc_id", "source", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"])

    return placed.mapInArrow(run, "doc_id long, source string, start long, length long, ids_crc32 long, doc_tokens long, "
                                  "sequence_id long, offset long, ids array<int>")
