"""Removal of repeated passages by blockwise suffix sorting.

A byte goes when a string of ``length`` bytes that covers it starts anywhere
else too.  The suffixes are sorted bucket by bucket, so memory is bounded by a
bucket, never by the corpus:

* Every start of a ``length``-byte string belongs to the smallest hashed
  ``GRAM``-byte gram inside the string.  Equal strings have equal grams at equal
  offsets, so the suffixes that can tie share a bucket keyed by the gram, and a
  gram that occurs once in the corpus needs no sorting.
* A bucket holds the byte ranges around the anchors of its grams, each distinct
  range once with the places that it stands for.
* In a bucket, the suffixes at the positions of a difference cover modulo
  ``PERIOD`` are ranked first, by prefix doubling.  Anchors are laid at multiples
  of PERIOD, so the suffixes of a tie have one residue and reach the cover at
  the same two shifts: a suffix is placed by the few bytes before the cover, its
  ranks at both shifts and the few bytes behind; no comparison walks the string.

Matches never cross texts.  Nulls count as empty texts.  Repeated rows are
copies of each other and lose all bytes of strings of ``length`` and more.  An
empty table gives no rows.  Other input columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.llm.common import partitions, slices, span_hashes, utf8

GRAM = 64
PERIOD = 32
#: Bytes of text that one block of documents holds about.
BLOCK = 8 << 20
#: Texts longer than this are scanned in overlapping pieces.
PIECE = 4 << 20


def difference_cover(period: int) -> np.ndarray:
    """A small set of residues whose differences give all residues, grown by
    the residue that adds most new differences."""
    cover, seen = [0], {0}
    while len(seen) < period:
        def gain(r):
            return len({(r - c) % period for c in cover} | {(c - r) % period for c in cover} | seen)
        best = max((r for r in range(period) if r not in cover), key=lambda r: (gain(r), -r))
        cover.append(best)
        for c in cover:
            seen |= {(best - c) % period, (c - best) % period}
    return np.array(sorted(cover))


COVER = difference_cover(PERIOD)
_IN = np.zeros(PERIOD, bool)
_IN[COVER] = True
#: Steps from a residue forward and backward to the cover.
_AHEAD = np.array([next(s for s in range(PERIOD) if _IN[(r + s) % PERIOD]) for r in range(PERIOD)])
_BEHIND = np.array([next(s for s in range(PERIOD) if _IN[(r - s) % PERIOD]) for r in range(PERIOD)])


def anchors(data: np.ndarray, offs: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(gram hash, anchor, first start, last start) of every run of string
    starts with one anchor; positions in ``data``."""
    found = []
    size = np.diff(offs)
    long = np.flatnonzero(size > PIECE)
    pieces, start = [], 0
    for t in long.tolist():
        pieces.append((offs[start], offs[t], offs[start:t + 1]))
        for s in range(int(offs[t]), int(offs[t + 1]) - length + 1, PIECE):
            e = min(s + PIECE + length - 1, int(offs[t + 1]))
            pieces.append((s, e, np.array([s, e])))
        start = t + 1
    pieces.append((offs[start], offs[-1], offs[start:]))
    for s, e, cuts in pieces:
        if e - s >= length:
            found.append([x if i == 0 else x + s for i, x in enumerate(_anchors(data[s:e], cuts - s, length))])
    if not found:
        return np.zeros(0, np.uint64), *[np.zeros(0, np.int64)] * 3
    return tuple(np.concatenate(x) for x in zip(*found))


def _anchors(data, offs, length):
    n = len(data)
    at = np.arange(n - GRAM + 1)
    h = span_hashes(data, at, at + GRAM)
    low = np.uint64((1 << 24) - 1)
    if n > low:
        raise ValueError("a piece of text must stay under 16 MB")
    key = (h & ~low) | at.astype(np.uint64)
    width, step = length - GRAM + 1, 1
    while step * 2 <= width:
        key = np.minimum(key[:-step], key[step:])
        step *= 2
    if step < width:
        key = np.minimum(key[:step - width], key[width - step:])
    owner = (key & low).astype(np.int64)
    starts = np.arange(len(owner))
    end = offs[np.searchsorted(offs, starts, "right")]
    ok = starts + length <= end
    starts, owner = starts[ok], owner[ok]
    if len(starts) == 0:
        return h[:0], starts, starts, starts
    new = np.ones(len(starts), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (starts[1:] != starts[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(starts)) - 1
    return h[owner[first]], owner[first], starts[first], starts[last]


def _classes(*keys: np.ndarray) -> np.ndarray:
    """Ranks of the rows of ``keys`` in lexicographic order (equal rows tie)."""
    if len(keys[0]) == 0:
        return np.zeros(0, np.int64)
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), np.int64)
    for k in keys:
        s = k[order]
        new[1:] |= s[1:] != s[:-1]
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(new)
    return out


def sort_bucket(segments: list[bytes], lead: np.ndarray, length: int) -> np.ndarray:
    """Class of every string of ``length`` bytes that starts in the segments
    (all starts of the first, then of the second, ...), ordered as the suffixes
    cut at ``length`` are; ``lead`` is the anchor's place in its segment."""
    size = np.array([len(s) for s in segments], np.int64)
    room = (size + 2 * PERIOD) // PERIOD * PERIOD + PERIOD
    base = np.cumsum(room) - room + (-lead) % PERIOD  # anchors at multiples of PERIOD
    text = np.zeros(int(room.sum()) + PERIOD, np.uint8)
    of = np.repeat(np.arange(len(size)), size)
    inside = np.arange(len(of)) - (np.cumsum(size) - size)[of]
    text[base[of] + inside] = np.frombuffer(b"".join(segments), np.uint8)
    word = np.zeros(len(text), np.uint64)  # the eight bytes at a position, first byte highest
    for b in range(8):
        word[:len(text) - 7] |= text[b:len(text) - 7 + b].astype(np.uint64) << np.uint64(56 - 8 * b)
    # ranks of the cover's suffixes, for 32, 64, 128, 256 bytes
    place = base[of] + inside
    left = size[of] - inside
    cover = _IN[place % PERIOD]
    place, left = place[cover & (left >= PERIOD)], left[cover & (left >= PERIOD)]
    rank = np.full(len(text), -1, np.int64)
    rank[place] = _classes(*[word[place + 8 * i] for i in range(PERIOD // 8)])
    reach = PERIOD
    while reach * 2 <= length - PERIOD:
        more = left >= 2 * reach
        place, left = place[more], left[more]
        new = _classes(rank[place] * np.int64(len(text)) + rank[place + reach])
        rank[place] = new
        reach *= 2
    # all suffixes: bytes before the cover, rank there, rank near the end, bytes behind
    starts = np.maximum(size - length + 1, 0)
    of = np.repeat(np.arange(len(size)), starts)
    pos = base[of] + np.arange(len(of)) - (np.cumsum(starts) - starts)[of]
    head = _AHEAD[pos % PERIOD]
    second = pos + length - reach
    tail = _BEHIND[second % PERIOD]
    name = _classes(rank[pos + head] * np.int64(len(text)) + rank[second - tail])
    tied = np.flatnonzero(np.bincount(name)[name] > 1)
    p, hd, tl = pos[tied], head[tied], tail[tied]

    def some(at, count):  # up to eight bytes at a position, the others zero
        return np.where(count > 0, word[at] >> np.uint64(8) * (8 - np.clip(count, 0, 8)).astype(np.uint64) % np.uint64(64), np.uint64(0)) \
            * (count > 0)

    keys = [some(p + 8 * i, hd - 8 * i) for i in range((int(_AHEAD.max()) + 7) // 8)]
    keys += [name[tied]]
    keys += [some(p + length - tl + 8 * i, tl - 8 * i) for i in range((int(_BEHIND.max()) + 7) // 8)]
    out = name + len(name)  # untied ones keep a class of their own
    out[tied] = _classes(*keys)
    return out


def repeated(gram: np.ndarray, lead: np.ndarray, segments: list[bytes], copies: np.ndarray, length: int,
             limit: int = 4 << 20) -> list[list[tuple[int, int]]]:
    """For each distinct segment the ranges of bytes that strings cover which
    occur elsewhere.  Grams are sorted in runs of about ``limit`` bytes."""
    out: list[list[tuple[int, int]]] = [[] for _ in segments]
    order = np.argsort(gram, kind="stable")
    cut = np.flatnonzero(np.append(True, gram[order][1:] != gram[order][:-1])) if len(order) else np.zeros(0, int)
    run: list[int] = []
    held = 0

    def settle():
        nonlocal run, held
        if run:
            part = np.array(run)
            names = sort_bucket([segments[i] for i in run], lead[part], length)
            starts = np.array([max(len(segments[i]) - length + 1, 0) for i in run])
            both = (np.bincount(names)[names] > 1) | np.repeat(copies[part] > 1, starts)
            ends = np.cumsum(starts)
            for i, s, e in zip(run, (ends - starts).tolist(), ends.tolist()):
                edge = np.diff(np.concatenate([[0], both[s:e].view(np.int8), [0]]))
                out[i] = [(a, b - 1 + length) for a, b in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist())]
        run, held = [], 0

    for s, e in zip(cut.tolist(), np.append(cut[1:], len(order)).tolist()):
        if e - s == 1:
            i = int(order[s])
            if copies[i] > 1:
                out[i] = [(0, len(segments[i]))]
            continue
        run += order[s:e].tolist()
        held += sum(len(segments[i]) for i in order[s:e].tolist())
        if held > limit:
            settle()
    settle()
    return out


def repeated_spans(docs: DataFrame, length: int = 400, text: str = "text", key: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """(documents dealt into blocks, spans): rows (block, row, doc_id, text) and
    (block, row, start, end) of byte ranges that repeat."""
    reach = PERIOD
    while reach * 2 <= length - PERIOD:
        reach *= 2
    if length < GRAM + 2 * PERIOD or 2 * reach < length:
        raise ValueError("two ranks must cover a string: its length must lie in 97..128, 161..256, 289..512 or so on, from 128")
    source = docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")).withColumn(
        "row", F.monotonically_increasing_id())
    total = docs.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0)).cast("long")).first()[0]
    blocks = max(1, -(-total // BLOCK))
    buckets = max(partitions(docs.sparkSession), blocks)
    source = source.select(F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int").alias("block"), "row", "doc_id", "text")

    def grams(batches):
        """Grams of the task's texts by bucket, with the blocks they are in."""
        held, count = [], 0

        def flush():
            gram, block = (np.concatenate(x) for x in zip(*held))
            bucket = (gram % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            cut = np.flatnonzero(np.append(True, bucket[order][1:] != bucket[order][:-1]))
            rows = [order[s:e] for s, e in zip(cut, np.append(cut[1:], len(order)))]
            return pa.RecordBatch.from_arrays([
                pa.array(bucket[order][cut].astype(np.int32)), pa.array([gram[r].tobytes() for r in rows], pa.binary()),
                pa.array([block[r].tobytes() for r in rows], pa.binary())], ["bucket", "grams", "blocks"])

        for b in slices(batches, "text", 2 << 20):
            data, offs = utf8(b.column(1))
            gram, at, _, _ = anchors(data, offs, length)
            if len(gram):
                doc = np.searchsorted(offs, at, "right") - 1
                held.append((gram, b.column(0).to_numpy()[doc].astype(np.int32)))
                count += len(gram)
            if count > 1 << 20:
                yield flush()
                held, count = [], 0
        if held:
            yield flush()

    def shared(t: pa.Table) -> pa.Table:
        """Grams that occur more than once, for each block that has them."""
        gram = np.frombuffer(b"".join(t.column("grams").to_pylist()), np.uint64)
        block = np.frombuffer(b"".join(t.column("blocks").to_pylist()), np.int32)
        order = np.lexsort((block, gram))
        gram, block = gram[order], block[order]
        new = np.append(True, gram[1:] != gram[:-1])
        size = np.diff(np.append(np.flatnonzero(new), len(gram)))
        keep = np.repeat(size > 1, size)
        keep[1:] &= new[1:] | (block[1:] != block[:-1])
        gram, block = gram[keep], block[keep]
        order = np.argsort(block, kind="stable")
        gram, block = gram[order], block[order]
        cut = np.flatnonzero(np.append(True, block[1:] != block[:-1])) if len(block) else np.zeros(0, int)
        return pa.Table.from_arrays([pa.array(block[cut], pa.int32()), pa.array([
            gram[s:e].tobytes() for s, e in zip(cut, np.append(cut[1:], len(gram)))], pa.binary())], ["block", "grams"])

    def segments(texts: pa.Table, flags: pa.Table) -> pa.Table:
        """Byte ranges around shared grams; equal ones of a block once."""
        wanted = np.unique(np.frombuffer(b"".join(flags.column("grams").to_pylist()), np.uint64))
        table: dict[tuple, list] = {}
        if len(wanted):
            for b in slices(texts.sort_by("row").to_batches(), "text", 2 << 20):
                data, offs = utf8(b.column(3))
                rows = b.column(1).to_numpy()
                gram, at, lo, hi = anchors(data, offs, length)
                place = np.minimum(np.searchsorted(wanted, gram), len(wanted) - 1)
                hit = wanted[place] == gram
                gram, at, lo, hi = gram[hit], at[hit], lo[hit], hi[hit]
                doc = np.searchsorted(offs, at, "right") - 1
                raw = data.tobytes()
                for g, a, s, e, r, o in zip(gram.tolist(), at.tolist(), lo.tolist(), hi.tolist(), rows[doc].tolist(), offs[doc].tolist()):
                    table.setdefault((g, a - s, raw[s:e + length]), []).append((r, s - o))
        keys = list(table)
        return pa.Table.from_arrays([
            pa.array([k[0] % buckets for k in keys], pa.int32()), pa.array(np.array([k[0] for k in keys], np.uint64).view(np.int64)),
            pa.array([k[1] for k in keys], pa.int32()), pa.array([k[2] for k in keys], pa.binary()),
            pa.array([np.array(table[k], np.int64).tobytes() for k in keys], pa.binary())],
            ["bucket", "gram", "lead", "body", "places"])

    def sort(t: pa.Table) -> pa.Table:
        table: dict[tuple, list] = {}
        for g, a, body, places in zip(*[t.column(c).to_pylist() for c in ("gram", "lead", "body", "places")]):
            table.setdefault((g, a, body), []).append(places)
        keys = list(table)
        places = [np.frombuffer(b"".join(table[k]), np.int64).reshape(-1, 2) for k in keys]
        spans = repeated(np.array([k[0] for k in keys], np.int64), np.array([k[1] for k in keys], np.int64),
                         [k[2] for k in keys], np.array([len(p) for p in places], np.int64), length)
        row, start, end = [], [], []
        for p, parts in zip(places, spans):
            for s, e in parts:
                row.append(p[:, 0])
                start.append(p[:, 1] + s)
                end.append(p[:, 1] + e)
        empty = [np.zeros(0, np.int64)]
        return pa.Table.from_arrays([pa.array(np.concatenate(x or empty)) for x in (row, start, end)], ["row", "start", "end"])

    flags = source.select("block", "text").mapInArrow(grams, "bucket int, grams binary, blocks binary") \
        .groupBy("bucket").applyInArrow(shared, "block int, grams binary")
    ranges = source.groupBy("block").cogroup(flags.groupBy("block")).applyInArrow(
        segments, "bucket int, gram long, lead int, body binary, places binary")
    spans = ranges.groupBy("bucket").applyInArrow(sort, "row long, start long, end long")
    return source, spans.select(F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int").alias("block"), "row", "start", "end")


def remove_repeats(docs: DataFrame, length: int = 400, text: str = "text", key: str = "doc_id", kept_bytes: bool = False) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256,
    the removed byte ranges and, if asked for, the bytes that stay."""
    source, spans = repeated_spans(docs, length, text, key)

    def cut(texts: pa.Table, found: pa.Table) -> pa.Table:
        row, start, end = (found.column(c).to_numpy() for c in ("row", "start", "end"))
        order = np.lexsort((start, row))
        row, start, end = row[order], start[order], end[order]
        out = [[] for _ in range(7)]
        for i, r, t in zip(*[texts.column(c).to_pylist() for c in ("doc_id", "row", "text")]):
            raw = t.encode()
            s, e = np.searchsorted(row, [r, r + 1])
            runs: list[list[int]] = []
            for a, b in zip(start[s:e].tolist(), end[s:e].tolist()):
                if runs and a <= runs[-1][1]:
                    runs[-1][1] = max(runs[-1][1], b)
                else:
                    runs.append([a, b])
            last, parts = 0, []
            for a, b in runs:
                parts.append(raw[last:a])
                last = b
            parts.append(raw[last:])
            kept = b"".join(parts)
            one = (i, len(raw), len(raw) - len(kept), len(runs), hashlib.sha256(kept).hexdigest(),
                   [{"start": a, "end": b} for a, b in runs], kept if kept_bytes else None)
            for column, x in zip(out, one):
                column.append(x)
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(),
                 pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.binary()]
        return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)],
                                    ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "kept"])

    out = source.groupBy("block").cogroup(spans.groupBy("block")).applyInArrow(
        cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
             "spans array<struct<start:long,end:long>>, kept binary")
    return out if kept_bytes else out.drop("kept")
