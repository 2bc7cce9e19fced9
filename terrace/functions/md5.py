"""First 32 bits of md5 for many short keys and many names at once.

The same number as ``conv(substring(md5(concat(name, ':', key)), 1, 8), 16, 10)``.
A hash per column and row in SQL costs 1.5 us (string building, hex digits and
back); the rounds of md5 over NumPy columns cost a third of a microsecond.
"""

from __future__ import annotations

import hashlib
import math
import sys
from collections.abc import Sequence

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

# shipped with the query: the executors need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_START = (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)
_K = [int(abs(math.sin(i + 1)) * 2 ** 32) & 0xFFFFFFFF for i in range(64)]
_TURN = [s for row in ((7, 12, 17, 22), (5, 9, 14, 20), (4, 11, 16, 23), (6, 10, 15, 21)) for s in row * 4]
#: Rows per pass: few enough for the processor's cache, enough to hide the calls.
_ROWS = 16384


def _rounds(words: dict[int, np.ndarray], bits: int, n: int) -> np.ndarray:
    """The first four digest bytes of one block per row, as big-endian numbers:
    ``words`` are its words that hold text; word 14 is the length, others are 0."""
    a, b, c, d = (np.full(n, x, np.uint32) for x in _START)
    f, t = np.empty(n, np.uint32), np.empty(n, np.uint32)
    for i in range(64):
        if i < 16:
            g = i
            np.bitwise_xor(c, d, out=f)
            np.bitwise_and(f, b, out=f)
            np.bitwise_xor(f, d, out=f)
        elif i < 32:
            g = (5 * i + 1) % 16
            np.bitwise_xor(b, c, out=f)
            np.bitwise_and(f, d, out=f)
            np.bitwise_xor(f, c, out=f)
        elif i < 48:
            g = (3 * i + 5) % 16
            np.bitwise_xor(b, c, out=f)
            np.bitwise_xor(f, d, out=f)
        else:
            g = 7 * i % 16
            np.invert(d, out=f)
            np.bitwise_or(f, b, out=f)
            np.bitwise_xor(f, c, out=f)
        a += f
        a += np.uint32((_K[i] + (bits if g == 14 else 0)) & 0xFFFFFFFF)
        if g in words:
            a += words[g]
        np.left_shift(a, np.uint32(_TURN[i]), out=t)
        np.right_shift(a, np.uint32(32 - _TURN[i]), out=a)
        a |= t
        a += b
        a, b, c, d = d, a, b, c
    a += np.uint32(_START[0])
    return a.byteswap()


def md5_u32(names: Sequence[str], keys: Sequence[bytes]) -> np.ndarray:
    """(keys x names) first 32 bits of md5("name:key")."""
    out = np.empty((len(keys), len(names)), np.int64)
    prefixes = [f"{n}:".encode() for n in names]
    longest = max(map(len, prefixes), default=0)
    lengths = np.fromiter(map(len, keys), np.int64, len(keys))
    for size in np.unique(lengths).tolist():
        same = np.flatnonzero(lengths == size)
        if size + longest > 55:  # more than one block
            for i in same.tolist():
                out[i] = [int.from_bytes(hashlib.md5(p + keys[i]).digest()[:4], "big") for p in prefixes]
            continue
        text = np.frombuffer(b"".join([keys[i] for i in same.tolist()]), np.uint8).reshape(len(same), size)
        for s in range(0, len(same), _ROWS):
            rows, part = same[s:s + _ROWS], text[s:s + _ROWS]
            for k, p in enumerate(prefixes):
                end = len(p) + size
                block = np.zeros((len(rows), (end + 4) // 4 * 4), np.uint8)
                block[:, :len(p)] = np.frombuffer(p, np.uint8)
                block[:, len(p):end] = part
                block[:, end] = 0x80
                words = np.ascontiguousarray(block.view("<u4").T)
                out[rows, k] = _rounds(dict(enumerate(words)), 8 * end, len(rows))
    return out


def hashes_u32(names: Sequence[str], key: Column) -> Column:
    """array<bigint>: the hash of every name with the key; NULL for a NULL key."""
    names = list(names)

    @F.arrow_udf("array<bigint>")
    def hashed(keys):
        import pyarrow as pa
        known = keys.drop_null()
        flat = pa.array(md5_u32(names, [k.encode() for k in known.to_pylist()]).ravel())
        there = np.asarray(keys.is_valid().to_numpy(zero_copy_only=False), dtype=bool)
        ends = np.concatenate([[0], np.cumsum(there) * len(names)])
        offsets = pa.array(ends.astype(np.int32), mask=np.append(~there, False))
        return pa.ListArray.from_arrays(offsets, flat)

    return hashed(key.cast("string"))
