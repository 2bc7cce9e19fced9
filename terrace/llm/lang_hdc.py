"""Language identification with hyperdimensional profiles.

Every letter (and the gap between words) has a fixed random vector of +1 and
-1.  A trigram's vector binds its letters: the first rotated twice, the second
once, the third as it is, multiplied.  A document's vector bundles (adds) its
trigram vectors, a language's prototype bundles those of all its training
documents, and a document takes the language of the prototype with the
largest cosine.

A text that is null or has no letter gets ``und`` and score 0.  A null label
is not learnt from.  Ties go to the smaller label.  Repeated rows count as
often as they occur.  With nothing to learn from, every text is ``und``.
Other input columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.llm.common import slices

UNKNOWN = "und"
#: More labels than this are not language labels; prototypes go to all tasks.
MAX_LANGUAGES = 512
#: Distinct trigrams whose vectors are in memory at a time.
BLOCK = 2048
_LETTERS: dict[tuple[int, int, int], np.ndarray] = {}


def letter_vector(point: int, size: int, seed: int) -> np.ndarray:
    key = (point, size, seed)
    if key not in _LETTERS:
        if len(_LETTERS) > 20_000:
            _LETTERS.clear()
        _LETTERS[key] = (np.random.default_rng([seed, point]).integers(0, 2, size) * 2 - 1).astype(np.int8)
    return _LETTERS[key]


def trigrams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(letters of each distinct trigram (t, 3), text number and trigram number
    of every occurrence).  Small letters; any run of other characters is one
    gap (code point 32); gaps stand before and after a text."""
    small = [" " + t.lower() + " " if t else "" for t in texts]
    points = np.frombuffer("".join(small).encode("utf-32-le", "surrogatepass"), np.uint32)
    doc = np.repeat(np.arange(len(small)), [len(s) for s in small])
    alphabet = np.flatnonzero(np.bincount(points, minlength=1)) if len(points) else np.zeros(0, np.int64)
    letter = np.array([chr(p).isalpha() for p in alphabet.tolist()], bool)
    number = np.zeros(int(alphabet.max(initial=0)) + 1, np.int64)
    letters = np.concatenate([[32], alphabet[letter]]).astype(np.int64)
    number[alphabet[letter]] = np.arange(1, len(letters))
    code = number[points]
    keep = code > 0
    keep[1:] |= (code[:-1] > 0) | (doc[1:] != doc[:-1])
    keep[:1] = True
    code, doc = code[keep], doc[keep]
    if len(code) < 3:
        return np.zeros((0, 3), np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    base = len(letters)
    tri = (code[:-2] * base + code[1:-1]) * base + code[2:]
    whole = (doc[:-2] == doc[2:]) & (code[1:-1] > 0)
    tri, of = tri[whole], doc[:-2][whole]
    if base ** 3 <= 1 << 23:
        there = np.zeros(base ** 3, bool)
        there[tri] = True
        distinct = np.flatnonzero(there)
        place = np.zeros(base ** 3, np.int64)
        place[distinct] = np.arange(len(distinct))
        tri = place[tri]
    else:
        distinct, tri = np.unique(tri, return_inverse=True)
    parts = np.stack([distinct // (base * base), distinct // base % base, distinct % base], axis=1)
    return letters[parts], of, tri


def bind(parts: np.ndarray, size: int, seed: int) -> np.ndarray:
    """Vectors of trigrams (t, size) of +1 and -1."""
    points, where = np.unique(parts, return_inverse=True)
    where = where.reshape(parts.shape)
    plain = np.stack([letter_vector(int(p), size, seed) for p in points]) if len(points) else np.zeros((0, size), np.int8)
    return np.roll(plain, 2, axis=1)[where[:, 0]] * np.roll(plain, 1, axis=1)[where[:, 1]] * plain[where[:, 2]]


def bundled(parts: np.ndarray, row: np.ndarray, tri: np.ndarray, rows: int, size: int, seed: int) -> np.ndarray:
    """Exact sums (rows, size) of the vectors of each row's trigrams, over
    blocks of distinct trigrams of bounded size."""
    out = np.zeros((rows, size))
    step = max(64, min(BLOCK, (1 << 22) // max(rows, 1)))
    if len(parts) > step:
        order = np.argsort(tri, kind="stable")
        row, tri = row[order], tri[order]
    for first in range(0, len(parts), step):
        n = min(step, len(parts) - first)
        lo, hi = (0, len(tri)) if n == len(parts) else np.searchsorted(tri, [first, first + n])
        counts = np.bincount(row[lo:hi] * n + (tri[lo:hi] - first), minlength=rows * n).reshape(rows, n)
        kind = np.float32 if counts.sum(axis=1).max(initial=0) < 1 << 24 else np.float64  # whole numbers stay exact
        out += counts.astype(kind) @ bind(parts[first:first + n], size, seed).astype(kind)
    return out


def prototypes(docs: DataFrame, train: Column, size: int, seed: int, text: str = "text", lang: str = "lang") -> dict[str, np.ndarray]:
    """Bundled vector of each label over all rows where ``train`` holds."""
    def run(batches):
        sums: dict[str, np.ndarray] = {}
        for b in slices(batches, "text", 1 << 20):
            labels = np.array(b.column(1).to_pylist(), object)
            names, which = np.unique(labels, return_inverse=True)
            parts, of, tri = trigrams(b.column(0).to_pylist())
            if len(parts) == 0:
                continue
            vectors = bundled(parts, which[of], tri, len(names), size, seed)
            for name, v in zip(names.tolist(), vectors):
                sums[name] = sums.get(name, 0) + v.astype(np.int64)
        for name, v in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([name] * size), pa.array(np.arange(size, dtype=np.int32)), pa.array(v)], ["lang", "axis", "value"])

    rows = docs.where(train & F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"))
    sums = rows.mapInArrow(run, "lang string, axis int, value long").groupBy("lang", "axis").agg(F.sum("value").alias("value"))
    bound = MAX_LANGUAGES * size
    out: dict[str, np.ndarray] = {}
    found = sums.limit(bound + 1).toPandas()
    if len(found) > bound:
        raise ValueError(f"more than {MAX_LANGUAGES} labels")
    for name, part in found.groupby("lang"):
        v = np.zeros(size)
        v[part["axis"].to_numpy()] = part["value"].to_numpy()
        out[name] = v
    return out


def predict(docs: DataFrame, protos: dict[str, np.ndarray], size: int, seed: int, text: str = "text",
            keep: list[str] | None = None, names_as: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """Adds label and score, named as ``names_as`` says, to the columns ``keep``
    (all by default); a kept column with such a name gives way."""
    names = sorted(n for n, v in protos.items() if np.any(v))
    matrix = np.stack([protos[n] / np.linalg.norm(protos[n]) for n in names]) if names else np.zeros((0, size))
    columns = [c for c in (keep or docs.columns) if c not in names_as]
    source = docs.select(*[F.col(c).alias(f"_{i}") for i, c in enumerate(columns)], F.col(text).alias("_text"))

    def run(batches):
        for b in slices(batches, "_text", 1 << 20):
            texts = b.column(len(columns)).to_pylist()
            parts, of, tri = trigrams(texts)
            best, score = np.full(len(texts), -1), np.zeros(len(texts))
            if len(parts) and names:
                docs_v = bundled(parts, of, tri, len(texts), size, seed)
                norm = np.sqrt(np.einsum("ij,ij->i", docs_v, docs_v))
                cos = docs_v @ matrix.T / np.maximum(norm, 1e-12)[:, None]
                some = np.bincount(of, minlength=len(texts)) > 0
                best[some] = np.argmax(cos[some], axis=1)
                score[some] = np.clip(cos[some].max(axis=1), 0, 1)
            labels = [names[i] if i >= 0 else UNKNOWN for i in best.tolist()]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(labels, pa.string()), pa.array(score, pa.float64())],
                                             [*b.schema.names[:-1], "lang_pred", "score"])

    kinds = {f.name: f.dataType for f in docs.schema.fields}
    schema = ", ".join(f"_{i} {kinds[c].simpleString()}" for i, c in enumerate(columns)) + ", lang_pred string, score double"
    return source.mapInArrow(run, schema).toDF(*columns, *names_as)


def identify(docs: DataFrame, train: Column, size: int = 1024, seed: int = 9, text: str = "text", lang: str = "lang",
             keep: list[str] | None = None, names_as: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """Learns prototypes from the rows where ``train`` holds, predicts all rows."""
    return predict(docs, prototypes(docs, train, size, seed, text, lang), size, seed, text, keep, names_as)
