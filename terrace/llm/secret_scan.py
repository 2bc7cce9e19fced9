"""Secret scan by token efficiency.

Besides fixed patterns, a string is suspicious when a tokenizer's vocabulary
knows it badly: few characters per token mean that no part of it is a usual
word.  Candidates are runs of key characters with letters; hexadecimal digests
of known lengths, UUIDs and identifiers made of words are excluded first.  Words
are known by the vocabulary too: cut at separators, digits and changes of case,
an identifier's parts have clearly more characters per token than a key's.

Nulls count as empty texts.  Repeated rows are scanned each.  An empty table
gives no rows.  Other input columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.llm.common import slices

#: Fixed patterns.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LONG_HEX = re.compile(r"[0-9a-f]{32,}")
_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
#: Order of the kinds at one start.
KINDS = ("assign", "access", "hex", "random")
#: Lengths of hexadecimal digests (MD5, SHA-1, SHA-224, SHA-256, SHA-384, SHA-512).
DIGESTS = (32, 40, 56, 64, 96, 128)
_CANDIDATE = r"[A-Za-z0-9+/_=-]{%d,}"
_UUID = re.compile(r"[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}")
_HEX_ONLY = re.compile(r"[0-9a-fA-F]+")
#: Words of letters with separators and at most short numbers between them.
_IDENTIFIER = re.compile(r"[/=+-]*[A-Za-z]+(?:[_/=+-]+(?:[A-Za-z]+|[0-9]{1,4}))*[0-9]{0,4}[_/=+-]*")

#: Parts of identifiers: a word in one case, or with a first capital.
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
#: Characters per token that the parts of an identifier exceed.
WORD_RATIO = 2.5


def encoding(path: str):
    import public_tokenizers
    import tiktoken
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
    return tiktoken.Encoding("scan", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


_ENCODINGS: dict[str, object] = {}


def _loaded(path: str):
    if path not in _ENCODINGS:
        _ENCODINGS[path] = encoding(path)
    return _ENCODINGS[path]


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, number of the kind, end) of the fixed patterns."""
    out = []
    low = text.lower()
    if any(w in low for w in _WORDS):  # a cheap necessary condition
        for m in ASSIGN.finditer(text):
            if m.end(2) - m.start(2) >= 8:
                out.append((m.start(), 0, m.end()))
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    out += [(m.start(), 2, m.end()) for m in LONG_HEX.finditer(text)]  # maximal runs, like HEX with 32 or more
    return out


def known(s: str, enc) -> bool:
    """Digests, UUIDs and identifiers made of words."""
    return (len(s) in DIGESTS and _HEX_ONLY.fullmatch(s) is not None) or _UUID.fullmatch(s) is not None \
        or (_IDENTIFIER.fullmatch(s) is not None and of_words(s, enc))


def of_words(s: str, enc) -> bool:
    """The vocabulary knows the parts of ``s``, each alone."""
    parts = _PART.findall(s)
    return sum(map(len, parts)) > WORD_RATIO * sum(len(enc.encode_ordinary(p)) for p in parts)


#: Shortest strings looked at, and their ratio: of 16 to 19 characters, words of
#: natural compounds come nearer to random strings (README), so the bound is lower.
SHORTEST, SHORT_RATIO = 16, 1.7


def random_spans(text: str, enc, least: int, ratio: float) -> list[tuple[int, int, str]]:
    out = []
    shortest = min(SHORTEST, least)
    for m in re.finditer(_CANDIDATE % shortest, text):
        s = m.group()
        core = s.strip("=-_/+")
        if len(core) < shortest or not any(c.isalpha() for c in core):
            continue
        if len(s) <= (ratio if len(core) >= least else min(ratio, SHORT_RATIO)) * len(enc.encode_ordinary(s)) and not known(core, enc):
            out.append((m.start(), 3, m.end()))
    return out


def _join(spans) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in sorted(spans))


def scan(docs: DataFrame, vocabulary: str, least: int = 20, ratio: float = 2.0, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per document: counts of the base kinds and of random strings,
    the digest of the base spans, all spans, and the found strings."""
    def run(batches):
        enc = _loaded(vocabulary)
        for b in slices(batches, "text"):
            rows = [[] for _ in range(7)]
            for t in b.column(1).to_pylist():
                t = t or ""
                base = base_spans(t)
                both = base + random_spans(t, enc, least, ratio)
                one = [sum(k == i for _, k, _ in both) for i in range(4)]
                one += [hashlib.sha256(_join(base).encode()).hexdigest(), _join(both), [t[s:e] for s, _, e in sorted(both)]]
                for column, x in zip(rows, one):
                    column.append(x)
            kinds = [pa.int64()] * 4 + [pa.string(), pa.string(), pa.list_(pa.string())]
            yield pa.RecordBatch.from_arrays([b.column(0)] + [pa.array(r, k) for r, k in zip(rows, kinds)],
                                             ["doc_id", "n_assign", "n_access", "n_hex", "n_random", "base_sha256", "spans", "found"])

    source = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return source.mapInArrow(run, "doc_id long, n_assign long, n_access long, n_hex long, n_random long, "
                                  "base_sha256 string, spans string, found array<string>")
