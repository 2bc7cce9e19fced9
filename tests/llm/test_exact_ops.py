"""Operators whose results are exact: held against brute force."""

import collections
import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from terrace.llm import chunk_dedup, hilbert_shard, packing, queries, secret_scan, suffix_dedup, topk_nra

BLANK = str.maketrans("", "", " \t\n\x0b\x0c\r")


def with_clashes(df, *names):
    return df.withColumns({n: F.lit("clash") for n in names})


# --- Hilbert shards --------------------------------------------------------

@pytest.mark.parametrize("dims,bits", [(2, 4), (3, 3)])
def test_hilbert_curve_visits_neighbours(dims, bits):
    grid = np.indices([1 << bits] * dims).reshape(dims, -1)
    index = hilbert_shard.hilbert_index(list(grid), bits)
    assert sorted(index.tolist()) == list(range(1 << (bits * dims)))
    path = grid[:, np.argsort(index)]
    assert (np.abs(np.diff(path, axis=1)).sum(axis=0) == 1).all()


def shards(df, n, law):
    dims = {"lang": F.col("lang"), "source": F.col("source"), "chars": F.lpad(F.col("n_chars").cast("string"), 12, "0")}
    return hilbert_shard.hilbert_shards(df, dims, n, law=law)


@pytest.mark.parametrize("law", ["rows", "bytes"])
def test_shards(corpus, law):
    df, rows = corpus
    out = shards(with_clashes(df, "shard", "size", "slot"), 7, law).collect()
    assert collections.Counter(r.doc_id for r in out) == collections.Counter(r[0] for r in rows)
    text = {r[0]: r[1] for r in rows}
    by = collections.defaultdict(list)
    for r in out:
        raw = (text[r.doc_id] or "").encode()
        assert r["size"] == len(raw) + 16 and r.text_crc32 == zlib.crc32(raw)
        by[r.shard].append(r)
    for part in by.values():
        assert sorted(r.slot for r in part) == list(range(len(part)))
    order = sorted(out, key=lambda r: (r.shard, r.slot))
    assert all(a.hilbert <= b.hilbert for a, b in zip(order, order[1:]))
    if law == "rows":
        assert max(map(len, by.values())) - min(map(len, by.values())) <= 1 and set(by) == set(range(7))
    else:
        total, most = sum(r["size"] for r in out), max(r["size"] for r in out)
        assert all(sum(r["size"] for r in p) <= total / 7 + most for p in by.values())


def test_shards_of_nothing(empty):
    assert shards(empty, 4, "rows").count() == 0


def test_written_shards(corpus, tmp_path):
    df, _ = corpus
    unique = df.where("doc_id is not null").dropDuplicates(["doc_id"])
    out = shards(unique, 5, "rows")
    manifest = hilbert_shard.write_shards(unique, out, str(tmp_path / "s")).collect()
    back = df.sparkSession.read.parquet(str(tmp_path / "s"))
    assert back.count() == unique.count() == sum(r["rows"] for r in manifest)


# --- exact dedup -------------------------------------------------------------

def groups(rows):
    by = collections.defaultdict(list)
    for i, t, *_ in rows:
        by[(t or "").translate(BLANK)].append((-len(t or ""), i))
    return by


@pytest.mark.parametrize("bits", [128, 3])
def test_chunk_recipes(corpus, bits):
    df, rows = corpus
    some = [r for r in rows if r[0] is not None]
    out = chunk_dedup.exact_groups(with_clashes(df.where("doc_id is not null"), "row", "recipe"), digest_bits=bits).collect()
    assert len(out) == len(some)
    text = {r[0]: r[1] for r in some}
    by = groups(some)
    for r in out:
        same = by[(text[r.doc_id] or "").translate(BLANK)]
        assert (r.keep_id, r.group_size) == (min(same)[1], len(same))
        assert r.text_sha256 == hashlib.sha256((text[r.doc_id] or "").translate(BLANK).encode()).hexdigest()
    kept = [r for r in out if r.kept]
    assert len(kept) == len(by) and all(r.doc_id == r.keep_id for r in kept)


def test_chunks_cover_the_text():
    rnd = random.Random(1)
    for n in (0, 1, 511, 513, 5000, 60000):
        data = bytes(rnd.choice(b"abcd ") for _ in range(n))
        ends = chunk_dedup.cuts(data)
        assert ends == sorted(set(ends)) and (ends[-1] if n else 0) == n
        assert all(e - s <= 16384 for s, e in zip([0] + ends, ends))
    data = bytes(rnd.choice(b"abcd ") for _ in range(60000))
    tails = [{data[s:e] for s, e in zip([0] + c, c)} for data, c in ((d, chunk_dedup.cuts(d)) for d in (data, b"zz" + data))]
    assert len(tails[0] & tails[1]) >= len(tails[0]) - 3  # an insertion moves few chunks


def test_chunks_of_nothing(empty):
    assert chunk_dedup.exact_groups(empty).count() == 0


# --- packing ----------------------------------------------------------------

def test_schedule_against_single_steps():
    rng = np.random.default_rng(2)
    for trial in range(60):
        many = int(rng.integers(1, 9))
        totals = rng.integers(0, 4000, many) * (rng.random(many) < 0.8)
        weights = rng.random(many) * (rng.random(many) < 0.9) if trial % 2 else totals.astype(float)
        window = max(64, many * many)
        plan = packing.Schedule(totals.tolist(), weights.tolist(), window)
        given = np.stack([plan.given(np.arange(plan.windows + 1), s) for s in range(many)], axis=1)
        assert (given[0] == 0).all() and (given[-1] == totals).all()
        steps = np.diff(given, axis=0)
        assert (steps >= 0).all() and (steps.sum(axis=1)[:-1] == window).all()
        for s in range(many):
            x = np.arange(totals[s])
            w = plan.window_of(x, s)
            assert (given[w, s] <= x).all() and (given[w + 1, s] > x).all()


def test_weights_hold_in_every_window():
    plan = packing.Schedule([900_000, 400_000, 50_000], [5, 4, 1], 1000)
    steps = np.diff(np.stack([plan.given(np.arange(400), s) for s in range(3)], axis=1), axis=0)
    assert (np.abs(steps - [500, 400, 100]) <= 1).all()


def _order(tree, totals, window):
    """Source of every id, in the order of the windows; each place is taken once."""
    sources = np.flatnonzero(totals)
    cuts = tree.pieces(sources, np.zeros(len(sources), np.int64), totals[sources])
    out = np.full(int(totals.sum()), -1)
    ids = collections.defaultdict(int)
    for run, start, length, w, offset in cuts[:, np.lexsort((cuts[1], cuts[0]))].T.tolist():
        assert start == ids[run] and 0 <= offset and offset + length <= window
        ids[run] += length
        assert (out[w * window + offset:w * window + offset + length] == -1).all()
        out[w * window + offset:w * window + offset + length] = sources[run]
    assert (out >= 0).all()
    return out


def test_tree_takes_every_id_once():
    rng = np.random.default_rng(6)
    for trial in range(40):
        many, window = int(rng.integers(1, 300)), int(rng.choice([16, 64, 100, 4096]))
        totals = (rng.pareto(1.0, many) * 50).astype(np.int64) * (rng.random(many) < 0.9)
        weights = totals.astype(float) if trial % 2 else rng.random(many) * (rng.random(many) < 0.7)
        _order(packing.Tree(totals.tolist(), weights.tolist(), window), totals, window)


def test_proportions_of_many_sources_hold_in_every_window():
    for many in (61, 200, 1000):  # the queue that fills a window takes what others round off
        totals = np.full(many, 1_600_000 // many, np.int64)
        order = _order(packing.Tree(totals.tolist(), [1.0] * many, 4096), totals, 4096)
        full = order[:len(order) // 4096 * 4096].reshape(-1, 4096)
        counts = np.stack([np.bincount(w, minlength=many) for w in full[:-8]])
        assert np.abs(counts - 4096 / many).sum(axis=1).max() <= 4096 * (0.65 if many == 1000 else 0.07)
        assert many == 1000 or counts.min() >= 12
        means = counts[:len(counts) // 16 * 16].reshape(-1, 16, many).mean(axis=1)
        assert np.abs(means - 4096 / many).max() <= 2.5
    # a source without a weight waits until all others are empty
    totals = np.full(200, 2000, np.int64)
    order = _order(packing.Tree(totals.tolist(), [float(i % 2) for i in range(200)], 4096), totals, 4096)
    last = np.flatnonzero(order % 2 == 1).max() // 4096
    assert (order[:last * 4096] % 2 == 1).all()


@pytest.mark.parametrize("weights, window", [(None, 4096), ({"src0": 3.0, "src1": 1.0}, 256), ({"src0": 3.0, "src1": 1.0}, 16)])
def test_packing(corpus, weights, window):
    from tokenizers import Tokenizer
    df, rows = corpus
    tok = Tokenizer.from_file(queries.WORD_BPE)
    tok.encode_special_tokens = True
    out = packing.pack(with_clashes(df, "ids", "part", "queue"), queries.WORD_BPE, window=window, weights=weights).collect()
    want = collections.Counter((i, tuple(tok.encode(t or "", add_special_tokens=False).ids) + (2,)) for i, t, *_ in rows)
    pieces, windows = collections.defaultdict(dict), collections.defaultdict(list)
    for r in out:
        assert len(r.ids) == r.length and zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32
        pieces[r.doc_id].setdefault(r.start, []).append(r)
        windows[r.sequence_id].append((r.offset, r.length))
    for (i, ids), n in want.items():
        got = []
        for start in sorted(pieces[i]):
            assert len(pieces[i][start]) <= n and all(r.doc_tokens == len(ids) for r in pieces[i][start])
            got += [x for r in pieces[i][start] for x in zip(range(start, start + r.length), r.ids)]
        assert collections.Counter(got) == collections.Counter({x: n for x in enumerate(ids)})
    last = max(windows)
    for s, parts in windows.items():
        parts.sort()
        assert [o for o, _ in parts] == np.cumsum([0] + [k for _, k in parts])[:-1].tolist()
        assert sum(k for _, k in parts) == window or s == last
    assert sorted(windows) == list(range(last + 1))


def test_tokenizer_on_odd_texts():
    import pyarrow as pa
    from tokenizers import Tokenizer

    from terrace.llm.common import utf8
    tok = Tokenizer.from_file(queries.WORD_BPE)
    tok.encode_special_tokens = True
    rnd = random.Random(1)
    odd = [chr(c) for c in range(0x250)] + list("İıſKΣς中文ぁ한́̈'²½٣ 　​") + ["'s", "'t", "<|endoftext|>", "\n", "\x1c", "ǆ"]
    plain = [chr(c) for c in range(32, 127)] + list("ÉéÈçñÑßÿÜü'''sstmd0123  \n")
    texts = ["".join(rnd.choice(a) for _ in range(rnd.randint(0, 50))) for a in (odd, plain) for _ in range(400)]
    own = packing.PieceTokenizer(queries.WORD_BPE, most=2000)
    for got, t in zip(own.encode(*utf8(pa.array(texts))), texts):
        assert np.frombuffer(got, np.uint16).tolist() == tok.encode(t, add_special_tokens=False).ids


def test_packing_nothing(empty):
    assert packing.pack(empty, queries.WORD_BPE).count() == 0


# --- secrets -----------------------------------------------------------------

def test_base_spans_follow_the_patterns():
    rnd = random.Random(4)
    parts = ["password", "PassWd", "secret", "token", "api_key", "APIkey", "=", ":", " ", "  ", '"', "'", "AKIA", "abcdef12", "0" * 31, "f" * 33,
             "Ab3dEf6hIj9", "x.y-z_", "\n", "é", "ſecret", "AKIAABCDEFGH1234", "token:abc"]
    for _ in range(400):
        t = "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 14)))
        want = [(m.start(), 0, m.end()) for m in secret_scan.ASSIGN.finditer(t) if len(m.group(2)) >= 8]
        want += [(m.start(), 1, m.end()) for m in secret_scan.ACCESS.finditer(t) if m.end() - m.start() >= 16]
        want += [(m.start(), 2, m.end()) for m in secret_scan.HEX.finditer(t) if m.end() - m.start() >= 32]
        assert sorted(secret_scan.base_spans(t)) == sorted(want)


def test_random_strings_are_found_and_known_ones_are_not():
    enc = secret_scan.encoding(queries.BYTE_BPE)

    def found(t):
        return [t[s:e] for s, _, e in secret_scan.random_spans(t, enc, 20, 2.0)]

    rnd = random.Random(7)
    for _ in range(50):
        s = "".join(rnd.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789") for _ in range(40))
        assert found(f"key {s} end") == [s] or not any(c.isdigit() for c in s)
    for s in ("d41d8cd98f00b204e9800998ecf8427e", "123e4567-e89b-12d3-a456-426614174000", "get_user_account_name_from_table_2",
              "https/www/example/path/to/some/page", "internationalization12", "a" * 60):
        assert found(f"see {s} here") == []


def test_keys_of_letters_are_found_and_long_words_are_not():
    enc = secret_scan.encoding(queries.BYTE_BPE)

    def found(t):
        return [t[s:e] for s, _, e in secret_scan.random_spans(t, enc, 20, 2.0)]

    rnd = random.Random(8)
    low = "abcdefghijklmnopqrstuvwxyz"
    for alphabet, tail, least in ((low + low.upper(), "", 100), (low.upper(), "", 100), (low, "", 98), (low + low.upper(), "0123", 100)):
        keys = ["".join(rnd.choice(alphabet) for _ in range(32 - len(tail))) + tail for _ in range(100)]
        assert sum(found(f"key {k} end") == [k] for k in keys) >= least
    for s in ("Donaudampfschifffahrtsgesellschaft", "Rindfleischetikettierungsgesetz", "anticonstitutionnellement", "electroencefalografista",
              "Geschwindigkeitsbegrenzung", "getUserAccountNameFromTable", "SomeAbstractFactoryBean2", "MAX_NUMBER_OF_CONNECTIONS_PER_HOST",
              "state-of-the-art/well-known", "pneumonoultramicroscopicsilicovolcanoconiosis"):
        assert found(f"see {s} here") == []


def test_scan(corpus, empty):
    df, rows = corpus
    out = secret_scan.scan(with_clashes(df, "spans"), queries.BYTE_BPE).collect()
    assert len(out) == len(rows)
    text = {r[0]: r[1] for r in rows}
    for r in out:
        base = ",".join(f"{secret_scan.KINDS[k]}:{s}:{e}" for s, k, e in sorted(secret_scan.base_spans(text[r.doc_id] or "")))
        assert r.base_sha256 == hashlib.sha256(base.encode()).hexdigest()
    assert secret_scan.scan(empty, queries.BYTE_BPE).count() == 0


# --- suffix repeats ------------------------------------------------------------

def removed(texts, length):
    starts = collections.Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        mask = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if starts[t[i:i + length]] > 1:
                mask[i:i + length] = b"\x01" * length
        out.append(mask)
    return out


def test_difference_cover():
    for period in (7, 16, 32, 64):
        cover = suffix_dedup.difference_cover(period)
        assert {(a - b) % period for a in cover for b in cover} == set(range(period))


@pytest.mark.parametrize("length", [128, 400])
def test_suffix_classes_are_in_order(length):
    rnd = random.Random(length)
    core = bytes(rnd.choice(b"ab") for _ in range(length + 300))
    segments, lead = [], []
    for _ in range(12):
        s = rnd.randint(0, 60)
        segments.append(core[s:s + length + rnd.randint(0, 150)])
        lead.append(300 - s)
    names = suffix_dedup.sort_bucket(segments, np.array(lead), length)
    strings = [x[i:i + length] for x in segments for i in range(len(x) - length + 1)]
    by = collections.defaultdict(set)
    for n, x in zip(names.tolist(), strings):
        by[n].add(x)
    counts = collections.Counter(strings)
    assert all(len(v) == 1 for v in by.values())
    tied = sorted((n, next(iter(v))) for n, v in by.items() if counts[next(iter(v))] > 1)
    assert len({x for _, x in tied}) == len(tied) and [x for _, x in tied] != []


def test_repeats(corpus, empty):
    df, rows = corpus
    out = suffix_dedup.remove_repeats(with_clashes(df, "row", "block", "spans"), 400, kept_bytes=True).collect()
    texts = [(r[1] or "").encode() for r in rows]
    want = collections.Counter()
    for (i, *_), raw, mask in zip(rows, texts, removed(texts, 400)):
        kept = bytes(b for b, m in zip(raw, mask) if not m)
        runs = sum(1 for a, b in zip(b"\x00" + bytes(mask), mask) if b and not a)
        want[(i, len(raw), sum(mask), runs, hashlib.sha256(kept).hexdigest(), kept)] += 1
    got = collections.Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256, bytes(r.kept)) for r in out)
    assert got == want and any(k[2] not in (0, k[1]) for k in got)
    assert suffix_dedup.remove_repeats(empty).count() == 0


def test_long_texts_are_scanned_in_pieces(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "PIECE", 700)
    rnd = random.Random(3)
    text = np.frombuffer(bytes(rnd.choice(b"abc ") for _ in range(5000)), np.uint8)
    gram, at, lo, hi = suffix_dedup.anchors(text, np.array([0, 5000]), 400)
    assert sorted(x for s, e in zip(lo, hi) for x in range(s, e + 1)) == list(range(5000 - 400 + 1))


# --- top k -------------------------------------------------------------------

def test_nra_block_against_brute_force():
    rng = np.random.default_rng(0)
    for _ in range(60):
        n, d, m, k = (int(rng.integers(1, x)) for x in (200, 9, 6, 12))
        v, q = rng.integers(-5, 6, (n, d)).astype(float), rng.integers(-5, 6, (m, d)).astype(float)
        ids, qids = rng.permutation(n), rng.integers(0, n, m)
        row, cand, score = topk_nra.nra_block(q, qids, v, ids, k, first_depth=4)
        for i in range(m):
            want = sorted((-(v[j] @ q[i]), ids[j]) for j in range(n) if ids[j] != qids[i])[:k]
            assert list(zip(-score[row == i], ids[cand[row == i]])) == want


def test_top_k(llm):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.normal(size=6).astype(np.float32)]) for i in range(700)]
    rows += [(700, None), (701, [float("nan")] * 6), (702, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (703, [float("inf")] + [0.0] * 5),
             (800, [9.0, 9.0]), (805, [1.0, 1.0]), (806, [1.0, 1.0]), (None, [1.0] * 6)] + [(i, rows[3][1]) for i in range(900, 930)]
    df = llm.createDataFrame(rows, "vec_id long, embedding array<float>")
    out = topk_nra.top_k(with_clashes(df, "rank", "score", "c"), F.col("vec_id") % 100 == 0, block=97, query_block=5).collect()
    good = {i: np.floor(1024 * np.array(v, np.float32).astype(float)) for i, v in rows if i is not None and v is not None
            and all(x is not None and np.isfinite(x) for x in v)}
    want = {}
    for q in good:
        if q % 100 == 0:
            scores = sorted((-int(good[q] @ good[i]), i) for i in good if i != q and len(good[i]) == len(good[q]))[:10]
            want |= {(q, r + 1): (i, -s) for r, (s, i) in enumerate(scores)}
    assert {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in out} == want
    assert topk_nra.top_k(df.limit(0), F.col("vec_id") % 100 == 0).count() == 0
