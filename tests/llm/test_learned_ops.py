"""Operators that learn, sample or search: closed forms, brute force and
held-out accuracy; then the pipeline."""

import collections
import functools
import math
import random
import sys
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from terrace.llm import ctw, dart_minhash, ipf_mix, lang_hdc, packing, queries
from terrace.llm.common import utf8
from terrace.llm.components import components

sys.path.insert(0, __file__.rsplit("/tests/", 1)[0])


def with_clashes(df, *names):
    return df.withColumns({n: F.lit("clash") for n in names})


# --- context trees -----------------------------------------------------------

def test_context_trees_against_the_definition():
    texts, depth = ["the cat sat", "The hat", "", "the the thé"] * 2, 3
    key, size = ctw.grams(*utf8(pa.array(texts)), depth)
    assert size.tolist() == [len(t.encode()) + 1 for t in texts]
    known, count = np.unique(key, return_counts=True)
    nodes = ctw.levels(known, count, depth, 0)
    asked = np.array(sorted({*known.tolist(), int.from_bytes(b"zqab", "big"), int.from_bytes(b"eht!", "big")}), np.uint64)
    seen = []
    for t in texts:
        line = [255] * depth + list(t.lower().encode()) + [255]
        seen += [(tuple(line[i - 1 - d] for d in range(depth)), line[i]) for i in range(depth, len(line))]

    def counts(context, m):
        j, out = m.bit_length() - 1, [0, 0]
        for c, y in seen:
            if c[:len(context)] == context and (1 << j | y >> (8 - j)) == m:
                out[y >> (7 - j) & 1] += 1
        return out

    def estimate(a, b):
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)

    @functools.cache
    def weighted(context, m):
        a, b = counts(context, m)
        if len(context) == depth or a + b == 0:
            return estimate(a, b)
        below = {c[len(context)] for c, _ in seen if c[:len(context)] == context}
        return np.logaddexp(estimate(a, b), sum(weighted((*context, x), m) for x in below)) + math.log(0.5)

    def chance(context, d, m, bit):
        a, b = counts(context[:d], m)
        own = ((a, b)[bit] + 0.5) / (a + b + 1)
        if d == depth:
            return own
        w = math.exp(math.log(0.5) + estimate(a, b) - weighted(context[:d], m)) if a + b else 0.5
        return w * own + (1 - w) * (chance(context, d + 1, m, bit) if a + b else 0.5)

    for g, got in list(zip(asked.tolist(), ctw.code(asked, nodes, depth)))[::2]:
        *context, y = g.to_bytes(depth + 1, "big")
        want = sum(math.log10(chance(tuple(context), 0, 1 << j | y >> (8 - j), y >> (7 - j) & 1)) for j in range(8))
        assert got == pytest.approx(want, abs=1e-8)


def test_bytes_have_probability_one_in_all():
    key, _ = ctw.grams(*utf8(pa.array(["abracadabra", "alakazam"])), 2)
    nodes = ctw.levels(*np.unique(key, return_counts=True), 2, 0)
    every = np.array([ord("r") << 16 | ord("b") << 8 | b for b in range(256)], np.uint64)
    assert (10.0 ** ctw.code(every, nodes, 2)).sum() == pytest.approx(1)


@pytest.mark.parametrize("fan_in", [1024, 1])
def test_scores(corpus, monkeypatch, fan_in):
    monkeypatch.setattr(ctw, "FAN_IN", fan_in)
    monkeypatch.setattr(ctw, "CHUNK", 20_000)
    df, rows = corpus
    out = ctw.score_texts(with_clashes(df, "chunk", "score"), queries.remainder("doc_id", 5) == 1, 4).collect()
    held = {r[0]: r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 1 for r in rows}
    word = collections.Counter()
    low = [(r[0], (r[1] or "").encode().lower()) for r in rows]
    train = [t for i, t in low if not held[i]]
    for t in train:
        word.update([*t.split(), None])
    total, types = sum(word.values()), len(word)
    nodes = ctw.levels(*np.unique(ctw.grams(*utf8(pa.array([t.decode() for t in train])), 4)[0], return_counts=True), 4, 0)
    want = collections.defaultdict(list)
    for i, t in low:
        tokens = [*t.split(), None]
        want[i].append((held[i], len(tokens), sum(word[x] > 0 for x in tokens), total,
                        sum(math.log10((word[x] + 0.5) / (total + 0.5 * (types + 1))) for x in tokens),
                        ctw.code(ctw.grams(*utf8(pa.array([t.decode()])), 4)[0], nodes, 4).sum()))
    assert len(out) == len(rows)
    for r in out:
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == want[r.doc_id][0][:4]
        assert (r.base_score, r.score) == pytest.approx(want[r.doc_id][0][4:], rel=1e-5)


def test_scores_of_nothing(empty):
    assert ctw.score_texts(empty, F.lit(False)).count() == 0


def test_nothing_to_learn_from(corpus):
    df, _ = corpus
    for r in ctw.score_texts(df, F.lit(True)).collect():
        assert r.score == pytest.approx(8 * (r.n_bytes + 1) * math.log10(0.5)) and r.n_known == 0


# --- mixture -------------------------------------------------------------------

def test_raking_meets_the_marginals():
    rng = np.random.default_rng(3)
    t = rng.integers(50, 1000, (5, 3, 4)).astype(float)
    targets = [x / x.sum() for x in (rng.random(5) + 1, rng.random(3) + 1, rng.random(4) + 1)]
    x = ipf_mix.rake(t, targets, 0.2 * t.sum())
    for axis, target in enumerate(targets):
        assert x.sum(axis=tuple(a for a in range(3) if a != axis)) == pytest.approx(target * 0.2 * t.sum(), rel=1e-5)
    assert (x <= t).all()


TARGETS = {"source": {"src0": 1.0, "src1": 1.0}, "lang": {"en": 2.0, "de": 1.0}}


def test_mixture(corpus, empty):
    df, rows = corpus
    dims = {d: F.col(d) for d in TARGETS}
    out = ipf_mix.mix_weights(with_clashes(df, "probability", "kept"), TARGETS, dims, share=0.3).collect()
    assert len(out) == len(rows)
    names = [["src0", "src1", "other"], ["en", "de", "other"]]
    have = np.zeros((3, 3))
    for r in rows:
        at = [v.index(x) if x in v else 2 for v, x in zip(names, (r[3], r[2]))]
        have[tuple(at)] += len((r[1] or "").encode().split())
    share = [have.sum(axis=1) / have.sum(), have.sum(axis=0) / have.sum()]
    wanted = [np.append(np.array(w) * (1 - s[2]), s[2]) for w, s in zip(([0.5, 0.5], [2 / 3, 1 / 3]), share)]
    fitted = ipf_mix.rake(have, wanted, 0.3 * have.sum())
    for r in out:
        at = (names[0].index(r.source), names[1].index(r.lang))
        assert r.probability == pytest.approx(fitted[at] / have[at] if have[at] else 0.3)
    cells = collections.defaultdict(set)
    for r in out:
        cells[(r.source, r.lang)].add(r.probability)
        assert 0 <= r.probability <= 1
    assert all(len(v) == 1 for v in cells.values()) and ("other", "other") in cells
    drawn = collections.Counter(r.doc_id for r in out if r.kept)
    kept = ipf_mix.mixed(with_clashes(df, "probability"), TARGETS, dims, share=0.3)
    assert kept.columns == [*df.columns, "probability"]
    assert collections.Counter(r.doc_id for r in kept.collect()) == drawn
    assert ipf_mix.mix_weights(empty, TARGETS, dims).count() == 0 and ipf_mix.mixed(empty, TARGETS, dims).count() == 0


def test_draws_follow_their_probabilities(llm):
    df = llm.range(40000).select(F.col("id").alias("doc_id"), F.lit("one two three").alias("text"),
                                 F.when(F.col("id") % 4 == 0, "src1").otherwise("src0").alias("source"), F.lit("en").alias("lang"))
    out = ipf_mix.mix_weights(df, TARGETS, {d: F.col(d) for d in TARGETS}, share=0.4).where("kept").groupBy("source").count().collect()
    got = {r.source: r["count"] for r in out}
    assert got["src0"] == pytest.approx(8000, rel=0.05) and got["src1"] == pytest.approx(8000, rel=0.05)


# --- near duplicates -------------------------------------------------------------

def multiset(text):
    w = (text or "").encode().lower().split()
    return collections.Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else collections.Counter([tuple(w)] if w else [])


def similarity(a, b):
    both = sum((a & b).values())
    whole = sum((a | b).values())
    return both / whole if whole else 0


def test_darts_estimate_weighted_similarity():
    rnd = random.Random(6)
    words = [f"w{rnd.randint(0, 60)}" for _ in range(500)]
    texts = [" ".join(words)] + [" ".join(w if rnd.random() > p else "new" for w in words) for p in (0.01, 0.02, 0.05, 0.1) for _ in range(10)]
    of, cells, _ = dart_minhash.shingles(*utf8(pa.array(texts)))
    sig = dart_minhash.signatures(of, cells, len(texts), 256)
    assert (sig != 0).all()
    gap = [(sig[0] == sig[i]).mean() - similarity(multiset(texts[0]), multiset(texts[i])) for i in range(1, len(texts))]
    assert abs(np.mean(gap)) < 0.03 and np.abs(gap).max() < 0.13
    _, alone, _ = dart_minhash.shingles(*utf8(pa.array([texts[7]])))
    assert (dart_minhash.signatures(np.zeros(len(alone), int), alone, 1, 256)[0] == sig[7]).all()  # of a text alone


def brute_classes(rows, least=0.8):
    sets = [multiset(r[1]) for r in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if similarity(sets[i], sets[j]) >= least:
                parent[root(i)] = root(j)
    by = collections.defaultdict(list)
    for i in range(len(rows)):
        by[root(i)].append(i)
    return list(by.values())


@pytest.mark.parametrize("tile", [2048, 4])
def test_classes(corpus, empty, tile):
    df, rows = corpus
    out = dart_minhash.near_classes(with_clashes(df, "label", "rep", "words"), tile=tile).collect()
    assert len(out) == len(rows)
    got = collections.defaultdict(list)
    for r in out:
        got[(r.class_id, r.class_size)].append(r)
    want = sorted(sorted(str(rows[i][0]) for i in c) for c in brute_classes(rows))
    assert sorted(sorted(str(r.doc_id) for r in c) for c in got.values()) == want
    for (_, n), c in got.items():
        assert len(c) == n and sum(r.kept for r in c) == 1
    if tile == 4:
        return
    assert dart_minhash.near_classes(empty).count() == 0


def test_a_hot_group_of_near_copies(llm):
    rnd = random.Random(9)
    base = [f"w{rnd.randint(0, 2000)}" for _ in range(150)]
    rows = []
    for i in range(260):
        w = list(base)
        for _ in range(rnd.randint(0, 6)):
            w[rnd.randrange(len(w))] = f"x{rnd.randint(0, 10**6)}"
        rows.append((i, " ".join(w)))
    out = dart_minhash.near_classes(llm.createDataFrame(rows, "doc_id long, text string"), tile=64).collect()
    want = {frozenset(rows[i][0] for i in c) for c in brute_classes(rows)}
    got = collections.defaultdict(set)
    for r in out:
        got[r.class_id].add(r.doc_id)
    assert {frozenset(c) for c in got.values()} == want


def test_components(llm):
    rnd = random.Random(2)
    edges = [(i, i + 1) for i in range(60)] + [(rnd.randint(100, 200), rnd.randint(100, 200)) for _ in range(60)] + [(300, i) for i in range(301, 340)]
    out = {r.node: r.label for r in components(llm.createDataFrame(edges, "a long, b long")).collect()}
    parent = {x: x for e in edges for x in e}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    assert out == {x: root(x) for x in parent if any(x in e and e[0] != e[1] for e in edges)}


# --- language ----------------------------------------------------------------

def test_bound_trigrams():
    parts, of, tri = lang_hdc.trigrams(["Ab, c", None, "", "12", "é"])
    spelled = ["".join(map(chr, parts[t])) for t in tri]
    assert list(zip(of.tolist(), spelled)) == [(0, " ab"), (0, "ab "), (0, " c "), (4, " é ")]
    v = lang_hdc.bind(np.array([[97, 98, 99]]), 64, 1)[0]
    a, b, c = (lang_hdc.letter_vector(x, 64, 1) for x in (97, 98, 99))
    assert (v == np.roll(a, 2) * np.roll(b, 1) * c).all()


def test_held_out_accuracy(llm):
    docs = queries.documents(llm, "/root/testdata/sf0.01")
    out = queries.op9(llm, "/root/testdata/sf0.01").join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(out) > 150 and np.mean([r.lang == r.lang_pred for r in out]) > 0.97
    assert all(0 <= r.score <= 1 for r in out)


def test_language_edges(corpus, empty):
    df, rows = corpus
    out = lang_hdc.identify(with_clashes(df, "score", "lang_pred"), F.lit(True)).collect()
    assert len(out) == len(rows)
    for r in out:
        letters = any(c.isalpha() for c in (r.text or ""))
        assert (r.lang_pred == "und") == (not letters) and (letters or r.score == 0)
    assert lang_hdc.identify(empty, F.lit(True)).count() == 0
    assert {r.lang_pred for r in lang_hdc.identify(df, F.lit(False)).collect()} == {"und"}


def test_prototypes_are_exact_sums(corpus):
    df, rows = corpus
    got = lang_hdc.prototypes(df, F.lit(True), 64, 9)
    want = collections.defaultdict(lambda: np.zeros(64))
    for _, t, lang, *_ in rows:
        if t and lang:
            parts, _, tri = lang_hdc.trigrams([t])
            if len(tri):
                want[lang] += lang_hdc.bind(parts, 64, 9)[tri].astype(float).sum(axis=0)
    assert set(got) == set(want) and all((got[k] == want[k]).all() for k in want)


def test_many_distinct_trigrams_are_bound_in_blocks(monkeypatch):
    rnd, sizes, bind = random.Random(6), [], lang_hdc.bind
    texts = ["".join(chr(0x4E00 + rnd.randrange(3000)) for _ in range(n)) for n in (9000, 40, 3)] + ["aaa bbb aaa", None]
    parts, of, tri = lang_hdc.trigrams(texts)
    want = np.zeros((5, 32))
    np.add.at(want, of, bind(parts, 32, 9)[tri].astype(float))
    monkeypatch.setattr(lang_hdc, "bind", lambda p, *a: sizes.append(len(p)) or bind(p, *a))
    assert (lang_hdc.bundled(parts, of, tri, 5, 32, 9) == want).all()
    assert sum(sizes) == len(parts) > 8000 and max(sizes) <= lang_hdc.BLOCK


# --- pipeline ------------------------------------------------------------------

def test_stages_one_by_one(corpus):
    import corpus_pipeline as cp
    from terrace.session import scratch_path
    df, rows = corpus
    spark = df.sparkSession
    docs, kept = with_clashes(df, "kept", "score"), list(rows)
    for number, (_, stage) in enumerate(cp.STAGES):
        before = docs
        stage(spark, docs, "").write.parquet(path := scratch_path(spark, "test-stage"))
        docs = spark.read.parquet(path)
        if number < 4:
            assert docs.columns == before.columns
            got = collections.Counter((r.doc_id, r.text) for r in docs.collect())
        if number == 0:
            kept = [r for r in kept if any(c.isalpha() for c in (r[1] or ""))]
            assert set(got) <= {(r[0], r[1]) for r in kept} and len(got) >= len(kept) - 3
            kept = [r for r in kept if (r[0], r[1]) in got]
        elif number == 1:
            best = {}
            for r in kept:
                k = "".join((r[1] or "").split())
                if k not in best or (-len(r[1]), -1 if r[0] is None else r[0]) < (-len(best[k][1]), -1 if best[k][0] is None else best[k][0]):
                    best[k] = r
            kept = list(best.values())
            assert got == collections.Counter((r[0], r[1]) for r in kept)
        elif number == 2:
            classes = brute_classes(kept)
            kept = [min((kept[i] for i in c), key=lambda r: -1 if r[0] is None else r[0]) for c in classes]
            assert got == collections.Counter((r[0], r[1]) for r in kept)
        elif number == 3:
            marks = ipf_mix.mix_weights(before, queries.MIX, queries.mix_dims()).where("kept").collect()
            assert collections.Counter(r.doc_id for r in marks) == collections.Counter(i for i, _ in got.elements())
            kept = [r for r in kept if (r[0], r[1]) in got]
    assert {r.doc_id for r in docs.collect()} == {r[0] for r in kept}


def test_pipeline_runs_on_a_table(llm):
    import corpus_pipeline as cp
    out = cp.run(llm, "/root/testdata/sf0.001")
    assert out.agg(F.sum("length")).first()[0] > 4096 and packing.FRACTION == 16


def test_pipeline_of_nothing(empty):
    import corpus_pipeline as cp
    docs = empty
    for _, stage in cp.STAGES:
        docs = stage(empty.sparkSession, docs, "")
    assert docs.count() == 0


def test_short_texts_have_a_language(llm):
    import corpus_pipeline as cp
    long = queries.documents(llm, "/root/testdata/sf0.001").where("length(text) > 200").select("text", "lang").collect()
    rows = [(i, r.text, r.lang) for i, r in enumerate(long)]
    short = ["Avec.", "A.", "A.\nAll rights reserved.", "Onhaha sh.", "Yes", "Hello", "Bonjour", "Hallo Welt", "x", "é 1", "漢字", "12 34 !!", "...", " ", "", None]
    rows += [(10_000 + i, t, None) for i, t in enumerate(short)]
    docs = llm.createDataFrame(rows, "doc_id long, text string, lang string")
    out = cp.language(llm, docs, "")
    assert out.columns == docs.columns
    want = [r for r in rows if any(c.isalpha() for c in (r[1] or ""))]
    assert len(want) == len(rows) - 5 and collections.Counter(map(tuple, out.collect())) == collections.Counter(want)


def test_mixture_stage_against_brute_raking(corpus):
    import corpus_pipeline as cp
    df, rows = corpus

    def form(t):
        return next((name for mark, name in (("|", "table"), ("=", "code"), ("@", "contact")) if mark in t), "prose")

    def cell(r):
        at = (r[3], r[2], form(r[1] or ""))
        return tuple(v if v in queries.MIX[d] else "other" for d, v in zip(queries.MIX, at))

    have = collections.Counter()
    for r in rows:
        have[cell(r)] += len((r[1] or "").encode().split())
    total = sum(have.values())
    wanted = []
    for axis, weights in enumerate(queries.MIX.values()):
        share = collections.Counter()
        for c, n in have.items():
            share[c[axis]] += n / total
        there = {v: w for v, w in weights.items() if share[v] > 0}
        wanted.append({v: w / sum(there.values()) * (1 - share["other"]) for v, w in there.items()} | {"other": share["other"]})
    fit = {c: n / 2 for c, n in have.items()}
    for _ in range(1000):
        for axis, target in enumerate(wanted):
            sums = collections.Counter()
            for c, n in fit.items():
                sums[c[axis]] += n
            fit = {c: min(n * target.get(c[axis], 0) * total / 2 / sums[c[axis]], have[c]) if sums[c[axis]] else n for c, n in fit.items()}
    draw = {r.doc_id: r.u for r in df.select("doc_id", (F.pmod(F.xxhash64(F.lit(3), "doc_id"), F.lit(1 << 53)) / float(1 << 53)).alias("u")).collect()}
    want = collections.Counter((r[0], r[1]) for r in rows if draw[r[0]] < (fit[cell(r)] / have[cell(r)] if have[cell(r)] else 0.5))
    got = collections.Counter((r.doc_id, r.text) for r in cp.mixture(df.sparkSession, df, "").collect())
    assert got == want and 0 < len(got) < len(set((r[0], r[1]) for r in rows))
