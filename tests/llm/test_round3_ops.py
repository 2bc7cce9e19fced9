"""Line cleaning, conversation repair and hard negatives against brute force;
edge cases of the mixture, the secret scan and the top-k search."""

import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from terrace.llm import chat_repair, ipf_mix, line_clean, secret_scan, topk_nra, zone_negatives
from terrace.llm.common import keep_rows
from terrace.llm.queries import BYTE_BPE

WORD = r"[^\x20\x09-\x0D]+"


# ---------------------------------------------------------------- op11
def _base(text):
    text = text or ""
    words = re.findall(WORD, text)
    lines = [x for x in text.split("\n") if re.search(WORD, x)]
    grams = list(zip(words, words[1:], words[2:]))
    covered = {i + d for i, g in enumerate(grams) if grams.count(g) > 1 for d in range(3)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


def test_line_counts_equal_brute_force(llm):
    rnd = random.Random(2)
    texts = [None, "", " \n\t", "a a a a", "one two three one two three", "x y\nx y\n\nx y \n", "#*$%&|<>", "ü😀 é\r\n漢字 a\x0bb\x85c"]
    texts += ["".join(rnd.choice("ab .\n#\t") for _ in range(rnd.randint(0, 120))) for _ in range(60)]
    texts += ["word. " * 40000, " ".join(f"w{i}" for i in range(60)) + "."]
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(3, texts[3], "again"), (None, "no id", "x")]
    docs = llm.createDataFrame(rows, "doc_id long, text string, lines string")  # a clashing name
    out = line_clean.clean_lines(docs).collect()
    assert len(out) == len(rows)
    for r in out:
        text = "no id" if r["doc_id"] is None else texts[r["doc_id"]]
        if text is not None and len(text) > 10000:
            assert (r["n_words"], r["n_repeat_words"], r["base_failed"], r["kept"]) == (40000, 40000, True, False)
            continue
        want = _base(text)
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want, text
        assert r["base_failed"] == (want[0] < 50 or 100 * want[4] > 50 * want[0])
    assert line_clean.clean_lines(docs.limit(0)).count() == 0


def test_lines_fail_by_rule_and_lossy_documents_go(llm):
    prose = "\n".join(" ".join(f"{a}{i}{j}" for j in range(12)) + "." for i, a in enumerate("abcdefgh"))
    menu, table, legal, cut = "Home | About us | Contact", "home / login", "© 2020 Someone. All rights reserved.", "no mark at the end"
    clean, lossy = f"{prose}\n\n{menu}\n{legal}", "\n".join([prose[:300] + ".", *[f"menu{i} | a{i} | b{i} | c{i}" for i in range(40)]])
    docs = llm.createDataFrame([(1, clean), (2, lossy), (3, f"{prose}\n{cut}")], "doc_id long, text string")
    got = {r["doc_id"]: r for r in line_clean.clean_lines(docs).collect()}
    assert got[1]["cleaned"] == f"{prose}\n" and got[1]["kept"] and (got[1]["n_navigation"], got[1]["n_boilerplate"]) == (1, 1)
    assert not got[2]["kept"] and not got[2]["base_failed"] and got[2]["lost_chars"] * 100 > 30 * got[2]["word_chars"]
    assert got[3]["cleaned"] == prose and got[3]["n_punctuation"] == 1
    assert {r["rule"] for r in line_clean.line_report(docs.where("doc_id = 1")).collect()} == {None, "navigation", "boilerplate"}
    plan = line_clean.clean_lines(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|Exchange", plan)
    assert table and line_clean.line_report(llm.createDataFrame([(1, table)], "doc_id long, text string")).first()["rule"] == "navigation"


# ---------------------------------------------------------------- op12
def _cheapest(roles, faults):
    """Least (cost, audit) by dynamic programming over all labels."""
    nxt = {0: ("u", 2), 1: ("u", 2), 2: ("a", 3), 3: ("u", 2)}

    def inserted(labels):
        out = dict(labels)
        for _ in range(3):
            for s, (c, a) in list(out.items()):
                t = nxt[s][1]
                new = (c + 3, a + "I")
                if t not in out or new < out[t]:
                    out[t] = new
        return out

    labels = {0: (0, "")}
    for r, f in zip(roles, faults):
        new = {}

        def put(t, label):
            if t not in new or label < new[t]:
                new[t] = label

        for s, (c, a) in inserted(labels).items():
            put(s, (c + 4, a + "D"))
            if f in (1, 2):
                continue
            more = 3 if f == 3 else 0
            if r == "s" and s == 0:
                put(1, (c + more, a + "K"))
            put(nxt[s][1], (c + more, a + "K") if r == nxt[s][0] else (c + 3 + more, a + "R"))
        labels = new
    labels = inserted(labels)
    return min(labels[s] for s in (0, 3) if s in labels)


def test_bidirectional_search_equals_dynamic_programming():
    rnd = random.Random(4)
    for _ in range(600):
        n = rnd.randint(0, 9)
        roles = [rnd.choice("suax ") for _ in range(n)]
        faults = [rnd.choice([0, 0, 0, 1, 2, 3]) for _ in range(n)]
        cost, audit, _ = chat_repair.solve(roles, faults, [1] * n, 0, {0: 0, 3: 0}, True)
        assert (cost, audit) == _cheapest(roles, faults), (roles, faults)
    for roles in itertools.product("sua", repeat=4):
        assert chat_repair.solve(list(roles), [0] * 4, [1] * 4, 0, {0: 0, 3: 0}, True)[:2] == _cheapest(roles, [0] * 4)


def _repaired(rows):
    """Brute force of one conversation from its original (conv, turn, role, text)."""
    out = []
    for conv, turn, role, text in rows:
        blank = lambda x: " " if x is None else x
        hit = zlib.crc32(f"{blank(conv)}:{blank(turn)}".encode()) % 20
        role, text = blank(role), blank(text)
        if hit == 0:
            continue
        text = "" if hit == 1 else re.sub("[.!?]", "", text) if hit == 2 else text
        out += [(turn, "user" if hit == 4 else role, text)] * (2 if hit == 3 else 1)
    out.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    seen, faults = set(), []
    for _, role, text in out:
        bare = text.rstrip("\x20\x09\x0a\x0b\x0c\x0d")
        faults.append(1 if not bare else 2 if (role, text) in seen else 3 if bare[-1] not in ".!?" else 0)
        seen.add((role, text))
    roles = [r[1][:1] for r in out]
    cost, audit = _cheapest(roles, faults)
    lines, at, state = [], 0, 0
    nxt = {0: ("user", 2), 1: ("user", 2), 2: ("assistant", 3), 3: ("user", 2)}
    for letter in audit:
        if letter == "I":
            lines.append(nxt[state][0] + ":")
            state = nxt[state][1]
            continue
        _, role, text = out[at]
        at += 1
        if letter == "D":
            continue
        role = nxt[state][0] if letter == "R" else role
        state = 1 if role[:1] == "s" and letter == "K" else nxt[state][1]
        lines.append(f"{role}:{text}")
    turns = [r[0] for r in out if r[0] is not None]
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults.count(1), faults.count(2), faults.count(3),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(roles, roles[1:])), cost, audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest())


@pytest.mark.parametrize("block", [1024, 8])
def test_repair_equals_brute_force(llm, monkeypatch, block):
    """Nulls, ties, repeated rows, long texts, and conversations over many blocks."""
    monkeypatch.setattr(chat_repair, "BLOCK", block)
    rnd = random.Random(6)
    rows = []
    for conv in [*range(30), None]:
        for turn in range(rnd.randint(1, 9) if conv != 7 else 70):
            text = rnd.choice(["Yes.", "No.", "so", None, "", "What? ", f"t{conv}{turn}.", "x" * 3000 + "."])
            rows.append((conv, rnd.choice([turn, turn, turn, None]), rnd.choice(["user", "assistant", "system", "user", "assistant", None, ""]), text))
    rows += rows[10:14] + [rows[3]] * 3
    df = llm.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, block int").repartition(5)
    got = {r["conv_id"]: tuple(r)[1:] for r in chat_repair.repair(df).collect()}
    assert set(got) == {r[0] for r in rows}
    for conv in got:
        assert got[conv] == _repaired([r for r in rows if r[0] == conv]), conv
    assert chat_repair.repair(df.limit(0)).count() == 0


# ---------------------------------------------------------------- op13
def _mined(rows):
    """anchor, positive, rank, negative, scores of plain Python."""
    v = [(i, [int(np.floor(256 * x)) for x in e], (l + 1) % 10 if i % 7 == 0 else l) for i, e, l in rows
         if i is not None and l is not None and e is not None and all(x is not None and np.isfinite(x) for x in e)]
    out = []
    for a, x, la in v:
        if a % 100:
            continue
        scored = sorted((-sum(p * q for p, q in zip(x, y)), b, lb) for b, y, lb in v if b != a and len(y) == len(x))
        for s, p, _ in [r for r in scored if r[2] == la][:5]:
            window = [r for r in scored if r[2] != la and 80 * -s <= 100 * -r[0] <= 100 * -s][:5]
            out += [(a, p, k + 1, n, -s, -t) for k, (t, n, _) in enumerate(window)]
    return sorted(out)


@pytest.mark.parametrize("clustered", [False, True])
def test_negatives_equal_brute_force(llm, monkeypatch, clustered):
    monkeypatch.setattr(zone_negatives, "BLOCK", 32)
    monkeypatch.setattr(zone_negatives, "PIECE", 4)
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(10, 6)) * 2
    rows = []
    for i in range(700):
        label = int(rng.integers(10))
        rows.append((i, [float(x) for x in (centres[label] if clustered else 0) + rng.normal(size=6) * 0.4], label))
    rows[4] = (4, None, 1)
    rows[5] = (5, [None] * 6, 1)
    rows[6] = (6, [float("nan")] * 6, 1)
    rows[8] = (8, rows[9][1], None)
    rows[10] = (10, rows[11][1], rows[11][2])  # a tie
    rows += [(None, rows[1][1], 1), (901, [0.5, 0.5], 1), (902, [0.25, 0.5], 2), (800, [1.0, 1.0], 1), (903, [], 3)]
    df = llm.createDataFrame([(*r, 0) for r in rows], "vec_id long, embedding array<double>, label int, block int")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    out = zone_negatives.hard_negatives(df, F.col("vec_id") % 100 == 0, label)
    assert sorted(map(tuple, out.collect())) == _mined(rows)
    assert zone_negatives.hard_negatives(df.limit(0), F.col("vec_id") % 100 == 0, label).count() == 0


def test_bounds_hold_and_prune_blocks():
    rng = np.random.default_rng(1)
    anchors = np.floor(rng.normal(size=(5, 4)) * 100)
    blocks = [np.floor(rng.normal(size=(20, 4)) * 5 + c) for c in rng.normal(size=(30, 4)) * 100]
    low, high = (np.stack([f(b, axis=0) for b in blocks]) for f in (np.min, np.max))
    least, most = zone_negatives.intervals(anchors, low, high)
    for i, b in enumerate(blocks):
        s = zone_negatives.scores(anchors, b)
        assert (least[:, i] <= s.min(axis=1)).all() and (s.max(axis=1) <= most[:, i]).all()
    best = np.array([[zone_negatives.scores(a[None], b).max() for b in blocks] for a in anchors])
    assert (most < best.max(axis=1)[:, None]).mean() > 0.7  # most blocks need no reading


def test_scores_of_any_size():
    big = np.array([[1e300, 1.0], [-1e300, 2.0], [3e9, 4e9]])
    got = zone_negatives.scores(big, big)
    top, bottom = np.iinfo(np.int64).max, np.iinfo(np.int64).min
    assert got[0, 0] == top and got[0, 1] == bottom and got[2, 2] == top
    assert zone_negatives.scores(np.array([[2.0 ** 31, 1.0]]), np.array([[2.0 ** 30, 7.0]]))[0, 0] == 2 ** 61 + 7


# ---------------------------------------------------------------- earlier operators
def test_top_k_of_large_components_and_repeated_queries(llm):
    rows = [(0, [1.3e7, 1.0]), (0, [-1.3e7, 1.0]), (1, [1.3e7, -1.0]), (2, [1e300, 0.0]), (3, [-5.0, 2.0])]
    df = llm.createDataFrame(rows, "vec_id long, embedding array<double>")
    out = topk_nra.top_k(df, F.col("vec_id") == 0, k=2).collect()
    exact = lambda a, b: max(-2 ** 63, min(2 ** 63 - 1, sum(int(x * 1024) * int(y * 1024) for x, y in zip(a, b))))
    want = []
    for _, q in rows[:2]:
        want += [(0, r + 1, i, s) for r, (s, i) in enumerate(sorted(((exact(q, v), i) for i, v in rows[2:]), key=lambda x: (-x[0], x[1]))[:2])]
    assert sorted(map(tuple, out)) == sorted(want)


def test_short_keys_are_found_and_words_are_not():
    enc = secret_scan._loaded(BYTE_BPE)
    rnd = random.Random(3)
    letters = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
    for n in (16, 18, 20, 32, 64):
        keys = ["".join(rnd.choice(letters) for _ in range(n)) for _ in range(200)]
        found = sum(bool(secret_scan.random_spans(f"the key is {k} and so on", enc, 20, 2.0)) for k in keys)
        assert found >= (190 if n < 20 else 198), n
    plain = "internationalisation Donaudampfschifffahrt get_user_account_name configurationManager responsibilities"
    assert secret_scan.random_spans(plain, enc, 20, 2.0) == []


def test_mixture_takes_the_largest_share_that_meets_the_targets(llm):
    tokens = np.array([[900.0, 50.0], [40.0, 10.0]])
    targets = [np.array([0.5, 0.5]), np.array([0.8, 0.2])]
    fitted, share, apart = ipf_mix.feasible(tokens, targets, 0.5)
    assert apart <= 1e-4 and 0.09 < share <= 0.1 and (fitted <= tokens + 1e-9).all()  # 50 of 1,000 tokens are the second row's
    assert fitted.sum(axis=1) / fitted.sum() == pytest.approx([0.5, 0.5], abs=1e-3)
    impossible = np.array([[10.0, 0.0], [0.0, 10.0]])
    fitted, share, apart = ipf_mix.feasible(impossible, [np.array([0.9, 0.1]), np.array([0.1, 0.9])], 0.5)
    assert share == 0.5 and apart > 0.1
    docs = llm.createDataFrame([(i, "a b c", "en", "y") for i in range(200)], "doc_id long, text string, lang string, _MIX_P string")
    out = ipf_mix.mixed(docs, {"lang": {"en": 1.0}}, {"lang": F.col("lang")})
    assert out.columns == docs.columns and 60 < out.count() < 140


def test_kept_rows_have_all_columns_and_a_defined_choice(llm):
    docs = llm.createDataFrame([(1, "t", "b", 5), (1, "t", "a", 6), (2, None, "c", 7), (None, "n", "d", 8)],
                               "doc_id long, text string, _keep_id string, `_keep_hash` int")
    kept = docs.select("doc_id", F.xxhash64("text").alias("text_hash"))
    out = keep_rows(docs, kept)
    assert out.columns == docs.columns and out.count() == 3
    assert sorted(map(str, out.collect())) == sorted(map(str, keep_rows(docs.repartition(3), kept).collect()))
