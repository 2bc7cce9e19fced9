import random

import pytest

from terrace.llm.common import on_workers

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def llm(spark):
    on_workers(spark)
    return spark


@pytest.fixture(scope="session")
def corpus(llm):
    """Small documents with copies, near copies, a shared passage, nulls,
    empty texts, ties, a repeated row and one long text."""
    rnd = random.Random(5)
    words = ["".join(rnd.choice("abcdefghiklmnoprstu") for _ in range(rnd.randint(2, 8))) for _ in range(400)]

    def prose(n):
        return " ".join(rnd.choice(words) for _ in range(n))

    passage = prose(120)
    rows, base = [], [prose(rnd.randint(20, 160)) for _ in range(25)]
    for i in range(120):
        kind = i % 6
        if kind == 0:
            t = rnd.choice(base)
        elif kind == 1:
            w = rnd.choice(base).split()
            w[rnd.randrange(len(w))] = "changed"
            t = " ".join(w)
        elif kind == 2:
            t = prose(30) + " " + passage + " " + prose(30)
        elif kind == 3:
            t = rnd.choice(base).replace(" ", "\n  ")
        else:
            t = prose(rnd.randint(1, 90))
        rows.append((i, t, rnd.choice(["en", "de"]), "src0" if i % 3 else f"src{i % 7}", len(t)))
    rows += [(120, None, None, None, None), (121, "", "en", "src1", 0), (122, " \n\t", "en", "src1", 3), (123, "x" * 30000, "en", "src1", 30000),
             (124, prose(6000), "de", "src2", 1), (5, rows[5][1], rows[5][2], rows[5][3], rows[5][4]), (125, "Ünïcode é 漢字 ✓ it's", "fr", "src3", 20),
             (126, "12 34 !!", "fr", "src3", 8), (None, "row without an id and five words", "en", "src4", 1)]
    df = llm.createDataFrame(rows, SCHEMA).repartition(3)
    df.write.mode("overwrite").parquet(path := _path(llm))
    return llm.read.parquet(path), rows


def _path(spark):
    from terrace.session import scratch_path
    return scratch_path(spark, "test-corpus")


@pytest.fixture(scope="session")
def empty(llm):
    return llm.createDataFrame([], SCHEMA)
