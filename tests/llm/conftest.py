import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def corpus(seed: int = 7, n: int = 60) -> list[tuple]:
    """Small texts with copies, shared passages, ties, nulls, empty and one long text."""
    r = random.Random(seed)
    vocab = [f"w{i}" for i in range(60)] + ["é", "ß", "the", "The", "12"]
    passage = [r.choice(vocab) for _ in range(40)]
    rows = []
    for i in range(n):
        words = [r.choice(vocab) for _ in range(r.choice([0, 1, 5, 30, 80]))]
        if i % 3 == 0:
            k = r.randrange(len(words) + 1)
            words[k:k] = passage[r.randrange(8) : 40 - r.randrange(8)]
        if i % 7 == 3 and rows:
            words = (rows[r.randrange(len(rows))][1] or "").split()
        if i % 11 == 5:
            words = ["same"] * 50
        sep = r.choice([" ", "\n", "  ", "\t"])
        rows.append((i, sep.join(words), r.choice(["en", "de", None]), r.choice(["a", "a", "b", None, "é"]), len(words)))
    rows += [(1000, None, None, None, None), (1001, "", "en", "a", 0), (None, " ".join(passage), "en", "a", 1), (1002, " \t\n", "en", "b", 3)]
    rows += [(1003, " ".join(r.choice(vocab) for _ in range(6000)), "en", "a", 1)]
    rows += [(1004, rows[0][1], "en", "a", 1), (1005, "x" * 300 + " " + "é" * 120, "de", "b", 1), (1006, "x" * 250 + "é" * 90, "de", "b", 1)]
    return rows


@pytest.fixture(scope="session")
def rows():
    return corpus()


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
