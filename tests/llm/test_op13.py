import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from sievework.llm.runs import collapse_runs, find_runs, op13


def plain_runs(words, least=24, times=3):
    """All maximal runs by trying each period; the least period of equal ends."""
    found = {}
    for p in range(1, len(words) // times + 1):
        i = 0
        while i + p < len(words):
            j = i
            while j + p < len(words) and words[j] == words[j + p]:
                j += 1
            if j > i and j + p - i >= max(least, times * p):
                found.setdefault((i, j + p), p)
            i = max(j, i + 1)
    return sorted((s, e - s, p) for (s, e), p in found.items())


def plain_collapsed(words, runs):
    gone = {k for s, n, p in runs for k in range(s + p, s + n)}
    return b" ".join(w for k, w in enumerate(words) if k not in gone)


def plain(doc_id, text):
    """A row of the query, from its definition."""
    words = (text or "").encode().split()
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n and doc_id is not None:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    runs = plain_runs(words)
    best = None
    for s, m, p in runs:
        if best is None or m * best[2] > best[1] * p:
            best = (s, m, p)
    sha = lambda x: hashlib.sha256(x).hexdigest()
    return (doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None, sha("".join(f"{s},{m},{p}\n" for s, m, p in runs).encode()), sha(plain_collapsed(words, runs)))


def repeated(r, n, k):
    words = [r.randrange(k) for _ in range(n)]
    if n:
        a, p = r.randrange(n), r.randrange(1, max(2, n // 4))
        for i in range(a + p, min(n, a + p * r.randrange(2, 9) + r.randrange(p))):
            words[i] = words[i - p]
    return words


@pytest.mark.parametrize("least", [1, 3, 10, 24])
def test_runs_of_several_documents(least):
    r = random.Random(least)
    for _ in range(150):
        docs = [[1000 * d + x for x in repeated(r, r.choice([0, 5, 24, 30, 60, 200]), r.choice([1, 2, 3, 20]))] for d in range(3)]
        sizes = np.array([len(d) for d in docs])
        want = [(s + at, s + at + n, p) for d, at in zip(docs, np.cumsum(sizes) - sizes) for s, n, p in plain_runs(d, least)]
        assert [tuple(x) for x in find_runs(np.array(sum(docs, []), np.int64), sizes, least).tolist()] == want
    with pytest.raises(ValueError):
        find_runs(np.arange(3), np.array([3]), 24, 2)


def test_same_as_definition(spark, tmp_path):
    r = random.Random(3)
    texts = [" ".join(f"w{x}" for _ in range(2) for x in repeated(r, r.choice([0, 1, 23, 24, 40, 150]), r.choice([1, 2, 5]))) for _ in range(220)]
    texts += [None, "", " \t\n", "a " * 24, "é ß x y " * 30, "a\x0bb\x0cc\r\n" * 9, "x " * 5000, "x" * 100_000, "A a " * 12]
    rows = [(i, t, "en", "a", 1) for i, t in enumerate(texts)] + [(7, texts[7], "en", "a", 1), (None, "a b " * 20, None, None, None)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    got = [tuple(x) for x in op13(spark, str(tmp_path)).collect()]
    assert sorted(got, key=str) == sorted((plain(i, t) for i, t, *_ in rows), key=str)
    assert sum(x[1] > 1 for x in got) > 5 and sum(x[1] > 0 for x in got) > 40


def test_same_as_definition_on_the_documents(spark):
    at = "/root/testdata/sf0.001"
    want = {r.doc_id: plain(r.doc_id, r.text) for r in spark.read.parquet(f"{at}/documents.parquet").collect() if len(r.text) < 6000}
    got = {r.doc_id: tuple(r) for r in op13(spark, at).collect()}
    assert len(want) > 150 and {k: got[k] for k in want} == want


def test_long_text_and_other_columns(spark, docs, no_docs):
    r = random.Random(5)
    words = [f"w{r.randrange(9)}" for _ in range(40_000)]
    words[100:20_100] = (words[100:1_100]) * 20
    rows = [(" ".join(words), 1, "z"), (None, 2, "z")] * 2
    df = spark.createDataFrame(rows, "text string, runs int, `a.b` string").withColumns({c: F.lit(c) for c in ("row", "n_words", "collapsed", "words")})
    out = collapse_runs(df)
    assert out.columns == ["text", "a.b", "row", "words", "n_words", "runs", "collapsed"]
    got = out.collect()
    long_ = [x for x in got if x["text"]]
    assert len(got) == 4 and len(long_) == 2 and long_[0].runs == long_[1].runs and long_[0].n_words == 40_000
    assert any(x.period == 1000 and x.start <= 100 and x.start + x.length >= 20_100 for x in long_[0].runs)
    assert {(x.n_words, len(x.runs), x.collapsed) for x in got if x["text"] is None} == {(0, 0, "")}
    assert collapse_runs(no_docs).collect() == []
