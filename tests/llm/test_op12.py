import random
import re
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from sievework.llm import phrases as P
from sievework.llm.phrases import OP12_SQL, op12, phrases, top_phrases


def plain(rows, least, cover=80, longest=4):
    """All candidates of (lang, text) rows, by counting every phrase."""
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    f[lang, tuple(words[i : i + k])] += 1
    out = {}
    for (lang, p), a in f.items():
        if len(p) > 1 and a >= least:
            score, cut = min((2_000_000 * a // (f[lang, p[:k]] + f[lang, p[k:]]), k) for k in range(1, len(p)))
            out[lang, p] = [a, f[lang, p[:cut]], f[lang, p[cut:]], score, None]
    for (lang, p), x in list(out.items()):
        for k in range(2, len(p)):
            for i in range(len(p) - k + 1):
                part = out[lang, p[i : i + k]]
                part[4] = max(part[4] or 0, x[0])
    return {(lang, " ".join(p)): (a, l, r, score, covered, covered is not None and 100 * covered >= cover * a, n[lang]) for (lang, p), (a, l, r, score, covered) in out.items()}


def corpus(r, n=120):
    fixed = ["alpha beta gamma delta", "Alpha beta", "x y z", "é ß w", "on and on and on"]
    rows = []
    for i in range(n):
        words = []
        for _ in range(r.choice([0, 1, 5, 20, 60])):
            words.append(r.choice(fixed) if r.random() < 0.3 else r.choice("a b c dd ee the of in".split()))
            words.append(r.choice([" ", " ", " ", "  ", "\t", ". ", ", ", "\n", ";", " - ", ".\x0b"]))
        rows.append((i, "".join(words), r.choice(["en", "en", "de", None, "und", "", "a\n\"b\t"])))
    return rows + [(1000, None, "en"), (1001, "", None), (1002, " .,; \n", "fr"), (1003, "one two " * 4000, "en"), (1004, "A\x00b " * 50, "en"), (None, "x y z", "de")] + rows[:9]


@pytest.mark.parametrize("chunk,least,longest,blocks", [(1 << 22, 5, 4, 1 << 22), (300, 5, 4, 0), (500, 2, 5, 1 << 22)])
def test_same_as_counting(spark, monkeypatch, chunk, least, longest, blocks):
    """One chunk or many a task; blocks straight to their buckets, or (blocks = 0) by way of groups of chunks."""
    monkeypatch.setattr(P, "CHUNK_WORDS", chunk)
    monkeypatch.setattr(P, "MOST_BLOCKS", blocks)
    rows = corpus(random.Random(chunk))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    got = phrases(df, least=least, longest=longest).collect()
    want = plain([(lang, t) for _, t, lang in rows], least, longest=longest)
    assert len(want) > 30 and len({lang for lang, _ in want}) >= 4
    assert {(x.lang, x.phrase): (x.a, x.l, x.r, x.score, x.covered, x.dropped, x.n) for x in got} == want and len(got) == len(want)


def test_top_by_bytes_and_ties(spark):
    df = spark.createDataFrame([("en", p, 2, 9, 9, 9, 1, s, None, d, 100) for p, s, d in [("é x", 5, False), ("z x", 5, False), ("a x", 5, True), ("\U0001f600 x", 5, False), ("￮ x", 5, False), ("b x", 7, False)]], "lang string, phrase string, words int, a long, l long, r long, cut int, score long, covered long, dropped boolean, n long")
    assert [(x["rank"], x.phrase) for x in top_phrases(df, 4).orderBy("rank").collect()] == [(1, "b x"), (2, "z x"), (3, "é x"), (4, "￮ x")]


def test_counts_past_64_bits(spark):
    big = 6 * 10**18
    level = spark.createDataFrame([(1, 2, 3, "en", "p q", big, [big, big], [big + 7, big])], "id long, left long, right long, lang string, phrase string, a long, pre array<long>, suf array<long>")
    assert P.scored(level, None, 2).first().score == 2_000_000 * big // (big + big + 7)


@pytest.mark.parametrize("sf", ["sf0.01"])
def test_same_as_sql(spark, sf, tmp_path):
    rows = corpus(random.Random(9), 400)
    spark.createDataFrame(rows, "doc_id long, text string, lang string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    for at, files in ((str(tmp_path), "/*.parquet"), (f"/root/testdata/{sf}", "")):
        con.sql(f"CREATE OR REPLACE VIEW documents AS SELECT * FROM '{at}/documents.parquet{files}'")
        want = con.sql(OP12_SQL).fetchall()
        assert sorted(map(tuple, op12(spark, at).collect())) == sorted(want) and len(want) > 20


def test_empty_and_other_columns(spark, docs, no_docs):
    assert phrases(no_docs).collect() == [] and top_phrases(phrases(docs.where("doc_id = 1001"))).collect() == []
    more = docs.withColumns({c: F.lit(c) for c in ("chunk", "local", "word", "n", "at", "id", "a.b", "left")})
    key = lambda x: (x.lang, x.phrase, x.a, x.score)
    assert sorted(map(key, phrases(more).collect())) == sorted(map(key, phrases(docs).collect()))
