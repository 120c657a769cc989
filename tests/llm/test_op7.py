import random
import re

import duckdb
import numpy as np
from pyspark.sql import functions as F

from sievework.llm.decontaminate import OP7_SQL, FMIndex, decontaminate, find_contamination, op7

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def split(t):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def brute(rows, items, n=10):
    wins = {}
    for k, t in items:
        w = split(t)
        for i in range(max(1, len(w) - n + 1) if w else 0):
            wins.setdefault(tuple(w[i : i + n]), set()).add(k)
    out = []
    for d, t, *_ in rows:
        w, hit, got = split(t), set(), set()
        for size in {len(x) for x in wins}:
            for i in range(len(w) - size + 1):
                if tuple(w[i : i + size]) in wins:
                    hit |= set(range(i, i + size))
                    got |= wins[tuple(w[i : i + size])]
        out.append((d, len(w), len(hit), sorted(str(x) for x in got if x is not None)))
    return sorted(out, key=str)


def items_of(rows):
    r = random.Random(5)
    texts = [x[1].split() for x in rows if x[1] and len(x[1].split()) > 30]
    out = [(i, " ".join(w[3 : 3 + r.choice([4, 12, 25])]).upper() if i % 2 else " ".join(w[5:20])) for i, w in enumerate(texts[:12])]
    return out + [(100, None), (101, ""), (102, "w1, w2!"), (103, "same"), (None, "w3 w4 w5"), (102, "w1, w2!"), (104, "nowhere " * 12)]


def flat(df):
    return sorted(((r.doc_id, r.n_words, sum(s.end - s.start for s in r.spans), list(r["items"])) for r in df.collect()), key=str)


def test_same_as_brute_force(spark, docs, rows, no_docs):
    items = items_of(rows)
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = brute(rows, items)
    assert flat(find_contamination(docs, bench)) == want and sum(x[2] for x in want) > 100
    assert flat(find_contamination(docs.withColumn("spans", docs.doc_id), bench, block_bytes=200)) == want
    clean = decontaminate(docs, bench)
    assert clean.columns == docs.columns
    assert sorted((r.doc_id for r in clean.collect()), key=str) == sorted((x[0] for x in want if not x[2]), key=str)
    cut = {r.doc_id: r.text for r in decontaminate(docs, bench, drop=False).collect()}
    assert all(len(split(cut[d])) == n - h for d, n, h, _ in want)
    assert find_contamination(no_docs, bench).collect() == []
    assert flat(find_contamination(docs, bench.limit(0))) == brute(rows, [])


def test_clashing_columns_and_repeated_rows(spark, docs, rows):
    bench = spark.createDataFrame(items_of(rows), "item_id long, text string")
    more = docs.union(docs).withColumns({c: F.lit(c) for c in ("_row", "_text", "row", "items", "a.b")})
    found = find_contamination(more, bench)
    assert flat(found) == sorted([*brute(rows, items_of(rows))] * 2, key=str) and {r["a.b"] for r in found.collect()} == {"a.b"}
    for drop in (True, False):
        out = decontaminate(more, bench, drop=drop)
        assert out.columns == more.columns and {r["items"] for r in out.collect()} == {"items"}
        assert out.count() == 2 * decontaminate(docs, bench, drop=drop).count()


def test_same_as_sql(spark):
    at = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for n in ("documents", "benchmark"):
        con.sql(f"CREATE VIEW {n} AS SELECT * FROM '{at}/{n}.parquet'")
    cols = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    got = sorted(tuple(r[c] for c in cols) for r in op7(spark, at).collect())
    assert got == sorted(con.sql(f"SELECT {', '.join(cols)} FROM ({OP7_SQL})").fetchall()) and any(r[-1] for r in got)


def test_index_finds_all_occurrences():
    r = np.random.default_rng(2)
    for n, s in ((1, 3), (50, 2), (3000, 4), (2000, 300)):
        seq = r.integers(0, s + 1, n).astype(np.int32)
        seq[n // 2 :] = seq[: n - n // 2] if n > 60 else seq[n // 2 :]
        index = FMIndex(seq, s)
        for size in (1, 2, 5):
            p = np.array([seq[i : i + size] for i in range(0, max(n - size, 0), 37)] + [r.integers(1, s + 1, size) for _ in range(20)], np.int32)
            p = p[(p > 0).all(axis=1)]
            for q, low, high in zip(p, *index.search(p)):
                want = [i for i in range(n - size + 1) if (seq[i : i + size] == q).all()]
                assert sorted(index.locate(np.arange(low, high)).tolist()) == want
