import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from sievework.llm.quality import Logistic, quality_filter, score_quality, site_sums, without_own


def test_held_out_accuracy(spark):
    at = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{at}/documents.parquet").where("doc_id < 6000"), spark.read.parquet(f"{at}/labels.parquet")
    fit = labels.where("doc_id % 3 <> 0")
    rows = score_quality(docs, fit).join(labels.where("doc_id % 3 = 0"), "doc_id").select("keep", "quality", "toxic").collect()
    clean, bad = [r.keep for r in rows if r.quality and not r.toxic], [r.keep for r in rows if not r.quality or r.toxic]
    print(len(clean), sum(clean) / len(clean), len(bad), sum(bad) / len(bad))
    assert sum(clean) / len(clean) > 0.95 and sum(bad) / len(bad) < 0.12


def plain_posterior(rows, totals):
    """rows of (host, path, p) -> p_site and score of each, by the definition: sums over the other rows."""
    out = []
    for i, (h, w, p) in enumerate(rows):
        rest = rows[:i] + rows[i + 1 :]
        mean = sum(x[2] for x in rest) / len(rest)
        of_host, of_path = [x[2] for x in rest if x[0] == h], [x[2] for x in rest if x[:2] == (h, w)]
        host = (sum(of_host) + totals["host"] * mean) / (len(of_host) + totals["host"])
        site = (sum(of_path) + totals["path"] * host) / (len(of_path) + totals["path"])
        odds = lambda x: math.log(x / (1 - x))
        out.append((site, 1 / (1 + math.exp(-(odds(p) + odds(site) - odds(mean))))))
    return out


def plain_strength(groups, mean):
    n = sum(map(len, groups))
    spread = (sum(len(g) * (sum(g) / len(g) - mean) ** 2 for g in groups) - mean * (1 - mean) * (len(groups) - 1)) / n
    return min(max(mean * (1 - mean) / spread - 1, 2.0), 1e5) if spread > 1e-12 else 1e5


def test_posterior_against_definition(spark, docs):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(40)], "doc_id long, quality int, toxic int")
    got = score_quality(docs, labels).select("source", "lang", "p_doc", "p_site", "score", "keep").collect()
    rows = [(r.source, r.lang, r.p_doc) for r in got]
    mean = sum(r[2] for r in rows) / len(rows)
    groups = lambda n: [[x[2] for x in rows if x[:n] == k] for k in {x[:n] for x in rows}]
    want = plain_posterior(rows, {"host": plain_strength(groups(1), mean), "path": plain_strength(groups(2), mean)})
    for r, (site, score) in zip(got, want):
        assert r.p_site == pytest.approx(site, abs=1e-9) and r.score == pytest.approx(score, abs=1e-9) and r.keep == (r.score >= 0.5)
    assert len({r.p_doc for r in got}) > 10


def test_shrinkage(spark):
    rows = [("a", "x", 0.9)] * 500 + [("a", "y", 0.1)] + [("b", "x", 0.2)] * 400 + [(None, "x", 0.5)] * 2
    sites, totals, n = site_sums(spark.createDataFrame(rows, "host string, path string, p double"))
    mean = totals["s"] / totals["n"]
    p = {(r.host, r.path): without_own(mean, r.n, r.s, r.hn, r.hs, totals)[0] for r in sites.collect()}
    assert n == 4 and p["a", "x"] > 0.85 and p["b", "x"] < 0.3 and 0.1 < p["a", "y"] < 0.95 and 0.4 < p[None, "x"] < mean + 0.1


CLASH = ("row", "text", "host", "path", "p", "n", "s", "hn", "hs", "of_host", "id", "q", "t", "a.b", "_host", "keep")


def test_clashing_columns(spark, docs, no_docs):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(40)], "doc_id long, quality int, toxic int")
    plain = docs.drop("n_chars").withColumns({c: F.lit(c) for c in CLASH if c != "text"})
    more = plain.select(*[F.col(f"`{c}`").alias({"text": "body"}.get(c, c)) for c in plain.columns]).withColumn("text", F.lit(1))
    kept, want = quality_filter(more, labels, text_col="body"), quality_filter(docs, labels)
    assert kept.columns == more.columns and sorted(map(str, kept.select("doc_id", "body").collect())) == sorted(str(r).replace("text=", "body=") for r in want.select("doc_id", "text").collect())
    assert {r["a.b"] for r in kept.collect()} == {"a.b"}
    assert score_quality(more, labels, text_col="body").count() == docs.count()
    assert quality_filter(no_docs, labels).collect() == []


def test_repeated_rows(spark, docs):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(40)], "doc_id long, quality int, toxic int")
    out = score_quality(docs.union(docs), labels.union(labels)).select("doc_id", "score").collect()
    assert len(out) == 2 * docs.count()
    for k in {r.doc_id for r in out if r.doc_id is not None}:
        assert len({round(r.score, 12) for r in out if r.doc_id == k}) == 1


def test_edges(spark, docs, no_docs):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(40)] + [(None, 1, 0), (41, None, None)], "doc_id long, quality int, toxic int")
    out = score_quality(docs.withColumn("keep", docs.lang), labels).collect()
    assert len(out) == docs.count() and all(0 <= r.score <= 1 for r in out)
    kept = quality_filter(docs, labels.limit(0))
    assert kept.columns == docs.columns and kept.count() == docs.count()
    assert score_quality(no_docs, labels).collect() == []


def test_logistic_learns():
    bad = [i % 4 == 0 for i in range(200)]
    row, word = np.array([i for i in range(200) for _ in range(1 if bad[i] else 2)]), np.array([w for b in bad for w in ([0] if b else [1, 2])])
    m = Logistic.fit([b"bad", b"x", b"y"], np.zeros((200, 8)), ~np.array(bad), row, word)
    assert m([0.0] * 8, {b"bad"}) < 0.2 < 0.8 < m([0.0] * 8, {b"x", b"y"})
    assert Logistic.fit([], np.zeros((0, 8)), np.zeros(0), np.zeros(0, int), np.zeros(0, int))([0.0] * 8, set()) == 0.5
    assert m([0.0] * 8, set()) == pytest.approx(m([0.0] * 8, {b"unseen"}))
