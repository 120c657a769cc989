import hashlib

import duckdb
import pytest

from sievework.llm import common as C
from sievework.llm.substring_dedup import OP1_SQL, op1, substring_dedup


def brute(rows, w=13):
    split = [(2**63 if d is None else d, d, (t or "").encode().split()) for d, t, *_ in rows]
    least = {}
    for k, _, ws in split:
        for i in range(len(ws) - w + 1):
            key = tuple(ws[i : i + w])
            least[key] = min(least.get(key, k), k)
    out = []
    for k, d, ws in split:
        gone = set()
        for i in range(len(ws) - w + 1):
            if least[tuple(ws[i : i + w])] < k:
                gone |= set(range(i, i + w))
        kept = b" ".join(x for i, x in enumerate(ws) if i not in gone)
        out.append((d, len(ws), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def got(df):
    return sorted(((r.doc_id, r.n_words, r.n_removed, hashlib.sha256(r.kept_text.encode()).hexdigest()) for r in df.collect()), key=str)


def test_same_as_brute_force(docs, rows):
    out = got(substring_dedup(docs))
    assert out == brute(rows)
    assert sum(x[2] for x in out) > 100


def test_repeated_rows_and_other_columns(spark, rows):
    twice = [r for r in rows[:12] for _ in range(2)]
    df = spark.createDataFrame([(*r, 1, "z") for r in twice], "doc_id long, text string, lang string, source string, n_chars long, src int, keys string")
    assert got(substring_dedup(df)) == brute(twice)


def test_other_window(docs, rows):
    assert got(substring_dedup(docs, window=20, period=13)) == brute(rows, 20)


def test_empty(no_docs):
    assert substring_dedup(no_docs).collect() == []


@pytest.mark.parametrize("groups", [12, 40])
def test_groups_of_groups(docs, rows, monkeypatch, groups):
    monkeypatch.setattr(C, "MOST_BLOCKS", 0)
    monkeypatch.setattr(C, "group_count", lambda *a: groups)
    monkeypatch.setattr(C, "bucket_count", lambda *a: 7)
    assert got(substring_dedup(docs)) == brute(rows)


def test_null_ids_are_dealt_out(spark, docs):
    lost = spark.createDataFrame([(None, f"text {i}", "en", "a", 1) for i in range(400)], docs.schema)
    sizes = [r["count"] for r in C.grouped_docs(lost, "doc_id", "text", 8).groupBy("src").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 90


def test_same_as_sql(spark):
    at = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{at}/documents.parquet'")
    cols = ["doc_id", "n_words", "n_removed", "kept_sha256"]
    rows = sorted(tuple(r[c] for c in cols) for r in op1(spark, at).collect())
    assert rows == sorted(con.sql(f"SELECT {', '.join(cols)} FROM ({OP1_SQL})").fetchall()) and any(r[2] for r in rows)
