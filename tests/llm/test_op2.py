import math
from collections import Counter, defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from sievework.llm.mixing import OP2_SQL, mix, op2, planned_copies


def targets(rows):
    size = Counter()
    for _, t, _, s, *_ in rows:
        size[s] += len((t or "").encode().split())
    names = sorted(size, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, capped = sum(size.values()), set()
    while True:
        free = [s for s in names if s not in capped]
        rest = total - sum(3 * size[s] for s in capped)
        t = {s: 3 * size[s] if s in capped else rest * weight[s] / sum(weight[x] for x in free) for s in names}
        over = {s for s in free if t[s] > 3 * size[s]}
        if not over:
            return size, t
        capped |= over


def test_targets_and_copies(docs, rows, no_docs):
    size, want = targets(rows)
    got = planned_copies(docs).collect()
    assert len(got) == len(rows)
    taken = defaultdict(int)
    for r in got:
        assert r.source_size == size[r.source] and math.isclose(r.target, want[r.source]) and 0 <= r.copies <= 3
        taken[r.source] += r.copies * r.size
    out = mix(docs)
    assert out.columns == docs.columns
    n = Counter(r.doc_id for r in out.collect())
    assert n == Counter({r.id: r.copies for r in got if r.copies})
    assert planned_copies(no_docs).collect() == [] and mix(no_docs).collect() == []


def test_repeated_rows(spark, docs):
    twice = docs.unionByName(docs)
    n = Counter(r.doc_id for r in mix(twice).collect())
    want = Counter()
    for r in planned_copies(twice).collect():
        want[r.id] += r.copies
    assert n == +want


@pytest.mark.parametrize("sf", ["sf0.001"])
def test_near_targets_and_same_as_sql(spark, sf):
    at = f"/root/testdata/{sf}"
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{at}/documents.parquet'")
    rows = op2(spark, at).collect()
    cols = ["doc_id", "size", "source_size", "target", "taken"]
    want = con.sql(f"SELECT {', '.join(cols)} FROM ({OP2_SQL})").fetchall()
    assert sorted(tuple(r[c] for c in cols) for r in rows) == sorted(want)
    taken, target = defaultdict(int), {}
    for r in rows:
        taken[r.target] += r.taken
    assert abs(sum(taken.values()) / sum(r.size for r in rows) - 1) < 0.1


CLASH = ("id", "copies", "_mix_k", "size", "slice", "class", "source_key", "key_a", "m", "row", "rows", "last", "rank", "a.b", "col", "_k", "_part")


def test_clashing_columns_and_hot_null_ids(spark, docs):
    more = docs.withColumns({c: F.lit(c) for c in CLASH})
    out = mix(more)
    assert out.columns == more.columns
    assert Counter(r.doc_id for r in out.collect()) == Counter(r.doc_id for r in mix(docs).collect())
    assert {r["a.b"] for r in out.collect()} == {"a.b"}
    lost = spark.createDataFrame([(None, f"w {i % 5}", "en", "a" if i % 2 else None, 1) for i in range(300)], docs.schema)
    want = Counter()
    for r in planned_copies(lost).collect():
        want[r.id, r.source] += r.copies
    assert Counter((r.doc_id, r.source) for r in mix(lost).collect()) == want


def test_many_sources(spark):
    rows = [(i, "w " * (1 + i % 11), f"s{i % 700:03d}") for i in range(3000)]
    got = planned_copies(spark.createDataFrame(rows, "doc_id long, text string, source string")).select("source", "target").distinct().collect()
    _, want = targets([(i, t, None, s) for i, t, s in rows])
    assert {r.source: r.target for r in got} == pytest.approx(want)
