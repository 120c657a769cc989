import zlib
from collections import Counter, defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from sievework.llm import sharding
from sievework.llm.sharding import OP11_SQL, op11, rendezvous, shard_plan, sharded, write_shards


def gapless(rows):
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    return all(sorted(x) == list(range(len(x))) for x in slots.values())


def digest(rows, id_="doc_id"):
    return Counter((r[id_], len((r.text or "").encode()) + 8, zlib.crc32((r.text or "").encode())) for r in rows)


def test_query(spark, docs, rows, tmp_path):
    docs.unionByName(docs.where("doc_id % 5 = 0")).write.parquet(f"{tmp_path}/documents.parquet")
    got = op11(spark, str(tmp_path)).collect()
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == digest(spark.read.parquet(f"{tmp_path}/documents.parquet").collect())
    assert gapless(got) and {r.law for r in got} == {"key"}
    by = defaultdict(set)
    for r in got:
        by[r.doc_id].add((r.shard, r.grown_shard))
    assert all(len(x) == 1 for x in by.values())
    assert all(g in (s, 24) for x in by.values() for s, g in x)


@pytest.mark.parametrize("sf", ["sf0.001"])
def test_same_as_sql(spark, sf, tmp_path):
    rows = [(i, t) for i, t in enumerate([None, "", "é" * 300, "a\nb", "same", "same"])] + [(5, "same"), (None, "x"), (None, "x"), (None, "y"), (-3, "neg"), (2**62, "big")]
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    for at, files in ((str(tmp_path), "/*.parquet"), (f"/root/testdata/{sf}", "")):
        con.sql(f"CREATE OR REPLACE VIEW documents AS SELECT * FROM '{at}/documents.parquet{files}'")
        assert sorted(map(tuple, op11(spark, at).collect()), key=str) == sorted(con.sql(OP11_SQL).fetchall(), key=str)


def test_shares_and_moves(spark):
    n = 40_000
    df = spark.range(n).select(F.xxhash64("id").alias("k"), "id")
    old, new = [1.0, 2.0, 0.0, 5.0], [1.0, 2.0, 0.0, 5.0, 2.0]
    got = df.select(rendezvous(F.col("k"), old).alias("a"), rendezvous(F.col("k"), new).alias("b"), rendezvous(F.col("k"), [1.0, 2.0, 0.0, 8.0]).alias("c")).select("a.shard", F.col("b.shard").alias("b"), F.col("c.shard").alias("c")).collect()
    share = Counter(r.shard for r in got)
    assert set(share) == {0, 1, 3} and all(abs(share[s] - n * w / 8) < 5 * (n * w / 8) ** 0.5 for s, w in enumerate(old) if w)
    assert all(r.b in (r.shard, 4) for r in got) and abs(sum(r.b == 4 for r in got) - n / 5) < 500
    assert all(r.c in (r.shard, 3) for r in got)


def test_rows_with_their_slots(spark, docs, rows, no_docs):
    more = docs.unionByName(docs.where("doc_id % 4 = 0")).withColumns({c: F.lit(c) for c in ("shard", "slot", "_key", "_0", "_slice", "copies", "row", "a.b", "_from", "key_a")})
    out = sharded(more, [1.0, 3.0], [1.0, 3.0, 1.0])
    assert out.columns == [c for c in more.columns if c not in ("shard", "slot")] + ["shard", "slot", "grown_shard"]
    got = out.collect()
    assert gapless(got) and digest(got) == digest(more.collect()) and {r["a.b"] for r in got} == {"a.b"}
    again = sharded(more.repartition(5), [1.0, 3.0], [1.0, 3.0, 1.0]).collect()
    assert Counter((r.doc_id, r.text, r.shard, r.slot) for r in got) == Counter((r.doc_id, r.text, r.shard, r.slot) for r in again)
    assert sharded(no_docs, [1.0]).collect() == [] and shard_plan(no_docs, [1.0]).collect() == []
    assert gapless(shard_plan(docs, [2.0], key_cols=("lang", "source"), keep=[F.col("doc_id").alias("i")]).collect())


def test_many_equal_rows(spark, monkeypatch):
    monkeypatch.setattr(sharding, "COPIES", 64)
    df = spark.range(900).select(F.when(F.col("id") < 600, 1).otherwise(F.col("id")).alias("doc_id"), F.when(F.col("id") < 600, "t").otherwise(F.col("id").cast("string")).alias("text"))
    plan = shard_plan(df, [1.0] * 3, keep=[F.col("doc_id")]).collect()
    assert len(plan) == 900 and gapless(plan)
    got = sharded(df, [1.0] * 3).collect()
    assert len(got) == 900 and gapless(got) and Counter(r.doc_id for r in got)[1] == 600


def test_files(spark, docs, tmp_path):
    write_shards(docs, f"{tmp_path}/out", [1.0, 1.0, 1.0])
    back = spark.read.parquet(f"{tmp_path}/out")
    assert digest(back.collect()) == digest(docs.collect()) and gapless(back.collect())


@pytest.mark.parametrize("weights", [[], [0.0], [1.0, -1.0], [float("inf")], [float("nan")]])
def test_weights_are_checked(docs, weights):
    with pytest.raises(ValueError):
        shard_plan(docs, weights)
