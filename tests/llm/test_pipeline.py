from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from sievework.llm.decontaminate import Phrases, shard_hits
from sievework.llm.token_store import encoder, tokenizer_path


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    at = "/root/testdata/sf0.001"
    docs, out = spark.read.parquet(f"{at}/documents.parquet"), []
    for k, (name, f) in enumerate(P.STAGES):
        path = str(tmp_path_factory.mktemp("stage") / str(k))
        f(spark, docs, at).write.parquet(path)
        out.append((docs, docs := spark.read.parquet(path)))
    return at, out


def test_stages_against_plain_versions(spark, stages):
    at, out = stages
    assert [name for name, _ in P.STAGES] == ["quality", "near_duplicates", "benchmark_free", "mixture", "tokens"]
    for before, after in out[:-1]:
        assert after.columns == before.columns and after.count() > 0
    before, after = ([tuple(r) for r in x.collect()] for x in out[0])
    assert set(after) < set(before) and len(after) > 0.6 * len(before)

    before, after = ([tuple(r) for r in x.collect()] for x in out[1])
    sets = {r[0]: {tuple(w[i : i + 5]) for w in [r[1].lower().split()] for i in range(max(1, len(w) - 4))} for r in before}
    kept, ids = {r[0] for r in after}, sorted(sets)
    like = {(a, b): len(sets[a] & sets[b]) / len(sets[a] | sets[b]) for a in ids for b in ids if a < b}
    assert set(after) < set(before) and len(kept) == len(after)
    assert not [p for p, j in like.items() if j >= 0.9 and p[0] in kept and p[1] in kept]
    near = [p for p, j in like.items() if 0.8 <= j < 0.9]
    assert sum(a in kept and b in kept for a, b in near) <= len(near) // 10
    assert all(max(j for p, j in like.items() if x in p) > 0.6 for x in set(ids) - kept)

    before, after = ([tuple(r) for r in x.collect()] for x in out[2])
    items = [(str(r.item_id), r.text) for r in spark.read.parquet(f"{at}/benchmark.parquet").collect()]
    hits = shard_hits([r[1] for r in before], Phrases(items, 10))[1]
    assert sorted(after) == sorted(r for r, h in zip(before, hits) if not h.any())

    before, after = ([tuple(r) for r in x.collect()] for x in out[3])
    assert set(after) <= set(before) and max(Counter(after).values()) <= 3

    before, after = (x.collect() for x in out[4])
    enc = encoder(tokenizer_path())
    assert sorted((r.doc_id, r.n_tokens) for r in after) == sorted((r.doc_id, len(enc.ids(r.text)) // enc.width + 1) for r in before)
    assert sorted(r.start for r in after)[0] == 0 and sum(r.n_tokens for r in after) == max(r.start + r.n_tokens for r in after)


def test_run_repeats(spark, stages):
    a, b = (sorted(map(tuple, P.run(spark, stages[0]).collect())) for _ in range(2))
    assert a == b == sorted(map(tuple, stages[1][-1][1].collect()))


@pytest.mark.parametrize("k", range(4))
def test_stage_on_odd_tables(spark, docs, no_docs, k):
    """Empty tables, repeated rows, nulls in every column and further columns of clashing names: no stage fails, and each
    gives the columns that it got."""
    at, (name, f) = "/root/testdata/sf0.001", P.STAGES[k]
    assert f(spark, no_docs, at).collect() == []
    odd = docs.union(docs).union(spark.createDataFrame([(None, None, None, None, None)] * 2, docs.schema))
    odd = odd.withColumns({c: F.lit(c) for c in ("row", "id", "copies", "_mix_k", "p_doc", "keep", "spans", "_text", "near_id", "a.b")})
    out = f(spark, odd, at)
    got, ids = out.collect(), {r.doc_id for r in odd.collect()}
    assert out.columns == odd.columns and got and {r.doc_id for r in got} <= ids and {r["a.b"] for r in got} == {"a.b"}


def test_tokens_of_odd_tables(spark, docs, no_docs):
    at = "/root/testdata/sf0.001"
    assert P.tokens(spark, no_docs, at).collect() == []
    odd = docs.union(docs).withColumns({c: F.lit(c) for c in ("part", "number", "start", "a.b")})
    assert P.tokens(spark, odd, at).count() == odd.count()
