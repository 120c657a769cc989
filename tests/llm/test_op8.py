import random

import duckdb
import numpy as np
import pytest

from sievework.llm.binary_search import OP8_SQL, MultiIndex, nearest_codes, op8


@pytest.mark.parametrize("n,k", [(1, 3), (7, 10), (600, 10), (3000, 5)])
def test_index_is_exact(n, k):
    r = random.Random(n)
    base = [r.getrandbits(64) for _ in range(max(1, n // 4))]
    base += base[:1] * n if n == 600 else []
    codes = np.array([r.choice(base) ^ sum({1 << r.randrange(64) for _ in range(r.randrange(5))}) for _ in range(n)], np.uint64)
    ids = np.array(r.sample(range(10 * n), n))
    q = r.sample(range(n), min(n, 40))
    for x, (d, i) in [y for c in (None, k + 1) for y in zip(q, MultiIndex(ids, codes, c).search(codes[q], ids[q], k))]:
        want = sorted((int(codes[y] ^ codes[x]).bit_count(), int(ids[y])) for y in range(n) if y != x)[:k]
        assert list(zip(d.tolist(), i.tolist())) == want


def test_same_as_sql(spark):
    at = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{at}/embeddings.parquet'")
    want = con.sql(f"SELECT query_id, rank, neighbor_id, distance FROM ({OP8_SQL})").fetchall()
    got = [tuple(r) for r in op8(spark, at).collect()]
    assert sorted(got) == sorted(want) and len(want) == 250


def test_edges(spark):
    rows = [(0, [1.0] * 64, "a"), (1, [1.0] * 64, "b"), (1, [1.0] * 64, "b"), (2, None, "c"), (None, [1.0] * 64, "d"), (20, [-1.0] * 64, "e"), (3, [], "f"), (4, [None, 1.0], "g")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, rank string")
    got = sorted(map(tuple, nearest_codes(df, df.where("vec_id % 20 = 0"), k=2, part_rows=2).collect()))
    assert got == [(0, 1, 1, 0), (0, 2, 4, 63), (20, 1, 3, 0), (20, 2, 4, 1)]
    assert nearest_codes(df.limit(0), df.limit(0)).collect() == []


def test_repeated_rows_of_one_code_count_once(spark):
    one, near = [1.0] * 64, [-1.0] + [1.0] * 63
    rows = [(i, one) for i in range(20) for _ in range(3)] + [(i, near) for i in range(100, 115)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted(map(tuple, nearest_codes(df, df.where("vec_id = 0"), k=10, part_rows=1000).collect()))
    assert got == [(0, i, i, 0) for i in range(1, 11)]
    ids, codes = np.repeat(np.arange(20), 3), np.full(60, 7, np.uint64)
    assert MultiIndex(ids, codes, 11).search(codes[:1], ids[:1], 10)[0][1].tolist() == list(range(1, 11))


@pytest.mark.parametrize("part_rows", [5000, 100, 20])
def test_routed_search_is_exact(spark, part_rows):
    r = random.Random(part_rows)
    base = [r.getrandbits(64) for _ in range(150)]
    codes = [r.choice(base) ^ sum({1 << r.randrange(64) for _ in range(r.randrange(6))}) for _ in range(900)] + [r.getrandbits(64) for _ in range(60)] + [base[0]] * 40
    vector = lambda c: [1.0 if c >> i & 1 else -1.0 for i in range(64)]
    df = spark.createDataFrame([(i, vector(c)) for i, c in enumerate(codes)], "vec_id long, embedding array<double>")
    got = sorted(map(tuple, nearest_codes(df, df.where("vec_id % 10 = 0"), k=5, part_rows=part_rows).collect()))
    want = []
    for q in range(0, len(codes), 10):
        near = sorted(((codes[q] ^ c).bit_count(), i) for i, c in enumerate(codes) if i != q)[:5]
        want += [(q, n + 1, i, d) for n, (d, i) in enumerate(near)]
    assert got == sorted(want)


def test_long_vectors_are_refused(spark):
    df = spark.createDataFrame([(0, [1.0] * 65)], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="more than 64"):
        nearest_codes(df, df).collect()
