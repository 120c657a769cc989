"""Every registered query against its SQL on the smallest tables."""

import duckdb
import pytest

from sievework.catalog import ORACLES, QUERIES

AT = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.sql("SET TimeZone = 'UTC'")
    for n in TABLES.split():
        c.sql(f"CREATE VIEW {n} AS SELECT * FROM '{AT}/{n}.parquet'")
    return c


def plain(v):
    return f"{v:.6f}" if isinstance(v, float) else str(v)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_as_sql(spark, con, name):
    df = QUERIES[name](spark, AT)
    cols = sorted(df.columns)
    got = sorted(tuple(plain(r[c]) for c in cols) for r in df.collect())
    if name in ORACLES:
        want = con.sql(f"SELECT {', '.join(f'"{c}"' for c in cols)} FROM ({ORACLES[name]})").fetchall()
        assert got == sorted(tuple(map(plain, r)) for r in want)
    else:
        assert got
