"""The queries over whole tables against plain Python."""

from collections import Counter, defaultdict

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from sievework.catalog import QUERIES, pairs
from sievework.operators.control import seed_chunks, with_order

AT = "/root/testdata/sf0.001"


def rows(name):
    return pq.read_table(f"{AT}/{name}.parquet").to_pylist()


@pytest.fixture(scope="module")
def run(spark):
    return lambda name: [r.asDict() for r in QUERIES[name](spark, AT).collect()]


def test_scan_jsonl(run):
    keys = ("doc_id", "text", "lang", "source", "n_chars")
    plain = lambda rs: sorted(repr([r[k] for k in keys]) for r in rs)
    assert plain(run("scan_jsonl")) == plain(rows("documents"))


def test_patterns(spark, run):
    lost = {}
    for r in pairs(spark, AT).collect():
        lost[r.doc_id] = f"https://ex.org/p{r.doc_id}?q=1" not in r.target_text, f"a{r.doc_id}@ex.org" not in r.target_text
    assert any(any(v) for k, v in lost.items() if k % 5 == 3)
    misses = {r["doc_id"]: r for r in run("pattern_misses")}
    assert {k: (r["url"] > 0, r["email"] > 0) for k, r in misses.items()} == lost
    assert {r["doc_id"]: r["bad"] for r in run("v_patterns")} == {k: any(lost[k]) or r["number"] != "" for k, r in misses.items()}
    assert any(r["number"] for r in misses.values())


def test_issues(run):
    docs = {r["doc_id"]: r["text"] for r in rows("documents")}
    assert max(map(len, docs.values())) >= 3000
    n, left = {}, {}
    for k, text in docs.items():
        w = text.split()
        own = [w[i * (len(w) - 1) // 7] for i in range(8)] if w else []
        spans = [*own, own[0].upper() if own else None, "zzqq", "Zzqq", None]
        n[k] = sum(not x or x not in text for x in spans)
        names = ["R1"] * (len(own) + 1) + ["R2", "R2", "R3"]
        kept = [(x, r) for x, r in zip(spans, names) if (not x or x.casefold() not in text.casefold()) and not (x and x[:1].isupper())]
        left[k] = ",".join(x if x is not None else r for x, r in kept)
    assert {r["doc_id"]: r["n"] for r in run("suppress_verbatim")} == n and len(set(n.values())) > 1
    assert {r["doc_id"]: r["left"] for r in run("lt_findings_filter")} == left


def test_pattern_misses_by_the_modifier(run):
    """Every lost address and number of the plain form, the numbers themselves among them, and how many those are."""
    want = [r | {"numbers": len(r["number"].split(",")) if r["number"] else 0} for r in run("pattern_misses")]
    assert sorted(run("pattern_misses_whole"), key=repr) == sorted(want, key=repr) and max(r["numbers"] for r in want) > 1


def test_findings_filter_with_and_without_reference(run):
    """Both filters, as the plain form; and capitals alone, which leave what stands in the text."""
    got = {r["doc_id"]: r for r in run("lt_findings_filter_whole")}
    assert {k: r["left"] for k, r in got.items()} == {r["doc_id"]: r["left"] for r in run("lt_findings_filter")}
    for r in rows("documents"):
        w = r["text"].split()
        spans = [*[w[i * (len(w) - 1) // 7] for i in range(8)], w[0].upper(), "zzqq", "R3"] if w else ["R1", "zzqq", "R3"]
        assert got[r["doc_id"]]["alone"] == ",".join(x for i, x in enumerate(spans) if i == len(spans) - 1 or x == "R1" and not w or not x[:1].isupper())


def test_align_items(run):
    replies = defaultdict(list)
    for r in rows("lineitem"):
        replies[r["l_orderkey"], r["l_suppkey"] % 5].append(str(r["l_shipdate"])[:10])
    one = lambda x: x[0] if len(x) == 1 else None
    want = Counter((o["o_orderkey"], i, one(replies[o["o_orderkey"], i])) for o in rows("orders") for i in range(1, 5))
    assert Counter((r["k"], r["item"], r["reply"]) for r in run("align_items")) == want


def test_plan_diff(run):
    seen = defaultdict(list)
    for r in rows("events"):
        seen[r["user_id"] % 50, r["user_id"] // 50 % 2].append(r["event_type"])
    sig = {k: (min(v), len(v) % 3) for k, v in seen.items()}
    assert {r["stage"] for r in run("plan_diff")} == {k for k, _ in sig if sig.get((k, 0)) != sig.get((k, 1))}


def test_numbering_keeps_every_row(spark):
    """Whole tables with all columns: as many rows as before, each with a place of its own."""
    at = "/root/testdata/sf0.1"
    docs, orders = (spark.read.parquet(f"{at}/{n}.parquet") for n in ("documents", "orders"))
    for df, key in ((docs, "doc_id"), (orders, "o_orderkey")):
        out = with_order(df, key, "pos")
        n, low, high, places = out.agg(F.count("*"), F.min("pos"), F.max("pos"), F.count_distinct("pos")).first()
        assert (n, low, high, places) == (df.count(), 0, n - 1, n)
        assert not out.select(key, "pos").join(out.select(F.col(key).alias("k"), (F.col("pos") - 1).alias("pos")), "pos").where(f"k < {key}").head(1)
    out = seed_chunks(docs, "doc_id", "lang", ["en", "de"])
    assert out.count() == docs.count() == out.select("seed_id").distinct().count()
    assert {r["count"] for r in out.groupBy("chunk_id").count().collect()} <= {20, docs.count() % 20 or 20}
    assert with_order(docs.limit(0), "doc_id").collect() == []
