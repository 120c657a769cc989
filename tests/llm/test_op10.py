import hashlib
import random

import numpy as np

from sievework.llm import common as C
from sievework.llm import suffix_dedup as S
from sievework.llm.suffix_dedup import multikey_sort, suffix_dedup


def brute(rows, n=100):
    raws = [(2**63 if d is None else d, d, (t or "").encode()) for d, t, *_ in rows]
    least = {}
    for k, _, b in raws:
        for i in range(len(b) - n + 1):
            s = b[i : i + n]
            least[s] = min(least.get(s, (k, i)), (k, i))
    out = []
    for k, d, b in raws:
        gone = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - n + 1):
            if least[b[i : i + n]] < (k, i):
                gone[i : i + n] = True
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((d, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def got(df):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, len(r.spans), hashlib.sha256(r.kept).hexdigest()) for r in df.collect()), key=str)


def test_same_as_brute_force(docs, rows):
    out = got(suffix_dedup(docs))
    assert out == brute(rows)
    assert sum(x[2] for x in out) > 1000


def test_short_strings_repeats_and_other_columns(spark, rows):
    some = [r for r in rows[:16] for _ in range(2)] + [(2000, "ab" * 200, "en", "a", 1), (2001, "\x00" * 90 + "ab" * 60, "en", "a", 1), (2002, "\x00" * 150, "en", "a", 1)]
    df = spark.createDataFrame([(*r, 1, "z") for r in some], "doc_id long, text string, lang string, source string, n_chars long, src int, keys string")
    assert got(suffix_dedup(df, length=30, token=10)) == brute(some, 30)


def test_empty(no_docs):
    assert suffix_dedup(no_docs).collect() == []


def test_multikey_sort():
    r = random.Random(1)
    s = [bytes(r.choice(b"ab") for _ in range(21)) for _ in range(400)] + [b"a" * 21] * 3
    order, shared = multikey_sort(np.frombuffer(b"".join(s), np.uint8).reshape(-1, 21))
    t = [s[i] for i in order]
    assert t == sorted(s)
    assert all(a[:k] == b[:k] and (k == 21 or a[k] != b[k]) for a, b, k in zip(t, t[1:], shared[1:].tolist()))


def test_hot_tokens(spark, docs, rows, monkeypatch):
    """Every token hot, or every third, and ranges dealt on by hash: the same result."""
    plain = S._splitters
    for step in (1, 3):

        def all_hot(docs, text_col, length, token, ranges, sample_docs, seed, step=step):
            splitters, _ = plain(docs, text_col, length, token, ranges, sample_docs, seed)
            seen = {(r.text or "").encode()[i : i + token] for r in docs.select("text").collect() for i in range(len((r.text or "").encode()) - token + 1)}
            return splitters, np.unique(np.array(sorted(seen)[::step], dtype=f"S{token}"))

        monkeypatch.setattr(S, "_splitters", all_hot)
        some = docs.where("doc_id < 50 or doc_id > 1003 or doc_id is null")
        assert got(suffix_dedup(some)) == brute([r for r in rows if r[0] is None or r[0] < 50 or r[0] > 1003])
    monkeypatch.setattr(S, "_splitters", plain)
    monkeypatch.setattr(S, "MOST_RANGES", 3)
    assert got(suffix_dedup(docs)) == brute(rows)


def test_one_passage_in_many_documents(spark):
    r = random.Random(8)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(7))
    passage = " ".join(word() for _ in range(40))
    rows = [(i, " ".join(word() for _ in range(12)) + " " + passage + " " + " ".join(word() for _ in range(12))) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    splitters, hot = S._splitters(df, "text", 100, 32, 64, 1000, 13)
    assert len(hot)
    out = got(suffix_dedup(df))
    assert out == brute(rows) and sum(x[2] > 200 for x in out) == 299


def test_groups_of_groups(docs, rows, monkeypatch):
    monkeypatch.setattr(C, "MOST_BLOCKS", 0)
    monkeypatch.setattr(C, "group_count", lambda *a: 30)
    monkeypatch.setattr(C, "bucket_count", lambda *a: 5)
    assert got(suffix_dedup(docs)) == brute(rows)
