import difflib
import random

import pytest

from sievework.catalog import pairs
from sievework.functions import similarity as S
from sievework.functions import text as X
from sievework.operators import validators as V


def plain(a, b):
    return sum(m.size for m in difflib.SequenceMatcher(None, a, b, autojunk=False).get_matching_blocks())


@pytest.mark.parametrize("small", [400, 0])
def test_same_blocks_as_the_plain_form(monkeypatch, small):
    """By plain sets and by names: ties, empty texts, characters beyond the 16-bit range, copies with edits."""
    monkeypatch.setattr(S, "SMALL", small)
    r = random.Random(small)
    letters = "abcdefghijklmnopqrstuvwxyzé😀ß"
    for _ in range(400):
        k = r.choice([1, 2, 3, 29])
        a = "".join(r.choice(letters[:k]) for _ in range(r.randrange(60)))
        b = list(a) if r.random() < 0.7 else [r.choice(letters[:k]) for _ in range(r.randrange(60))]
        for _ in range(r.randrange(4)):
            i = r.randrange(len(b) + 1)
            b[i : i + r.randrange(5)] = [r.choice("abc😀") for _ in range(r.randrange(6))]
        assert S.matching(a, "".join(b)) == plain(a, "".join(b))


def test_long_texts():
    r = random.Random(1)
    words = [f"w{r.randrange(3000)}" for _ in range(20_000)]
    edited = [("x" if r.random() < 0.01 else w) for w in words]
    a, b = " ".join(words), " ".join(edited)
    assert 0.97 < 2 * S.matching(a, b) / (len(a) + len(b)) < 1 and S.matching(a, a) == len(a)
    assert S.matching(a[:2500], b[1000:3500]) == plain(a[:2500], b[1000:3500])


def test_over_the_pairs(spark):
    d = pairs(spark, "/root/testdata/sf0.001")
    rows = {r.doc_id: r for r in V.similarity(d, "doc_id", "target_text", "source_text", 0.8).collect()}
    texts = d.select("doc_id", X.normalize_text(V.python_str(d.target_text)).alias("a"), X.normalize_text(V.python_str(d.source_text)).alias("b")).collect()
    short = [t for t in texts if len(t.a) + len(t.b) < 2500]
    assert len(rows) == len(texts) and len(short) > 60
    assert all(rows[t.doc_id].ratio == pytest.approx(2 * plain(t.a, t.b) / (len(t.a) + len(t.b))) for t in short)
    assert {r.message is None for r in rows.values()} == {True, False}


@pytest.mark.parametrize("most", [(64, 256), (8, 3), (1, 1), (10**9, 10**9)])
def test_windows_find_the_same_blocks(monkeypatch, most):
    """Ties and repeats, with many windows and few, by windows alone and with the other ways."""
    monkeypatch.setattr(S, "WINDOWS", most[0])
    monkeypatch.setattr(S, "PLACES", most[1])
    r = random.Random(most[0])
    for _ in range(300):
        lines = ["".join(r.choice("abé😀 ") for _ in range(r.randrange(1, 30))) for _ in range(r.choice([1, 2, 8]))]
        a = [r.choice(lines) for _ in range(r.randrange(1, 20))]
        b = [r.choice(lines) if r.random() < 0.2 else x for x in a[r.randrange(len(a)) :]]
        a, b = "".join(a), "".join(b)
        for x, y in ((a, b), (b, a)):
            i, j, n = difflib.SequenceMatcher(None, x, y, autojunk=False).find_longest_match()
            assert S.windows(x, 0, len(x), y, 0, len(y)) in (None, (n, i, j) if n else (0, 0, 0))
            assert S.matching(x, y) == plain(x, y)


def test_edits_of_long_texts_need_no_names(monkeypatch):
    """Naming all substrings of both texts was what made whole tables slow."""
    monkeypatch.setattr(S, "substring_names", None)
    r = random.Random(2)
    a = " ".join(f"w{r.randrange(3000)}" for _ in range(10_000))
    cuts = sorted(r.sample(range(len(a)), 12))
    b = "".join(a[i:j] + "#" for i, j in zip([0, *cuts], [*cuts, len(a)]))
    assert S.matching(a, b) == S.matching(b, a) == len(a)
    assert S.matching(a, a + " one two") == S.matching("one " + a, a) == len(a) and S.matching(a[: len(a) // 2], a) == len(a) // 2


def test_a_row_is_measured_where_it_lies(spark):
    """Rows without a key or with the same one keep measures of their own (a join lost the first and mixed the second)."""
    rows = [(None, "a b c", "a b d"), (1, "one two", "two one"), (1, "x", "y"), (2, None, "None"), (3, "", ""), (4, "Ärger Straße", "ärger  STRASSE"), (5, "a_b 1²", "a_b 1²!")]
    d = spark.createDataFrame(rows, "k int, t string, r string")
    out = V.similarity(d, "k", "t", "r", 0.7, 0.5)
    got = sorted((-1 if x.k is None else x.k, round(x.ratio, 6), round(x.dice, 6), x.message is None) for x in out.collect())
    assert got == [(-1, 0.8, 0.666667, True), (1, 0.0, 0.0, False), (1, 0.428571, 1.0, True), (2, 1.0, 0.0, True), (3, 1.0, 1.0, True), (4, 1.0, 1.0, True), (5, 0.923077, 1.0, True)]
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    assert [x.dice for x in V.similarity(d, "k", "t", "r", 0.7).collect()] == [None] * 7


def test_dice_as_by_aggregation(spark):
    d = pairs(spark, "/root/testdata/sf0.001")
    want = {x.doc_id: x.dice for x in X.dice(d, "doc_id", "target_text", "source_text").collect()}
    got = {x.doc_id: x.dice for x in V.similarity(d, "doc_id", "target_text", "source_text", 0.8, 0.9).collect()}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], abs=1e-12) for k in want)


def test_tied_blocks_take_a_search_each(monkeypatch):
    """Lines that differ in a number each: the bound of a range is its block's length, and was sought from 1 on each time."""
    searches, isin = [], S.np.isin
    monkeypatch.setattr(S.np, "isin", lambda *a: searches.append(1) or isin(*a))
    monkeypatch.setattr(S, "WINDOWS", 0)
    monkeypatch.setattr(S, "SMALL", 0)
    a, b = ("\n".join("the same line again " + x for x in lines) for lines in ([str(i) for i in range(100, 300)], [""] * 200))
    assert S.matching(a, b) == plain(a, b) and len(searches) < 800
