import json

import pytest
from pyspark.sql import functions as F

from sievework.functions import text as X
from sievework.operators import control as K
from sievework.operators import records as R
from sievework.operators import services as S
from sievework.operators import validators as V
from sievework.plans import plan as P
from sievework.sources import jsonl as J


def rows(df, *cols):
    return [tuple(r[c] for c in cols) for r in df.collect()]


# --- records ---------------------------------------------------------------------------------------------------------

def test_rename(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    assert R.rename(df, {"a": "b", "b": "a"}).select("a", "b").first() == (2, 1)
    assert R.rename(df, {"a": "x"}, keep=True).columns == ["a", "b", "c", "x"]
    with pytest.raises(KeyError):
        R.rename(df, {"a": "b"})
    with pytest.raises(KeyError):
        R.rename(df, {"zz": "b"}, required=True)


def test_pass_and_drop(spark):
    df = spark.createDataFrame([(1, 1), (2, None), (3, 5)], "id int, q int")
    for filters in ([("q == 1", "pass"), ("id != 3", "drop")], [("id != 3", "drop"), ("q == 1", "pass")]):
        assert sorted(rows(R.select_input(df, filters), "id", "_skip")) == [(1, False), (2, True)]
    with pytest.raises(ValueError):
        R.select_input(df, [("q", "keep")])


def test_errors_keep_what_was_there(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, s string")
    out = R.write(df, "first", F.upper("s"))
    out = R.fail_when(out, F.col("id") == 2, "ValueError", "two")
    out = R.append_provenance(R.write(out, "second", F.lit("x")), {"stage": "st"})
    got = {r.id: r.asDict() for r in R.fold_errors(out, "st").collect()}
    assert got[2]["first"] == "B" and got[2]["second"] is None and got[2]["error"] and got[2]["error_type"] == "ValueError" and got[2]["error_stage"] == "st"
    assert got[1]["second"] == "x" and got[1]["error"] is None
    again = R.fold_errors(R.write(R.fold_errors(out, "st"), "third", F.lit("y")), "later")
    got = {r.id: r.asDict() for r in again.collect()}
    assert got[2]["third"] is None and got[2]["error_stage"] == "st" and got[1]["third"] == "y" and len(got[1]["_prov"]) == 1


def test_set_when_reads_before_it_writes(spark):
    df = spark.createDataFrame([(1, None), (2, ("old",))], "n int, meta struct<a:string>")
    out = {r.n: r for r in R.set_when(df, "n == 1", {"n2": 5, "meta.a": "new", "meta.b": True}).collect()}
    assert out[1].n2 == 5 and out[1].meta.a == "new" and out[1].meta.b and out[2].meta.a == "old" and out[2].meta.b is None and out[2].n2 is None


def test_candidates_select_and_shuffle(spark):
    df = spark.createDataFrame([("x", None, "z", "C2"), ("x", "y", "z", "C9"), ("x", "y", None, None)], "a string, b string, c string, sel string")
    d = R.candidates(df, "items", ["a", "b", "c"], "C", required=False)
    out = R.fold_errors(R.select_by_id(d, "sel", "items", "t", required=False), "s").collect()
    assert [(r.t, r.error) for r in out] == [("z", None), (None, True), (None, None)]
    one, two = (R.candidates(df, "i", ["a", "b", "c"], required=False, shuffle=True).collect() for _ in range(2))
    assert one == two and all(sorted(x.text for x in r["i"]) == sorted(x for x in r[:3] if x) for r in one)
    assert [r._err is not None for r in R.candidates(df, "i", ["a", "b", "c"]).collect()] == [True, False, True]


def test_edits(spark):
    seg = [("S1", "aXbX", "en1"), ("S2", "c", "en2")]
    df = spark.createDataFrame([(1, seg, [("S1", "X", "Y"), ("S1", "Yb", "-")]), (2, seg, [("S9", "X", "Y")]), (3, seg, [("S1", "X", "Y"), ("S1", "X", "Z")]), (4, seg, []), (5, seg, None)], "k int, segments array<struct<id:string,translation:string,text:string>>, edits array<struct<segment_id:string,span:string,replacement:string>>")
    got = {r.k: r for r in R.fold_errors(R.apply_edits(df, "edits", "segments", "out"), "e").collect()}
    assert [x.text for x in got[1].out] == ["a-Y", "c"] and [x.edited for x in got[1].out] == [True, False]
    assert got[2].error and got[3].error and got[5].error and [x.text for x in got[4].out] == ["aXbX", "c"]


def test_lists(spark):
    df = spark.createDataFrame([(["a", "b", "a", "c"],), ([],), (None,)], "l array<string>")
    assert [r.l for r in R.list_dedup(df, "l").collect()] == [["a", "b", "c"], [], None]
    assert [(r.l, r.o) for r in R.list_limit(df, "l", 2, "o").collect()][:2] == [(["a", "b"], 2), ([], 0)]
    assert [len(r.l) for r in R.list_pick(df.limit(2), "l", 3, seed=5).collect()] == [3, 0]
    assert [r._err is None for r in R.list_pick(df.limit(2), "l", unwrap=True).collect()] == [True, False]


# --- text ------------------------------------------------------------------------------------------------------------

def test_text_functions(spark):
    texts = ["Straße ΣΑΣ İstanbul ﬁ", "a1 b_2 ½ 1st 1980s 1 000 000,5 1990 2", "日本語 Привет、hi", "", None, "x\x1cy z"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    import re
    got = df.select(X.word_tokens(F.col("t")).alias("w"), X.space_words(F.col("t")).alias("s"), X.numbers(F.col("t"), True).alias("n"), X.numbers(F.col("t")).alias("m")).collect()
    for t, r in zip(texts, got):
        assert list(r.w) == re.findall(r"\w+", (t or "").casefold().replace("½", "")) or t == texts[1]
        assert list(r.s) == (t or "").split()
    assert list(got[1].n) == ["1", "2", "10000005", "1990", "2"] and list(got[1].m) == ["1", "2", "1", "1980", "10000005", "1990", "2"]


def test_scripts_and_patterns(spark):
    df = spark.createDataFrame([("see http://a.org/x1. and u1@www.b.com/7 the 21st 3 and 3", "see 3 Привет мир кто бы")], "s string, h string")
    r = df.select(X.foreign_scripts(F.col("s"), F.col("h")).alias("f"), X.foreign_scripts(F.col("s"), F.col("h"), ("cyrillic",)).alias("g"), X.pattern_misses(F.col("s"), F.col("h"), mode="both").alias("p")).first()
    assert r.f == {"cyrillic": "Приветмк…"[:8] + "…"} or len(r.f["cyrillic"]) == 9
    assert r.g == {} and r.p["url"] == ["http://a.org/x1", "www.b.com/7"] and r.p["email"] == ["u1@www.b.com"] and r.p["number"] == ["3"]
    with pytest.raises(ValueError):
        X.pattern_misses(F.col("s"), F.col("h"), ("word",))


def test_ngrams_and_dice(spark):
    df = spark.createDataFrame([(1, "a b c a b c d", "a b c"), (2, "x y", ""), (3, "one two three four", "one two three four"), (4, "", "")], "k int, t string, r string")
    got = {r.k: (r.ngram, r["count"], r.excess) for r in X.repeated_ngram(df, "k", "t", "r").collect()}
    assert got == {1: ("a b c", 2, 1), 2: (None, 0, 0), 3: (None, 0, 0), 4: (None, 0, 0)}
    assert {r.k: r.dice for r in X.dice(df, "k", "t", "r").collect()} == {1: 0.6, 2: 0.0, 3: 1.0, 4: 1.0}


# --- validators ------------------------------------------------------------------------------------------------------

def test_validators(spark):
    df = spark.createDataFrame([(1, "abcd", "ab"), (2, None, "abcd"), (3, "ab", "")], "k int, t string, r string")
    assert [x is None for (x,) in df.select(V.length_ratio(F.col("t"), F.col("r"), 0.5, 1.5)).collect()] == [False, True, True]
    out = {r.k: r for r in V.similarity(df, "k", "t", "r", 0.9, 0.5).collect()}
    assert out[1].ratio == pytest.approx(2 / 3) and out[1].message
    issues = [("Foo", "R1"), ("bar", "R1_X"), ("", "R2"), (None, "R3"), ("zed", "Q")]
    d = spark.createDataFrame([(issues, "has BAR and Foo")], "i array<struct<error_text:string,rule_id:string>>, ref string")
    r = d.select(V.suppress_verbatim(F.col("i"), F.col("ref")).alias("a"), V.findings_filter(F.col("i"), F.col("ref")).alias("b"), V.rule_filter(F.col("i"), ("R",), ("R1",)).alias("c")).first()
    assert [x.rule_id for x in r.a] == ["R1_X", "R2", "R3", "Q"] and [x.rule_id for x in r.b] == ["R2", "R3", "Q"] and [x.rule_id for x in r.c] == ["R2", "R3"]


def test_edit_span(spark):
    seg = [("S1", "The Dog", "ten pies"), ("S2", "a dog", "inny pies")]
    bad = [("S1", "pies", "pies", "dog"), ("S7", "pies", "x", "dog"), ("S1", "kot", "x", "cat"), ("S1", "pies", "a b c d e f g", "dog")]
    df = spark.createDataFrame([(seg, [("S1", "pies", "kundel", "DOG ")]), (seg, bad), (seg, [])], "s array<struct<id:string,text:string,translation:string>>, e array<struct<segment_id:string,span:string,replacement:string,source_term:string>>")
    got = [list(x) for (x,) in df.select(V.edit_span(F.col("e"), F.col("s"))).collect()]
    assert got == [[], ["S1: replacement equals span", "S7: no such segment", "S1: span does not occur", "S1: term not shared", "S1: replacement too long"], []]


# --- plans -----------------------------------------------------------------------------------------------------------

def test_signatures(spark):
    p = P.example_plan()
    sigs = P.signatures(p)
    assert P.Plan.from_json(p.to_json()) == p and [r.sig for r in P.signature_table(spark, p).collect()] == sigs
    a, b, c = p.stages
    changed = P.Plan(p.name, (a, P.Stage(b.id, b.op, {**b.options, "when": "n_chars > 9"}), c))
    assert P.first_changed(sigs, P.signatures(changed)) == 1 and P.signatures(changed)[2] != sigs[2]
    reordered = P.Plan(p.name, (a, P.Stage(b.id, b.op, dict(reversed(b.options.items()))), c))
    assert P.signatures(reordered) == sigs
    served = P.Plan(p.name, (P.Stage(a.id, a.op, {**a.options, "concurrency": 4}), b, c))
    assert P.signatures(served) == sigs
    for s in (P.Stage("x", "none"), P.Stage("x", "constants", {"client": {"api_key": "k"}})):
        with pytest.raises(P.PlanError):
            P.signatures(P.Plan("p", (s,)))


def test_run_resumes(spark, tmp_path):
    calls = []

    @P.op("count_calls")
    def op(df):
        calls.append(1)
        return R.write(df, "seen", F.lit("yes"))

    plan = P.Plan("r", (P.Stage("a", "constants", {"values": {"v": 1}}), P.Stage("b", "count_calls", service=True), P.Stage("c", "coalesce", {"target": "o", "sources": ["missing", "seen"]}, filters=(("id > 1", "pass"),))))
    docs = spark.range(4)
    for _ in range(2):
        got = {r.id: (r.o, len(r._prov)) for r in P.run(spark, plan, docs, f"file://{tmp_path}").collect()}
        assert got == {0: (None, 2), 1: (None, 2), 2: ("yes", 3), 3: ("yes", 3)}
    assert len(calls) == 1
    with pytest.raises(P.PlanError):
        P.run(spark, plan, docs, f"file://{tmp_path}", start_from="zz")


def test_sinks(spark, tmp_path):
    base = f"file://{tmp_path}"
    df = spark.createDataFrame([(1, "000000"), (2, "000000"), (3, "000002")], "id long, chunk_id string")
    J.write_chunks(df, spark.createDataFrame([("000000",), ("000001",), ("000002",)], "chunk_id string"), f"{base}/c")
    assert [sorted(r.id for r in J.read_chunk(spark, f"{base}/c", c, "id long").collect()) for c in ("000000", "000001")] == [[1, 2], []]
    with pytest.raises(FileNotFoundError):
        J.read_chunk(spark, f"{base}/c", "000009", "id long")
    with pytest.raises(FileNotFoundError):
        J.scan(spark, f"{base}/no*")
    assert J.scan(spark, f"{base}/no", "id long", missing_ok=True).count() == 0
    J.write_shards(spark.range(25), f"{base}/s", 10)
    assert J.scan(spark, f"{base}/s", "id long").count() == 25 and J.delete(spark, [f"{base}/s"]) == 1 and not J.exists(spark, f"{base}/s")
    assert J.stage_key(3, "gate", "ab", "000001") == "stage/03_gate/ab/chunk-000001.jsonl"


def test_seed_order(spark):
    df = spark.createDataFrame([(i, "en" if i % 3 else "de") for i in range(50)], "id long, lang string").repartition(5)
    got = sorted(rows(K.seed_chunks(df, "id", "lang", ["de"], size=10), "seed_id", "chunk_id", "id"))
    want = [i for i in range(50) if i % 3 == 0] + [i for i in range(50) if i % 3]
    assert got == [(f"{k:08d}", f"{k // 10:06d}", i) for k, i in enumerate(want)]


# --- services --------------------------------------------------------------------------------------------------------

def test_llm_stage(spark):
    def client(turns):
        last = turns[-1]["content"]
        if "down" in turns[1]["content"]:
            raise S.ServiceDown("gone")
        return json.dumps({"ok": "fix" in last}) if "bad" not in last else "not json"

    def check(answer, row):
        if not answer["ok"]:
            raise S.Rejected("not ok", "please fix")

    df = spark.createDataFrame([(1, "hello", None), (2, "bad", None), (3, "down", None), (4, "hello", True)], "id int, t string, error boolean")
    out = S.llm_stage(df, client, "say {t}", "a", checks=(check,), reprompts=1, keep_rejected=True)
    got = {r.id: r for r in R.fold_errors(out, "llm").collect()}
    assert len(got) == 4 and json.loads(got[1].a) == {"ok": True} and got[1].a_reprompt_rounds == 1
    assert got[2].error and got[2].error_type == "JSONDecodeError" and got[3].error_type == "ServiceDown" and got[4].a is None and got[4].error_type is None
    kept = {r.id: r for r in S.llm_stage(df.where("id = 1"), client, "say {t}", "a", checks=(check,), keep_on_failure=True).collect()}
    assert json.loads(kept[1].a) == {"ok": False} and kept[1].a_guard_failure == "not ok"
    with pytest.raises(KeyError):
        S.llm_stage(df, client, "{nope}", "a")


def test_batches_align(spark):
    def client(todo, feedback):
        out = [(k, t.upper()) for k, t in todo.items()]
        return [x for x in out if x[1] != "LOST"] + [x for x in out if x[1] == "TWICE"]

    df = spark.createDataFrame([(i, "c" + str(i // 7), t) for i, t in enumerate(["a", "b", "lost", "c", "twice", "d", "e", "f"])], "id long, chunk_id string, t string")
    got = {r.id: (r.o, r._err is not None) for r in S.batched_llm(df, client, "id", "t", "o", size=3).collect()}
    assert got == {0: ("A", False), 1: ("B", False), 2: (None, True), 3: ("C", False), 4: (None, True), 5: ("D", False), 6: ("E", False), 7: ("F", False)}


def test_translate_issues_score(spark):
    df = spark.createDataFrame([(1, "word word"), (2, " "), (3, "fail"), (4, None)], "id int, t string")
    say = lambda t: "" if t == "fail" else t[::-1]
    got = {r.id: (r.o, r._err is not None) for r in S.translate(df, say, "t", "o").collect()}
    assert got == {1: ("drow drow", False), 2: (" ", False), 3: (None, True), 4: (None, False)}
    assert {r.id: r.o for r in S.translate(df, say, "t", "o", keep_original=True).collect()}[3] == "fail"
    find = lambda t: [(5, 4, "REPEAT", "twice", ["x"])] if t == "word word" else []
    got = {r.id: r["i"] for r in S.language_issues(df, find, "t", "i").collect()}
    assert got[1][0].error_text == "word" and got[1][0].context == "word «word»" and got[2] == []
    assert S.fix_until_stable("word word", find) == "word x"
    got = {r.id: r.s for r in S.score(df, lambda ps: [99.0 for _ in ps], "t", "t", "s", "id != 3").collect()}
    assert got == {1: 25.0, 2: 25.0, 3: None, 4: None}
    with pytest.raises(ValueError):
        V_max = S.max_score(F.col("s"), 30)
        assert V_max is None
    v = S.embed(df, lambda ts: [[3.0, 4.0] for _ in ts], "t").first().embedding
    assert v == pytest.approx([0.6, 0.8])
