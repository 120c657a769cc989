"""Jobs on a store, plans with prompts and bindings, services with batches, repairs and typed answers."""

import json

import pytest
from pyspark.sql import functions as F

from sievework.functions import text as X
from sievework.operators import jobs as J
from sievework.operators import records as R
from sievework.operators import services as C
from sievework.plans import plan as P
from sievework.sources import commits
from sievework.sources import jsonl as S
from sievework.sources.commits import Log


def seeded(spark, root, job="j1", n=47, plan=None, size=10, **k):
    docs = spark.createDataFrame([(i, "en" if i % 2 else "de", 100 * i) for i in range(n)], "doc_id long, lang string, n_chars long")
    return J.seed(spark, docs, plan or P.example_plan(), root, job, "doc_id", size=size, **k)


def test_life_of_a_job(spark, tmp_path):
    root = f"file://{tmp_path}/store"
    plan = P.example_plan()
    record = seeded(spark, root, field="lang", order=["en"])
    assert record["chunk_count"] == 5 and seeded(spark, root, field="lang", order=["en"]) == record
    assert {r.stage: (r.done, r.missing) for r in J.status(spark, root, "j1").collect()} == {0: (0, 5), 1: (0, 5), 2: (0, 5)}
    assert J.run(spark, root, "j1", ["000001"])["state"] == J.ACTIVE
    assert {r.stage: (r.done, r.missing_ids) for r in J.status(spark, root, "j1").collect()} == dict.fromkeys(range(3), (1, "000000,000002,000003,000004"))
    assert J.run(spark, root, "j1")["state"] == J.COMPLETE
    out = J.output(spark, root, "j1")
    assert out.count() == 47 and {r.doc_id: r.out for r in out.collect()} == {i: "long" if i * 100 > 500 else ("en" if i % 2 else "de") for i in range(47)}
    assert J.rerun(spark, root, "j1", ["000002"], force=True)["state"] == J.COMPLETE and J.output(spark, root, "j1").count() == 47
    assert J.collect_garbage(spark, root) == []
    other = P.Plan("example", (*plan.stages[:2], P.Stage("final", "coalesce", {"target": "out", "sources": ["lang"]})))
    assert seeded(spark, root, plan=other)["stages"][:2] == record["stages"][:2]
    dead = J.collect_garbage(spark, root)
    assert len(dead) == 1 and record["stages"][2]["sig"] in dead[0] and J.collect_garbage(spark, root) == []
    assert J.run(spark, root, "j1")["state"] == J.COMPLETE and {r.out for r in J.output(spark, root, "j1").collect()} == {"de", "en"}
    assert seeded(spark, root, "canary", max_chunks=2)["chunk_count"] == 2
    J.run(spark, root, "canary")
    J.cancel(spark, root, "canary")
    with pytest.raises(J.JobError):
        J.run(spark, root, "canary")
    assert len(J.collect_garbage(spark, root)) == 3 and J.output(spark, root, "j1").count() == 47
    with pytest.raises(J.JobError):
        J.load(spark, root, "none")


def test_commits_observe_themselves(spark, tmp_path):
    root = f"file://{tmp_path}/store"
    plan = P.Plan("p", (P.Stage("odd", "constants", {"values": {"x": 1}}, filters=(("n_chars % 200 == 100", "drop"),)), P.Stage("fail", "coalesce", {"target": "y", "sources": ["none"]})))
    seeded(spark, root, "j", 20, plan)
    J.run(spark, root, "j", ["000001"])
    J.run(spark, root, "j")
    got = {(r.stage, r.version): (r.rows, r.errors) for r in J.metrics(spark, root, "j").collect()}
    assert got == {(-1, 0): (20, 0), (0, 1): (5, 0), (1, 2): (5, 5), (0, 3): (5, 0), (1, 4): (5, 5)}
    assert J.output(spark, root, "j").where("error").count() == 10


def test_two_jobs_of_one_plan(spark, tmp_path):
    """Neither has what the other did, and force and garbage collection of one leave the other alone."""
    root = f"file://{tmp_path}/store"
    a, b = seeded(spark, root, "a", 20), seeded(spark, root, "b", 15)
    assert not {s["sig"] for s in a["stages"]} & {s["sig"] for s in b["stages"]}
    assert [s["sig"] for s in seeded(spark, root, "twin", 20)["stages"]] == [s["sig"] for s in a["stages"]]
    J.run(spark, root, "a")
    assert {(r.done, r.missing) for j in ("b", "twin") for r in J.status(spark, root, j).collect()} == {(0, 2)}
    with pytest.raises(FileNotFoundError):
        J.output(spark, root, "twin").count()
    J.run(spark, root, "b")
    assert J.output(spark, root, "b").count() == 15 and J.output(spark, root, "a").count() == 20
    J.rerun(spark, root, "a", force=True)
    J.cancel(spark, root, "a")
    assert J.collect_garbage(spark, root) and J.output(spark, root, "b").count() == 15 and J.load(spark, root, "b")["state"] == J.COMPLETE


def test_emptied_chunks_are_done(spark, tmp_path):
    root = f"file://{tmp_path}/store"
    plan = P.Plan("p", (P.Stage("few", "constants", {"values": {"x": 1}}, filters=(("n_chars < 500", "drop"),)), P.Stage("more", "constants", {"values": {"y": 2}})))
    record = seeded(spark, root, "j", 20, plan)
    assert J.run(spark, root, "j")["state"] == J.COMPLETE
    assert {(r.stage, r.chunk_id): r.records for r in J.done(spark, root, record).where("stage >= 0").collect()} == {(0, "000000"): 5, (0, "000001"): 0, (1, "000000"): 5, (1, "000001"): 0}
    nothing = P.Plan("p", (P.Stage("none", "constants", {"values": {"x": 1}}, filters=(("n_chars < 0", "drop"),)),))
    seeded(spark, root, "void", 20, nothing)
    assert J.run(spark, root, "void")["state"] == J.COMPLETE and J.output(spark, root, "void").count() == 0


def test_a_limit_counts_per_job(spark, tmp_path):
    root = f"file://{tmp_path}/store"
    plan = P.Plan("p", (P.Stage("a", "constants", {"values": {"x": 1}}), P.Stage("b", "constants", {"values": {"y": 2}}, filters=(("n_chars > 100", "drop"),), limit=12)))
    seeded(spark, root, "j", 40, plan)
    assert J.run(spark, root, "j", ["000000", "000002"])["state"] == J.ACTIVE
    assert {r.stage: r.done for r in J.status(spark, root, "j").collect()} == {0: 2, 1: 0}
    for force in (False, True):
        assert J.run(spark, root, "j", force=force)["state"] == J.COMPLETE
        assert sorted(r.doc_id for r in J.output(spark, root, "j").collect()) == list(range(2, 14))


def test_a_writer_that_dies_leaves_nothing_half_done(spark, tmp_path, monkeypatch):
    root = f"file://{tmp_path}/store"
    record = seeded(spark, root, "j", 20)

    def dies(self, entry):
        raise OSError("killed")

    with monkeypatch.context() as m:
        m.setattr(Log, "append", dies)
        with pytest.raises(OSError):
            J.run(spark, root, "j")
    assert {(r.done, r.missing) for r in J.status(spark, root, "j").collect()} == {(0, 2)}
    assert J.collect_garbage(spark, root) == [] and len(J.collect_garbage(spark, root, grace=-1)) == 1
    assert J.run(spark, root, "j")["state"] == J.COMPLETE and J.output(spark, root, "j").count() == 20
    # one that repeats what another has done adds no row twice
    spec, at = record["stages"][-1], J.log(spark, root, "j")
    rows = J.output(spark, root, "j").where("chunk_id = '000001'")
    at.commit(rows, rows, at.attempt(spec["index"], spec["sig"], J.stage_path(root, "j", spec)))
    assert J.output(spark, root, "j").count() == 20


def test_entries_snapshots_and_small_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(commits, "SNAPSHOT_EVERY", 3)
    at = Log(spark, f"file://{tmp_path}/log")
    assert at.state().collect() == [] and at.entries() == []
    rows = spark.createDataFrame([("c1", 1), ("c1", 2), ("c2", 3)], "chunk_id string, x int")
    covered = spark.createDataFrame([("c1",), ("c2",), ("c3",)], "chunk_id string")
    for n in range(5):
        assert at.commit(rows.where(f"x > {n}"), covered, at.attempt(n % 2, "s", f"file://{tmp_path}/rows")) == n
    assert at.snapshots() == [2] and len(at.entries()) == 5
    assert {(r.stage, r.chunk_id): r.records for r in at.state().collect()} == {(0, "c1"): 0, (0, "c2"): 0, (0, "c3"): 0, (1, "c1"): 0, (1, "c2"): 0, (1, "c3"): 0}
    assert {(r.stage, r.chunk_id): r.records for r in at.state(1).collect()} == {(0, "c1"): 2, (0, "c2"): 1, (0, "c3"): 0, (1, "c1"): 1, (1, "c2"): 1, (1, "c3"): 0}
    assert not S.create(spark, f"file://{tmp_path}/log/{0:012d}.json", "{}") and "attempt" in at.entries()[0]
    # two that saw the same last number: the second takes the next
    monkeypatch.setattr(Log, "snapshots", lambda self: [])
    real, calls = S.keys, []
    monkeypatch.setattr(S, "keys", lambda *a: real(*a)[: -1 if not calls.append(1) and len(calls) == 1 else None])
    assert at.append({"stage": 0, "sig": "s", "attempt": "none", "manifest": at.entries()[0]["manifest"]}) == 5
    for text in ("one", "two"):
        S.write_text(spark, f"file://{tmp_path}/r.json", text)
        assert S.read_small(spark, f"file://{tmp_path}/r.json") == text


def test_plans_with_prompts_and_bindings():
    plan = P.Plan("p", (P.Stage("a", "constants", {"values": {"x": 1}, "system_file": "sys.txt", "host": None}),))
    text = P.render(P.inline_prompts(plan, {"sys.txt": "be brief"}.get))
    assert text.stages[0].options == {"values": {"x": 1}, "system": "be brief"}
    assert P.signatures(text) != P.signatures(P.render(P.inline_prompts(plan, {"sys.txt": "be long"}.get)))
    with pytest.raises(P.PlanError):
        P.render(P.Plan("p", (P.Stage("a", "constants", {"values": {}, "host": "h"}),)))
    assert P.bound(text.stages[0], {"constants": {"host": "h"}}).options["host"] == "h"
    with pytest.raises(P.PlanError):
        P.bound(text.stages[0], {"constants": {"values": {}}})
    assert P.resolve_version("7") == "7" and P.resolve_version()


def test_fields_and_guards(spark):
    df = spark.createDataFrame([(1, "слово", "word", [1, 1, 2], None), (2, "x", "", [3], "z")], "id long, h string, s string, l array<long>, e string")
    with pytest.raises(KeyError):
        R.add_field(df, "h", F.lit(1))
    with pytest.raises(KeyError):
        R.replace_field(df, "none", F.lit(1))
    assert [r.was for r in R.replace_field(df, "h", F.lit("new"), old="was").collect()] == ["слово", "x"]
    for f in (lambda: R.list_dedup(df, "h"), lambda: R.list_limit(df, "h", 1), lambda: R.list_pick(df, "h")):
        with pytest.raises(TypeError):
            f()
    got = R.transfer_check(R.transfer_check(df, "script", "scripts", "s", "h"), "patterns", "lost", "s", "h").collect()
    assert got[0].scripts == {"cyrillic": "слов"} and got[0].lost == {} and got[1].scripts is None
    assert [r[0] for r in df.select(X.script_of("h")).collect()] == ["cyrillic", None]
    with pytest.raises(KeyError):
        R.coalesce_fields(df, "h", ["s"], exists_ok=False)
    assert [r.o for r in R.coalesce_fields(df, "o", ["e", "l"]).collect()] == ["[1,1,2]", "z"]


def test_typed_answers_and_loops():
    parse = C.typed({"verdict": str, "score": (int, float)})
    assert parse(json.dumps({"verdict": "ok", "score": 1})) == {"verdict": "ok", "score": 1}
    for bad in ("[]", "{}", json.dumps({"verdict": 1, "score": 1})):
        with pytest.raises(C.Rejected):
            parse(bad)
    with pytest.raises(C.Rejected) as e:
        parse("{\"verdict\": \"" + "again and again " * 8)
    assert "again" in e.value.feedback and "over and over" in e.value.feedback


def test_batches_with_checks(spark):
    df = spark.createDataFrame([(i, f"t{i}", i // 4) for i in range(10)], "id long, t string, chunk_id long")

    def client(items, feedback):
        for k, t in items.items():
            if t == "t3" or t == "t5" and not feedback:
                continue
            yield k, "bad" if t == "t7" and k not in feedback else t.upper()

    def no_bad(answer, k):
        if answer == "bad":
            raise ValueError("bad answer")

    out = {r.id: r for r in R.fold_errors(C.batched_llm(df, client, "id", "t", "out", size=3, checks=(no_bad,)), "ask").collect()}
    assert {k: r.out for k, r in out.items() if k != 3} == {i: f"T{i}" for i in range(10) if i != 3}
    assert out[3].out is None and out[3].error and out[3].error_type == "ValueError"
    alone = C.batched_llm(df, client, "id", "t", "out", size=3, single=lambda t: "one by one")
    assert {r.id: r.out for r in alone.collect()}[3] == "one by one"


def test_language_forms(spark):
    df = spark.createDataFrame([(1, "a teh word", "teh"), (2, "boom", ""), (3, None, "")], "id long, t string, s string")

    def client(t):
        if t == "boom":
            raise RuntimeError("no")
        at = t.find("teh")
        return [(at, 3, "TYPO_1", "typo", ["the"])] if at >= 0 else []

    got = {r.id: r.i for r in C.language_issues(df, client, "t", "i").collect()}
    assert got[1][0].error_text == "teh" and got[2][0].rule_id is None and got[3] == []
    assert {r.id: len(r.i) for r in C.language_issues(df, client, "t", "i", suppress_source="s").collect()} == {1: 0, 2: 1, 3: 0}
    assert {r.id: len(r.i) for r in C.language_issues(df, client, "t", "i", deny=("TYPO",)).collect()} == {1: 0, 2: 1, 3: 0}
    fixed = C.language_fix(df.where("id <> 2"), client, ["t"], ("TYPO_1",)).collect()
    assert [r.t for r in fixed] == ["a the word", None]

    def down(t):
        raise ConnectionError("gone")

    with pytest.raises(Exception, match="gone"):
        C.language_issues(df, down, "t", "i").collect()


def test_stage_folders(spark, tmp_path):
    df = spark.createDataFrame([(i,) for i in range(5)], "id long")
    S.write_shards(df, f"file://{tmp_path}/a")
    assert S.scan_shards(spark, [f"file://{tmp_path}/a", f"file://{tmp_path}/none"], "id long").count() == 5


def test_a_run_says_what_it_stored(spark, tmp_path):
    plan = P.Plan("p", (P.Stage("tag", "constants", {"values": {"x": 1}}, service=True), P.Stage("end", "constants", {"values": {"y": 2}})), "v7")
    P.run(spark, plan, spark.createDataFrame([(1, 0)], "id long, _ord long"), f"file://{tmp_path}")
    (said,) = P.stored(spark, f"file://{tmp_path}")
    assert (said["stage"], said["op"], said["sig"], said["version"]) == ("tag", "constants", P.signatures(plan)[0], "v7") and "x" in said["columns"]


def test_first_of_each_key(spark):
    rows = [(1, [("a", 1), ("b", 2), ("a", 3), (None, 4), (None, 5), ("b", 6)]), (2, []), (3, None), (4, [("z", i) for i in range(500)] + [("y", 500)])]
    df = spark.createDataFrame(rows, "id int, x array<struct<k:string,v:int>>")
    got = {r.id: None if r.x is None else [y.v for y in r.x] for r in R.list_dedup(df, "x", "k").collect()}
    assert got == {1: [1, 2, 4, 5], 2: [], 3: None, 4: [0, 500]}
