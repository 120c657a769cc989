"""Checks with the parameters that all share, and reports, against plain rules."""

import random

import pytest
from pyspark.sql import functions as F

from sievework.functions import text as X
from sievework.operators import checks as Q
from sievework.operators import records as R
from sievework.operators import reports as RP

ROWS = [
    (1, ("short", ""), "a much longer source text", 3.0),
    (2, ("a much longer source text", ""), "a much longer source text", 9.0),
    (3, ("слово is here with it all", ""), "a much longer source text", 3.0),
    (4, (None, ""), "a much longer source text", 3.0),
    (5, ("anything", ""), None, 3.0),
    (6, ("", ""), "a source", 3.0),
    (7, ("one two three " * 9, ""), "one two three " * 9, 3.0),
    (8, ("say say say " * 9, ""), "the source has others " * 5, 3.0),
    (9, ("tel 12 and 1,000!!", ""), "tel 12 and 1,000 and 77!", 3.0),
]


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(ROWS, "id long, out struct<text:string,note:string>, source string, score double")


def messages(df, checks, **options):
    return {r.id: (r._err.message if r._err else None) for r in Q.validate(df, checks, key="id", **options).collect()}


def test_shared_parameters(rows):
    ratio = lambda **o: messages(rows, [Q.LengthRatio(["out.text"], "source", min_ratio=0.5, **o)])
    got = ratio()
    assert "length ratio 0.20" in got[1] and "missing" in got[4] and got[5] is None and got[2] is None and "0.00" in got[6]
    assert ratio(skip_empty_fields=True)[6] is None and "reference source is missing" in ratio(required=True)[5]
    said = Q.validate(rows, [Q.LengthRatio(["out.text"], "source", min_ratio=0.5, feedback_template="{field}: {length}/{ref_length} {unit}", unit="word")], attach="why")
    why = {r.id: r.why for r in said.collect()}
    assert why[1].feedback == "out.text: 1/5 word" and why[2] is None and all(r._err is None for r in said.collect())
    with pytest.raises(ValueError):
        Q.LengthRatio(["x"], "y", min_ratio=1, feedback_template="{nothing}")
    with pytest.raises(ValueError):
        Q.LengthRatio(["x"], "y")


def test_each_check(rows):
    one = lambda c: {k for k, m in messages(rows.where("id not in (4, 5)"), [c]).items() if m}
    assert one(Q.CharacterCount(["out.text"], "source", ["!"])) == {9}
    assert one(Q.CharacterCount(["out.text"], "source", ["!"], max_diff=1)) == set()
    assert one(Q.ScriptConsistency(["out.text"], "source")) == {3}
    assert one(Q.ScriptConsistency(["out.text"], "source", allow_scripts=("cyrillic",))) == set()
    assert one(Q.PatternPreservation(["out.text"], "source")) == {9}
    assert one(Q.PatternPreservation(["out.text"], "source", max_diff=1)) == set()
    assert one(Q.Repetition(["out.text"], "source")) == {8}
    assert one(Q.Repetition(["out.text"])) == {7, 8}
    assert 2 not in one(Q.Similarity(["out.text"], "source", min_similarity=0.9)) >= {1, 3, 8}
    assert one(Q.MaxScore(["out.text"], "source", {"out.text": "score"}, max_score=5)) == {2}
    issue = F.array(F.struct(F.lit("rule").alias("rule_id"), F.lit("much").alias("error_text"), F.lit("m").alias("message")))
    spoken = rows.withColumn("found", F.when(F.col("out.text").contains("much"), issue))
    assert {k for k, m in messages(spoken.where("id < 4"), [Q.Language(["out.text"], {"out.text": "found"})]).items() if m} == {2}
    assert not any(messages(spoken.where("id < 4"), [Q.Language(["out.text"], {"out.text": "found"}, suppress_source_field="source")]).values())
    assert not any(messages(spoken.where("id < 4"), [Q.Language(["out.text"], {"out.text": "found"}, denied_fixes=("ru",))]).values())


def test_order_and_error_fields(rows):
    checks = [Q.ScriptConsistency(["out.text"], "source", name="script"), Q.LengthRatio(["out.text"], "source", min_ratio=0.5, name="length")]
    out = {r.id: r for r in R.fold_errors(Q.validate(rows, checks), "gate").collect()}
    assert out[3].error_message.startswith("script") and out[1].error_message.startswith("length") and out[1].error_type == "ResponseValidationError" and out[2].error is None
    assert len(out) == len(ROWS)


def test_reports(spark):
    scores = spark.createDataFrame([(i, float(i * i % 17), None) for i in range(50)] + [(50, None, "empty"), (51, None, "empty"), (52, None, "long")], "id long, s double, why string")
    r = RP.score_summary(scores, "s", 10, (0.25, 0.5), reason="why").first()
    v = sorted(float(i * i % 17) for i in range(50))
    at = lambda p: v[int(p * 49)] + (p * 49 % 1) * (v[min(49, int(p * 49) + 1)] - v[int(p * 49)])
    assert r.n == 50 and r.p25 == pytest.approx(at(0.25)) and r.p50 == pytest.approx(at(0.5)) and r.dropped == sum(x >= 10 for x in v) and r.drops == {"empty": 2, "long": 1}
    assert RP.quantiles(scores.where("id > 100"), "s", [0.5]) == {0.5: None}
    flags = spark.createDataFrame([("j", {"a": 2, "b": 1}), ("j", {"a": 3}), ("k", None)], "job string, types map<string,long>")
    got = RP.flagged_by_type(RP.exploded_flags(flags, "types", ["job"]), ["job", "error_type"], "count").collect()
    assert {(x.job, x.error_type): x.n for x in got} == {("j", "a"): 5, ("j", "b"): 1}
    done = spark.createDataFrame([(0, "a"), (0, "b"), (0, "x"), (1, "a")], "stage int, chunk_id string")
    chunks, stages = spark.createDataFrame([("a",), ("b",), ("c",)], "chunk_id string"), spark.createDataFrame([(0,), (1,), (2,)], "stage int")
    got = {r.stage: (r.done, r.missing, r.missing_ids) for r in RP.job_status(done, chunks, stages, shown=2).collect()}
    assert got == {0: (2, 1, "c"), 1: (1, 2, "b,c"), 2: (0, 3, None)}


def test_a_dear_measure_is_computed_once(spark):
    """The findings were made anew for the verdict, the message and the feedback, each time with all their patterns."""
    d = spark.createDataFrame([(1, "see www.a.org 5", "see 7"), (2, "Привет", "x"), (3, None, "x")], "id int, t string, r string")
    times = lambda f, what: f._jdf.queryExecution().optimizedPlan().toString().count(what)
    for made, alone, what in (
        (Q.PatternPreservation(["t"], "r", mode="both"), X.pattern_misses(F.col("r"), F.col("t"), mode="both"), "regexp_extract_all"),
        (Q.ScriptConsistency(["t"], "r"), X.foreign_scripts(F.col("r"), F.col("t")), "array_distinct"),
    ):
        assert times(Q.validate(d, [made]), what) == times(d.select(alone.alias("v")), what) > 0
    out = Q.validate(d, [Q.PatternPreservation(["t"], "r", mode="both"), Q.ScriptConsistency(["t"], "r")], attach="x").orderBy("id").collect()
    assert [r.x and r.x.message for r in out] == ["PatternPreservation: t patterns missing: 7; extra: 5", "ScriptConsistency: t foreign scripts: cyrillic Привет", "PatternPreservation: output field t is missing"]
    assert "missing: 7; not in the source: 5" in out[0].x.feedback


def test_addresses_are_sought_from_the_first_mark_on(spark):
    """What the whole text gives: marks in any place, in words with other white space, beside characters of two units."""
    r = random.Random(5)
    parts = ["www.", "wWw.", "w", "a@b.c", "x.y@d-e.org", "http://", "HTTPS://q", "/", "//", "@", " ", " ", " ", "\n", " ", "é", "😀", "12", "<", '"', "%", "..", "abc", "1,000.5"]
    texts = [None, "", " ", "@", "a@b.c", "no mark at all"] + ["".join(r.choice(parts) for _ in range(r.randrange(1, 25))) for _ in range(3000)]
    c, plain = F.col("c"), X.none_as_empty(F.col("c"))
    domain = X.EMAIL.partition("@")[2]
    d = spark.createDataFrame([(t,) for t in texts], "c string").select(
        "c",
        X.emails(c).alias("emails"),
        X.blank_addresses(c).alias("blank"),
        F.transform(F.regexp_extract_all(plain, F.lit(X.LOCAL + domain), F.lit(0)), X.trim_trailing).alias("all_emails"),
        F.regexp_replace(plain, rf"{X.LOCAL}{X.URL}|{X.URL}|{X.LOCAL}{domain}", "  ").alias("all_blank"),
    )
    rows = d.collect()
    assert all(x.emails == x.all_emails and x.blank == x.all_blank for x in rows)
    assert sum(bool(x.emails) for x in rows) > 300 < sum(x.blank != (x.c or "") for x in rows)
