"""Plans that name checks, answers and services; bindings for the moment of running alone."""

import json

import pytest
from pyspark.sql import functions as F

from sievework.operators import jobs as J
from sievework.plans import ops
from sievework.plans import plan as P


@ops.client("test_pick")
def pick(host=None, api_key=None):
    """Answers only for one who knows the host."""
    def call(turns):
        if host != "h1":
            raise ConnectionError("no host")
        return json.dumps({"ranking": ["C1", "C2"], "selected_id": "C2" if turns[-1]["content"] != "3" else "C1"})

    return call


@ops.client("test_upper")
def upper():
    return lambda text: text.upper()


def test_a_job_of_service_stages(spark, tmp_path):
    root = f"file://{tmp_path}/store"
    stages = (
        P.Stage("pick", "llm", {"client": "test_pick", "template": "{doc_id}", "output": "raw", "retries": 1, "concurrency": 2, "timeout": 5}, service=True),
        P.Stage("type", "typed_answer", {"raw": "raw", "shape": "TranslationPickById", "target": "answer"}),
        P.Stage("refuse", "fail_when", {"when": "answer.selected_id != 'C2'", "message": "not the second"}),
        P.Stage("shout", "translate", {"client": "test_upper", "source": "lang", "target": "loud"}, service=True),
    )
    plan = P.Plan("served", stages)
    docs = spark.createDataFrame([(i, "en") for i in range(6)], "doc_id long, lang string")
    J.seed(spark, docs, plan, root, "j", "doc_id", size=3)
    J.run(spark, root, "j", bindings={"llm": {"host": "h1", "api_key": "k"}})
    out = {r.doc_id: r for r in J.output(spark, root, "j").collect()}
    assert {i: (r.error, r.error_stage, r.loud) for i, r in out.items()} == {i: (True, "refuse", None) if i == 3 else (None, None, "EN") for i in range(6)}
    assert "h1" not in J.load(spark, root, "j")["plan"] and out[3].answer.selected_id == "C1"
    J.run(spark, root, "j", ["000000"], force=True)
    assert {r.doc_id: r.error_type for r in J.output(spark, root, "j").collect() if r.doc_id < 3} == dict.fromkeys(range(3), "ConnectionError")


def test_plans_are_refused_before_they_run(spark):
    df = spark.createDataFrame([(1, "a")], "id long, t string").withColumn("_ord", F.col("id"))
    for name, options in (("validate", {"checks": [{"check": "Nope"}]}), ("validate", {"checks": [{"check": "Check", "fields": []}]}), ("typed_answer", {"raw": "t", "shape": "Nope", "target": "x"}), ("embed", {"client": "nope", "text": "t"})):
        with pytest.raises(P.PlanError):
            P.compile_stage(df, P.Stage("s", name, options), "sig")
    with pytest.raises(P.PlanError):
        P.check(P.Plan("p", (P.Stage("s", "llm", {"client": "test_pick", "host": "h1"}),)))
