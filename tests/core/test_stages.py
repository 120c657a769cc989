"""Plans over streams: no barrier between stages, nothing redone."""

import time

import pandas as pd
import pytest
from pyspark.sql import functions as F

from sievework.operators import control as K
from sievework.operators import records as R
from sievework.plans import plan as P
from sievework.streaming.stages import Counters, Flow

SCHEMA = "doc_id long, n long, chunk_id string"


@P.op("test_slow")
def slow(df, folder, seconds):
    """Leaves a file for each row that it is asked for, and sleeps over those of chunk slow."""
    def run(frames):
        for f in frames:
            for i, c in zip(f["doc_id"], f["chunk_id"]):
                if c == "slow":
                    time.sleep(seconds)
                with open(f"{folder}/{i}", "a") as out:
                    out.write("x")
            yield f

    kept = df.select(*[c for c in df.columns if c not in ("_err", "_skip")])
    return R.with_state(kept.mapInPandas(run, kept.schema))


def flow(spark, tmp_path, seconds, last=1, lanes=4):
    (tmp_path / "calls").mkdir(exist_ok=True)
    stages = (P.Stage("tag", "constants", {"values": {"x": 1}}), P.Stage("slow", "test_slow", {"folder": str(tmp_path / "calls"), "seconds": seconds}), P.Stage("end", "constants", {"values": {"y": last}}, filters=(("n < 3", "drop"),)))
    return Flow(spark, f"file://{tmp_path}/flow", P.Plan("flow", stages), SCHEMA, lanes)


def chunks(spark, names, first=0):
    return spark.createDataFrame([(first + 10 * k + i, i, c) for k, c in enumerate(names) for i in range(3)], SCHEMA)


def test_a_slow_chunk_holds_up_nobody(spark, tmp_path):
    f = flow(spark, tmp_path, 20, lanes=2)
    lane = {r.chunk_id: r.l for r in chunks(spark, ["slow", *"abcdefgh"]).select("chunk_id", F.pmod(F.xxhash64("chunk_id"), F.lit(2)).alias("l")).collect()}
    quick = [c for c in lane if lane[c] != lane["slow"]]
    f.feed(chunks(spark, ["slow", *quick]))
    counters = Counters()
    spark.streams.addListener(counters)
    running = f.start()
    try:
        ahead = set()
        for _ in range(100):
            ahead = {r.chunk_id for r in f.rows().select("chunk_id").distinct().collect()}
            if set(quick) <= ahead:
                break
            time.sleep(0.5)
        assert ahead == set(quick)
        assert {r.chunk_id for r in K.missing_chunks(chunks(spark, ["slow"]), f.done(), 3).collect()} == {"slow"}
        for q in running:
            q.processAllAvailable()
    finally:
        for q in running:
            q.stop()
        spark.streams.removeListener(counters)
    assert f.rows().count() == 3 * len(quick) + 3
    assert {k.split("-")[0]: (v["rows"], v["errors"]) for k, v in counters.counts.items()}["tag"] == (3 * len(quick) + 3, 0)


def test_a_restart_redoes_nothing_and_a_changed_stage_itself_alone(spark, tmp_path):
    f = flow(spark, tmp_path, 0, lanes=2)
    f.feed(chunks(spark, "abc"))
    f.drain(files=1)
    f.feed(chunks(spark, "de", 100))
    f.drain(files=1)
    f.drain()
    rows = f.rows().collect()
    assert sorted(r.doc_id for r in rows) == sorted([*(10 * k + i for k in range(3) for i in range(3)), *(100 + 10 * k + i for k in range(2) for i in range(3))])
    assert all(p.read_text() == "x" for p in (tmp_path / "calls").iterdir()) and {(r.x, r.y, len(r._prov)) for r in rows} == {(1, 1, 3)}
    other = flow(spark, tmp_path, 0, last=2, lanes=2)
    other.drain()
    assert {r.y for r in other.rows().collect()} == {2} and other.rows().count() == 15
    assert all(p.read_text() == "x" for p in (tmp_path / "calls").iterdir())
    with pytest.raises(P.PlanError):
        Flow(spark, "x", P.Plan("p", (P.Stage("a", "constants", {"values": {}}, limit=1),)), SCHEMA).stages()
    assert isinstance(rows[0].asDict(), dict) and pd.DataFrame([r.asDict() for r in rows]).doc_id.is_unique
