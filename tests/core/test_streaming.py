import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from sievework.streaming import control as ST
from sievework.streaming import rules as RL


@pytest.fixture(scope="module", autouse=True)
def rocksdb(spark):
    old = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", RL.ROCKSDB)
    yield
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", old)


@pytest.fixture()
def events(spark, tmp_path):
    rows = [(i, f"k{i % 2}", 1_700_000_000 + i * 700) for i in range(20)] + [(0, "k0", 1_700_000_000)]
    df = spark.createDataFrame(rows, "id long, k string, s long").select("id", "k", F.timestamp_seconds("s").alias("ts"))
    df.coalesce(1).write.parquet(f"{tmp_path}/in")
    return df, spark.readStream.schema(df.schema).parquet(f"{tmp_path}/in"), tmp_path


def test_dedup(spark, events):
    _, stream, at = events
    ST.once(ST.stream_dedup(stream, "id", "ts"), f"{at}/out", f"file://{at}/cp")
    assert sorted(r.id for r in spark.read.parquet(f"{at}/out").collect()) == list(range(20))


def test_cooldown_is_the_same_in_both_forms(spark, events):
    df, stream, at = events
    batch = {(r.k, r.id) for r in ST.cooldown(df, "k", "ts", "id").collect()}
    when = {r.id: r.s for r in df.select("id", ST.micros("ts").alias("s")).collect()}
    ST.once(ST.stream_cooldown(stream, "k", "ts"), f"{at}/out2", f"file://{at}/cp2")
    assert {(r.key, r.fired) for r in spark.read.parquet(f"{at}/out2").collect()} == {(k, when[i]) for k, i in batch} and len(batch) > 4


def test_batch_rules(spark, events):
    df, _, _ = events
    assert ST.flag_spikes(df.distinct(), ["k"], "ts", seconds=1400, least=2).count() == 18
    assert [r.k for r in ST.alive(df, "k", "ts", seconds=30).collect()] == ["k1"]
    assert {r.k: r.lease for r in ST.lease_state(df, "k", "ts").collect()} == {"k1": "fresh", "k0": "expired"}


def test_bootstrap(spark):
    rows = [(i, float(i % 4)) for i in range(800)]
    df = spark.createDataFrame(rows, "id long, d double")
    a, b = (ST.paired_bootstrap(x, "d", "id", 400, 3).first() for x in (df.coalesce(1), df.repartition(7)))
    assert a.low == pytest.approx(b.low) and a.high == pytest.approx(b.high)
    # the interval of a mean of 800 values of deviation 1.118: 1.5 +- 0.0775
    assert a.low < 1.5 < a.high and 0.85 < (a.high - a.low) / 0.155 < 1.15


def test_bootstrap_counts():
    """Addressed by row, draw and seed alone; Poisson(1) in mean, variance and shares; rows and draws are independent."""
    rows = np.random.default_rng(1).integers(0, 2**63, 400).astype(np.uint64)
    c = ST.bootstrap_counts(rows, 4001, 7)
    assert c.shape == (400, 4001) and (ST.bootstrap_counts(rows[37:39], 50, 7) == c[37:39, :50]).all() and (ST.bootstrap_counts(rows, 50, 8) != c[:, :50]).any()
    assert abs(c.mean() - 1) < 0.005 and abs(c.var() - 1) < 0.01 and abs((c == 0).mean() - np.exp(-1)) < 0.002
    assert abs(np.corrcoef(c[:, :3999].ravel(), c[:, 1:4000].ravel())[0, 1]) < 0.004 and abs(np.corrcoef(c[:-1].ravel(), c[1:].ravel())[0, 1]) < 0.004


def test_cooldown_over_batches(spark, tmp_path):
    """One key, one trigger, many Arrow batches and out of order: as the batch form."""
    rows = [(i, "k", 1_700_000_000 + (i * 7919) % 3000 * 11) for i in range(3000)]
    df = spark.createDataFrame(rows, "id long, k string, s long").select("id", "k", F.timestamp_seconds("s").alias("ts"))
    df.repartition(3).write.parquet(f"{tmp_path}/in")
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        ST.once(ST.stream_cooldown(spark.readStream.schema(df.schema).parquet(f"{tmp_path}/in"), "k", "ts", 600), f"{tmp_path}/out", f"file://{tmp_path}/cp")
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    when = {r.id: r.s for r in df.select("id", ST.micros("ts").alias("s")).collect()}
    want = sorted(when[r.id] for r in ST.cooldown(df, "k", "ts", "id", 600).collect())
    assert sorted(r.fired for r in spark.read.parquet(f"{tmp_path}/out").collect()) == want and len(want) > 30


def test_drained_stream(spark, tmp_path):
    ticks = spark.createDataFrame([(f"j{j}", 1_700_000_000 + 60 * i, (i * (j + 1)) % 5 % 2) for j in range(3) for i in range(40)], "job string, s long, busy int").select("job", F.timestamp_seconds("s").alias("tick"), "busy")
    ticks.coalesce(1).write.parquet(f"{tmp_path}/ticks")
    ST.once(ST.stream_drained(spark.readStream.schema(ticks.schema).parquet(f"{tmp_path}/ticks"), "job", "tick", "busy", 2), f"{tmp_path}/idle", f"file://{tmp_path}/cp1")
    want = {(r.job, r.s) for r in ST.idle_ticks(ticks, "job", "tick", "busy", 2).select("job", ST.micros("tick").alias("s")).collect()}
    assert {(r.key, r.tick) for r in spark.read.parquet(f"{tmp_path}/idle").collect()} == want and want


def fed(spark, tmp_path, df, parts, name):
    """df as a stream whose micro-batches are files in an order of their own, one a trigger."""
    where = f"{tmp_path}/{name}"
    for k, part in enumerate(parts):
        df.where(part).coalesce(1).write.parquet(f"{where}/{k}")
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(where)


def ran(stream, tmp_path, name, mode="append"):
    """Rows of a stream run to its end, and the state rows that it held at most and at last."""
    q = stream.writeStream.outputMode(mode).format("memory").queryName(name).option("checkpointLocation", f"file://{tmp_path}/cp-{name}").trigger(availableNow=True).start()
    q.awaitTermination()
    held = [s["numRowsTotal"] for p in q.recentProgress for s in p["stateOperators"]]
    return [tuple(r) for r in stream.sparkSession.table(name).collect()], held


@pytest.fixture(scope="module")
def signs(spark):
    """Events of three keys and a null one, with ties, gaps and a null time, and one far later that lets the watermark pass."""
    r = random.Random(4)
    rows, at = [], 1_700_000_000
    for i in range(260):
        at += r.choice([0, 1, 5, 20, 70, 130, 400, 3000])
        rows.append((i, r.choice(["a", "b", "", None]), at, r.randrange(4), r.choice(["x", "y"])))
    rows += [(900, "a", None, 1, "x"), (901, "end", at + 10**6, 0, "x")]
    return spark.createDataFrame(rows, "id long, k string, s long, n int, stage string").select("id", "k", "n", "stage", F.timestamp_seconds("s").alias("ts"))


def test_rules_are_the_same_over_shuffled_micro_batches(spark, signs, tmp_path):
    """Within a micro-batch and between near ones events come in any order; what the batch queries say is what comes out."""
    nth = F.row_number().over(Window.orderBy(F.coalesce("ts", F.lit("2023-11-15").cast("timestamp"))))
    rows = signs.withColumn("b", F.floor(nth / 40)).withColumn("b", F.when(F.col("k") == "end", 99).otherwise(F.col("b"))).cache()
    parts = [f"b = {k}" for k in range(7)] + ["b = 99"]
    stream = lambda name: fed(spark, tmp_path, rows.drop("b").join(rows.select("id", "b"), "id").orderBy(F.hash("id")), parts, name).drop("b")
    us = lambda df, *c: {tuple(r) for r in df.select(*c).collect()}
    live = signs.where("k <> 'end' or k is null")

    got, held = ran(RL.stream_flag_spikes(stream("s"), ["k"], "ts", "id", 600, 5, "n"), tmp_path, "spikes")
    want = us(ST.flag_spikes(live.where("ts is not null"), ["k"], "ts", 600, 5, "n"), "k", ST.micros("ts"), F.col("id").cast("string"), "n")
    assert set(got) == want and len(got) == len(want) > 20 and max(held) < 260 and held[-1] <= 4

    got, held = ran(RL.stream_cooldown(stream("c"), ["k"], "ts", "id", 600), tmp_path, "cooldown")
    want = us(ST.cooldown(live, "k", "ts", "id", 600).join(live.select("id", ST.micros("ts").alias("at")), "id"), "k", "at", F.col("id").cast("string"))
    assert {x for x in got if x[0] != "end"} == want and len(want) > 20 and held[-1] <= 4

    got, held = ran(RL.stream_leases(stream("l"), ["k"], "ts"), tmp_path, "leases")
    want = us(ST.lease_transitions(live, "k", "ts", until="2033-01-01 00:00:00"), "k", "at", "lease")
    assert {x for x in got if x[0] != "end"} == want and {x[2] for x in want} == {"fresh", "stale", "expired"} and held[-1] <= 4

    got, held = ran(RL.stream_stall_digest(stream("d"), ["k"], "ts", "stage", "n", 600, 1800), tmp_path, "digest")
    want = us(ST.stall_digest(signs, "k", "ts", "stage", "n", 600, 1800), "k", "at", "stages", "queued", "names")
    assert {x for x in got if x[0] != "end"} == {x for x in want if x[0] != "end"} and len(want) > 20 and held[-1] <= 6

    ticks = signs.where("k = 'a'").select("k", "ts", "n").groupBy("k", "ts").agg(F.max("n").alias("n"))
    parts = [f"id % 2 = {k}" for k in range(2)]
    shuffled = fed(spark, tmp_path, ticks.withColumn("id", F.lit(0)).unionByName(signs.where("k = 'end'").select("k", "ts", "n", F.lit(1).alias("id"))), parts, "t")
    got, held = ran(RL.stream_drained(shuffled, ["k"], "ts", "n", 2), tmp_path, "drained")
    assert {x[1] for x in got if x[0] == "a"} == {r[0] for r in ST.idle_ticks(ticks.where("ts is not null"), "k", "ts", "n", 2).select(ST.micros("ts")).collect()} and len(got) > 1 and held[-1] <= 4


def test_cooldown_of_nulls(spark):
    df = spark.createDataFrame([(1, None, 0), (2, "", 10), (3, None, 20), (4, "x", None), (5, "", 10**6)], "id long, k string, s long").select("id", "k", F.timestamp_seconds("s").alias("ts"))
    assert {(r.k, r.id) for r in ST.cooldown(df, "k", "ts", "id").collect()} == {(None, 1), ("", 2), ("", 5)}


def test_reconcile_stream(spark, tmp_path):
    """Each trigger writes what its own chunks lack; a second run with the same checkpoint reads nothing twice."""
    done = spark.createDataFrame([(0, "a", 0), (0, "b", 0), (1, "a", 1), (2, "b", 1), (None, "b", 1), (0, None, 1)], "stage int, chunk_id string, part int")
    chunks = spark.createDataFrame([("a",), ("b",), ("c",)], "chunk_id string")
    stream = fed(spark, tmp_path, done, ["part = 0", "part = 1"], "done").drop("part")
    for _ in range(2):
        ST.reconcile_every(stream, f"{tmp_path}/rec", f"file://{tmp_path}/cp", 3).awaitTermination()
        assert {tuple(r) for r in ST.missing_now(spark, f"{tmp_path}/rec", chunks).collect()} == {(0, "c"), (1, "b"), (2, "a")}
    assert {r.batch: r.n for r in spark.read.parquet(f"{tmp_path}/rec").groupBy("batch").agg(F.count("*").alias("n")).collect()} == {0: 2, 1: 2}
