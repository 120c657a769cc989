"""Event logic of the control plane: batch queries, and the same as Structured Streaming operators."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from sievework.operators.reports import count_of

DUPLICATES_S, SPIKE_S, SPIKE_LEAST, COOLDOWN_S, ALIVE_S, LEASE_S = 120, 600, 25, 3600, 30, 120


def micros(c: str) -> Column:
    """A timestamp as microseconds, with or without a time zone: for differences."""
    return F.unix_micros(F.col(c).cast("timestamp"))


def micros_of(c: Column) -> Column:
    return F.unix_micros(c.cast("timestamp"))


def nak_delay(n: Column, base: int = 60, most: int = 900) -> Column:
    return F.least(base * F.pow(F.lit(2.0), F.greatest(n, F.lit(1)) - 1), F.lit(float(most)))


def flag_spikes(events: DataFrame, keys: list[str], ts: str, seconds: int = SPIKE_S, least: int = SPIKE_LEAST, count: str | None = None) -> DataFrame:
    """Events at which the counts of their key in the trailing window, their own included, add up to least or more. Without
    a count column each event counts once."""
    # microseconds, so that a window ends where timestamps differ by less than a second
    w = Window.partitionBy(*keys).orderBy(micros(ts)).rangeBetween(-seconds * 1_000_000, 0)
    return events.withColumn("n", F.sum(count_of(count)).over(w)).where(F.col("n") >= least)


def alive(events: DataFrame, worker: str, ts: str, seconds: int = ALIVE_S) -> DataFrame:
    seen = events.groupBy(worker).agg(F.max(ts).alias("seen"))
    return seen.join(F.broadcast(events.agg(F.max(ts).alias("now")))).where(micros("now") - micros("seen") <= seconds * 1_000_000).drop("now")


def lease_state(events: DataFrame, key: str, ts: str, fresh: int = 60, lease: int = LEASE_S) -> DataFrame:
    seen = events.groupBy(key).agg(F.max(ts).alias("seen")).join(F.broadcast(events.agg(F.max(ts).alias("now"))))
    age = (micros("now") - micros("seen")) / 1e6
    return seen.select(key, F.when(age <= fresh, "fresh").when(age <= lease, "stale").otherwise("expired").alias("lease"))


def lease_transitions(events: DataFrame, key: str, ts: str, fresh: int = 60, lease: int = LEASE_S, until: str | None = None) -> DataFrame:
    """(key, at, lease): when a key becomes fresh (a sign of life after none, or after it was stale), stale (none for more than
    fresh seconds) and expired (none for more than lease seconds). until: a timestamp up to which silence is known, else the
    last event of all. Times in microseconds; events without a time are left out."""
    w = Window.partitionBy(key).orderBy("at")
    rows = events.where(F.col(ts).isNotNull()).select(key, micros(ts).alias("at")).distinct()
    end = F.broadcast(rows.agg(F.max("at").alias("end"))) if until is None else F.broadcast(events.sparkSession.range(1).select(micros_of(F.lit(until)).alias("end")))
    rows = rows.join(end).withColumns({"gap": F.coalesce(F.lead("at").over(w), "end") - F.col("at"), "before": F.col("at") - F.lag("at").over(w)})
    steps = F.array(
        F.when(F.coalesce(F.col("before") > fresh * 1_000_000, F.lit(True)), F.struct(F.col("at").alias("at"), F.lit("fresh").alias("lease"))),
        F.when(F.col("gap") > fresh * 1_000_000, F.struct((F.col("at") + fresh * 1_000_000).alias("at"), F.lit("stale").alias("lease"))),
        F.when(F.col("gap") > lease * 1_000_000, F.struct((F.col("at") + lease * 1_000_000).alias("at"), F.lit("expired").alias("lease"))),
    )
    return rows.select(key, F.explode(F.array_compact(steps)).alias("x")).select(key, "x.at", "x.lease")


def stall_digest(reports: DataFrame, key: str, ts: str, stage: str, queued: str, every: int = 3600, hold: int = 7200) -> DataFrame:
    """(key, at, stages, queued, names): at every tick (a multiple of every seconds) at which stages of a key are stalled, one
    row of them all. A report says how much a stage has queued that nothing can pull (0: it is not stalled); it holds for hold
    seconds or until the stage's next. Ticks run to the last report of all. Reports without a time are left out."""
    step, span = every * 1_000_000, hold * 1_000_000
    rows = reports.where(F.col(ts).isNotNull()).select(key, F.coalesce(F.col(stage).cast("string"), F.lit("")).alias("stage"), micros(ts).alias("from"), F.col(queued).cast("double").alias("q"))
    rows = rows.groupBy(key, "stage", "from").agg(F.max("q").alias("q"))
    end = F.broadcast(rows.agg(F.max("from").alias("end")))
    w = Window.partitionBy(key, "stage").orderBy("from")
    rows = rows.join(end).withColumn("until", F.least(F.coalesce(F.lead("from").over(w), F.col("from") + span), F.col("from") + span, F.col("end") + 1))
    first, last = F.ceil(F.col("from") / step) * step, F.floor((F.col("until") - 1) / step) * step
    held = rows.where((F.col("q") > 0) & (first <= last)).select(key, "stage", "q", F.explode(F.sequence(first, last, F.lit(step))).alias("at"))
    return held.groupBy(key, "at").agg(F.count("*").cast("int").alias("stages"), F.sum("q").cast("long").alias("queued"), F.array_join(F.array_sort(F.collect_list("stage")), ",").alias("names"))


def cooldown(events: DataFrame, key: str, ts: str, tie: str, seconds: int = COOLDOWN_S) -> DataFrame:
    """The events that fire if a key that has fired is silent for so long. One pass over each key's events in order: a
    partition streams through with one time in memory, however many events a key has. A null key is a key of its own; events
    without a time never fire."""

    def run(batches):
        now = fired = None
        for batch in batches:
            keep = []
            for i, (k, s) in enumerate(zip(batch.column("_k").to_pylist(), batch.column("_s").to_pylist())):
                if k != now or s - fired >= seconds * 1_000_000:
                    now, fired = k, s
                    keep.append(i)
            yield batch.take(pa.array(keep, pa.int64())).select([key, tie])

    rows = events.where(F.col(ts).isNotNull()).select(key, tie, micros(ts).alias("_s"), F.coalesce(F.concat(F.lit("k"), F.col(key).cast("string")), F.lit("null")).alias("_k"))
    ordered = rows.repartition("_k").sortWithinPartitions("_k", "_s", tie)
    kinds = dict(events.dtypes)
    return ordered.mapInArrow(run, f"{key} {kinds[key]}, {tie} {kinds[tie]}")


def idle_ticks(ticks: DataFrame, key: str, tick: str, busy: str, least: int) -> DataFrame:
    """The tick at which a key has been idle so many times in a row."""
    w = Window.partitionBy(key).orderBy(tick)
    run = ticks.withColumn("run", F.sum(F.when(F.col(busy) > 0, 1).otherwise(0)).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    idle = F.row_number().over(Window.partitionBy(key, "run").orderBy(tick)) - F.when(F.col("run") > 0, 1).otherwise(0)
    return run.withColumn("idle", idle).where(F.col("idle") == least).select(key, tick)


def poisson_bounds() -> np.ndarray:
    """Of 16 random bits, from which number on one more is counted: Poisson(1), its distribution rounded to 1 / 65536."""
    return np.round(np.cumsum([math.exp(-1) / math.factorial(k) for k in range(12)]) * 65536)


def poisson_counts() -> np.ndarray:
    """How often a row joins a resample, by 16 random bits."""
    return np.searchsorted(poisson_bounds(), np.arange(65536), side="right").astype(np.uint8)


def bootstrap_counts(rows: np.ndarray, draws: int, seed: int) -> np.ndarray:
    """(rows, draws) counts. Each 16 bits are addressed by row, draw and seed alone: a finalised hash of the row's number plus
    the number of the group of four draws, so any block of rows draws as one matrix."""
    odd, seed_ = np.uint64(0x9E3779B97F4A7C15), np.uint64(seed & 0xFFFFFFFFFFFFFFFF)
    x = rows[:, None] + (np.arange(-(-draws // 4), dtype=np.uint64) + np.uint64(1)) * odd + seed_ * np.uint64(0xD6E8FEB86659FD93)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    x ^= x >> np.uint64(31)
    return poisson_counts()[x.view(np.uint16)][:, :draws]


def paired_bootstrap(df: DataFrame, delta: str, key: str, draws: int = 10_000, seed: int = 0) -> DataFrame:
    """(mean, low, high): 95 % interval of the mean. Each row joins each resample a Poisson(1) number of times (the
    bootstrap of large tables), drawn by its key, the resample and the seed, so the result depends on no batch or partition;
    a batch's counts are a matrix, whose products with the deltas are added up in the task, and only draws of them leave it.
    Null deltas are left out; rows of one key draw alike, so keys should be the rows' ids."""

    def run(batches):
        sums, counts = np.zeros(draws), np.zeros(draws)
        for batch in batches:
            d, h = batch.column("d").to_numpy(), np.array([int(x, 16) for x in batch.column("h").to_pylist()], np.uint64)
            for a in range(0, len(d), 256):
                both = np.stack([d[a : a + 256], np.ones(len(d[a : a + 256]))]) @ bootstrap_counts(h[a : a + 256], draws, seed).astype(np.float64)
                sums += both[0]
                counts += both[1]
        yield pa.RecordBatch.from_pydict({"draw": pa.array(range(draws), pa.int32()), "s": pa.array(sums), "n": pa.array(counts)})

    rows = df.where(F.col(delta).isNotNull()).select(F.col(delta).cast("double").alias("d"), F.substring(F.md5(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")), 1, 16).alias("h"))
    means = rows.mapInArrow(run, "draw int, s double, n double").groupBy("draw").agg(F.sum("s").alias("s"), F.sum("n").alias("n")).where("n > 0").select((F.col("s") / F.col("n")).alias("m"))
    return means.agg(F.avg("m").alias("mean"), F.percentile("m", 0.025).alias("low"), F.percentile("m", 0.975).alias("high"))


# --- Structured Streaming --------------------------------------------------------------------------------------------

def stream_dedup(events: DataFrame, key: str, ts: str, seconds: int = DUPLICATES_S) -> DataFrame:
    return events.withWatermark(ts, f"{seconds} seconds").dropDuplicatesWithinWatermark([key])


def stream_flag_spike(events: DataFrame, keys: list[str], ts: str, seconds: int = SPIKE_S, slide: int = 60, least: int = SPIKE_LEAST, count: str | None = None) -> DataFrame:
    """Sliding windows stand in for the exact trailing one of flag_spikes."""
    w = F.window(ts, f"{seconds} seconds", f"{slide} seconds")
    return events.withWatermark(ts, f"{seconds} seconds").groupBy(w, *keys).agg(F.sum(count_of(count)).alias("n")).where(F.col("n") >= least)


def stream_cooldown(events: DataFrame, key: str, ts: str, seconds: int = COOLDOWN_S) -> DataFrame:
    """(key, fired): alerts of a key that has been silent for so long, fired in microseconds. A trigger's events of a key are
    judged in the order of time, whatever batches they come in; the state is one time a key, and goes when the watermark
    has passed the end of its silence, after which it would change nothing."""
    def step(k, frames, state: GroupState):
        out = []
        if not state.hasTimedOut:
            fired = state.get[0] if state.exists else None
            for s in np.sort(np.concatenate([f["_s"].to_numpy() for f in frames])).tolist():
                if fired is None or s - fired >= seconds * 1_000_000:
                    fired = s
                    out.append(s)
            until = fired // 1000 + seconds * 1000 + 1
            if until > state.getCurrentWatermarkMs():
                state.update((fired,))
                state.setTimeoutTimestamp(until)
            elif state.exists:
                state.remove()
        elif state.exists:
            state.remove()
        yield pd.DataFrame({"key": [k[0]] * len(out), "fired": pd.Series(out, dtype="int64")})

    rows = events.withWatermark(ts, f"{seconds} seconds").select(F.col(key).cast("string").alias("key"), F.col(ts), micros(ts).alias("_s"))
    return rows.groupBy("key").applyInPandasWithState(step, "key string, fired long", "fired long", "append", GroupStateTimeout.EventTimeTimeout)


def stream_drained(ticks: DataFrame, key: str, tick: str, busy: str, least: int, late: int = 3600) -> DataFrame:
    """(key, tick): the stream form of idle_ticks. The state is how many idle ticks a key has had in a row; ticks of a trigger
    are taken in order, and later triggers are expected to hold later ticks."""

    def step(k, frames, state: GroupState):
        run = state.get[0] if state.exists else 0
        out = []
        for t, b in sorted((t, b) for f in frames for t, b in zip(f["_s"], f["busy"])):
            run = 0 if b > 0 else run + 1
            if run == least:
                out.append(t)
        state.update((run,))
        yield pd.DataFrame({"key": [k[0]] * len(out), "tick": pd.Series(out, dtype="int64")})

    rows = ticks.select(F.col(key).cast("string").alias("key"), micros(tick).alias("_s"), F.col(busy).cast("long").alias("busy"))
    return rows.groupBy("key").applyInPandasWithState(step, "key string, tick long", "run long", "append", GroupStateTimeout.NoTimeout)


class Stages(StatefulProcessor):
    """A chunk's stages that are done: one number a stage; ttl milliseconds after the last event a chunk is forgotten."""

    def __init__(self, stages: int, ttl: int | None):
        self.stages, self.ttl = stages, ttl

    def init(self, handle) -> None:
        self.done = handle.getValueState("done", "stages array<int>", self.ttl)

    def handleInputRows(self, key, rows, timerValues):
        had = set(self.done.get()[0]) if self.done.exists() else set()
        done = had | {r.stage for r in rows if r.stage is not None and 0 <= r.stage < self.stages}
        if done != had:
            self.done.update((sorted(done),))
            yield Row(chunk_id=key[0], missing=[s for s in range(self.stages) if s not in done and (s == 0 or s - 1 in done)])

    def close(self) -> None:
        pass


def reconcile_every(stream: DataFrame, path: str, checkpoint: str, stages: int, trigger: dict | None = None, ttl: int | None = None):
    """The periodic repair as a stream: each trigger writes, for the chunks that had an event and for no other, which stages
    they lack now (done by the stage before, but not by this one); what a chunk has done is state. Micro-batches have a place
    each, so a repeated one replaces itself, and missing_now reads a whole state at any time. ttl (milliseconds) goes with a
    trigger that runs on, since availableNow would wait for its end. Returns the running query."""
    lacking = stream.where("chunk_id is not null").select("chunk_id", F.col("stage").cast("int").alias("stage")).groupBy("chunk_id").transformWithState(Stages(stages, ttl), "chunk_id string, missing array<int>", "Update", "None" if ttl is None else "ProcessingTime")

    def sink(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return lacking.writeStream.outputMode("update").foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def missing_now(spark, path: str, chunks: DataFrame) -> DataFrame:
    """(stage, chunk_id) that chunks lack by the last thing that reconcile_every said of each; of one without an event, stage 0."""
    said = spark.read.schema("chunk_id string, missing array<int>, batch long").parquet(path)
    last = said.groupBy("chunk_id").agg(F.max_by("missing", "batch").alias("missing"))
    return chunks.select("chunk_id").distinct().join(last, "chunk_id", "left").select(F.explode(F.coalesce("missing", F.array(F.lit(0)))).alias("stage"), "chunk_id")


def once(stream: DataFrame, path: str, checkpoint: str, write=None) -> None:
    """Run what there is and stop; each micro-batch overwrites its own place, so a repeated one leaves no double."""
    def sink(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    stream.writeStream.foreachBatch(write or sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
