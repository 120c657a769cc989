"""Event rules with memory and timers: each the stream form of a batch query, equal to it whatever order events arrive in.

A rule sees a key's events in the order of their own time. Events wait in the state store until the watermark has passed
them, so none can come before; then they are taken in order, and what the rule remembers is let go by a timer as soon as
it can change nothing any more. So a key's state is its events of the last late seconds and a few numbers, and a key that
has been silent has none. Events later than the watermark are dropped, as everywhere in Structured Streaming; so are those
without a time. transformWithState keeps its state in RocksDB.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from sievework.operators.reports import count_of
from sievework.streaming import control as ST

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
SECOND = 1_000_000


class InOrder(StatefulProcessor):
    """Hands a rule its key's events in order of (time, tie), with what it remembers (any JSON value, None at first).

    take(memory, events, now) -> (rows, memory, wake): events as (time, tie, amount), times in microseconds; now: the time that
    the watermark has reached; wake: when to be called without an event, or None. A memory of None leaves no state.
    """

    def init(self, handle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "at long, tie string, amount double")
        self.memory = handle.getValueState("memory", "value string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        new = [(r.at, r.tie, r.amount) for r in rows]
        yield from self.advance(key, new, timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        yield from self.advance(key, [], timerValues)

    def advance(self, key, new, timers) -> Iterator[Row]:
        now = max(timers.getCurrentWatermarkInMs(), 0) * 1000
        events = sorted([*(tuple(x) for x in self.waiting.get()), *new], key=lambda e: (e[0], e[1] or "", e[2]))
        ready = [e for e in events if e[0] <= now]
        rest = events[len(ready) :]
        memory = json.loads(self.memory.get()[0]) if self.memory.exists() else None
        rows, memory, wake = self.take(memory, ready, now)
        if rest:
            self.waiting.put(rest)
        else:
            self.waiting.clear()
        if memory is None:
            self.memory.clear()
        else:
            self.memory.update((json.dumps(memory),))
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)
        due = [-(-x // 1000) for x in [rest[0][0] if rest else None, wake] if x is not None]
        if due:
            self.handle.registerTimer(max(min(due), now // 1000 + 1))
        for row in rows:
            yield Row(**dict(zip(self.names, (*key, *row))))

    def take(self, memory, events, now):
        raise NotImplementedError

    def close(self) -> None:
        pass


class Spikes(InOrder):
    """Events at which the trailing window's amounts, those of the same moment included, add up to least."""

    def __init__(self, seconds: int, least: float):
        self.span, self.least = seconds * SECOND, least

    def take(self, memory, events, now):
        window, rows, i = [tuple(x) for x in memory or []], [], 0
        while i < len(events):
            j = i
            while j < len(events) and events[j][0] == events[i][0]:
                j += 1
            at = events[i][0]
            window = [x for x in window if x[0] >= at - self.span] + [(at, sum(e[2] for e in events[i:j]))]
            total = sum(x[1] for x in window)
            rows += [(e[0], e[1], int(total)) for e in events[i:j] if total >= self.least]
            i = j
        window = [x for x in window if x[0] + self.span > now]
        return rows, window or None, window[-1][0] + self.span if window else None


class Cooldown(InOrder):
    """Events that fire if a key that has fired is silent for so long."""

    def __init__(self, seconds: int):
        self.span = seconds * SECOND

    def take(self, memory, events, now):
        rows = []
        for at, tie, _ in events:
            if memory is None or at - memory >= self.span:
                memory = at
                rows.append((at, tie))
        over = memory is not None and memory + self.span <= now
        return rows, None if over else memory, None if over or memory is None else memory + self.span


class Drained(InOrder):
    """Ticks at which a key has been idle (amount 0 or less) so many times in a row. Ticks further apart than expire start anew."""

    def __init__(self, least: int, expire: int):
        self.least, self.span = least, expire * SECOND

    def take(self, memory, events, now):
        run, last = memory or (0, None)
        rows = []
        for at, tie, busy in events:
            run = 0 if busy > 0 else (run if last is None or at - last <= self.span else 0) + 1
            last = at
            if run == self.least:
                rows.append((at, tie))
        over = last is None or last + self.span < now or run == 0
        return rows, None if over else [run, last], None if over else last + self.span + 1


class Leases(InOrder):
    """(at, lease): when a key becomes fresh, stale and expired by the times of its signs of life."""

    def __init__(self, fresh: int, lease: int):
        self.steps = ((fresh * SECOND, "stale"), (lease * SECOND, "expired"))

    def take(self, memory, events, now):
        rows, (seen, state) = [], memory or (None, "expired")
        for at in [*(e[0] for e in events), None]:
            until = now if at is None else at
            for span, name in self.steps if seen is not None else ():
                if until - seen > span and (state, name) in (("fresh", "stale"), ("stale", "expired")):
                    rows.append((seen + span, name))
                    state = name
            if at is not None:
                if state != "fresh":
                    rows.append((at, "fresh"))
                seen, state = at, "fresh"
        if seen is None or state == "expired":
            return rows, None, None
        return rows, [seen, state], seen + self.steps[0 if state == "fresh" else 1][0] + 1


class Digests(InOrder):
    """(tick, stages, queued, names): at every tick at which some stages of a key are stalled, one row of them all. An event
    says how much a stage (tie) has queued that nothing can pull, 0 if it is not stalled, and holds for so many seconds; of
    several of one moment the largest does."""

    def __init__(self, every: int, hold: int):
        self.every, self.hold = every * SECOND, hold * SECOND

    def take(self, memory, events, now):
        stages, done = (memory or [{}, None])
        rows, events = [], list(events)
        tick = None
        while True:
            first = events[0][0] if events else None
            known = [x[1] for x in stages.values()]
            if done is None:
                if first is None:
                    break
                done = (first - 1) // self.every * self.every
            tick = done + self.every
            if not known and first is not None and first > tick:  # nothing is held until then
                done = (first - 1) // self.every * self.every
                continue
            if tick > now or not known and first is None:
                break
            while events and events[0][0] <= tick:
                at, stage, amount = events.pop(0)
                stages[stage or ""] = [amount, at]
            held = {s: q for s, (q, at) in stages.items() if at + self.hold > tick}
            stuck = {s: q for s, q in held.items() if q > 0}
            if stuck:
                rows.append((tick, len(stuck), int(sum(stuck.values())), ",".join(sorted(stuck))))
            stages, done = {s: stages[s] for s in held}, tick
        for at, stage, amount in events:
            stages[stage or ""] = [amount, at]
        return (rows, [stages, done], done + self.every) if stages else (rows, None, None)


def _rule(events: DataFrame, keys: list[str], ts: str, rule: InOrder, out: str, late: int, tie: str | None = None, amount=None) -> DataFrame:
    """The rule over a stream: keys, then the columns of out. Set-up of the state store is the session's, once."""
    spark = events.sparkSession
    if spark.conf.get("spark.sql.streaming.stateStore.providerClass", ROCKSDB) != ROCKSDB:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    named = [F.col(k).alias(f"k{i}") for i, k in enumerate(keys)]
    at = F.col(ts).cast("timestamp")
    rows = events.where(F.col(ts).isNotNull()).select(*named, at.alias("ts"), F.unix_micros(at).alias("at"), (F.col(tie).cast("string") if tie else F.lit("")).alias("tie"), (amount if amount is not None else F.lit(1.0)).cast("double").alias("amount"))
    rows = rows.withWatermark("ts", f"{late} seconds")
    rule.names = [*(f"k{i}" for i in range(len(keys))), *(x.split()[0] for x in out.split(", "))]
    kinds = ", ".join(f"k{i} {rows.schema[f'k{i}'].dataType.simpleString()}" for i in range(len(keys)))
    found = rows.groupBy(*[f"k{i}" for i in range(len(keys))]).transformWithState(rule, f"{kinds}, {out}", "Append", "EventTime")
    return found.withColumnsRenamed({f"k{i}": k for i, k in enumerate(keys)})


def stream_flag_spikes(events: DataFrame, keys: list[str], ts: str, tie: str, seconds: int = ST.SPIKE_S, least: int = ST.SPIKE_LEAST, count: str | None = None, late: int = 60) -> DataFrame:
    """(*keys, at, tie, n): control.flag_spikes, exactly: the window trails each event."""
    return _rule(events, keys, ts, Spikes(seconds, least), "at long, tie string, n long", late, tie, count_of(count))


def stream_cooldown(events: DataFrame, keys: list[str], ts: str, tie: str, seconds: int = ST.COOLDOWN_S, late: int = 60) -> DataFrame:
    """(*keys, at, tie): control.cooldown."""
    return _rule(events, keys, ts, Cooldown(seconds), "at long, tie string", late, tie)


def stream_drained(ticks: DataFrame, keys: list[str], tick: str, busy: str, least: int, expire: int = 86_400, late: int = 60) -> DataFrame:
    """(*keys, at, tie): control.idle_ticks; a key without a tick for expire seconds is forgotten."""
    return _rule(ticks, keys, tick, Drained(least, expire), "at long, tie string", late, None, F.col(busy))


def stream_leases(events: DataFrame, keys: list[str], ts: str, fresh: int = 60, lease: int = ST.LEASE_S, late: int = 60) -> DataFrame:
    """(*keys, at, lease): control.lease_transitions."""
    return _rule(events, keys, ts, Leases(fresh, lease), "at long, lease string", late)


def stream_stall_digest(reports: DataFrame, keys: list[str], ts: str, stage: str, queued: str, every: int = 3600, hold: int = 7200, late: int = 60) -> DataFrame:
    """(*keys, at, stages, queued, names): control.stall_digest."""
    return _rule(reports, keys, ts, Digests(every, hold), "at long, stages int, queued long, names string", late, stage, F.col(queued))
