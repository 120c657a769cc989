"""Calls under way at once: order, back-pressure, outages, repairs, batches that stream."""

import threading
import time

import pytest
from pyspark.sql import functions as F

from sievework.operators import records as R
from sievework.operators import services as C


def test_a_window_of_calls_in_order():
    busy, most, drawn = [0], [0], []
    lock = threading.Lock()

    def source():
        for i in range(60):
            drawn.append(i)
            yield i

    def call(i):
        with lock:
            busy[0] += 1
            most[0] = max(most[0], busy[0])
        time.sleep(0.03 if i % 7 else 0.1)
        with lock:
            busy[0] -= 1
        return i

    start, out = time.time(), []
    for i in C.in_order(source(), call, 8):
        out.append(i)
        assert len(drawn) <= i + 9  # no more is drawn than is under way
    assert out == list(range(60)) and most[0] == 8 and time.time() - start < 0.5 * (52 * 0.03 + 9 * 0.1)
    with pytest.raises(ZeroDivisionError):
        list(C.in_order(range(5), lambda i: 1 // (3 - i), 2))
    assert list(C.in_order(range(3), str, 1)) == ["0", "1", "2"]


def test_a_slow_client(spark):
    """Eight calls at a time, over rows with types and names that pandas would change."""
    df = spark.createDataFrame([(i, None if i % 3 else i, [f"x{i}"], {"k": i}) for i in range(48)], "id long, maybe long, `a.b` array<string>, m map<string,long>").coalesce(1)

    def client(turns):
        time.sleep(0.1)
        return '"' + turns[-1]["content"] + '"'

    took = []
    for n in (1, 16):
        start = time.time()
        rows = C.llm_stage(df, client, "{id} {maybe}", "out", concurrency=n).collect()
        took.append(time.time() - start)
        assert {r.id: (r.out, r.maybe, r["a.b"], r.m) for r in rows} == {i: (f'"{i} {None if i % 3 else i}"', None if i % 3 else i, [f"x{i}"], {"k": i}) for i in range(48)}
    assert took[1] < 0.6 * took[0]


def test_outages_and_repairs(spark):
    df = spark.createDataFrame([(i,) for i in range(20)], "id long").coalesce(1)

    def down(turns):
        if int(turns[-1]["content"]) in (3, 7, 8):
            raise C.ServiceDown("gone")
        return '{"v": "teh"}'

    def repair(answer, row):
        return answer | {"v": answer["v"].replace("teh", "the"), "id": row["id"]}

    def check(answer, row):
        if answer["v"] != "the":
            raise ValueError("not mended")

    rows = R.fold_errors(C.llm_stage(df, down, "{id}", "out", checks=(check,), repairs=(repair,), breaker=3), "ask").collect()
    assert {r.id for r in rows if r.error} == {3, 7, 8} and {r.error_type for r in rows if r.error} == {"ServiceDown"}
    assert next(r.out for r in rows if r.id == 4) == '{"v": "the", "id": 4}'
    with pytest.raises(Exception, match="down 2 times"):
        C.llm_stage(df, down, "{id}", "out", breaker=2, concurrency=1).collect()


def test_batches_stream_and_stay_in_their_chunk(spark):
    df = spark.createDataFrame([(i, f"t{i}", None if i < 5 else i // 1000, i % 10 == 9) for i in range(2600)], "id long, t string, chunk_id long, error boolean")
    seen = spark.sparkContext.accumulator(0)

    def client(items, feedback):
        seen.add(1)
        ids = list(map(int, items))
        assert len(ids) <= 7 and len({None if i < 5 else i // 1000 for i in ids}) == 1 and ids == sorted(ids)
        return [(k, t.upper()) for k, t in items.items()]

    rows = C.batched_llm(df, client, "id", "t", "out", size=7).collect()
    assert {r.id: r.out for r in rows} == {i: None if i % 10 == 9 else f"T{i}" for i in range(2600)}
    assert 2340 / 7 <= seen.value <= 2340 / 7 + 4
    assert C.batched_llm(df.where(F.lit(False)), client, "id", "t", "out").collect() == []
