"""What the workers of an executor hold, and give back, between the stages of the pipeline."""

import subprocess
import sys

import pyarrow as pa
from pyspark.sql import functions as F

from sievework.llm import common as C
from sievework.llm import simhash as S
from sievework.llm import token_store as T

HELD = """
import random, re
from pathlib import Path
from sievework.llm import common as C
from sievework.llm import token_store as T

def held():
    return sum(map(int, re.findall(r"\\nPss_(?:Anon|Shmem):\\s+(\\d+)", Path("/proc/self/smaps_rollup").read_text()))) / 1024

r, at = random.Random(5), held()
enc = T.encoder(T.tokenizer_path())
for _ in range(12):
    for _ in enc.all_ids([" ".join(str(r.randrange(10**9)) for _ in range(700)) for _ in range(100)]):
        pass
full = held()
del enc
C.drop_caches()
print(full - at, held() - at, len(T.Encoder(T.tokenizer_path())))
"""


def test_a_worker_holds_and_returns_memory():
    out = subprocess.run([sys.executable, "-c", HELD], capture_output=True, text=True, check=True).stdout.split()
    full, after = map(float, out[:2])
    assert full < 180 and after < 110


def test_texts_go_to_workers_in_small_batches(spark, docs, tmp_path, monkeypatch):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before, seen, checkpointed = spark.conf.get(key), [], C.checkpointed
    monkeypatch.setattr(C, "checkpointed", lambda df: seen.append(spark.conf.get(key)) or checkpointed(df))
    S.near_dedup(docs).collect()
    assert "1000" in seen and spark.conf.get(key) == before
    spark.conf.set(key, "7")
    try:
        with C.text_batches(spark):
            assert spark.conf.get(key) == "7"
        spark.conf.set(key, "-1")
        with C.text_batches(spark):
            assert spark.conf.get(key) == "1000"
    finally:
        spark.conf.set(key, before)
    many = spark.range(5000, numPartitions=1).select("id", F.lit("x").alias("text"))
    with C.text_batches(spark):
        sizes = many.mapInArrow(lambda bs: (pa.RecordBatch.from_pydict({"n": [b.num_rows]}) for b in bs), "n long").collect()
    assert [r.n for r in sizes] == [1000] * 5


def test_dictionary_is_written_without_python_rows(spark, docs, tmp_path, monkeypatch):
    monkeypatch.setattr(type(spark), "createDataFrame", None)
    T.write_tokens(docs, f"file://{tmp_path}/t", T.tokenizer_path())
    assert isinstance(spark.read.parquet(f"file://{tmp_path}/t/dictionary").first().dictionary, (bytes, bytearray))


def test_values():
    column = pa.array([None, "", *map(str, range(600))])
    assert list(C.values(column)) == column.to_pylist() and list(C.values(column[:0])) == []
