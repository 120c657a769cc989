"""JSON lines sources and sinks: shards, chunks, listings, keys, status envelopes."""

from __future__ import annotations

import json
import time
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievework.sources.shared import scratch  # noqa: F401  (the scans' own scratch paths)


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _fs(spark, path)
    return bool(fs.globStatus(p))


def delete(spark: SparkSession, paths: list[str]) -> int:
    n = 0
    for path in paths:
        p, fs = _fs(spark, path)
        n += bool(fs.delete(p, True))
    return n


def make_dir(spark: SparkSession, path: str) -> None:
    p, fs = _fs(spark, path)
    fs.mkdirs(p)


def keys(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob, sorted; none is no error."""
    p, fs = _fs(spark, pattern)
    return sorted(str(s.getPath()) for s in (fs.globStatus(p) or []))


def age(spark: SparkSession, path: str) -> float:
    """Seconds since a path was last changed."""
    p, fs = _fs(spark, path)
    return time.time() - fs.getFileStatus(p).getModificationTime() / 1000


def _put(spark: SparkSession, path: str, text: str, overwrite: bool) -> None:
    p, fs = _fs(spark, path)
    out = fs.create(p, overwrite)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file (a record, a status), replaced as a whole: written beside its place and renamed over it, so a reader (or
    one who comes after a crash) finds the old text or the new one, never none."""
    beside = f"{path}.{uuid.uuid4().hex}.new"
    _put(spark, beside, text, True)
    _rename(spark, beside, path, "OVERWRITE")


def _rename(spark: SparkSession, old: str, new: str, how: str) -> None:
    jvm, (p, fs) = spark.sparkContext._jvm, _fs(spark, old)
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = getattr(jvm.org.apache.hadoop.fs.Options.Rename, how)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    context.rename(p, jvm.org.apache.hadoop.fs.Path(new), options)


def rename_new(spark: SparkSession, old: str, new: str) -> bool:
    """Give a finished folder its name; False if another has it, and the folder goes."""
    if not exists(spark, new):
        try:
            _rename(spark, old, new, "NONE")
            return True
        except Py4JJavaError:
            if not exists(spark, new):
                raise
    delete(spark, [old])
    return False


def create(spark: SparkSession, path: str, text: str) -> bool:
    """A small file that must not be there yet; False if it is. The text is complete before the name is taken: it is written
    beside and the name given by a rename that replaces nothing."""
    beside = f"{path.rsplit('/', 1)[0]}/tmp-{uuid.uuid4().hex}"
    _put(spark, beside, text, False)
    return rename_new(spark, beside, path)


def read_text(spark: SparkSession, path: str) -> str:
    return spark.read.option("wholetext", True).text(path).first().value


def read_small(spark: SparkSession, path: str) -> str:
    """The text of a file of at most a few kB, without a job."""
    p, fs = _fs(spark, path)
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def scan_shards(spark: SparkSession, paths: list[str], schema: str) -> DataFrame:
    """Stage folders of JSON lines shards as one frame; a folder that is not there has no rows. Rows know their shard
    (input_file_name), whose names give the order."""
    out = spark.createDataFrame([], schema)
    for path in paths:
        out = out.unionByName(scan(spark, f"{path}/*.json*", schema, missing_ok=True))
    return out


def resolve(spark: SparkSession, spec: str | list[str]) -> list[str]:
    """Files, globs or a list of them, each once, sorted; nothing at all is an error."""
    out = set()
    for one in [spec] if isinstance(spec, str) else spec:
        p, fs = _fs(spark, one)
        out.update(str(s.getPath()) for s in (fs.globStatus(p) or []))
    if not out:
        raise FileNotFoundError(f"no input matches {spec}")
    return sorted(out)


def scan(spark: SparkSession, spec: str | list[str], schema: str | None = None, missing_ok: bool = False, pattern: str | None = None) -> DataFrame:
    """Records of JSON lines (blank lines are none). With a schema no pass over the data is spent on inference."""
    try:
        paths = resolve(spark, spec)
    except FileNotFoundError:
        if not (missing_ok and schema):
            raise
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema) if schema else spark.read
    return (reader.option("pathGlobFilter", pattern) if pattern else reader).json(paths)


def write_shards(df: DataFrame, path: str, size: int = 1000, mode: str = "errorifexists") -> None:
    df.write.mode(mode).option("maxRecordsPerFile", size).json(path)


def write_chunks(df: DataFrame, chunks: DataFrame, path: str) -> None:
    """Rows by chunk_id, and a manifest of every chunk with its count, so an empty chunk is known to be done."""
    df.write.mode("overwrite").partitionBy("chunk_id").json(f"{path}/data")
    counts = df.groupBy("chunk_id").agg(F.count("*").alias("records"))
    chunks.select("chunk_id").distinct().join(counts, "chunk_id", "left").select("chunk_id", F.coalesce("records", F.lit(0)).alias("records")).write.mode("overwrite").json(f"{path}/manifest")


def read_chunk(spark: SparkSession, path: str, chunk_id: str, schema: str) -> DataFrame:
    if not scan(spark, f"{path}/manifest", "chunk_id string, records long").where(F.col("chunk_id") == chunk_id).head(1):
        raise FileNotFoundError(f"no chunk {chunk_id} under {path}")
    return scan(spark, f"{path}/data/chunk_id={chunk_id}", schema, missing_ok=True)


def stage_key(index: int, stage_id: str, sig: str, chunk: str | None = None) -> str:
    """Where a stage's output lies: its signature is a part of the path, so a changed stage writes elsewhere."""
    base = f"stage/{index:02d}_{stage_id}/{sig}"
    return f"{base}/chunk-{chunk}.jsonl" if chunk is not None else base


def prefix_counts(df: DataFrame, key: str) -> DataFrame:
    """Keys per parent."""
    return df.groupBy(F.regexp_replace(key, "/[^/]*$", "").alias("prefix")).agg(F.count("*").alias("n"))


def collect_keys(df: DataFrame, json_col: str, order: str) -> DataFrame:
    """Top-level keys of JSON objects by their first appearance; counted per key before they meet."""
    keys = df.select(F.posexplode(F.json_object_keys(json_col)).alias("p", "key"), F.col(order).alias("o"))
    first = keys.groupBy("key").agg(F.min(F.struct("o", "p")).alias("f")).agg(F.array_sort(F.collect_list(F.struct("f", "key"))).alias("a"))
    return first.select(F.posexplode("a").alias("place", "x")).select("x.key", F.col("place").cast("long").alias("place"))


def envelope(df: DataFrame) -> DataFrame:
    """Rows as status JSON; null fields are left out."""
    return df.select(F.to_json(F.struct(*df.columns)).alias("status"))


def prompt_snapshot(messages: list[dict]) -> str:
    return json.dumps([{k: m.get(k) for k in ("role", "source", "text")} for m in messages], ensure_ascii=False)
