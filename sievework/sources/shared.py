"""The folder that driver and executors share: checkpoints, scratch paths."""

from __future__ import annotations

import re
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that the session names in spark.checkpoint.dir (or the context's checkpoint folder). Where it names none, a
    temporary folder will do for a local master alone, which is one machine; on a cluster each executor would write to its
    own disk, so there it is an error."""
    context = spark.sparkContext._jsc.sc()
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at and context.getCheckpointDir().isDefined():
        at = context.getCheckpointDir().get()
    if not at:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        at = "file://" + tempfile.mkdtemp(prefix="sievework-")
    if not context.getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(at)
    return at


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    shared_dir(df.sparkSession)
    return df.checkpoint()


@contextmanager
def set_for_now(spark: SparkSession, key: str, value: str):
    """The session's setting, for the actions inside."""
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def text_batches(spark: SparkSession, rows: int = 1000):
    """For actions that send texts to Python: batches of at most so many rows, as each is held by the executor and by its
    worker, there also as Python's strings."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key))
    return set_for_now(spark, key, str(min(rows, now) if now > 0 else rows))


def settled(df: DataFrame) -> DataFrame:
    """checkpointed, and what its shuffles wrote goes at once: else those files stay until the driver happens to collect its
    garbage, and a chain of checkpoints holds the shuffles of all its steps on disk."""
    with set_for_now(df.sparkSession, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"):
        return checkpointed(df.select("*"))


def remove(spark: SparkSession, path: str) -> None:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
