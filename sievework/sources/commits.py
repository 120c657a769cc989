"""What is done, as a log: numbered entries, each created only if it is absent, with a snapshot now and then.

Data comes first: an attempt writes its rows to a folder of its own, then a manifest beside the log: a table of (chunk_id,
records) of every chunk that it covers, those without a row too. The entry that names the manifest makes all of it count
at once. A writer that dies before has left a folder that nothing reads; one that repeats work adds a later entry, and of
several entries for a chunk the last holds. Manifests are tables, so the driver reads entries (one a write), never chunks.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from sievework.sources import jsonl as S

#: Entries after which a snapshot is written.
SNAPSHOT_EVERY = 16
STATE = "stage int, sig string, chunk_id string, attempt string, records long"


@dataclass(frozen=True)
class Attempt:
    """One write of one stage, and where its rows go."""

    name: str
    stage: int
    sig: str
    folder: str

    @property
    def rows(self) -> str:
        return f"{self.folder}/attempt={self.name}"


@dataclass(frozen=True)
class Log:
    spark: SparkSession
    path: str

    def entries(self, after: int = -1) -> list[dict]:
        """Entries with a number above after, in order."""
        names = [p for p in S.keys(self.spark, f"{self.path}/[0-9]*.json") if int(p.rsplit("/", 1)[1][:-5]) > after]
        return [json.loads(S.read_small(self.spark, p)) | {"version": int(p.rsplit("/", 1)[1][:-5])} for p in names]

    def snapshots(self) -> list[int]:
        return [int(p.rsplit("-", 1)[1]) for p in S.keys(self.spark, f"{self.path}/snapshot-[0-9]*")]

    def append(self, entry: dict) -> int:
        """Add an entry under the next free number; another writer's entry of that number is never replaced."""
        version = max([*(int(p.rsplit("/", 1)[1][:-5]) for p in S.keys(self.spark, f"{self.path}/[0-9]*.json")), *self.snapshots()], default=-1) + 1
        while not S.create(self.spark, f"{self.path}/{version:012d}.json", json.dumps(entry, sort_keys=True)):
            version += 1
        if version % SNAPSHOT_EVERY == SNAPSHOT_EVERY - 1:
            self.snapshot(version)
        return version

    def snapshot(self, version: int) -> None:
        """Write the state as of an entry. The snapshot's name appears by one rename, so a half-written one is never read."""
        beside = f"{self.path}/tmp-{uuid.uuid4().hex}"
        self.state(version).write.parquet(beside)
        S.rename_new(self.spark, beside, f"{self.path}/snapshot-{version:012d}")

    def state(self, until: int | None = None) -> DataFrame:
        """(stage, sig, chunk_id, attempt, records): for each chunk of each signature the last entry's."""
        base = max([v for v in self.snapshots() if until is None or v < until], default=None)
        entries = [e for e in self.entries(-1 if base is None else base) if until is None or e["version"] <= until]
        state = self.spark.createDataFrame([], STATE + ", version long")
        if base is not None:
            state = self.spark.read.schema(STATE).parquet(f"{self.path}/snapshot-{base:012d}").withColumn("version", F.lit(-1).cast("long"))
        if entries:
            named = self.spark.createDataFrame([(e["stage"], e["sig"], e["attempt"], e["version"]) for e in entries], "stage int, sig string, attempt string, version long")
            rows = self.spark.read.schema("attempt string, chunk_id string, records long").parquet(*[e["manifest"] for e in entries])
            state = state.unionByName(rows.join(F.broadcast(named), "attempt").select("stage", "sig", "chunk_id", "attempt", "records", "version"))
        last = F.max_by(F.struct("attempt", "records"), "version").alias("last")
        return state.groupBy("stage", "sig", "chunk_id").agg(last).select("stage", "sig", "chunk_id", "last.attempt", "last.records")

    def commit(self, rows: DataFrame, covered: DataFrame, attempt: Attempt) -> int:
        """Write rows (which have chunk_id), count them by chunk of covered (chunk_id), and make them count. What the write
        observes of itself, rows and errors, goes into the entry."""
        seen = Observation(f"attempt-{attempt.name}")
        failed = F.coalesce("error", F.lit(False)) if dict(rows.dtypes).get("error") == "boolean" else F.lit(False)
        rows.observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if(failed).alias("errors")).write.parquet(attempt.rows)
        counts = self.spark.read.parquet(attempt.rows).groupBy("chunk_id").agg(F.count("*").alias("records"))
        manifest = covered.select("chunk_id").distinct().join(counts, "chunk_id", "left").select(F.lit(attempt.name).alias("attempt"), "chunk_id", F.coalesce("records", F.lit(0)).alias("records"))
        manifest.write.parquet(at := f"{self.path}/manifest-{attempt.name}")
        return self.append({"stage": attempt.stage, "sig": attempt.sig, "attempt": attempt.name, "manifest": at, "rows": seen.get["rows"] or 0, "errors": seen.get["errors"] or 0})

    def attempt(self, stage: int, sig: str, folder: str) -> Attempt:
        return Attempt(uuid.uuid4().hex, stage, sig, folder)

    def rows(self, stage: int, sig: str, folder: str) -> DataFrame:
        """The rows that count of a stage, each chunk's from one attempt. Attempts that count are a few (one a run), so only
        their folders are listed and read; chunks meet their attempt by a join."""
        live = self.state().where((F.col("stage") == stage) & (F.col("sig") == sig)).select("attempt", "chunk_id")
        names = sorted(r.attempt for r in live.select("attempt").distinct().collect())
        if not names:
            raise FileNotFoundError(f"stage {stage} has no committed rows under {folder}")
        found = self.spark.read.option("basePath", folder).parquet(*[f"{folder}/attempt={n}" for n in names])
        return found.join(live, ["attempt", "chunk_id"], "left_semi").drop("attempt")
