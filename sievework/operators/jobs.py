"""The life of a job on the shared store: seed, run what is missing, status, rerun, cancel, collect garbage.

A job is a plan over frozen chunks. Its record is a small JSON file; what is done is what its own log of commits says
(sources.commits), so a job that dies anywhere goes on from there, a chunk that keeps no row is done like any other, and
no job sees another's outputs. Everything of a job lies under its own folder; signatures start from a digest of the
frozen input.
"""

from __future__ import annotations

import json
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievework.operators import control as K
from sievework.operators import reports as RP
from sievework.plans import plan as P
from sievework.sources import jsonl as S
from sievework.sources.commits import Log

ACTIVE, COMPLETE, CANCELLED = "active", "complete", "cancelled"
#: The stage number under which the log has a job's frozen input.
SEED = -1
#: Seconds for which a write without an entry may still be going on.
GRACE_S = 24 * 3600


class JobError(RuntimeError):
    pass


def _record_path(root: str, job_id: str) -> str:
    return f"{root}/jobs/{job_id}.json"


def save(spark: SparkSession, root: str, record: dict) -> dict:
    S.write_text(spark, _record_path(root, record["job_id"]), json.dumps(record, sort_keys=True))
    return record


def load(spark: SparkSession, root: str, job_id: str) -> dict:
    if not S.exists(spark, _record_path(root, job_id)):
        raise JobError(f"no job {job_id!r}")
    return json.loads(S.read_small(spark, _record_path(root, job_id)))


def jobs(spark: SparkSession, root: str) -> list[dict]:
    return [json.loads(S.read_small(spark, p)) for p in S.keys(spark, f"{root}/jobs/*.json")]


def job_path(root: str, job_id: str) -> str:
    return f"{root}/job/{job_id}"


def log(spark: SparkSession, root: str, job_id: str) -> Log:
    return Log(spark, f"{job_path(root, job_id)}/log")


def stage_path(root: str, job_id: str, stage: dict) -> str:
    return f"{job_path(root, job_id)}/{S.stage_key(stage['index'], stage['stage_id'], stage['sig'])}"


def digest(df: DataFrame) -> str:
    """A digest of a frame's rows, whatever their order, and of its columns: two sums of 64-bit hashes and the count. Maps
    and variants have no order to hash and go by their JSON text."""
    cols = [F.to_json(F.struct(F.col(f"`{f.name}`"))) if "map<" in f.dataType.simpleString() or "variant" in f.dataType.simpleString() else F.col(f"`{f.name}`") for f in df.schema]
    nulls = F.concat(*[F.when(c.isNull(), "1").otherwise("0") for c in cols])
    sums = [F.sum(F.xxhash64(F.lit(k), nulls, *cols).cast("decimal(38,0)")).cast("string").alias(f"s{k}") for k in (1, 2)]
    row = df.agg(F.count("*").alias("n"), *sums).first()
    return f"input:{','.join(df.columns)}:{row.n}:{row.s1}:{row.s2}"


def seed(spark: SparkSession, docs: DataFrame, plan: P.Plan, root: str, job_id: str, order_col: str, field: str | None = None, order: list | None = None, size: int = 20, max_chunks: int | None = None) -> dict:
    """Freeze docs into chunks and save the job's record; max_chunks seeds a canary of the first chunks alone. Rows keep their
    place as _ord. Seeding a job again keeps its chunks; with the same plan it changes nothing, with another it takes the
    new signatures."""
    at = log(spark, root, job_id)
    seeds = f"{job_path(root, job_id)}/seed"
    if not at.entries():
        chunks = K.seed_chunks(docs, order_col, field, order, size).withColumn("_ord", F.col("seed_id").cast("long"))
        if max_chunks is not None:
            chunks = chunks.where(F.col("chunk_id").cast("long") < max_chunks)
        at.commit(chunks, chunks, at.attempt(SEED, "seed", seeds))
    frozen = at.rows(SEED, "seed", seeds)
    old = load(spark, root, job_id) if S.exists(spark, _record_path(root, job_id)) else None
    source = old["source"] if old else digest(frozen)
    sigs = [{"index": i, "stage_id": s.id, "sig": sig, "requires": list(s.requires)} for i, (s, sig) in enumerate(zip(P.check(plan), P.signatures(plan, source)))]
    record = {"job_id": job_id, "version": plan.version, "state": ACTIVE, "chunk_count": chunk_ids(at.state(), SEED, "seed").count(), "plan": plan.to_json(), "stages": sigs, "source": source}
    return old if old and old | {"state": ACTIVE} == record else save(spark, root, record)


def chunk_ids(state: DataFrame, stage: int, sig: str) -> DataFrame:
    """(chunk_id) that a stage has done under a signature."""
    return state.where((F.col("stage") == stage) & (F.col("sig") == sig)).select("chunk_id")


def done(spark: SparkSession, root: str, record: dict) -> DataFrame:
    """(stage, chunk_id, records) of all that is done under the record's own signatures; the frozen input is stage -1."""
    named = [(SEED, "seed"), *((s["index"], s["sig"]) for s in record["stages"])]
    wanted = spark.createDataFrame(named, "stage int, sig string")
    return log(spark, root, record["job_id"]).state().join(F.broadcast(wanted), ["stage", "sig"]).select("stage", "chunk_id", "records")


def output(spark: SparkSession, root: str, job_id: str, stage: str | None = None) -> DataFrame:
    """The committed rows of a stage, the last one unless named."""
    record = load(spark, root, job_id)
    spec = record["stages"][-1] if stage is None else next(s for s in record["stages"] if s["stage_id"] == stage)
    return log(spark, root, job_id).rows(spec["index"], spec["sig"], stage_path(root, job_id, spec))


def run(spark: SparkSession, root: str, job_id: str, only: list[str] | None = None, force: bool = False, bindings: dict[str, dict] | None = None) -> dict:
    """Run each stage over the chunks that are due and missing (only: of these chunks; force: of these, done or not), and mark
    the job complete if nothing is missing then.

    The chunks of a stage are one frame and one commit. A stage with a limit takes the first rows of the whole job, so it
    waits until the stage before has done every chunk, and is then run over all of them at once. bindings: by operator, for
    this run alone; no record has them.
    """
    record = load(spark, root, job_id)
    if record["state"] == CANCELLED:
        raise JobError(f"{job_id!r} is cancelled")
    at = log(spark, root, job_id)
    all_ = chunk_ids(at.state(), SEED, "seed")
    targets = all_.where(F.col("chunk_id").isin(only)) if only is not None else all_
    before, folder = {"index": SEED, "sig": "seed"}, f"{job_path(root, job_id)}/seed"
    for stage, spec in zip(P.check(P.Plan.from_json(record["plan"])), record["stages"]):
        state = at.state()
        had, have = chunk_ids(state, before["index"], before["sig"]), chunk_ids(state, spec["index"], spec["sig"])
        if stage.limit is not None:
            waits = all_.join(had, "chunk_id", "left_anti").head(1)
            due = all_ if not waits and (force or all_.join(have, "chunk_id", "left_anti").head(1)) else all_.limit(0)
        else:
            due = targets.join(had, "chunk_id", "left_semi")
            due = due if force else K.resume(due, have, "chunk_id")
        if due.head(1):
            rows = at.rows(before["index"], before["sig"], folder).join(due, "chunk_id", "left_semi")
            at.commit(P.compile_stage(rows, P.bound(stage, bindings or {}), spec["sig"]), due, at.attempt(spec["index"], spec["sig"], stage_path(root, job_id, spec)))
        before, folder = spec, stage_path(root, job_id, spec)
    complete = not all_.join(chunk_ids(at.state(), before["index"], before["sig"]), "chunk_id", "left_anti").head(1)
    return save(spark, root, record | {"state": COMPLETE if complete else ACTIVE})


def status(spark: SparkSession, root: str, job_id: str, shown: int = 8) -> DataFrame:
    """(stage, done, missing, missing_ids) under the record's current signatures."""
    record = load(spark, root, job_id)
    had = done(spark, root, record)
    stages = spark.createDataFrame([(s["index"],) for s in record["stages"]], "stage int")
    return RP.job_status(had.where(F.col("stage") != SEED), had.where(F.col("stage") == SEED), stages, shown=shown)


def metrics(spark: SparkSession, root: str, job_id: str) -> DataFrame:
    """(stage, sig, attempt, rows, errors) of every commit in order, as the writes observed themselves; no data is read."""
    found = [(e["version"], e["stage"], e["sig"], e["attempt"], e.get("rows"), e.get("errors")) for e in log(spark, root, job_id).entries()]
    return spark.createDataFrame(found, "version long, stage int, sig string, attempt string, rows long, errors long")


def rerun(spark: SparkSession, root: str, job_id: str, chunks: list[str] | None = None, force: bool = False, bindings: dict[str, dict] | None = None) -> dict:
    """Run what is missing, of the chunks named if any are; with force run these again, done or not. What was there counts
    until the new rows do."""
    record = load(spark, root, job_id)
    if record["state"] != ACTIVE:
        save(spark, root, record | {"state": ACTIVE})
    return run(spark, root, job_id, chunks, force, bindings)


def cancel(spark: SparkSession, root: str, job_id: str) -> dict:
    """Mark a job cancelled: its outputs stay, nothing runs it any more."""
    return save(spark, root, load(spark, root, job_id) | {"state": CANCELLED})


def collect_garbage(spark: SparkSession, root: str, dry_run: bool = False, grace: int = GRACE_S) -> list[str]:
    """Delete what no job can read any more, and give the paths: folders without a record, all outputs of cancelled jobs,
    outputs under signatures that a record no longer names, and attempts that no chunk needs. An attempt without an entry
    may still be written, so it stays for grace seconds."""
    records = {r["job_id"]: r for r in jobs(spark, root)}
    dead = []
    for home in S.keys(spark, f"{root}/job/*"):
        record = records.get(home.rsplit("/", 1)[1])
        if record is None:
            dead += [home] if S.age(spark, home) > grace else []
            continue
        live = {stage_path(root, record["job_id"], s).split("/job/", 1)[1] for s in record["stages"]} if record["state"] != CANCELLED else set()
        kept = [p for p in S.keys(spark, f"{home}/stage/*/*") if p.split("/job/", 1)[1] in live]
        dead += [p for p in S.keys(spark, f"{home}/stage/*/*") if p not in kept]
        at = log(spark, root, record["job_id"])
        named, needed = {e["attempt"] for e in at.entries()}, {r.attempt for r in at.state().select("attempt").distinct().collect()}
        for p in [x for k in kept for x in S.keys(spark, f"{k}/attempt=*")] + S.keys(spark, f"{home}/seed/attempt=*"):
            name = p.rsplit("attempt=", 1)[1]
            if name not in needed and (name in named or S.age(spark, p) > grace):
                dead.append(p)
    dead.sort()
    if not dry_run:
        S.delete(spark, dead)
    return dead
