"""Declarative plans: stages with chained signatures, compiled to frames; only changed stages are run again."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable
from dataclasses import dataclass, field, replace
from importlib import metadata

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievework.operators import records as R
from sievework.sources import jsonl as S

#: Settings that bind a stage to a machine or an account; they never enter a plan.
BINDING_KEYS = ("api_key", "base_url", "endpoint", "host", "password", "token", "url")
#: Settings of how a stage is served, which do not change what it computes.
SERVING_KEYS = ("concurrency", "timeout", "max_retries")


class PlanError(ValueError):
    pass


@dataclass(frozen=True)
class Stage:
    """op names a registered function frame -> frame; options are its arguments. service marks costly or outside work."""

    id: str
    op: str
    options: dict = field(default_factory=dict)
    filters: tuple[tuple[str, str], ...] = ()
    drop_fields: tuple[str, ...] = ()
    limit: int | None = None
    enabled: bool = True
    service: bool = False
    requires: tuple[str, ...] = ()


@dataclass(frozen=True)
class Plan:
    name: str
    stages: tuple[Stage, ...]
    version: str = "1"

    def to_json(self) -> str:
        return json.dumps({"name": self.name, "version": self.version, "stages": [vars(s) for s in self.stages]}, sort_keys=True)

    @classmethod
    def from_json(cls, text: str) -> Plan:
        d = json.loads(text)
        stages = [Stage(**(s | {"filters": tuple(map(tuple, s["filters"])), "drop_fields": tuple(s["drop_fields"]), "requires": tuple(s["requires"])})) for s in d["stages"]]
        return cls(d["name"], tuple(stages), d["version"])


OPS: dict[str, Callable] = {}


def op(name: str):
    def keep(f):
        OPS[name] = f
        return f

    return keep


def binding_keys(options, path: str = "") -> list[str]:
    if isinstance(options, dict):
        return [p for k, v in options.items() for p in ([f"{path}{k}"] if k in BINDING_KEYS and v is not None else binding_keys(v, f"{path}{k}."))]
    if isinstance(options, (list, tuple)):
        return [p for i, v in enumerate(options) for p in binding_keys(v, f"{path}{i}.")]
    return []


def without(options, keys) -> object:
    if isinstance(options, dict):
        return {k: without(v, keys) for k, v in options.items() if k not in keys}
    return [without(v, keys) for v in options] if isinstance(options, (list, tuple)) else options


def canonical(stage: Stage) -> str:
    d = {k: v for k, v in vars(stage).items() if k != "enabled"}
    return json.dumps(without(d, SERVING_KEYS), sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def check(plan: Plan) -> list[Stage]:
    """The enabled stages of a plan that is sound."""
    ids = [s.id for s in plan.stages]
    if len(set(ids)) != len(ids):
        raise PlanError("stage ids repeat")
    for s in plan.stages:
        if s.op not in OPS:
            raise PlanError(f"{s.id}: no operator {s.op!r}")
        if found := binding_keys(s.options):
            raise PlanError(f"{s.id}: a plan never holds bindings: {found}")
    return [s for s in plan.stages if s.enabled]


def resolve_version(version: str | None = None) -> str:
    """The version that signatures carry: as given, else that of the package, else dev."""
    if version:
        return version
    try:
        return metadata.version("sievework")
    except metadata.PackageNotFoundError:
        return "dev"


def inline_prompts(plan: Plan, read: Callable[[str], str]) -> Plan:
    """The plan with the texts of prompt files in their places: an option named x_file becomes x, so a plan needs no file
    and a changed prompt changes the signature."""

    def walk(v):
        if isinstance(v, dict):
            clash = [k for k in v if k.endswith("_file") and k.removesuffix("_file") in v]
            if clash:
                raise PlanError(f"text and file of one prompt: {clash}")
            return {k.removesuffix("_file") if k.endswith("_file") else k: read(x) if k.endswith("_file") else walk(x) for k, x in v.items()}
        return [walk(x) for x in v] if isinstance(v, (list, tuple)) else v

    return replace(plan, stages=tuple(replace(s, options=walk(s.options)) for s in plan.stages))


def render(plan: Plan) -> Plan:
    """A plan fit to be stored: null bindings go, others are refused."""
    clean = lambda v: {k: clean(x) for k, x in v.items() if not (k in BINDING_KEYS and x is None)} if isinstance(v, dict) else [clean(x) for x in v] if isinstance(v, (list, tuple)) else v
    plan = replace(plan, stages=tuple(replace(s, options=clean(s.options)) for s in plan.stages))
    check(plan)
    return plan


def bound(stage: Stage, bindings: dict[str, dict]) -> Stage:
    """The stage with the bindings of its operator, for the moment of running alone: never stored, never signed."""
    extra = bindings.get(stage.op, {})
    if unknown := set(extra) - {*BINDING_KEYS, *SERVING_KEYS}:
        raise PlanError(f"{stage.op}: not bindings: {sorted(unknown)}")
    return replace(stage, options=stage.options | extra)


def signatures(plan: Plan, source: str = "input") -> list[str]:
    """Each stage's signature covers the source (a digest of the input, where one is known), the version and all stages before
    it, so a change redoes that stage and those after."""
    out, before = [], source
    for s in check(plan):
        before = hashlib.sha256(f"{plan.version}|{before}|{canonical(s)}".encode()).hexdigest()[:8]
        out.append(before)
    return out


def first_changed(old: list[str], new: list[str]) -> int:
    return next((i for i, s in enumerate(new) if i >= len(old) or old[i] != s), len(new))


def compile_stage(df: DataFrame, stage: Stage, sig: str) -> DataFrame:
    """select, run, provenance, error fields: one lazy frame, so stages without services fuse into one job."""
    df = R.with_state(df)
    df = R.select_input(df, list(stage.filters), stage.drop_fields, stage.limit)
    df = OPS[stage.op](df, **stage.options)
    df = R.append_provenance(df, {"stage": stage.id, "sig": sig})
    return R.fold_errors(df, stage.id)


def run(spark: SparkSession, plan: Plan, docs: DataFrame, root: str, start_from: str | None = None, bindings: dict[str, dict] | None = None) -> DataFrame:
    """bindings: by operator, for this run alone. Compile a plan over docs (with _ord). Stages up to a service stage, and that stage itself, are written to a place
    named by their signature and read back; a place that is complete already is read, not run. Pure stages stay lazy."""
    stages, sigs = check(plan), signatures(plan)
    if start_from is not None and start_from not in [s.id for s in stages]:
        raise PlanError(f"no stage {start_from!r}")
    first = next((i for i, s in enumerate(stages) if s.id == start_from), 0)
    done = {i: f"{root}/{S.stage_key(i, s.id, sig)}" for i, (s, sig) in enumerate(zip(stages, sigs)) if s.service or i + 1 < len(stages) and stages[i + 1].service}
    resume = max([i for i, path in done.items() if S.exists(spark, f"{path}/_SUCCESS")], default=-1)
    if resume + 1 < first:
        raise PlanError(f"{start_from!r} starts from outputs that are not there")
    df = spark.read.parquet(done[resume]) if resume >= 0 else docs
    for i in range(resume + 1, len(stages)):
        df = compile_stage(df, bound(stages[i], bindings or {}), sigs[i])
        if i in done:
            df.write.mode("overwrite").parquet(done[i])
            S.write_text(spark, f"{done[i]}.json", json.dumps({"stage": stages[i].id, "op": stages[i].op, "sig": sigs[i], "version": plan.version, "columns": df.columns}, sort_keys=True))
            df = spark.read.parquet(done[i])
    return df


def stored(spark: SparkSession, root: str) -> list[dict]:
    """What lies beside each written stage under root: its id, operator, signature, version and columns."""
    return [json.loads(S.read_small(spark, p)) for p in S.keys(spark, f"{root}/stage/*/*.json")]


def abort_unless_listed(df: DataFrame, listed: tuple[str, ...]) -> None:
    """The strict policy: an error of a type that is not listed stops the run."""
    bad = df.where(F.coalesce("error", F.lit(False)) & ~F.col("error_type").isin(*listed)).select("error_type", "error_message").head(1)
    if bad:
        raise RuntimeError(f"{bad[0].error_type}: {bad[0].error_message}")


@op("constants")
def _constants(df, values, **k):
    return R.constants(df, values, **k)


@op("rename")
def _rename(df, fields, **k):
    return R.rename(df, fields, **k)


@op("set_when")
def _set_when(df, when, values):
    return R.set_when(df, when, values)


@op("coalesce")
def _coalesce(df, target, sources, required=True):
    return R.coalesce_fields(df, target, list(sources), required)


@op("candidates")
def _candidates(df, target, sources, **k):
    return R.candidates(df, target, list(sources), **k)


@op("select_by_id")
def _select_by_id(df, **k):
    return R.select_by_id(df, **k)


@op("list_dedup")
def _list_dedup(df, **k):
    return R.list_dedup(df, **k)


@op("list_limit")
def _list_limit(df, **k):
    return R.list_limit(df, **k)


@op("apply_edits")
def _apply_edits(df, **k):
    return R.apply_edits(df, **k)


@op("derive_verdict")
def _derive_verdict(df, **k):
    return R.derive_verdict(df, **k)


def example_plan() -> Plan:
    return Plan("example", (Stage("tag", "constants", {"values": {"target": "en"}}), Stage("route", "set_when", {"when": "n_chars > 500", "values": {"route": "long"}}), Stage("final", "coalesce", {"target": "out", "sources": ["route", "lang"]})))


def signature_table(spark: SparkSession, plan: Plan) -> DataFrame:
    """(index, stage_id, sig), the chain computed by Spark's own sha2 over the stages' canonical text."""
    stages = check(plan)
    rows = [(i, s.id, canonical(s)) for i, s in enumerate(stages)]
    sig = F.lit("input")
    out = None
    for i, stage_id, text in rows:
        sig = F.substring(F.sha2(F.concat(F.lit(plan.version + "|"), sig, F.lit("|" + text)), 256), 1, 8)
        one = spark.range(1).select(F.lit(i).alias("index"), F.lit(stage_id).alias("stage_id"), sig.alias("sig"))
        out = one if out is None else out.unionByName(one)
    return out


from sievework.plans import ops  # noqa: E402,F401  (registers the other operators)
