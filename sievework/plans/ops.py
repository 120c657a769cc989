"""Operators that plans name, beyond those that plans.plan registers: checks, flags, transfer findings, answers, services.

A stage that calls a service names its client; what builds it is registered here, and gets the stage's bindings (hosts, keys)
when the stage is run, so a plan holds neither.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import functions as F

from sievework.functions.expressions import compile_expression
from sievework.operators import answers as A
from sievework.operators import checks as Q
from sievework.operators import records as R
from sievework.operators import services as C
from sievework.plans.plan import BINDING_KEYS, SERVING_KEYS, PlanError, op

CLIENTS: dict[str, Callable[..., Callable]] = {}


def client(name: str):
    """Register what builds a client from bindings."""

    def keep(f):
        CLIENTS[name] = f
        return f

    return keep


def served(name: str, options: dict) -> tuple[Callable, dict]:
    """The client, built from the bindings among the options, and the other options."""
    if name not in CLIENTS:
        raise PlanError(f"no client {name!r}")
    return CLIENTS[name](**{k: v for k, v in options.items() if k in BINDING_KEYS}), {k: v for k, v in options.items() if k not in BINDING_KEYS}


def only(options: dict, *known: str) -> dict:
    """Options without serving settings that an operator has no use for."""
    return {k: v for k, v in options.items() if k not in SERVING_KEYS or k in known}


@op("validate")
def _validate(df, checks, key=None, attach=None):
    """checks: [{"check": name of a class of operators.checks, its parameters}], in order."""
    made = []
    for c in checks:
        kind = getattr(Q, c["check"], None)
        if not (isinstance(kind, type) and issubclass(kind, Q.Check)) or kind is Q.Check:
            raise PlanError(f"no check {c['check']!r}")
        made.append(kind(**{k: v for k, v in c.items() if k != "check"}))
    return Q.validate(df, made, key, attach)


@op("fail_when")
def _fail_when(df, when, type="ValueError", message="refused"):  # noqa: A002
    return R.fail_when(df, compile_expression(when, df.schema), type, message)


@op("list_pick")
def _list_pick(df, **k):
    return R.list_pick(df, **k)


@op("transfer_check")
def _transfer_check(df, **k):
    return R.transfer_check(df, **k)


@op("typed_answer")
def _typed_answer(df, raw, shape, target):
    if shape not in A.SHAPES:
        raise PlanError(f"no shape {shape!r}")
    found = A.typed_answers(R.with_state(df), raw, shape, "_value", "_why")
    failure = F.when(F.col("_why").isNotNull(), R.error("ValueError", F.concat(F.lit("answer: "), F.col("_why"))))
    return R.write(found, target, F.col("_value"), failure).drop("_value", "_why")


@op("llm")
def _llm(df, client, template, output, shape=None, **k):  # noqa: F811
    call, k = served(client, k)
    more = {"parse": A.parser(shape)} if shape else {}
    return C.llm_stage(df, call, template, output, **more, **only(k, "concurrency"))


@op("batched_llm")
def _batched(df, client, **k):  # noqa: F811
    call, k = served(client, k)
    return C.batched_llm(df, call, **only(k, "concurrency"))


@op("translate")
def _translate(df, client, **k):  # noqa: F811
    call, k = served(client, k)
    return C.translate(df, call, **only(k))


@op("language_issues")
def _language_issues(df, client, **k):  # noqa: F811
    call, k = served(client, k)
    return C.language_issues(df, call, **only(k))


@op("language_fix")
def _language_fix(df, client, fields, rules=None, **k):  # noqa: F811
    call, k = served(client, k)
    return C.language_fix(df, call, list(fields), tuple(rules) if rules is not None else None, **only(k))


@op("score")
def _score(df, client, **k):  # noqa: F811
    call, k = served(client, k)
    return C.score(df, call, **only(k))


@op("embed")
def _embed(df, client, **k):  # noqa: F811
    call, k = served(client, k)
    return C.embed(df, call, **only(k))
