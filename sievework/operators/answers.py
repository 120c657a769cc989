"""Typed, nested answers: shapes with closed word lists and length bounds, checked as columns or call by call.

A shape is a list of fields, each `name` or `name:kind`: text unless said; `bool`; `text<=N` of at most N characters; a
closed list `(a|b)` by name; `[kind]` or a shape's name. `?` after a kind lets the field be absent, and then a list is
empty and a text is "". Further fields of an answer are ignored. A refused answer says where it is wrong, by path.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework.functions import exact as E
from sievework.operators.services import Rejected, cut_off_feedback

# The closed lists of the answers.
LISTS = {
    "category": "terminology accuracy linguistic_conventions style locale_conventions audience_appropriateness",
    "pick_category": "terminology accuracy linguistic_conventions style locale_conventions audience_appropriateness consistency relevance",
    "severity": "minor major serious",
    "quality": "good acceptable poor",
    "segment": "question answer",
    "harmony": "consistency locale_conventions linguistic_conventions",
    "verdict": "publishable needs_edit",
    "pick_id": "C1 C2",
    "adjust": "terminology named_entity title format",
}
# The fields of the answers.
SHAPES = {
    "SimpleTranslation": "translation",
    "LanguageToolEvaluation": "finding_message is_real_issue:bool reason",
    "TranslationIssue": "category:(category) severity:(severity) span_in_target explanation suggested_fix",
    "TranslationReview": "overall_quality languagetool_evaluations:[LanguageToolEvaluation]? issues:[TranslationIssue]? improved_primary improved_polished improved_alternative",
    "CandidateIssue": "category:(pick_category) severity:(severity) span explanation",
    "CandidateEvaluation": "id quality:(quality) issues:[CandidateIssue]? key_terms:[text]?",
    "SharedConcept": "concept question_form answer_form consistent:bool",
    "ConsistencyCheck": "shared_concepts:[SharedConcept]? register_match:bool relevance_ok:bool relevance_note",
    "HarmonizationEdit": "segment:(segment) span replaced_with category:(harmony) reason",
    "QAPairSelection": "question_candidate_evaluations:[CandidateEvaluation]? answer_candidate_evaluations:[CandidateEvaluation]? selected_question_id selected_answer_id selection_rationale consistency_check:ConsistencyCheck harmonization_edits:[HarmonizationEdit]? final_question final_answer overall_quality:(quality)",
    "SegmentCandidateIssue": "category:(category) severity:(severity) span explanation",
    "SegmentCandidateEvaluation": "id quality:(quality) issues:[SegmentCandidateIssue]?",
    "TranslationSelection": "candidate_evaluations:[SegmentCandidateEvaluation]? ranking:[text]? selected_id selection_rationale selected_translation",
    "GateIssue": "category:(category) span_in_target explanation:text<=240 severity:(severity)",
    "TranslationGate": "issues:[GateIssue]? verdict:(verdict)",
    "TranslationGateRewrite": "issues:[GateIssue]? verdict:(verdict) improved_translation?",
    "GateIssueVerdict": "span_in_target is_valid:bool reason:text<=120",
    "TranslationFix": "issue_verdicts:[GateIssueVerdict]? approach improved_primary improved_polished",
    "TranslationPick": "ranking:[text]? selected_id selected_translation",
    "TranslationPickById": "ranking:[(pick_id)]? selected_id:(pick_id)",
    "TermEdit": "segment_id source_term span replacement category:(adjust) reason:text<=120",
    "PairAdjustment": "edits:[TermEdit]?",
}


def fields(shape: str) -> list[tuple[str, str, bool]]:
    """(name, kind, may be absent) of a shape."""
    out = []
    for f in SHAPES[shape].split():
        name, _, kind = f.removesuffix("?").partition(":")
        out.append((name, kind or "text", f.endswith("?")))
    return out


def ddl(kind: str) -> str:
    if kind.startswith("["):
        return f"array<{ddl(kind[1:-1])}>"
    if kind in SHAPES:
        return f"struct<{','.join(f'`{n}`:{ddl(k)}' for n, k, _ in fields(kind))}>"
    return "boolean" if kind == "bool" else "string"


def words(kind: str) -> list[str]:
    return LISTS[kind[1:-1]].split()


def problem(v: Column, kind: str, path: Column, absent_ok: bool = False) -> Column:
    """Where and how a VARIANT is not of a kind; NULL if it is."""
    say = lambda text: F.concat(path, F.lit(f": {text}"))

    def of(v: Column, k: Column) -> Column:
        missing = F.when((k == "absent") & F.lit(not absent_ok), say("missing"))
        if kind.startswith("["):
            inner = F.filter(F.transform(E.items(v), lambda x, i: problem(x, kind[1:-1], F.concat(path, F.lit("["), i.cast("string"), F.lit("]")))), lambda p: p.isNotNull())
            found = F.when(k != "list", say("a list is expected")).otherwise(F.try_element_at(inner, F.lit(1)))
        elif kind in SHAPES:
            dot = F.when(path == "", "").otherwise(F.concat(path, F.lit(".")))
            parts = [problem(E.get(v, n), t, F.concat(dot, F.lit(n)), ok) for n, t, ok in fields(kind)]
            found = F.when(k != "map", say("an object is expected")).otherwise(F.coalesce(*parts))
        elif kind == "bool":
            found = F.when(k != "bool", say("true or false is expected"))
        else:
            found = F.when(k != "str", say("a text is expected"))
            if kind.startswith("("):
                found = F.coalesce(found, F.when(~E.text(v, k).isin(words(kind)), say(f"one of {', '.join(words(kind))} is expected")))
            elif "<=" in kind:
                most = int(kind.split("<=")[1])
                found = F.coalesce(found, F.when(F.length(E.text(v, k)) > most, say(f"more than {most} characters")))
        return F.when(k == "absent", missing).otherwise(found)

    return E.bind(of, v, E.kind(v))


def filled(c: Column, kind: str) -> Column:
    """A parsed answer with what may be absent filled in."""
    if kind.startswith("["):
        inner = kind[1:-1]
        return F.transform(c, lambda x: filled(x, inner)) if inner in SHAPES else c
    if kind not in SHAPES:
        return c
    parts = []
    for n, t, ok in fields(kind):
        x = filled(c.getField(n), t)
        empty = F.array().cast(ddl(t)) if t.startswith("[") else F.lit("")
        parts.append((F.coalesce(x, empty) if ok else x).alias(n))
    return F.struct(*parts)


def typed_answers(df: DataFrame, raw: str, shape: str, value: str = "value", why: str = "problem") -> DataFrame:
    """df with the answer as a struct and what is wrong with it as a path and a text: exactly one of both is null. A null or
    empty answer, and one that is no JSON, are refused."""
    at = E.bind(lambda v: F.when(v.isNull(), F.lit("not JSON")).otherwise(problem(v, shape, F.lit(""))), F.try_parse_json(F.col(raw)))
    out = df.withColumn(why, at)
    return out.withColumn(value, F.when(F.col(why).isNull(), filled(F.from_json(raw, ddl(shape)), shape)))


def check(v, kind: str, path: str = "", absent: bool = False, absent_ok: bool = False) -> str | None:
    """The same of one parsed answer."""
    if absent:
        return None if absent_ok else f"{path}: missing"
    if kind.startswith("["):
        if not isinstance(v, list):
            return f"{path}: a list is expected"
        return next((p for i, x in enumerate(v) if (p := check(x, kind[1:-1], f"{path}[{i}]"))), None)
    if kind in SHAPES:
        if not isinstance(v, dict):
            return f"{path}: an object is expected"
        return next((p for n, t, ok in fields(kind) if (p := check(v.get(n), t, f"{path}.{n}" if path else n, n not in v, ok))), None)
    if kind == "bool":
        return None if isinstance(v, bool) else f"{path}: true or false is expected"
    if not isinstance(v, str):
        return f"{path}: a text is expected"
    if kind.startswith("(") and v not in words(kind):
        return f"{path}: one of {', '.join(words(kind))} is expected"
    most = re.search(r"<=(\d+)$", kind)
    return f"{path}: more than {most[1]} characters" if most and len(v) > int(most[1]) else None


def parser(shape: str) -> Callable[[str], dict]:
    """The shape as a parse function of services.llm_stage: what is wrong goes into the next turn."""

    def parse(raw: str) -> dict:
        try:
            value = json.loads(raw)
        except ValueError as e:
            raise Rejected(f"not JSON: {e}", cut_off_feedback(raw) if not raw.rstrip().endswith("}") else "answer with one JSON object") from e
        if wrong := check(value, shape):
            raise Rejected(wrong, f"your answer is not as asked for: {wrong}")

        def fill(v, kind: str):
            if kind.startswith("["):
                return [fill(x, kind[1:-1]) for x in v]
            return {n: fill(v[n], t) if n in v else [] if t.startswith("[") else "" for n, t, _ in fields(kind)} if kind in SHAPES else v

        return fill(value, shape)

    return parse
