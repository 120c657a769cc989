"""Checks of output fields with the parameters that all of them share, as columns: a check reads dotted paths, and gives a
struct of a message and a feedback text for the next turn, or null where it passes."""

from __future__ import annotations

from string import Formatter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievework.functions import text as X
from sievework.operators import records as R
from sievework.operators import validators as V

FAILURE = "struct<message:string,feedback:string>"


def placeholders(template: str) -> set[str]:
    return {name for _, name, _, _ in Formatter().parse(template) if name}


def render(template: str, values: dict[str, Column]) -> Column:
    """str.format over columns: literal parts and the values' strings; null values are the text None."""
    parts = []
    for text, name, _, _ in Formatter().parse(template):
        parts += [F.lit(text)] if text else []
        parts += [F.coalesce(values[name].cast("string"), F.lit("None"))] if name else []
    return F.concat(*parts) if parts else F.lit("")


def failure(message: Column, feedback: Column | None = None) -> Column:
    return F.struct(message.alias("message"), (feedback if feedback is not None else F.lit(None).cast("string")).alias("feedback"))


class Check:
    """fields: dotted paths to check, in order; the first that fails counts. reference: a dotted path; where a row has none
    the check passes, or fails if it is required. An output field that a row lacks fails; an empty one is passed over with
    skip_empty_fields. feedback_template takes the placeholders of the check's own template, and no others."""

    template = ""
    known: frozenset[str] = frozenset()

    def __init__(self, fields: list[str], reference: str | None = None, *, required: bool = False, skip_empty_fields: bool = False, name: str | None = None, feedback_template: str | None = None):
        if feedback_template is not None and (unknown := placeholders(feedback_template) - self.known):
            raise ValueError(f"unknown placeholders {sorted(unknown)}; there are {sorted(self.known)}")
        self.fields, self.reference, self.required, self.skip_empty = list(fields), reference, required, skip_empty_fields
        self.name, self.feedback_template = name or type(self).__name__, feedback_template

    def prepare(self, df: DataFrame, key: str | None) -> DataFrame:
        """Columns that the check needs and no expression over one row can give."""
        return df

    def measure(self, text: Column, reference: Column) -> Column | None:
        """What bad, the message and the feedback are all made of, if it is dear: it is computed once a row, and given to bad."""
        return None

    def bad(self, field: str, text: Column, reference: Column, *measured: Column) -> tuple[Column, Column, dict[str, Column]]:
        """(does it fail, what is wrong, values of the feedback's placeholders)"""
        raise NotImplementedError

    def judged(self, field: str, text: Column, reference: Column, *measured: Column) -> Column:
        bad, wrong, values = self.bad(field, text, reference, *measured)
        said = failure(F.concat(F.lit(f"{self.name}: {field} "), wrong), render(self.feedback_template or self.template, values | {"field": F.lit(field)}))
        return F.when(F.coalesce(bad, F.lit(False)), said)

    def empty(self, text: Column) -> Column:
        return text == ""

    def __call__(self, schema: T.StructType) -> Column:
        ref = R.get_path(schema, self.reference) if self.reference else None
        ref = ref.cast("string") if ref is not None else F.lit(None).cast("string")
        found = []
        for field in self.fields:
            at = R.get_path(schema, field)
            text = at.cast("string") if at is not None else F.lit(None).cast("string")
            m = self.measure(text, ref)
            said = self.judged(field, text, ref) if m is None else X.let(m, lambda v: self.judged(field, text, ref, v))  # noqa: B023
            one = F.when(text.isNull(), failure(F.lit(f"{self.name}: output field {field} is missing")))
            if self.skip_empty:
                one = one.when(self.empty(text), F.lit(None).cast(FAILURE))
            found.append(one.otherwise(said))
        out = F.coalesce(*found)
        if self.reference is None:
            return out
        absent = failure(F.lit(f"{self.name}: reference {self.reference} is missing")) if self.required else F.lit(None).cast(FAILURE)
        return F.when(ref.isNull(), absent).otherwise(out)


class LengthRatio(Check):
    template = "{field} has {length} {unit}s against {ref_length} in the text that it mirrors: ratio {ratio}, allowed {min_ratio} to {max_ratio}. Give the complete text at a like length."
    known = frozenset({"field", "length", "ref_length", "ratio", "min_ratio", "max_ratio", "unit"})

    def __init__(self, fields, reference, *, min_ratio: float | None = None, max_ratio: float | None = None, unit: str = "char", **shared):
        super().__init__(fields, reference, **shared)
        if unit not in ("char", "word") or min_ratio is None and max_ratio is None:
            raise ValueError("unit is char or word, and one bound at least is needed")
        self.low, self.high, self.unit = min_ratio, max_ratio, unit

    def size(self, c: Column) -> Column:
        return F.length(c) if self.unit == "char" else F.size(X.space_words(c))

    def empty(self, text):
        return self.size(text) == 0

    def bad(self, field, text, reference):
        a, b = self.size(text), self.size(reference)
        ratio = F.when(b > 0, a / b)
        values = {"length": a, "ref_length": b, "ratio": F.format_number(ratio, 2), "min_ratio": F.lit(self.low), "max_ratio": F.lit(self.high), "unit": F.lit(self.unit)}
        out = F.lit(False)
        for bound, hit in ((self.low, lambda: ratio < self.low), (self.high, lambda: ratio > self.high)):
            out = out | hit() if bound is not None else out
        return out, F.concat(F.lit("length ratio "), values["ratio"]), values


class CharacterCount(Check):
    template = "these have to be in {field} as often as in the source: {mismatches}."
    known = frozenset({"field", "mismatches"})

    def __init__(self, fields, reference, characters: list[str], *, max_diff: int = 0, **shared):
        super().__init__(fields, reference, **shared)
        if not characters or max_diff < 0:
            raise ValueError("characters are needed, and max_diff is 0 or more")
        self.characters, self.most = list(characters), max_diff

    def bad(self, field, text, reference):
        each = []
        for c in self.characters:
            a, b = X.char_count(text, c), X.char_count(reference, c)
            each.append(F.when(F.abs(a - b) > self.most, F.concat(F.lit(f"{c!r} "), a.cast("string"), F.lit(" for "), b.cast("string"))))
        wrong = F.filter(F.array(*each), lambda x: x.isNotNull())
        return F.size(wrong) > 0, F.concat(F.lit("counts differ: "), F.array_join(wrong, "; ")), {"mismatches": F.array_join(wrong, "; ")}


class ScriptConsistency(Check):
    template = "{field} uses scripts that the source does not: {leaks}. Write it without them."
    known = frozenset({"field", "leaks"})

    def __init__(self, fields, reference, *, allow_scripts: tuple[str, ...] = (), **shared):
        super().__init__(fields, reference, **shared)
        if unknown := set(allow_scripts) - set(X.SCRIPT_RANGES):
            raise ValueError(f"no such scripts: {sorted(unknown)}")
        self.allow = tuple(allow_scripts)

    def measure(self, text, reference):
        return F.array_join(F.transform(F.map_entries(X.foreign_scripts(reference, text, self.allow)), lambda e: F.concat(e.key, F.lit(" "), e.value)), "; ")

    def bad(self, field, text, reference, leaks):
        return leaks != "", F.concat(F.lit("foreign scripts: "), leaks), {"leaks": leaks}


class PatternPreservation(Check):
    template = "{field} has to keep what the source has; missing: {missing}; not in the source: {extra}."
    known = frozenset({"field", "missing", "extra"})

    def __init__(self, fields, reference, *, kinds: tuple[str, ...] = X.KINDS, mode: str = "missing", max_diff: int = 0, **shared):
        super().__init__(fields, reference, **shared)
        self.kinds, self.mode, self.most = tuple(kinds), mode, max_diff

    def measure(self, text, reference):
        return X.pattern_misses(reference, text, self.kinds, self.mode)

    def bad(self, field, text, reference, m):
        of = lambda k: F.coalesce(F.try_element_at(m, F.lit(k)), F.array().cast("array<string>"))
        missing, extra = F.array_join(F.concat(of("url"), of("email"), of("number")), ", "), F.array_join(of("extra_number"), ", ")
        hit = (F.size(of("url")) + F.size(of("email")) > 0) | (F.size(of("number")) + F.size(of("extra_number")) > self.most)
        return hit, F.concat(F.lit("patterns missing: "), missing, F.lit("; extra: "), extra), {"missing": missing, "extra": extra}


class _PerKey(Check):
    """A check whose measure is an aggregation: prepare adds it by the rows' key."""

    def column(self, field: str) -> str:
        return f"_check_{self.name}_{field}".replace(".", "_")

    def texts(self, df: DataFrame, key: str | None, field: str) -> DataFrame:
        if key is None:
            raise ValueError(f"{self.name} needs the rows' key")
        path = lambda p: R.get_path(df.schema, p) if p else None
        a, b = path(field), path(self.reference)
        null = F.lit(None).cast("string")
        return df.select(F.col(key), (a.cast("string") if a is not None else null).alias("_text"), (b.cast("string") if b is not None else null).alias("_ref"))

    def measured(self, rows: DataFrame, key: str) -> DataFrame:
        raise NotImplementedError

    def prepare(self, df, key):
        for field in self.fields:
            got = self.measured(self.texts(df, key, field), key)
            df = df.join(got.select(key, F.struct(*[c for c in got.columns if c != key]).alias(self.column(field))), key, "left")
        return df


class Repetition(_PerKey):
    template = "{field} repeats {phrase} {count} times (the source: {ref_count}); at most {max_excess} more are allowed. Write it without the loop."
    known = frozenset({"field", "phrase", "count", "ref_count", "max_excess"})

    def __init__(self, fields, reference=None, *, ngram: int = 3, max_excess: int = 5, **shared):
        super().__init__(fields, reference, **shared)
        self.ngram, self.most = ngram, max_excess

    def measured(self, rows, key):
        return X.repeated_ngram(rows, key, "_text", "_ref" if self.reference else None, self.ngram)

    def bad(self, field, text, reference):
        m = F.col(self.column(field))
        return m.excess > self.most, F.concat(F.lit("repeats "), m.ngram), {"phrase": m.ngram, "count": m["count"], "ref_count": m["count"] - m.excess, "max_excess": F.lit(self.most)}


class Similarity(_PerKey):
    template = "{field} is too unlike the draft that it should edit lightly: similarity {ratio} (at least {min_similarity}), words in common {dice} (at least {min_dice})."
    known = frozenset({"field", "ratio", "min_similarity", "dice", "min_dice"})

    def __init__(self, fields, reference, *, min_similarity: float, min_dice: float | None = None, stem_prefix: int = 5, normalize_case: bool = True, collapse_whitespace: bool = True, **shared):
        super().__init__(fields, reference, **shared)
        self.low, self.low_dice = min_similarity, min_dice
        self.options = (normalize_case, collapse_whitespace, stem_prefix)

    def measured(self, rows, key):
        return V.similarity(rows, key, "_text", "_ref", self.low, self.low_dice, *self.options).drop("message")

    def bad(self, field, text, reference):
        m = F.col(self.column(field))
        low = (m.ratio < self.low) & (F.lit(True) if self.low_dice is None else m.dice < self.low_dice)
        values = {"ratio": F.format_number(m.ratio, 2), "min_similarity": F.lit(self.low), "dice": F.format_number(m.dice, 2), "min_dice": F.lit(self.low_dice)}
        return low, F.concat(F.lit("similarity "), values["ratio"]), values


class Language(Check):
    """Over issues that language_issues has put beside each field: issues maps field to the column of its issues."""

    template = "a language checker finds in {field}: {findings}. Mend these places."
    known = frozenset({"field", "findings"})

    def __init__(self, fields, issues: dict[str, str], *, suppress_source_field: str | None = None, skip_capitalized: bool = True, allowed_fixes: tuple[str, ...] = (), denied_fixes: tuple[str, ...] = (), skip_empty_fields: bool = True, **shared):
        super().__init__(fields, None, skip_empty_fields=skip_empty_fields, **shared)
        self.issues, self.source, self.capitals, self.allow, self.deny = issues, suppress_source_field, skip_capitalized, tuple(allowed_fixes), tuple(denied_fixes)

    def __call__(self, schema):
        self.at_source = R.get_path(schema, self.source) if self.source else None
        return super().__call__(schema)

    def bad(self, field, text, reference):
        found = V.rule_filter(F.col(self.issues[field]), self.allow, self.deny)
        found = V.findings_filter(found, self.at_source.cast("string") if self.at_source is not None else None, self.capitals)
        each = F.array_join(F.transform(found, lambda i: F.concat_ws(": ", F.coalesce(i.rule_id, F.lit("no rule")), F.coalesce(i.error_text, i.message))), "; ")
        return F.size(found) > 0, each, {"findings": each}


class MaxScore(Check):
    """Over scores that score has put beside each field: scores maps field to the column of its score."""

    template = "{field} has an error score of {score}, above {max_score}: it leaves out or changes what the source says."
    known = frozenset({"field", "score", "max_score"})

    def __init__(self, fields, reference, scores: dict[str, str], *, max_score: float, **shared):
        super().__init__(fields, reference, **shared)
        if not 0 <= max_score <= 25:
            raise ValueError("scores are in [0, 25]")
        self.scores, self.most = scores, max_score

    def bad(self, field, text, reference):
        s = F.col(self.scores[field])
        return s > self.most, F.concat(F.lit("score "), F.format_number(s, 2)), {"score": F.format_number(s, 2), "max_score": F.lit(self.most)}


class EditSpan(Check):
    template = "some edits cannot be used: {problems}."
    known = frozenset({"problems"})

    def __init__(self, edits: str = "edits", segments: str = "segments", *, text_key: str = "translation", source_key: str = "text", min_segments_with_term: int = 2, max_words: int = 6, max_edits: int = 6, name: str | None = None, feedback_template: str | None = None):
        super().__init__([], None, name=name, feedback_template=feedback_template)
        self.edits, self.segments, self.options = edits, segments, (text_key, source_key, min_segments_with_term, max_words, max_edits)

    def __call__(self, schema):
        e, s = R.get_path(schema, self.edits), R.get_path(schema, self.segments)
        if e is None or s is None:
            return failure(F.lit(f"{self.name}: {self.edits} or {self.segments} is missing"))
        problems = F.array_join(V.edit_span(e, s, *self.options), "; ")
        return F.when(problems != "", failure(F.concat(F.lit(f"{self.name}: "), problems), render(self.feedback_template or self.template, {"problems": problems})))


def validate(df: DataFrame, checks: list[Check], key: str | None = None, attach: str | None = None) -> DataFrame:
    """Run checks in order over live rows. The first failure becomes the row's error (of type ResponseValidationError), or,
    with attach, a column of that name with the failure's message and feedback, and the row stays well."""
    columns = df.columns
    df = R.with_state(df)
    for c in checks:
        df = c.prepare(df, key)
    found = F.coalesce(*[c(df.schema) for c in checks]) if checks else F.lit(None).cast(FAILURE)
    df = df.withColumn("_check_found", F.when(R.live(), found))
    if attach:
        df = df.withColumn(attach, F.col("_check_found"))
    else:
        df = R.fail_when(df, F.col("_check_found").isNotNull(), "ResponseValidationError", F.col("_check_found.message"))
    return df.select(*[F.col(f"`{c}`") for c in columns], *[c for c in ("_err", "_skip") if c not in columns], *([attach] if attach and attach not in columns else []))
