"""Checks of a text against a reference: each gives an error message, or null where the text passes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework.functions import text as X
from sievework.functions.similarity import closeness_of


def python_str(c: Column) -> Column:
    """str(value): null is the text None."""
    return F.coalesce(c.cast("string"), F.lit("None"))


def length_ratio(text: Column, reference: Column, low: float | None = None, high: float | None = None, unit: str = "char") -> Column:
    """Length over the reference's, in characters or words; an empty reference skips."""
    if unit not in ("char", "word"):
        raise ValueError("unit is char or word")
    size = (lambda c: F.length(c)) if unit == "char" else (lambda c: F.size(X.space_words(c)))
    a, b = size(python_str(text)), size(python_str(reference))
    ratio = F.when(b > 0, a / b)
    bad = F.lit(False)
    if low is not None:
        bad = bad | (ratio < low)
    if high is not None:
        bad = bad | (ratio > high)
    return F.when(F.coalesce(bad, F.lit(False)), F.concat(F.lit("length ratio "), F.format_number(ratio, 2)))


def char_count(text: Column, reference: Column, characters: list[str], max_diff: int = 0) -> Column:
    out = []
    for c in characters:
        d = F.abs(X.char_count(python_str(text), c) - X.char_count(python_str(reference), c))
        out.append(F.when(d > max_diff, F.concat(F.lit(f"count of {c!r} differs by "), d.cast("string"))))
    return F.coalesce(*out)


def script_consistency(text: Column, reference: Column, allow: tuple[str, ...] = ()) -> Column:
    found = F.map_keys(X.foreign_scripts(reference, text, allow))
    return F.when(F.size(found) > 0, F.concat(F.lit("foreign script: "), F.array_join(found, ", ")))


def pattern_preservation(text: Column, reference: Column, kinds: tuple[str, ...] = X.KINDS, mode: str = "missing", max_diff: int = 0) -> Column:
    """Any lost URL or address fails; so do more than max_diff lost (and added) numbers."""
    m = X.pattern_misses(reference, text, kinds, mode)
    n = lambda k: F.coalesce(F.size(F.try_element_at(m, F.lit(k))), F.lit(0))
    bad = (n("url") + n("email") > 0) | (n("number") + n("extra_number") > max_diff)
    return F.when(bad, F.concat(F.lit("patterns: "), F.to_json(m)))


def repetition(df: DataFrame, key: str, text: str, reference: str | None = None, ngram: int = 3, max_excess: int = 5) -> DataFrame:
    """(key, ngram, count, excess, message)"""
    r = X.repeated_ngram(df, key, text, reference, ngram)
    return r.withColumn("message", F.when(F.col("excess") > max_excess, F.concat(F.lit("repeats "), F.col("ngram"))))


def similarity(df: DataFrame, key: str, text: str, reference: str, min_similarity: float, min_dice: float | None = None, case: bool = True, whitespace: bool = True, stem: int = 5) -> DataFrame:
    """(key, ratio, dice, message), a row for each: fails only if the ratio, and the word Dice where it is asked for, are both
    low. Both are of the row's own texts, measured where the row lies."""
    m = closeness_of(F.col(text).cast("string"), F.col(reference).cast("string"), case, whitespace, stem if min_dice is not None else None)
    out = df.select(key, m.alias("_m")).select(key, "_m.ratio", "_m.dice")
    low = (F.col("ratio") < min_similarity) & (F.lit(True) if min_dice is None else F.col("dice") < min_dice)
    return out.withColumn("message", F.when(low, F.concat(F.lit("similarity "), F.format_number("ratio", 3))))


def edit_span(edits: Column, segments: Column, text_key: str = "translation", source_key: str = "text", min_segments: int = 2, max_words: int = 6, max_edits: int = 6) -> Column:
    """All that is wrong with [{segment_id, span, replacement, source_term}], as an array of messages (empty: valid)."""
    text = lambda s, k: F.coalesce(s[k].cast("string"), F.lit(""))
    words = lambda c: F.size(X.space_words(c))

    def problems(e):
        span, new = F.coalesce(e.span, F.lit("")), F.coalesce(e.replacement, F.lit(""))
        term = F.trim(X.fold(F.coalesce(e.source_term, F.lit(""))))
        own = F.filter(segments, lambda s: s.id.cast("string") == e.segment_id.cast("string"))
        sharing = F.filter(segments, lambda s: (term != "") & F.contains(X.fold(text(s, source_key)), term))
        shared = F.exists(sharing, lambda s: s.id.cast("string") == e.segment_id.cast("string")) & (F.size(sharing) >= min_segments)
        known = F.size(own) > 0
        checks = [
            F.when(~known, F.lit("no such segment")),
            F.when(known & ((span == "") | ~F.exists(own, lambda s: F.contains(text(s, text_key), span))), F.lit("span does not occur")),
            F.when(known & (span == new), F.lit("replacement equals span")),
            F.when(known & (words(span) > max_words), F.lit("span too long")),
            F.when(known & (words(new) > max_words), F.lit("replacement too long")),
            F.when(known & ~shared, F.lit("term not shared")),
        ]
        return F.transform(F.filter(F.array(*checks), lambda x: x.isNotNull()), lambda x: F.concat(F.coalesce(e.segment_id.cast("string"), F.lit("?")), F.lit(": "), x))

    many = F.when(F.size(edits) > max_edits, F.array(F.lit("too many edits"))).otherwise(F.array().cast("array<string>"))
    return F.when(F.coalesce(F.size(edits), F.lit(0)) == 0, F.array().cast("array<string>")).otherwise(F.concat(many, F.flatten(F.transform(edits, problems))))


def chain(*messages: Column) -> Column:
    """The first failure in order."""
    return F.coalesce(*messages)


def suppress_verbatim(issues: Column, reference: Column, casefold: bool = False) -> Column:
    """Issues whose span is not in the reference; those without a span stay, and an empty reference drops none."""
    f = X.fold if casefold else (lambda c: c)
    kept = lambda ref: F.filter(issues, lambda i: (ref == "") | F.coalesce(i.error_text == "", F.lit(True)) | ~F.contains(ref, f(i.error_text)))
    return X.let(f(F.coalesce(reference, F.lit(""))), kept)


def findings_filter(issues: Column, reference: Column | None = None, skip_capitalized: bool = True) -> Column:
    """Drop findings that stand in the reference, then spans that start with a capital; span-less ones survive both."""
    out = suppress_verbatim(issues, reference, True) if reference is not None else issues
    if skip_capitalized:
        first = lambda i: F.substring(i.error_text, 1, 1)
        out = F.filter(out, lambda i: ~F.coalesce(first(i).rlike(r"^\p{Lu}"), F.lit(False)))
    return out


def rule_filter(issues: Column, allow: tuple[str, ...] = (), deny: tuple[str, ...] = ()) -> Column:
    """Issues by rule id prefixes: of the allowed, where any are, and none of the denied."""
    starts = lambda i, ps: F.coalesce(F.array_contains(F.array(*[F.startswith(i.rule_id, F.lit(p)) for p in ps]), True), F.lit(False))
    return F.filter(issues, lambda i: (starts(i, allow) if allow else F.lit(True)) & (~starts(i, deny) if deny else F.lit(True)))
