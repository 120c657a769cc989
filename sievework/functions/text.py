"""Text functions as built-in column expressions: scripts, tokens, numbers, folding, multisets, word statistics."""

from __future__ import annotations

import sys
from functools import cache, reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Ranges of code points and the script that a text is held to use in them.
SCRIPT_RANGES = {
    "greek": [(0x0370, 0x03FF), (0x1F00, 0x1FFF)],
    "cyrillic": [(0x0400, 0x04FF), (0x0500, 0x052F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F)],
    "armenian": [(0x0530, 0x058F)],
    "hebrew": [(0x0590, 0x05FF)],
    "arabic": [(0x0600, 0x06FF), (0x0750, 0x077F), (0x08A0, 0x08FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF)],
    "devanagari": [(0x0900, 0x097F)],
    "thai": [(0x0E00, 0x0E7F)],
    "georgian": [(0x10A0, 0x10FF)],
    "hangul": [(0x1100, 0x11FF), (0x3130, 0x318F), (0xAC00, 0xD7AF)],
    "hiragana": [(0x3040, 0x309F)],
    "katakana": [(0x30A0, 0x30FF), (0x31F0, 0x31FF), (0xFF66, 0xFF9F)],
    "han": [(0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x2A6DF)],
    "cjk_punctuation": [(0x3000, 0x303F), (0xFF01, 0xFF65)],
}

# Patterns of tokens that a translation has to keep, and the marks trimmed from their ends.
#: White space as str.isspace has it, for Java patterns.
SPACE = r"\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
WORD = r"[\p{L}\p{N}_]+"
URL = rf"(?i:https?://[^{SPACE}<>\"'“”]+|www\.[^{SPACE}<>\"'“”]+)"
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"
#: The same, tried once at the beginning of a run of local characters and not at each of them.
LOCAL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@"
DOMAIN = EMAIL.partition("@")[2]
#: What every address holds.
MARK = r"(?=[@/Ww])(?:@|//|[Ww]{3}\.)"
NUMBER = r"(?:\p{Nd}{1,3}(?:[ \u00A0\u202F]\p{Nd}{3})+(?:[.,]\p{Nd}+)?|\p{Nd}+(?:[.,]\p{Nd}+)*)"
ORDINAL = r"(?i:st|nd|rd|th|s)(?![\p{L}\p{N}_])"
TRAILING = ".,;:!?…\"')]}"
KINDS = ("number", "url", "email")
MODES = ("missing", "both")


#: Where the guarded scripts lie, coarsely: a quick look at a text, which most texts fail.
MAY_BE_GUARDED = r"[\x{370}-\x{1FFF}\x{2DE0}-\x{FFFF}\x{20000}-\x{2A6DF}]"


def _class(script: str) -> str:
    return "[" + "".join(rf"\x{{{a:X}}}-\x{{{b:X}}}" for a, b in SCRIPT_RANGES[script]) + "]"


def let(value: Column, f) -> Column:
    """f(value), with the value computed once: a lambda's body would compute it again for each element."""
    return F.element_at(F.transform(F.array(value), f), 1)


def none_as_empty(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def foreign_scripts(source: Column, hypothesis: Column, allow: tuple[str, ...] = ()) -> Column:
    """map<script, sample>: scripts of the hypothesis that the source lacks, with up to 8 distinct characters of each."""
    entries = []
    for script in SCRIPT_RANGES:
        if script in allow:
            continue
        chars = F.array_distinct(F.regexp_extract_all(none_as_empty(hypothesis), F.lit(_class(script)), F.lit(0)))
        sample = F.concat(F.array_join(F.slice(chars, 1, 8), ""), F.when(F.size(chars) > 8, F.lit("…")).otherwise(F.lit("")))
        found = none_as_empty(hypothesis).rlike(_class(script)) & ~none_as_empty(source).rlike(_class(script))
        entries.append(F.struct(F.lit(script).alias("k"), F.when(found, sample).alias("v")))
    none = F.array().cast("array<struct<k:string,v:string>>")
    kept = F.filter(F.array(*entries), lambda e: e.v.isNotNull()) if entries else none
    return F.map_from_entries(F.when(none_as_empty(hypothesis).rlike(MAY_BE_GUARDED), kept).otherwise(none))


def script_of(c: Column) -> Column:
    """The name of the guarded script of a text's first character; null for others."""
    first, out = F.substring(c, 1, 1), F.lit(None).cast("string")
    for script in SCRIPT_RANGES:
        out = F.coalesce(out, F.when(first.rlike(_class(script)), script))
    return out


def trim_trailing(c: Column) -> Column:
    return F.rtrim(c, F.lit(TRAILING))


def urls(c: Column) -> Column:
    return F.transform(F.regexp_extract_all(none_as_empty(c), F.lit(URL), F.lit(0)), trim_trailing)


def word_of_first(c: Column, mark: str) -> Column:
    """The characters before the word (between spaces) of the first place of a mark; without one, before the last word."""
    return let(F.element_at(F.split(c, mark, 2), 1), lambda head: F.length(head) - F.length(F.substring_index(head, " ", -1)))


def emails(c: Column) -> Column:
    """No address begins before the word of the first @, and the pattern is tried from there on alone."""
    rest = lambda x: F.substr(x, word_of_first(x, "@") + 1)
    return F.transform(F.regexp_extract_all(let(none_as_empty(c), rest), F.lit(LOCAL + DOMAIN), F.lit(0)), trim_trailing)


def blank_addresses(c: Column) -> Column:
    """Without URL and e-mail spans (their union, also where an address runs into a URL); two spaces hold each place."""
    blanked = lambda x: F.regexp_replace(x, f"{URL}|{LOCAL}(?:{URL}|{DOMAIN})", "  ")
    return let(none_as_empty(c), lambda x: let(word_of_first(x, MARK), lambda n: F.concat(F.left(x, n), blanked(F.substr(x, n + 1)))))


def numbers(c: Column, drop_ordinals: bool = False) -> Column:
    """Number tokens as digits alone, in order; those with an ordinal or decade suffix left out if asked."""
    found = F.regexp_extract_all(none_as_empty(c), F.lit(rf"(?=\p{{Nd}}){NUMBER}(?:{ORDINAL})?"), F.lit(0))
    if drop_ordinals:
        found = F.filter(found, lambda x: ~x.rlike(r"[A-Za-z]$"))
    return F.transform(found, lambda x: F.regexp_replace(x, r"[^\p{Nd}]", ""))


def count_in(a: Column, x: Column) -> Column:
    return F.size(F.filter(a, lambda y: y == x))


def multiset_diff(a: Column, b: Column) -> Column:
    """Sorted elements of a, less those of b, counting repeats: quadratic only where the two differ."""
    if_unlike = lambda v: F.when(F.array_sort(v.a) == F.array_sort(v.b), F.slice(v.a, 1, 0)).otherwise(left(v))
    left = lambda v: F.flatten(F.transform(F.array_distinct(v.a), lambda x: F.array_repeat(x, F.greatest(F.lit(0), count_in(v.a, x) - count_in(v.b, x)))))
    return F.array_sort(let(F.struct(a.alias("a"), b.alias("b")), if_unlike))


def pattern_misses(source: Column, hypothesis: Column, kinds: tuple[str, ...] = KINDS, mode: str = "missing") -> Column:
    """map<kind, array<string>>: addresses of the source that the hypothesis lacks, and numbers it lacks (or adds)."""
    if set(kinds) - set(KINDS) or mode not in MODES:
        raise ValueError(f"kinds are of {KINDS} and the mode is one of {MODES}: {kinds}, {mode}")
    entries = []
    for kind, find in (("url", urls), ("email", emails)):
        if kind in kinds:
            entries.append((kind, F.filter(find(source), lambda t: (t != "") & ~F.contains(none_as_empty(hypothesis), t))))
    if "number" in kinds:
        a, b = numbers(blank_addresses(source), True), numbers(blank_addresses(hypothesis))
        entries.append(("number", multiset_diff(a, b)))
        if mode == "both":
            entries.append(("extra_number", multiset_diff(b, a)))
    pairs = F.array(*[F.struct(F.lit(k).alias("k"), v.alias("v")) for k, v in entries]) if entries else F.array().cast("array<struct<k:string,v:array<string>>>")
    return F.map_from_entries(F.filter(pairs, lambda e: F.size(e.v) > 0))


#: Where characters lie that fold otherwise than they lower (but for ß): a coarse class for a quick look at a text.
MAY_FOLD = "[\u00b5\u0149-\u1fff\uab70-\ufb17]"


@cache
def _folds() -> tuple[str, str, dict[str, str], str]:
    """Characters that fold otherwise than they lower: one to one as two strings, the rest (but for ß) as a map, and a class
    of all of them; from Unicode itself."""
    once, many = {}, {}
    for i in range(sys.maxunicode + 1):
        c = chr(i)
        low, fold = c.lower(), c.casefold()
        if low == fold or 0xD800 <= i < 0xE000 or len(low) != 1:
            continue
        (once if len(fold) == 1 else many)[low] = fold
    many.pop("ß")
    return "".join(once), "".join(once.values()), many, "[" + "".join(sorted({*once, *many})) + "]"


def fold(c: Column) -> Column:
    """str.casefold: lower case, then the characters that fold further; those other than ß only where a text has one."""
    ones, to, many, any_ = _folds()
    long = lambda x: reduce(lambda y, kv: F.replace(y, F.lit(kv[0]), F.lit(kv[1])), many.items(), F.translate(x, ones, to))
    return let(F.replace(F.lower(c), F.lit("ß"), F.lit("ss")), lambda x: F.when(x.rlike(MAY_FOLD) & x.rlike(any_), long(x)).otherwise(x))


def word_tokens(c: Column) -> Column:
    return F.regexp_extract_all(fold(none_as_empty(c)), F.lit(WORD), F.lit(0))


def space_words(c: Column) -> Column:
    """str.split()."""
    return F.filter(F.split(none_as_empty(c), f"[{SPACE}]+"), lambda w: w != "")


def normalize_text(c: Column, case: bool = True, whitespace: bool = True) -> Column:
    c = fold(c) if case else c
    return F.regexp_replace(F.regexp_replace(c, f"[{SPACE}]+", " "), "^ | $", "") if whitespace else c


def truncate(c: Column, limit: int = 80) -> Column:
    return F.when(F.length(c) <= limit, c).otherwise(F.concat(F.substring(c, 1, limit - 1), F.lit("…")))


def span_context(text: Column, start: Column, size: Column, margin: int = 40) -> Column:
    """The span (start from 0) in « », with margin characters on either side."""
    first = F.greatest(start - margin, F.lit(0))
    return F.concat(F.substr(text, first + 1, start - first), F.lit("«"), F.substr(text, start + 1, size), F.lit("»"), F.substr(text, start + size + 1, F.lit(margin)))


def char_count(text: Column, characters: str) -> Column:
    """Occurrences, not overlapping, of a string."""
    return ((F.length(text) - F.length(F.replace(text, F.lit(characters), F.lit("")))) / len(characters)).cast("long")


def dice(df: DataFrame, key: str, a: str, b: str, stem: int = 5) -> DataFrame:
    """(key, dice): Dice coefficient of the two texts' multisets of word stems; 1 if neither has words.

    Stems of both sides are counted as 64-bit hashes by key before they shuffle, so a long text is narrow rows."""
    side = lambda c, own: F.transform(word_tokens(F.col(c)), lambda w: F.struct(F.xxhash64(F.substring(w, 1, stem)).alias("w"), F.lit(own).alias("own")))
    both = df.select(key, F.explode(F.concat(side(a, 1), side(b, 0))).alias("x")).groupBy(key, F.col("x.w").alias("w")).agg(F.sum("x.own").alias("x"), F.sum(1 - F.col("x.own")).alias("y"))
    sums = both.groupBy(key).agg((2 * F.sum(F.least("x", "y")) / F.sum(F.col("x") + F.col("y"))).alias("dice"))
    return df.select(key).distinct().join(sums, key, "left").select(key, F.coalesce("dice", F.lit(1.0)).alias("dice"))


def most_repeated(words: Column, reference: Column, n: int = 3) -> Column:
    """struct<ngram,count,excess>: the n-gram of words that occurs most beyond the reference's words, the first of equals;
    null where none does. N-grams are 64-bit hashes in one sorted array, and one pass over it closes a run of equal ones
    at a time; so a text of any length costs its own sort, and nothing is shuffled."""
    gram = lambda h, i: F.xxhash64(*[F.get(h, i + k) for k in range(n)])

    def grams(w: Column, own: int) -> Column:
        each = lambda h: F.transform(F.sequence(F.lit(0), F.size(h) - n), lambda i: F.struct(gram(h, i).alias("g"), i.alias("at"), F.lit(own).alias("own")))
        none = F.array().cast("array<struct<g:bigint,at:int,own:int>>")
        return let(F.transform(w, lambda x: F.xxhash64(x)), lambda h: F.when(F.size(h) >= n, each(h)).otherwise(none))

    def closed(acc: Column) -> Column:
        more = acc.own - acc.ref
        better = (more > acc.best.excess) | ((more == acc.best.excess) & (more > 0) & (acc["at"] < acc.best["at"]))
        return F.when(better, F.struct(acc["at"].alias("at"), acc.own.alias("count"), more.alias("excess"))).otherwise(acc.best)

    def step(acc: Column, x: Column) -> Column:
        same = acc.g.eqNullSafe(x.g)
        here = F.when(x.own == 1, x["at"])
        new = F.struct(x.g.alias("g"), x.own.alias("own"), (1 - x.own).alias("ref"), here.alias("at"), closed(acc).alias("best"))
        run = F.struct(acc.g.alias("g"), (acc.own + x.own).alias("own"), (acc.ref + 1 - x.own).alias("ref"), F.coalesce(acc["at"], here).alias("at"), acc.best.alias("best"))
        return F.when(same, run).otherwise(new)

    zero = F.lit(0)
    start = F.struct(F.lit(None).cast("bigint").alias("g"), zero.alias("own"), zero.alias("ref"), F.lit(None).cast("int").alias("at"), F.struct(F.lit(None).cast("int").alias("at"), zero.alias("count"), zero.alias("excess")).alias("best"))
    best = lambda w: F.aggregate(F.array_sort(F.concat(grams(w, 1), grams(reference, 0))), start, step, closed)
    named = lambda w: let(best(w), lambda b: F.when(b.excess > 0, F.struct(F.array_join(F.slice(w, b["at"] + 1, F.lit(n)), " ").alias("ngram"), b["count"].cast("long").alias("count"), b.excess.cast("long").alias("excess"))))
    return let(words, named)


def repeated_ngram(df: DataFrame, key: str, text: str, reference: str | None = None, n: int = 3) -> DataFrame:
    """(key, ngram, count, excess): the word n-gram that the text repeats most beyond the reference, the first of equals;
    (null, 0, 0) where none is in excess. Of several rows of a key that with the largest excess counts."""
    ref = word_tokens(F.col(reference)) if reference is not None else F.array().cast("array<string>")
    found = df.select(key, most_repeated(word_tokens(F.col(text)), ref, n).alias("b"))
    best = found.groupBy(key).agg(F.max_by("b", F.struct(F.coalesce("b.excess", F.lit(0)), F.coalesce("b.ngram", F.lit("")))).alias("b"))
    return best.select(key, F.col("b.ngram").alias("ngram"), F.coalesce("b.count", F.lit(0).cast("long")).alias("count"), F.coalesce("b.excess", F.lit(0).cast("long")).alias("excess"))


def first_by(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """The first row of each key in an order (dropDuplicates takes any)."""
    return df.withColumn("_first", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_first = 1").drop("_first")
