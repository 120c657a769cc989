"""Record operators that carry errors: no row is lost, a failed row keeps what it had and says why.

Frames may have two state columns: _err struct<type,message> (null while a row is well) and _skip boolean. Every write
goes to rows that are well and not skipped; others pass through unchanged. fold_errors turns _err into the error fields.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievework.functions.expressions import compile_expression
from sievework.functions.text import KINDS, foreign_scripts, let, pattern_misses

ERR = "struct<type:string,message:string>"


def with_state(df: DataFrame) -> DataFrame:
    """Add the state columns; rows that carry a true error field are done already, and bypass what follows."""
    new = {}
    if "_err" not in df.columns:
        new["_err"] = F.lit(None).cast(ERR)
    if "_skip" not in df.columns:
        new["_skip"] = F.coalesce(F.col("error"), F.lit(False)) if dict(df.dtypes).get("error") == "boolean" else F.lit(False)
    return df.withColumns(new) if new else df


def live() -> Column:
    return F.col("_err").isNull() & ~F.col("_skip")


def error(kind: str, message: str | Column) -> Column:
    return F.struct(F.lit(kind).alias("type"), (F.lit(message) if isinstance(message, str) else message).alias("message"))


def write(df: DataFrame, target: str, value: Column, failure: Column | None = None) -> DataFrame:
    """Set target on live rows; where failure (an error struct) is not null, set that instead."""
    df = with_state(df)
    failed = failure if failure is not None else F.lit(None).cast(ERR)
    old = F.col(f"`{target}`") if target in df.columns else F.lit(None)
    return df.withColumns({target: F.when(live() & failed.isNull(), value).otherwise(old), "_err": F.when(live(), failed).otherwise(F.col("_err"))})


def add_field(df: DataFrame, name: str, value: Column) -> DataFrame:
    """A new column; one that is there already is an error."""
    if name in df.columns:
        raise KeyError(f"field exists: {name}")
    return write(df, name, value)


def replace_field(df: DataFrame, name: str, value: Column, old: str | None = None) -> DataFrame:
    """A new value for a column that has to be there; old names a column for what it was."""
    if name not in df.columns:
        raise KeyError(f"no such field: {name}")
    df = write(df, old, F.col(f"`{name}`")) if old else df
    return write(df, name, value)


def set_field(df: DataFrame, name: str, value: Column) -> DataFrame:
    return write(df, name, value)


def require_list(df: DataFrame, source: str) -> None:
    """A plan over a field that is no list is refused before anything runs; a string is none."""
    if source not in df.columns or not isinstance(df.schema[source].dataType, T.ArrayType):
        raise TypeError(f"{source} is not a list")


def fail_when(df: DataFrame, condition: Column, kind: str, message: str | Column) -> DataFrame:
    df = with_state(df)
    return df.withColumn("_err", F.when(live() & F.coalesce(condition, F.lit(False)), error(kind, message)).otherwise(F.col("_err")))


def fold_errors(df: DataFrame, stage: str) -> DataFrame:
    """Write error, error_message, error_type, error_stage of failed rows; drop the state columns."""
    df = with_state(df)
    bad = F.col("_err").isNotNull()
    old = lambda c, t: F.col(c) if c in df.columns else F.lit(None).cast(t)
    return df.withColumns({
        "error": F.when(bad, F.lit(True)).otherwise(old("error", "boolean")),
        "error_message": F.when(bad, F.col("_err.message")).otherwise(old("error_message", "string")),
        "error_type": F.when(bad, F.col("_err.type")).otherwise(old("error_type", "string")),
        "error_stage": F.when(bad, F.lit(stage)).otherwise(old("error_stage", "string")),
    }).drop("_err", "_skip")


def append_provenance(df: DataFrame, entry: dict[str, str | int], column: str = "_prov") -> DataFrame:
    """Append an entry to the provenance of rows that ran; skipped and failed-before rows get none."""
    df = with_state(df)
    item = F.struct(*[F.lit(v).alias(k) for k, v in entry.items()])
    had = F.coalesce(F.col(column), F.array().cast(df.schema[column].dataType)) if column in df.columns else None
    new = F.array_append(had, item) if had is not None else F.array(item)
    return df.withColumn(column, F.when(~F.col("_skip"), new).otherwise(F.col(column) if column in df.columns else F.lit(None)))


# --- selection -----------------------------------------------------------------------------------------------------

def select_input(df: DataFrame, filters: list[tuple[str, str]], drop_fields: tuple[str, ...] = (), limit: int | None = None, order: str = "_ord") -> DataFrame:
    """filters are (expression, "drop" or "pass"): a row that a drop filter rejects goes; one that only pass filters reject
    stays, marked to be skipped. Dropped fields leave every row that stays. limit keeps the first rows in order."""
    df = with_state(df)
    for expression, mode in filters:
        if mode not in ("drop", "pass"):
            raise ValueError(f"mode is drop or pass, not {mode!r}")
    checks = [(compile_expression(e, df.schema), m) for e, m in filters]
    for keep, mode in checks:
        df = df.filter(keep) if mode == "drop" else df
    rejected = [~keep for keep, mode in checks if mode == "pass"]
    if rejected:
        any_ = rejected[0]
        for r in rejected[1:]:
            any_ = any_ | r
        df = df.withColumn("_skip", F.col("_skip") | any_)
    df = df.drop(*drop_fields)
    return df.orderBy(order).limit(limit) if limit is not None else df


def priority_rank(field: str, order: list) -> Column:
    """Place in the order; what is not listed comes last."""
    at = F.array_position(F.array(*map(F.lit, order)), F.col(field))
    return F.coalesce(F.nullif(at, F.lit(0)), F.lit(len(order) + 1))


# --- modifiers -----------------------------------------------------------------------------------------------------

def rename(df: DataFrame, fields: dict[str, str], keep: bool = False, required: bool = False, exists_ok: bool = False) -> DataFrame:
    """All targets from one snapshot: {a: b, b: c} does not cascade. A target that is there already is refused unless it is
    itself renamed away; with keep, sources stay."""
    absent = [s for s in fields if s not in df.columns]
    if absent and required:
        raise KeyError(f"no such fields: {absent}")
    fields = {s: t for s, t in fields.items() if s in df.columns}
    clash = [t for s, t in fields.items() if t in df.columns and t != s and (t not in fields or keep)]
    if clash and not exists_ok:
        raise KeyError(f"fields exist: {clash}")
    targets = set(fields.values())
    stay = [F.col(f"`{c}`") for c in df.columns if c not in targets and (keep or c not in fields)]
    return df.select(*stay, *[F.col(f"`{s}`").alias(t) for s, t in fields.items()])


def constants(df: DataFrame, values: dict, overwrite: bool = False, exists_ok: bool = False) -> DataFrame:
    there = [k for k in values if k in df.columns]
    if there and not (overwrite or exists_ok):
        raise KeyError(f"fields exist: {there}")
    df = with_state(df)
    old = lambda k: F.col(f"`{k}`") if k in df.columns else F.lit(None)
    first = lambda k, v: F.when(live(), v if overwrite or k not in df.columns else F.coalesce(old(k), v)).otherwise(old(k))
    return df.withColumns({k: first(k, F.lit(v)) for k, v in values.items()})


def get_path(schema: T.StructType, path: str) -> Column | None:
    """A dotted path through structs and maps; None where the schema has no such place."""
    head, *rest = path.split(".")
    if head not in schema.names:
        return None
    col, kind = F.col(f"`{head}`"), schema[head].dataType
    for name in rest:
        if isinstance(kind, T.StructType) and name in kind.names:
            col, kind = col.getField(name), kind[name].dataType
        elif isinstance(kind, T.MapType):
            col, kind = F.try_element_at(col, F.lit(name)), kind.valueType
        else:
            return None
    return col


def _set_in(kind: T.DataType | None, col: Column | None, rest: list[str], value: Column) -> Column:
    if not rest:
        return value
    fields = kind.fields if isinstance(kind, T.StructType) else []
    out, done = [], False
    for f in fields:
        old = col.getField(f.name)
        if f.name == rest[0]:
            out.append(_set_in(f.dataType, old, rest[1:], value).alias(f.name))
            done = True
        else:
            out.append(old.alias(f.name))
    if not done:
        out.append(_set_in(None, None, rest[1:], value).alias(rest[0]))
    return F.struct(*out)


def set_path(df: DataFrame, path: str, value: Column) -> Column:
    """The top column of path with the value set: missing parents are built, others that are no structs are replaced."""
    head, *rest = path.split(".")
    there = head in df.columns
    return _set_in(df.schema[head].dataType if there else None, F.col(f"`{head}`") if there else None, rest, value)


def set_when(df: DataFrame, when: str, values: dict) -> DataFrame:
    """Where the condition holds, set literals at dotted paths; the condition is read once, before any write."""
    df = with_state(df).withColumn("_cond", compile_expression(when, df.schema))
    for path, v in values.items():
        head = path.split(".")[0]
        new = set_path(df, path, F.lit(v))
        same = [f.name for f in df.schema[head].dataType.fields] if head in df.columns and isinstance(df.schema[head].dataType, T.StructType) else None
        hit = live() & F.col("_cond")
        if "." in path and same is not None and path.split(".")[1] not in same:
            old = set_path(df, path, F.lit(None).cast(df.select(F.lit(v)).schema[0].dataType))
        else:
            old = F.col(f"`{head}`") if head in df.columns else F.lit(None)
        df = df.withColumn(head, F.when(hit, new).otherwise(old))
    return df.drop("_cond")


def candidates(df: DataFrame, target: str, sources: list[str], prefix: str = "", required: bool = True, shuffle: bool = False) -> DataFrame:
    """[{id, text}] of the sources found, numbered in order among those found; shuffle puts them in an order that their
    contents alone decide."""
    cols = [get_path(df.schema, s) for s in sources]
    found = F.filter(F.array(*[c.cast("string") if c is not None else F.lit(None).cast("string") for c in cols]), lambda x: x.isNotNull())
    if shuffle:
        key = lambda f: F.transform(f, lambda x, i: F.struct(F.md5(F.concat(F.array_join(f, "\x1f"), F.lit("\x1f"), i.cast("string"))).alias("k"), x.alias("x")))
        found = F.transform(F.array_sort(let(found, key)), lambda e: e.x)
    items = F.transform(found, lambda x, i: F.struct(F.concat(F.lit(prefix), (i + 1).cast("string")).alias("id"), x.alias("text")))
    short = F.size(found) < len(sources)
    failure = F.when(short, error("KeyError", f"{target}: a source is missing")) if required else None
    return write(df, target, items, failure)


def select_by_id(df: DataFrame, id_source: str, candidates: str, target: str, required: bool = True, exists_ok: bool = True) -> DataFrame:
    """The text of the first candidate with the id; an id that no candidate has is always an error."""
    if target in df.columns and not exists_ok:
        raise KeyError(f"field exists: {target}")
    wanted, items = get_path(df.schema, id_source), get_path(df.schema, candidates)
    if wanted is None or items is None:
        return fail_when(df, F.lit(required), "KeyError", f"{id_source} or {candidates} missing")
    hit = F.filter(items, lambda c: c.id == wanted)
    absent = wanted.isNull() | items.isNull()
    unknown = ~absent & (F.size(hit) == 0)
    failure = F.when(unknown | (absent & F.lit(required)), error("KeyError", F.concat(F.lit("no candidate "), F.coalesce(wanted, F.lit("?")))))
    old = F.col(target) if target in df.columns else F.lit(None)
    return write(df, target, F.when(absent, old).otherwise(F.try_element_at(hit, F.lit(1)).text), failure)


def coalesce_fields(df: DataFrame, target: str, sources: list[str], required: bool = True, exists_ok: bool = True) -> DataFrame:
    """The first source that is neither null nor ''; 0, False and [] count. Sources of unlike types become text."""
    if target in df.columns and not exists_ok:
        raise KeyError(f"field exists: {target}")
    cols = [c for c in (get_path(df.schema, s) for s in sources) if c is not None]
    kinds = [df.select(c).schema[0].dataType for c in cols]
    if len(set(kinds)) > 1:
        cols = [F.to_json(c) if isinstance(k, (T.ArrayType, T.StructType, T.MapType)) else c.cast("string") for c, k in zip(cols, kinds)]
    value = F.coalesce(*[F.when(c.cast("string") != "", c) for c in cols]) if cols else F.lit(None)
    return write(df, target, value, F.when(value.isNull(), error("KeyError", f"{target}: no usable source")) if required else None)


def apply_edits(df: DataFrame, edits: str, segments: str, target: str, text_key: str = "translation") -> DataFrame:
    """Apply [{segment_id, span, replacement}] in order, replacing all occurrences in their segments; a segment that is not
    there, or a span that is empty or gone, is an error. target: [{id, source_id, text, edited}]."""
    e, s = get_path(df.schema, edits), get_path(df.schema, segments)
    has_source = "source_id" in df.schema[segments].dataType.elementType.names
    start = F.struct(F.transform(s, lambda x: F.struct(x.id.cast("string").alias("id"), (x.source_id.cast("string") if has_source else F.lit(None).cast("string")).alias("source_id"), x[text_key].cast("string").alias("text"), F.lit(False).alias("edited"))).alias("t"), F.lit(None).cast("string").alias("err"))

    def step(acc, d):
        seg = F.filter(acc.t, lambda x: x.id == d.segment_id.cast("string"))
        gone = F.coalesce(d.span == "", F.lit(True)) | ~F.exists(seg, lambda x: F.contains(x.text, d.span))
        bad = F.when(F.size(seg) == 0, F.concat(F.lit("edit of unknown segment "), F.coalesce(d.segment_id.cast("string"), F.lit("?")))).when(gone, F.concat(F.lit("span not in segment "), d.segment_id.cast("string")))
        done = F.transform(acc.t, lambda x: F.when(x.id == d.segment_id.cast("string"), F.struct(x.id.alias("id"), x.source_id.alias("source_id"), F.replace(x.text, d.span, F.coalesce(d.replacement, F.lit(""))).alias("text"), F.lit(True).alias("edited"))).otherwise(x))
        err = F.coalesce(acc.err, bad)
        return F.struct(F.when(err.isNotNull(), acc.t).otherwise(done).alias("t"), err.alias("err"))

    state = F.aggregate(F.coalesce(e, F.array().cast(df.schema[edits].dataType)), start, step)
    failure = F.when(s.isNull() | e.isNull(), error("KeyError", f"{edits} or {segments} missing")).when(state.err.isNotNull(), error("KeyError", state.err))
    return write(df, target, state.t, failure)


def derive_verdict(df: DataFrame, source: str = "gate_answer", severities: tuple[str, ...] = ("major", "serious"), mismatch_key: str = "model_verdict", required: bool = False) -> DataFrame:
    """verdict needs_edit if any issue's severity is listed, else publishable; the model's own verdict is kept where it differs."""
    c, kind = F.col(source), df.schema[source].dataType
    verdict = F.when(F.exists(F.coalesce(c.issues, F.array().cast(kind["issues"].dataType)), lambda i: F.coalesce(i.severity.isin(*severities), F.lit(False))), "needs_edit").otherwise("publishable")
    was = c.verdict if "verdict" in kind.names else F.lit(None).cast("string")
    fields = [c.getField(f).alias(f) for f in kind.names if f not in ("verdict", mismatch_key)]
    new = F.struct(*fields, F.when(live(), verdict).otherwise(was).alias("verdict"), F.when(live() & (was != verdict), was).alias(mismatch_key))
    df = with_state(df).withColumn(source, F.when(c.isNotNull(), new))
    return fail_when(df, F.col(source).isNull(), "KeyError", f"{source} missing") if required else df


def list_dedup(df: DataFrame, source: str, key: str | None = None) -> DataFrame:
    """Keep the first of equal items (or of items with one key); items without the key stay."""
    require_list(df, source)
    c = F.col(source)
    if key is None:
        return write(df, source, F.array_distinct(c))
    k = lambda x: x[key] if "." not in key else x.getField(key)
    # by key, then place: the first of a key is the one whose neighbour before has another
    new = lambda pairs: F.filter(pairs, lambda p, j: p.k.isNull() | ~F.coalesce(F.get(pairs, j - 1).k == p.k, F.lit(False)))
    first = lambda pairs: F.transform(F.array_sort(F.transform(new(pairs), lambda p: p.i)), lambda i: F.get(c, i))
    return write(df, source, let(F.array_sort(F.transform(c, lambda x, i: F.struct(k(x).alias("k"), i.alias("i")))), first))


def list_limit(df: DataFrame, source: str, limit: int, overflow: str | None = None) -> DataFrame:
    require_list(df, source)
    over = F.greatest(F.lit(0), F.size(source) - limit)
    df = write(df, overflow, over) if overflow else df
    return write(df, source, F.slice(source, 1, limit) if limit else F.filter(source, lambda x: F.lit(False)))


def list_pick(df: DataFrame, source: str, count: int = 1, preserve_order: bool = True, unwrap: bool = False, seed: int = 0) -> DataFrame:
    """count items at random, without replacement; with unwrap the one item itself, and an empty list is an error."""
    require_list(df, source)
    c = F.col(source)
    at = F.slice(F.shuffle(F.when(F.size(c) > 0, F.sequence(F.lit(0), F.size(c) - 1)).otherwise(F.array().cast("array<int>")), F.lit(seed)), 1, count)
    picked = F.transform(F.array_sort(at) if preserve_order else at, lambda i: F.get(c, i))
    if unwrap:
        return write(df, source + "_picked", F.try_element_at(picked, F.lit(1)), F.when(F.size(c) == 0, error("ValueError", f"{source} is empty")))
    return write(df, source, picked)


def transfer_check(df: DataFrame, check: str, target: str, source_field: str, hypothesis_field: str, allow_scripts: tuple[str, ...] = (), kinds: tuple[str, ...] = KINDS, mode: str = "missing") -> DataFrame:
    """What a hypothesis adds to or loses from its source: check "script" writes a map of scripts to their characters,
    "patterns" a map of kinds to counts. Where either text is empty or absent the column stays null."""
    a, b = get_path(df.schema, source_field), get_path(df.schema, hypothesis_field)
    if check not in ("script", "patterns"):
        raise ValueError(f"check is script or patterns, not {check!r}")
    if a is None or b is None:
        return write(df, target, F.lit(None).cast("map<string,string>" if check == "script" else "map<string,int>"))
    found = foreign_scripts(a, b, allow_scripts) if check == "script" else F.transform_values(pattern_misses(a, b, kinds, mode), lambda k, v: F.size(v))
    some = (F.coalesce(a, F.lit("")) != "") & (F.coalesce(b, F.lit("")) != "")
    return write(df, target, F.when(some, found))
