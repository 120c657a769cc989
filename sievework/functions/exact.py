"""The expression language over whole JSON records: one VARIANT column, whose rows may differ in schema.

A record is any JSON object. A field that is not there is SQL NULL, a JSON null is a VARIANT null, so they differ: `x == None`
holds for null alone, two absent fields are equal, and an absent one equals nothing else. Every value is a VARIANT, so each
row's own types decide. As in the typed form, comparisons of unlike values are false (`!=` is true), and only arithmetic on
what is no number and a division by zero raise. Whole numbers compare exactly; 1, 1.0 and true are equal, also in lists and
objects (true there only to true).
"""

from __future__ import annotations

import ast
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sievework.functions.expressions import ALIASES, ExpressionError, parse
from sievework.sources import jsonl as S

NUMBERS = ("bool", "int", "float")


def bind(f, *cols: Column) -> Column:
    """f of columns that are computed once, however often f uses them."""
    return F.element_at(F.transform(F.array(F.struct(*[c.alias(f"c{i}") for i, c in enumerate(cols)])), lambda s: f(*[s[f"c{i}"] for i in range(len(cols))])), 1)


def null() -> Column:
    return F.parse_json(F.lit("null"))


def step(name: str) -> str:
    if "'" in name and '"' in name or "\\" in name:
        raise ExpressionError(f"a field name with both quotes or a backslash: {name!r}")
    return f'["{name}"]' if "'" in name else f"['{name}']"


def get(v: Column, name: str) -> Column:
    """A field of an object; NULL where there is none, or v is no object."""
    return F.try_variant_get(v, "$" + step(name), "variant")


def get_path(record: Column, path: str) -> Column:
    """A dotted path through objects alone: a list, a text or a null on the way is an absent value."""
    return F.try_variant_get(record, "$" + "".join(map(step, path.split("."))), "variant")


def set_path(record: Column, path: str, value: Column) -> Column:
    """The record with a VARIANT at a dotted path. Parents that are not there, or are no objects, become objects."""
    head, _, rest = path.partition(".")
    fields = F.coalesce(F.try_variant_get(record, "$", "map<string,variant>"), F.create_map().cast("map<string,variant>"))

    def put(m: Column) -> Column:
        new = set_path(F.try_element_at(m, F.lit(head)), rest, value) if rest else value
        return F.to_variant_object(F.map_concat(F.map_filter(m, lambda k, _: k != head), F.create_map(F.lit(head), new)))

    return bind(put, fields)


def kind(v: Column) -> Column:
    """absent null bool int float str list map, or other. Whole numbers are 64 bits, or decimals of 19 digits and more; 1.0 is a
    decimal of fewer."""
    of = lambda s: F.when(s.isNull(), "absent").when(s == "VOID", "null").when(s == "BOOLEAN", "bool").when(s.rlike(r"^(BIGINT|DECIMAL\((19|[23]\d),0\))$"), "int").when(s.rlike("^(DOUBLE|FLOAT|DECIMAL)"), "float").when(s == "STRING", "str").when(s.startswith("ARRAY"), "list").when(s.startswith("OBJECT"), "map").otherwise("other")
    return bind(of, F.schema_of_variant(v))


def whole(v: Column, k: Column) -> Column:
    return F.when(k == "bool", F.try_variant_get(v, "$", "boolean").cast("int").cast("decimal(38,0)")).when(k == "int", F.try_variant_get(v, "$", "decimal(38,0)"))


def as_whole(c: Column) -> Column:
    return F.coalesce(c.try_cast("long").cast("variant"), c.cast("variant"))


def number(v: Column, k: Column) -> Column:
    return F.when(k == "bool", F.try_variant_get(v, "$", "boolean").cast("int").cast("double")).when(k.isin("int", "float"), F.try_variant_get(v, "$", "double"))


def text(v: Column, k: Column) -> Column:
    return F.when(k == "str", F.try_variant_get(v, "$", "string"))


def items(v: Column) -> Column:
    return F.try_variant_get(v, "$", "array<variant>")


def fields(v: Column) -> Column:
    return F.try_variant_get(v, "$", "map<string,variant>")


def canonical(v: Column) -> Column:
    """JSON text of a list or object, fields by name, whole floats as whole numbers."""
    return F.regexp_replace(F.to_json(v), r'("(?:[^"\\]|\\.)*")|(-?\d+)\.0+(?![\dEe])', "$1$2")


def truth_of(v: Column) -> Column:
    def of(v: Column, k: Column) -> Column:
        out = F.when(k == "bool", F.try_variant_get(v, "$", "boolean")).when(k.isin("int", "float"), number(v, k) != 0).when(k == "str", text(v, k) != "")
        return F.coalesce(out.when(k == "list", F.size(items(v)) > 0).when(k == "map", F.size(fields(v)) > 0), F.lit(False))

    return bind(of, v, kind(v))


def same(a: Column, b: Column) -> Column:
    """Equality, never NULL."""
    def of(a, b, i, j):
        mixed = lambda w, d: (d == F.floor(d)) & (d.try_cast("decimal(38,0)") == w)
        numbers = F.when((i != "float") & (j != "float"), whole(a, i) == whole(b, j)).when((i == "float") & (j == "float"), number(a, i) == number(b, j)).when(i == "float", mixed(whole(b, j), number(a, i))).otherwise(mixed(whole(a, i), number(b, j)))
        out = F.when(i.isin(*NUMBERS) & j.isin(*NUMBERS), numbers).when(i != j, False).when(i.isin("absent", "null"), True).when(i == "str", text(a, i) == text(b, j))
        return F.coalesce(out.otherwise(canonical(a) == canonical(b)), F.lit(False))

    return bind(of, a, b, kind(a), kind(b))


def ordered(a: Column, b: Column, op) -> Column:
    """A comparison by size: of numbers, of texts by code point, of lists of either; false of all else."""
    lists = lambda v, s, of: F.when(s.rlike(r"^ARRAY<(BIGINT|DOUBLE|FLOAT|DECIMAL\(\d+,\d+\))>$") | (F.size(items(v)) == 0), F.try_variant_get(v, "$", "array<double>")) if of == "double" else F.when((s == "ARRAY<STRING>") | (F.size(items(v)) == 0), F.try_variant_get(v, "$", "array<string>"))

    def of(a, b, i, j):
        numbers = F.when((i != "float") & (j != "float"), op(whole(a, i), whole(b, j))).otherwise(op(number(a, i), number(b, j)))
        out = F.when(i.isin(*NUMBERS) & j.isin(*NUMBERS), numbers).when((i == "str") & (j == "str"), op(text(a, i), text(b, j)))
        both = F.coalesce(*[op(lists(a, F.schema_of_variant(a), t), lists(b, F.schema_of_variant(b), t)) for t in ("double", "string")])
        return F.coalesce(out.when((i == "list") & (j == "list"), both), F.lit(False))

    return bind(of, a, b, kind(a), kind(b))


def within(a: Column, b: Column, negate: bool) -> Column:
    """a in b: items of a list, fields of an object, parts of a text; nothing, negated or not, is in or out of anything else."""
    def of(a, b, i, j):
        hit = F.when(j == "list", F.exists(items(b), lambda x: same(a, x))).when(j == "map", F.coalesce(F.map_contains_key(fields(b), text(a, i)), F.lit(False))).when((j == "str") & (i == "str"), F.contains(text(b, j), text(a, i)))
        return F.coalesce(~hit if negate else hit, F.lit(False))

    return bind(of, a, b, kind(a), kind(b))


def item(v: Column, key: Column) -> Column:
    """v[key]: by place from either end, by name, or a letter; NULL where there is none."""
    def of(v, key, i, j):
        at = whole(key, j).cast("long").cast("int")
        place = F.when(at >= 0, at + 1).otherwise(at)
        letter = lambda s: F.when((at < F.length(s)) & (at >= -F.length(s)), F.substring(s, place, F.lit(1))).cast("variant")
        whole_key = j.isin("int", "bool")
        return F.when((i == "list") & whole_key, F.try_element_at(items(v), place)).when((i == "map") & (j == "str"), F.try_element_at(fields(v), text(key, j))).when((i == "str") & whole_key, letter(text(v, i)))

    return bind(of, v, key, kind(v), kind(key))


def wrong(what: str, kind_: str) -> Column:
    return F.raise_error(F.lit(f"{what} on values of the wrong type")).cast(kind_)


def arithmetic(op: type, a: Column, b: Column) -> Column:
    def of(a, b, i, j):
        x, y, u, v = whole(a, i), whole(b, j), number(a, i), number(b, j)
        wholes = (i != "float") & (j != "float")
        down = lambda p, q: F.floor(p / q)
        apart = (x % y != 0) & ((x < 0) != (y < 0))
        if op is ast.Div:
            out = (u / v).cast("variant")
        else:
            exact = {ast.Add: lambda: x + y, ast.Sub: lambda: x - y, ast.Mult: lambda: x * y, ast.FloorDiv: lambda: F.call_function("div", x, y).cast("decimal(38,0)") - apart.cast("int").cast("decimal(38,0)"), ast.Mod: lambda: F.when(apart, x % y + y).otherwise(x % y)}[op]()
            near = {ast.Add: lambda: u + v, ast.Sub: lambda: u - v, ast.Mult: lambda: u * v, ast.FloorDiv: lambda: down(u, v).cast("double"), ast.Mod: lambda: F.when((u % v != 0) & ((u < 0) != (v < 0)), u % v + v).otherwise(u % v)}[op]()
            out = F.when(wholes, as_whole(exact.cast("decimal(38,0)"))).otherwise(near.cast("variant"))
        out = F.when(i.isin(*NUMBERS) & j.isin(*NUMBERS), out)
        if op is ast.Add:
            out = out.when((i == "str") & (j == "str"), F.concat(text(a, i), text(b, j)).cast("variant")).when((i == "list") & (j == "list"), F.concat(items(a), items(b)).cast("variant"))
        if op is ast.Mult:
            times = lambda s, n: F.repeat(s, F.greatest(n, F.lit(0)).cast("int")).cast("variant")
            out = out.when((i == "str") & j.isin("int", "bool"), times(text(a, i), y)).when((j == "str") & i.isin("int", "bool"), times(text(b, j), x))
        return out.otherwise(wrong("arithmetic", "variant"))

    return bind(of, a, b, kind(a), kind(b))


def called(name: str, v: Column) -> Column:
    def of(v, k):
        if name == "len":
            return F.when(k == "str", F.length(text(v, k))).when(k == "list", F.size(items(v))).when(k == "map", F.size(fields(v))).cast("variant")
        if name == "abs":
            return F.when(k.isin("bool", "int"), as_whole(F.abs(whole(v, k)))).when(k == "float", F.abs(number(v, k)).cast("variant"))
        if name == "str":
            return F.when(k == "absent", "MISSING").when(k == "null", "None").when(k == "bool", F.when(F.try_variant_get(v, "$", "boolean"), "True").otherwise("False")).when(k == "int", whole(v, k).cast("string")).when(k.isin("float", "str"), F.try_variant_get(v, "$", "string")).cast("variant")
        plain = F.replace(F.trim(text(v, k)), F.lit("_"), F.lit(""))
        if name == "int":
            return as_whole(F.when(k.isin("bool", "int"), whole(v, k)).when(k == "float", F.when(number(v, k) < 0, F.ceil(number(v, k))).otherwise(F.floor(number(v, k))).try_cast("decimal(38,0)")).when(F.regexp_like(F.trim(text(v, k)), F.lit(r"^[+-]?\d+(_\d+)*$")), plain.try_cast("decimal(38,0)")))
        return F.when(k.isin(*NUMBERS), number(v, k)).when(F.regexp_like(F.trim(text(v, k)), F.lit(r"(?i)^[+-]?(\d+(_\d+)*(\.\d*)?|\.\d+)(e[+-]?\d+)?$|^[+-]?(inf|infinity|nan)$")), plain.try_cast("double")).cast("variant")

    return bind(of, v, kind(v))


@dataclass
class Value:
    """A VARIANT column, or a truth that none has asked for as a value; items of a list that is written out."""

    col: Column | None = None
    test: Column | None = None
    items: list[Value] | None = None

    @property
    def value(self) -> Column:
        return self.col if self.col is not None else self.test.cast("variant")

    @property
    def truth(self) -> Column:
        return self.test if self.test is not None else truth_of(self.col)


class ExactCompiler:
    def __init__(self, record: Column):
        self.record = record

    def visit(self, n: ast.expr) -> Value:
        return getattr(self, "on_" + type(n).__name__.lower())(n)

    def literal(self, v) -> Value:
        if v is None:
            return Value(null())
        if not isinstance(v, (bool, int, float, str)):
            raise ExpressionError(f"literal {v!r} is not allowed")
        big = isinstance(v, int) and not -(2**63) <= v < 2**63
        return Value(F.parse_json(F.lit(str(v))) if big else F.lit(v).cast("variant"))

    def on_constant(self, n):
        return self.literal(n.value)

    def on_name(self, n):
        at = get(self.record, n.id)
        return Value(F.coalesce(at, self.literal(ALIASES[n.id]).col) if n.id in ALIASES else at)

    def on_attribute(self, n):
        return Value(get(self.visit(n.value).value, n.attr))

    def on_subscript(self, n):
        if isinstance(n.slice, ast.Slice):
            raise ExpressionError("slices are not allowed")
        return Value(item(self.visit(n.value).value, self.visit(n.slice).value))

    def _list(self, n):
        found = [self.visit(x) for x in n.elts]
        return Value(F.array(*[F.coalesce(x.value, null()) for x in found]).cast("array<variant>").cast("variant"), items=found)

    on_list = on_tuple = on_set = _list

    def on_boolop(self, n):
        out = self.visit(n.values[0])
        for x in n.values[1:]:
            a, b, both = out, self.visit(x), isinstance(n.op, ast.And)
            test = a.truth & b.truth if both else a.truth | b.truth
            out = Value(F.when(a.truth, b.value).otherwise(a.value) if both else F.when(a.truth, a.value).otherwise(b.value), test)
        return out

    def on_unaryop(self, n):
        v = self.visit(n.operand)
        if isinstance(n.op, ast.Not):
            return Value(test=~v.truth)
        if isinstance(n.operand, ast.Constant) and isinstance(n.operand.value, (int, float)):
            return self.literal(-n.operand.value if isinstance(n.op, ast.USub) else +n.operand.value)
        return Value(arithmetic(ast.Sub if isinstance(n.op, ast.USub) else ast.Add, self.literal(0).col, v.value))

    def on_binop(self, n):
        return Value(arithmetic(type(n.op), self.visit(n.left).value, self.visit(n.right).value))

    def on_compare(self, n):
        parts, out = [self.visit(x) for x in (n.left, *n.comparators)], F.lit(True)
        for a, op, b in zip(parts, n.ops, parts[1:]):
            out = out & self.pair(a, op, b)
        return Value(test=out)

    def pair(self, a: Value, op: ast.cmpop, b: Value) -> Column:
        negate = isinstance(op, (ast.NotEq, ast.IsNot, ast.NotIn))
        if isinstance(op, (ast.Eq, ast.NotEq, ast.Is, ast.IsNot)):
            hit = same(a.value, b.value)
            hit = hit & kind(a.value).eqNullSafe(kind(b.value)) if isinstance(op, (ast.Is, ast.IsNot)) else hit
            return ~hit if negate else hit
        if isinstance(op, (ast.In, ast.NotIn)):
            if b.items is None:
                return within(a.value, b.value, negate)
            hit = F.lit(False)
            for x in b.items:
                hit = hit | same(a.value, x.value)
            return ~hit if negate else hit
        return ordered(a.value, b.value, {ast.Lt: lambda x, y: x < y, ast.LtE: lambda x, y: x <= y, ast.Gt: lambda x, y: x > y, ast.GtE: lambda x, y: x >= y}[type(op)])

    def on_call(self, n):
        v = self.visit(n.args[0])
        return Value(test=v.truth) if n.func.id == "bool" else Value(called(n.func.id, v.value))


def compile_exact(expression: str, record: Column | str = "record") -> Column:
    """The expression's truth over a VARIANT record, as a boolean Column that is never NULL."""
    return ExactCompiler(F.col(record) if isinstance(record, str) else record).visit(parse(expression)).truth


def scan_records(spark: SparkSession, spec: str | list[str]) -> DataFrame:
    """JSON lines as one VARIANT column, record; blank lines are none. A line that is no JSON raises when it is read."""
    lines = spark.read.text(S.resolve(spark, spec)).where(F.trim("value") != "")
    return lines.select(F.parse_json("value").alias("record"))


def as_records(df: DataFrame) -> DataFrame:
    """Typed rows as records: null columns are absent fields."""
    return df.select(F.parse_json(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]))).alias("record"))


def write_records(df: DataFrame, path: str, record: str = "record") -> None:
    df.select(F.to_json(F.col(record)).alias("value")).write.text(path)
