"""A small, safe expression language over records, compiled to Columns.

An expression is parsed by Python's own parser, checked against an allow-list, and turned into one Column against the
schema of a frame, so Catalyst can push it down. SQL NULL stands for an absent field. Truth is two-valued: comparisons
of unlike or absent values are false (!= is true), and nothing but arithmetic on absent values, or a division by zero,
raises.
"""

from __future__ import annotations

import ast
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


class ExpressionError(ValueError):
    """The expression is not valid; raised when it is compiled."""


ALIASES = {"true": True, "false": False, "null": None, "none": None}
CALLS = ("len", "abs", "str", "int", "float", "bool")
_NODES = (ast.Expression, ast.BoolOp, ast.And, ast.Or, ast.UnaryOp, ast.Not, ast.USub, ast.UAdd, ast.BinOp, ast.Add, ast.Sub, ast.Mult, ast.Div, ast.FloorDiv, ast.Mod, ast.Compare, ast.Eq, ast.NotEq, ast.Lt, ast.LtE, ast.Gt, ast.GtE, ast.In, ast.NotIn, ast.Is, ast.IsNot, ast.Name, ast.Load, ast.Constant, ast.Attribute, ast.Subscript, ast.List, ast.Tuple, ast.Set, ast.Call)


def parse(expression: str) -> ast.expr:
    """Parse and check; the same check for every schema."""
    try:
        tree = ast.parse(expression.strip(), mode="eval")
    except (SyntaxError, ValueError, AttributeError) as e:
        raise ExpressionError(f"not an expression: {expression!r}") from e
    called = {id(n.func) for n in ast.walk(tree) if isinstance(n, ast.Call)}
    for n in ast.walk(tree):
        if not isinstance(n, _NODES):
            raise ExpressionError(f"{type(n).__name__} is not allowed in {expression!r}")
        if isinstance(n, ast.Call) and not (isinstance(n.func, ast.Name) and n.func.id in CALLS and len(n.args) == 1 and not n.keywords):
            raise ExpressionError(f"only {CALLS} of one argument can be called in {expression!r}")
        if isinstance(n, ast.Name) and id(n) not in called and n.id.startswith("__"):
            raise ExpressionError(f"name {n.id!r} is not allowed")
    return tree.body


@dataclass
class Value:
    """A column and what it holds: bool int float str list map struct none missing; mixed (a list of unlike items, whose
    truth alone counts); or choice: of two values of unlike kinds one, as a condition says."""

    col: Column
    kind: str
    type: T.DataType | None = None
    truth_col: Column | None = None
    literal: object = None
    either: tuple[Column, Value, Value] | None = None

    @property
    def truth(self) -> Column:
        """Truthiness, never NULL."""
        if self.truth_col is not None:
            return self.truth_col
        c, no = self.col, F.lit(False)
        if self.kind == "bool":
            return F.coalesce(c, no)
        if self.kind in ("int", "float"):
            return F.coalesce(c != 0, no)
        if self.kind == "str":
            return F.coalesce(c != "", no)
        if self.kind in ("list", "map"):
            return F.coalesce(F.size(c) > 0, no)
        if self.kind == "struct":
            return c.isNotNull()
        return no

    @property
    def number(self) -> Column:
        return self.col.cast("int") if self.kind == "bool" else self.col


NUMERIC = ("bool", "int", "float")


def _of(col: Column, type_: T.DataType) -> Value:
    kind = "bool" if isinstance(type_, T.BooleanType) else "int" if isinstance(type_, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)) else "float" if isinstance(type_, (T.FloatType, T.DoubleType, T.DecimalType)) else "str" if isinstance(type_, T.StringType) else "list" if isinstance(type_, T.ArrayType) else "map" if isinstance(type_, T.MapType) else "struct" if isinstance(type_, T.StructType) else "none" if isinstance(type_, T.NullType) else "str"
    return Value(col if kind != "str" or isinstance(type_, T.StringType) else col.cast("string"), kind, type_)


def choose(condition: Column, x, y):
    """x where the condition holds, else y: values, or plain columns."""
    if isinstance(x, Column):
        return F.when(condition, x).otherwise(y)
    truth = F.when(condition, x.truth).otherwise(y.truth)
    if x.kind == y.kind and x.kind not in ("mixed", "missing", "none", "choice") and x.type == y.type:
        return Value(F.when(condition, x.col).otherwise(y.col), x.kind, x.type, truth)
    return Value(F.lit(None), "choice", truth_col=truth, either=(condition, x, y))


def over(f, *values: Value):
    """f of the values; of a choice it is the choice between f of either."""
    for i, v in enumerate(values):
        if v.kind == "choice":
            condition, x, y = v.either
            return choose(condition, *(over(f, *values[:i], z, *values[i + 1 :]) for z in (x, y)))
    return f(*values)


class Compiler:
    def __init__(self, schema: T.StructType):
        self.fields = {f.name: f.dataType for f in schema.fields}

    def __call__(self, expression: str) -> Value:
        return self.visit(parse(expression))

    def visit(self, n: ast.expr) -> Value:
        return getattr(self, "on_" + type(n).__name__.lower())(n)

    def missing(self) -> Value:
        return Value(F.lit(None), "missing")

    def literal(self, v) -> Value:
        if v is None:
            return Value(F.lit(None), "none")
        for t, kind, spark in ((bool, "bool", T.BooleanType()), (int, "int", T.LongType()), (float, "float", T.DoubleType()), (str, "str", T.StringType())):
            if isinstance(v, t):
                return Value(F.lit(v).cast(spark), kind, spark, literal=v)
        raise ExpressionError(f"literal {v!r} is not allowed")

    def on_constant(self, n):
        return self.literal(n.value)

    def on_name(self, n):
        if n.id in self.fields:
            return _of(F.col(f"`{n.id}`"), self.fields[n.id])
        return self.literal(ALIASES[n.id]) if n.id in ALIASES else self.missing()

    def on_attribute(self, n):
        return over(lambda v: self.field(v, n.attr), self.visit(n.value))

    def field(self, v: Value, name: str) -> Value:
        if v.kind == "struct" and name in v.type.names:
            return _of(v.col.getField(name), v.type[name].dataType)
        if v.kind == "map" and isinstance(v.type.keyType, T.StringType):
            return _of(F.try_element_at(v.col, F.lit(name)), v.type.valueType)
        return self.missing()

    def on_subscript(self, n):
        if isinstance(n.slice, ast.Slice):
            raise ExpressionError("slices are not allowed")
        return over(self.item, self.visit(n.value), self.visit(n.slice))

    def item(self, v: Value, k: Value) -> Value:
        if v.kind in ("struct", "map") and isinstance(k.literal, str):
            return self.field(v, k.literal)
        if v.kind in ("list", "str") and k.kind in ("int", "bool"):
            i = k.number.cast("int")
            if v.kind == "list":
                return _of(F.try_element_at(v.col, F.when(i >= 0, i + 1).otherwise(i)), v.type.elementType)
            n_ = F.length(v.col)
            at = F.when(i >= 0, i).otherwise(n_ + i)
            return Value(F.when((at >= 0) & (at < n_), F.substr(v.col, at + 1, F.lit(1))), "str", T.StringType())
        if v.kind == "map" and k.kind not in ("missing", "none", "mixed"):
            return _of(F.try_element_at(v.col, k.col.cast(v.type.keyType)), v.type.valueType)
        return self.missing()

    def _list(self, n):
        items = [self.visit(x) for x in n.elts]
        kinds = {v.kind for v in items} - {"none", "missing"}
        if not items:
            return Value(F.array().cast("array<string>"), "list", T.ArrayType(T.StringType()), literal=[])
        if len(kinds) > 1 and kinds <= set(NUMERIC):
            out = Value(F.array(*[v.number.cast("double") for v in items]), "list", T.ArrayType(T.DoubleType()))
        elif len(kinds) > 1 or "choice" in kinds:
            out = Value(F.lit(True), "mixed", truth_col=F.lit(True))
        else:
            type_ = next((v.type for v in items if v.kind in kinds), T.StringType())
            out = Value(F.array(*[v.col.cast(type_) for v in items]), "list", T.ArrayType(type_))
        out.literal = items
        return out

    on_list = on_tuple = on_set = _list

    def on_boolop(self, n):
        out = self.visit(n.values[0])
        for x in n.values[1:]:
            a, b = out, self.visit(x)
            both = isinstance(n.op, ast.And)
            out = choose(a.truth, b, a) if both else choose(a.truth, a, b)
            out.truth_col = (a.truth & b.truth) if both else (a.truth | b.truth)
        return out

    def on_unaryop(self, n):
        v = self.visit(n.operand)
        if isinstance(n.op, ast.Not):
            return Value(~v.truth, "bool", T.BooleanType())
        return over(lambda x: self.signed(n, x), v)

    def signed(self, n: ast.UnaryOp, v: Value) -> Value:
        if v.kind not in NUMERIC:
            return self._type_error("unary operator")
        if isinstance(n.operand, ast.Constant):
            return self.literal(-v.literal if isinstance(n.op, ast.USub) else +v.literal)
        c = self._known(v)
        return Value(-c if isinstance(n.op, ast.USub) else c, "float" if v.kind == "float" else "int", v.type)

    def _type_error(self, what: str) -> Value:
        return Value(F.raise_error(F.lit(f"{what} on values of the wrong type")).cast("long"), "int", T.LongType())

    def _known(self, v: Value) -> Column:
        """The value, or an error where it is absent."""
        return v.number if v.literal is not None else F.when(v.col.isNull(), F.raise_error(F.lit("arithmetic on an absent value")).cast("double" if v.kind == "float" else "long")).otherwise(v.number.cast("double" if v.kind == "float" else "long"))

    def on_binop(self, n):
        return over(lambda a, b: self.arithmetic(type(n.op), a, b), self.visit(n.left), self.visit(n.right))

    def arithmetic(self, op: type, a: Value, b: Value) -> Value:
        if a.kind == b.kind == "str" and op is ast.Add:
            return Value(F.concat(a.col, b.col), "str", T.StringType())
        if op is ast.Mult and {a.kind, b.kind} <= {"str", "int", "bool"} and "str" in (a.kind, b.kind) and a.kind != b.kind:
            s, k = (a, b) if a.kind == "str" else (b, a)
            return Value(F.repeat(s.col, F.greatest(k.number.cast("int"), F.lit(0))), "str", T.StringType())
        if op is ast.Add and a.kind == b.kind == "list" and a.type == b.type:
            return Value(F.concat(a.col, b.col), "list", a.type)
        if a.kind not in NUMERIC or b.kind not in NUMERIC:
            return self._type_error("arithmetic")
        whole = "float" not in (a.kind, b.kind)
        to = "long" if whole else "double"
        x, y = self._known(a).cast(to), self._known(b).cast(to)
        if op is ast.Div:
            return Value(x.cast("double") / y.cast("double"), "float", T.DoubleType())
        # towards minus infinity; whole numbers stay whole, so none is rounded
        apart = (x % y != 0) & ((x < 0) != (y < 0))
        down = lambda: F.call_function("div", x, y) - apart.cast("long") if whole else F.floor(x / y).cast(to)
        left = lambda: F.when(apart, x % y + y).otherwise(x % y)
        col = {ast.Add: lambda: x + y, ast.Sub: lambda: x - y, ast.Mult: lambda: x * y, ast.FloorDiv: down, ast.Mod: left}[op]()
        return Value(col, "int" if whole else "float", T.LongType() if whole else T.DoubleType())

    def on_compare(self, n):
        parts = [self.visit(x) for x in (n.left, *n.comparators)]
        out = None
        for a, op, b in zip(parts, n.ops, parts[1:]):
            c = over(lambda x, y, op=op: self._pair(x, op, y), a, b)
            out = c if out is None else out & c
        return Value(out, "bool", T.BooleanType())

    def _same(self, a: Value, b: Value) -> Column:
        if "none" in (a.kind, b.kind) or "missing" in (a.kind, b.kind):
            if {a.kind, b.kind} <= {"none", "missing"}:
                return F.lit(a.kind == b.kind)
            other, mark = (a, b) if b.kind in ("none", "missing") else (b, a)
            return other.col.isNull() if other.kind != "mixed" else F.lit(False)
        if a.kind in NUMERIC and b.kind in NUMERIC:
            return a.number.eqNullSafe(b.number)
        if a.kind == b.kind and a.kind in ("str", "list", "struct"):
            return a.col.eqNullSafe(b.col) if a.kind != "struct" or a.type == b.type else F.lit(False)
        return a.col.isNull() & b.col.isNull()

    def _pair(self, a: Value, op: ast.cmpop, b: Value) -> Column:
        if isinstance(op, (ast.Is, ast.IsNot)) and a.kind != b.kind and a.kind in NUMERIC and b.kind in NUMERIC:
            return F.lit(isinstance(op, ast.IsNot))  # True is not 1, nor 1 the same as 1.0
        if isinstance(op, (ast.Eq, ast.Is)):
            return self._same(a, b)
        if isinstance(op, (ast.NotEq, ast.IsNot)):
            return ~self._same(a, b)
        if isinstance(op, (ast.In, ast.NotIn)):
            return self._in(a, b, isinstance(op, ast.NotIn))
        if not (a.kind in NUMERIC and b.kind in NUMERIC or a.kind == b.kind == "str" or a.kind == b.kind == "list" and a.type == b.type):
            return F.lit(False)
        x, y = (a.number, b.number) if a.kind in NUMERIC else (a.col, b.col)
        c = {ast.Lt: lambda: x < y, ast.LtE: lambda: x <= y, ast.Gt: lambda: x > y, ast.GtE: lambda: x >= y}[type(op)]()
        return F.coalesce(c, F.lit(False))

    def _in(self, a: Value, b: Value, negate: bool) -> Column:
        turn = lambda c: ~c if negate else c
        if isinstance(b.literal, list):
            hit = F.lit(False)
            for v in b.literal:
                hit = hit | over(self._same, a, v)
            return turn(hit)
        if b.kind == "list":
            item = lambda y: self._same(a, _of(y, b.type.elementType))
            hit = F.exists(b.col, item)
        elif b.kind == "str" and a.kind == "str":
            hit = F.contains(b.col, a.col)
        elif b.kind == "map" and a.kind not in ("missing", "none", "mixed"):
            hit = F.map_contains_key(b.col, a.col.cast(b.type.keyType))
        elif b.kind == "struct":
            hit = F.lit(a.literal in b.type.names if isinstance(a.literal, str) else False)
        else:
            return F.lit(False)
        return F.when(b.col.isNull(), F.lit(False)).otherwise(F.coalesce(turn(hit), F.lit(False)))

    def on_call(self, n):
        return over(lambda v: self.called(n.func.id, v), self.visit(n.args[0]))

    def called(self, name: str, v: Value) -> Value:
        c, k = v.col, v.kind
        if name == "bool":
            return Value(v.truth, "bool", T.BooleanType())
        if name == "len":
            size = F.length(c) if k == "str" else F.size(c) if k in ("list", "map") else F.lit(len(v.type.names)) if k == "struct" else None
            return Value(F.when(c.isNotNull(), size.cast("long")), "int", T.LongType()) if size is not None else self.missing()
        if name == "abs":
            return Value(F.abs(v.number), "float" if k == "float" else "int", T.DoubleType() if k == "float" else T.LongType()) if k in NUMERIC else self.missing()
        if name == "str":
            text = F.when(c, "True").otherwise("False") if k == "bool" else c.cast("string") if k in ("int", "float", "str") else None
            if k in ("none", "missing"):
                return self.literal("None" if k == "none" else "MISSING")
            return Value(F.when(c.isNull(), F.lit("None")).otherwise(text), "str", T.StringType()) if text is not None else self.missing()
        to = "long" if name == "int" else "double"
        kind, type_ = ("int", T.LongType()) if name == "int" else ("float", T.DoubleType())
        if k in NUMERIC:
            return Value(v.number.try_cast(to), kind, type_)
        if k == "str":
            trimmed = F.trim(c)
            ok = trimmed.rlike(r"^[+-]?\d+(_?\d+)*$") if name == "int" else trimmed.rlike(r"(?i)^[+-]?(\d+(\.\d*)?|\.\d+)(e[+-]?\d+)?$|^[+-]?(inf|infinity|nan)$")
            return Value(F.when(ok, F.replace(trimmed, F.lit("_"), F.lit("")).try_cast(to)), kind, type_)
        return self.missing()


def compile_expression(expression: str, schema: T.StructType) -> Column:
    """The expression's truth as a boolean Column that is never NULL."""
    return Compiler(schema)(expression).truth


def filter_by(df: DataFrame, expression: str) -> DataFrame:
    return df.filter(compile_expression(expression, df.schema))
