"""Chat templates given as text, compiled to column expressions.

Models ship their chat format as a small template program. ``ChatTemplate.compile`` reads
one and turns it into a single native expression over a message list: loops become ``transform``
and ``array_join``, conditions ``CASE``, so rendering runs in the JVM beside the scan, without a UDF. Types
come from the schema; anything the language or the schema does not have is a ``TemplateError`` at
compile time, never at run time.

The language: ``{{ expression }}``, ``{% for x in list %}`` (also ``for k, v in map | items``), ``{% if %}`` /
``elif`` / ``else``, ``{% set x = ... %}``, ``{# comment #}``, ``-`` for white-space control; literals, names,
``a.b``, ``a['b']``, ``a[0]``, ``a[1:-1]``, ``== != < <= > >= + - % ~``, ``in``, ``not in``, ``and or not``,
``x if c else y``, ``is [not] defined | none | string | iterable | mapping``; filters and methods of ``FILTERS``; ``loop.first``,
``last``, ``index``, ``index0``, ``length``; and ``raise_exception``.
``trim_blocks`` and ``lstrip_blocks`` default to true, as chat templates expect.

Where a column cannot follow: a NULL field counts as not defined and prints as nothing; a
row that reaches ``raise_exception`` renders as NULL, to be quarantined; ``tojson`` writes no spaces and sorts keys.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as t

from chatscope.functions.text import py_strip


class TemplateError(ValueError):
    """The template uses what the language or the schema does not have."""


# ------------------------------------------------------------------ reading
_TAG = re.compile(r"\{\{-?|\{%-?|\{#")
_END = {"{{": re.compile(r"-?\}\}"), "{%": re.compile(r"-?%\}"), "{#": re.compile(r"-?#\}")}
_TOKEN = re.compile(r"""\s*(?:(?P<str>'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*")|(?P<int>\d+)|(?P<name>[A-Za-z_]\w*)|"""
                    r"""(?P<op>==|!=|<=|>=|[-+~%<>()\[\].,|:=]))""", re.S)
_ESCAPES = {"n": "\n", "t": "\t", "r": "\r", "\\": "\\", "'": "'", '"': '"'}
_WORDS = {"and", "or", "not", "in", "is", "if", "else"}


def _tokens(code: str) -> list[tuple[str, object]]:
    out, at, code = [], 0, code.rstrip()
    while at < len(code):
        m = _TOKEN.match(code, at)
        if not m:
            raise TemplateError(f"cannot read {code[at:at + 20]!r} in {code!r}")
        kind, text = m.lastgroup, m[m.lastgroup]
        if kind == "str":
            out.append(("str", re.sub(r"\\(.)", lambda e: _ESCAPES.get(e[1], e[0]), text[1:-1], flags=re.S)))
        elif kind == "int":
            out.append(("int", int(text)))
        else:
            out.append(("op", text) if kind == "op" or text in _WORDS else ("name", text))
        at = m.end()
    return [*out, ("end", "")]


def _pieces(source: str, trim_blocks: bool, lstrip_blocks: bool) -> list[tuple[str, str]]:
    """``(kind, text)`` with kind text, ``{{`` or ``{%``; white-space control is done here."""
    out: list[tuple[str, str]] = []
    at, trim_next, drop_newline = 0, False, False
    source = source.removesuffix("\n")
    while True:
        m = _TAG.search(source, at)
        text = source[at:m.start() if m else len(source)]
        if trim_next:
            text = text.lstrip()
        elif drop_newline:
            text = text.removeprefix("\n")
        if m and m[0].endswith("-"):
            text = text.rstrip()
        elif m and lstrip_blocks and m[0] != "{{":
            line = text.rpartition("\n")
            if not line[2].strip(" \t") and (line[1] or at == 0 or drop_newline and source[at:at + 1] == "\n"):
                text = line[0] + line[1]
        out.append(("text", text))
        if not m:
            return [p for p in out if p[0] != "text" or p[1]]
        kind = m[0][:2]
        end = _END[kind].search(source, m.end())
        if not end:
            raise TemplateError(f"{m[0]} is never closed")
        if kind != "{#":
            out.append((kind, source[m.end():end.start()].strip()))
        at, trim_next = end.end(), end[0].startswith("-")
        drop_newline = trim_blocks and kind != "{{"


# ------------------------------------------------------------------ expressions
@dataclass
class Value:
    """A typed column; ``NullType`` stands for what is not defined."""
    col: Column
    type: t.DataType
    literal: object = None
    fields: dict[str, Value] = field(default_factory=dict)  # of the loop variable


def _lit(x: str | int | bool | None) -> Value:
    kind = {str: t.StringType(), bool: t.BooleanType(), int: t.LongType()}.get(type(x), t.NullType())
    return Value(F.lit(x), kind, x)


def undefined() -> Value:
    return _lit(None)


def _is(v: Value, *kinds: type) -> bool:
    return isinstance(v.type, kinds)


def _truth(v: Value) -> Column:
    if _is(v, t.BooleanType):
        return F.coalesce(v.col, F.lit(False))
    if _is(v, t.StringType):
        return F.coalesce(F.length(v.col) > 0, F.lit(False))
    if _is(v, t.ArrayType, t.MapType):
        return F.coalesce(F.size(v.col) > 0, F.lit(False))
    if _is(v, t.NumericType):
        return F.coalesce(v.col != 0, F.lit(False))
    if _is(v, t.VariantType):
        # nothing, null, false, zero, and what is empty
        return ~F.coalesce(F.to_json(v.col), F.lit("null")).isin("null", "false", "0", '""', "[]", "{}")
    return F.lit(False) if _is(v, t.NullType) else v.col.isNotNull()


def _text(v: Value) -> Column:
    """What ``{{ v }}`` prints."""
    if _is(v, t.StringType):
        return F.coalesce(v.col, F.lit(""))
    if _is(v, t.IntegralType):
        return F.coalesce(v.col.cast("string"), F.lit(""))
    if _is(v, t.BooleanType):
        return F.when(v.col, "True").when(~v.col, "False").otherwise("")
    if _is(v, t.VariantType):
        return F.coalesce(F.try_variant_get(v.col, "$", "string"), F.lit(""))
    raise TemplateError("only strings, whole numbers and truth values can be printed, use tojson for "
                        + ("what is not defined" if _is(v, t.NullType) else v.type.simpleString()))


def _same(a: Value, b: Value) -> Column:
    if _is(a, t.NullType) or _is(b, t.NullType):
        other = b if _is(a, t.NullType) else a
        return F.lit(True) if _is(other, t.NullType) else other.col.isNull()
    if _is(a, t.VariantType) or _is(b, t.VariantType):
        return _text(a).eqNullSafe(_text(b))
    if (_is(a, t.NumericType), _is(a, t.StringType), _is(a, t.BooleanType)) != (
            _is(b, t.NumericType), _is(b, t.StringType), _is(b, t.BooleanType)):
        return F.lit(False)
    return a.col.eqNullSafe(b.col)


def _json(v: Value) -> Value:
    if _is(v, t.StructType, t.ArrayType, t.MapType, t.VariantType):
        out = F.to_json(v.col)
    else:  # scalars are no JSON documents for to_json: wrap and unwrap
        wrapped = F.to_json(F.array(v.col))
        out = F.substring(wrapped, F.lit(2), F.length(wrapped) - 2)
    return Value(F.coalesce(out, F.lit("null")), t.StringType())


def _string_filter(f: Callable[[Column], Column]) -> Callable:
    return lambda v: Value(f(_text(v)), t.StringType())


def _items(v: Value) -> Value:
    if _is(v, t.MapType):
        pair = t.StructType([t.StructField("key", v.type.keyType), t.StructField("value", v.type.valueType)])
        return Value(F.map_entries(v.col), t.ArrayType(pair))
    if _is(v, t.ArrayType) and _is(Value(v.col, v.type.elementType), t.StructType) and \
            v.type.elementType.names == ["key", "value"]:
        return v
    raise TemplateError(f"no items in {v.type.simpleString()}")


def _sorted_items(v: Value) -> Value:
    pairs = _items(v)
    return Value(F.array_sort(pairs.col), pairs.type)


def _length(v: Value) -> Value:
    if _is(v, t.ArrayType, t.MapType):
        return Value(F.size(v.col).cast("bigint"), t.LongType())
    return Value(F.length(_text(v)).cast("bigint"), t.LongType())


def _at(v: Value, i: int) -> Value:
    if not _is(v, t.ArrayType):
        raise TemplateError(f"{v.type.simpleString()} has no positions")
    return Value(F.try_element_at(v.col, F.lit(i + 1 if i >= 0 else i)), v.type.elementType)


def _join(v: Value, sep: Value | None = None) -> Value:
    if not _is(v, t.ArrayType):
        raise TemplateError("join needs a list")
    texts = F.transform(v.col, lambda x: _text(Value(x, v.type.elementType)))
    return Value(F.array_join(texts, "" if sep is None else sep.literal), t.StringType())


FILTERS: dict[str, Callable[..., Value]] = {
    "trim": _string_filter(py_strip), "upper": _string_filter(F.upper), "lower": _string_filter(F.lower),
    "string": _string_filter(lambda c: c), "tojson": _json, "length": _length, "count": _length, "items": _items,
    "dictsort": _sorted_items, "first": lambda v: _at(v, 0), "last": lambda v: _at(v, -1), "join": _join,
    "default": lambda v, other: other if _is(v, t.NullType) else Value(F.coalesce(v.col, other.col), v.type),
    "replace": lambda v, a, b: Value(F.replace(_text(v), a.col, b.col), t.StringType()),
}
METHODS: dict[str, Callable[..., Value]] = {
    "strip": FILTERS["trim"], "upper": FILTERS["upper"], "lower": FILTERS["lower"], "items": _items,
    "replace": FILTERS["replace"],
    "startswith": lambda v, x: Value(F.startswith(_text(v), _text(x)), t.BooleanType()),
    "endswith": lambda v, x: Value(F.endswith(_text(v), _text(x)), t.BooleanType()),
}


def _member(v: Value, name: str) -> Value:
    if name in v.fields:
        return v.fields[name]
    if _is(v, t.StructType):
        return Value(v.col[name], v.type[name].dataType) if name in v.type.names else undefined()
    if _is(v, t.MapType) and isinstance(v.type.keyType, t.StringType):
        return Value(F.try_element_at(v.col, F.lit(name)), v.type.valueType)
    if _is(v, t.VariantType):
        if not re.fullmatch(r"\w+", name):
            raise TemplateError(f"cannot look up {name!r} in JSON")
        return Value(F.try_variant_get(v.col, f"$.{name}", "variant"), t.VariantType())
    if _is(v, t.NullType):
        return undefined()
    raise TemplateError(f"{v.type.simpleString()} has no member {name!r}")


def _as_list(v: Value) -> Value:
    if _is(v, t.VariantType):
        return Value(F.coalesce(F.try_variant_get(v.col, "$", "array<variant>"), F.array().cast("array<variant>")),
                     t.ArrayType(t.VariantType()))
    if _is(v, t.NullType):
        return Value(F.array().cast("array<string>"), t.ArrayType(t.StringType()))
    if not _is(v, t.ArrayType):
        raise TemplateError(f"cannot loop over {v.type.simpleString()}")
    return Value(F.coalesce(v.col, F.array().cast(v.type)), v.type)


class _Expression:
    """Recursive descent, weakest operator first; every method returns a ``Value``."""

    def __init__(self, code: str, names: dict[str, Value]) -> None:
        self.code, self.names, self.tokens, self.at = code, names, _tokens(code), 0

    def whole(self) -> Value:
        out = self.choice()
        if self.tokens[self.at][0] != "end":
            raise TemplateError(f"cannot read {self.tokens[self.at][1]!r} in {self.code!r}")
        return out

    def take(self, *ops: str) -> str | None:
        kind, text = self.tokens[self.at]
        if kind == "op" and text in ops:
            self.at += 1
            return text
        return None

    def need(self, what: str) -> object:
        kind, text = self.tokens[self.at]
        if what not in (kind, text):
            raise TemplateError(f"{what} expected, not {text!r}, in {self.code!r}")
        self.at += 1
        return text

    def choice(self) -> Value:
        out = self.either()
        if self.take("if"):
            test = _truth(self.either())
            other = self.choice() if self.take("else") else undefined()
            out = merged([(test, out)], other)
        return out

    def either(self) -> Value:
        out = self.both()
        while self.take("or"):
            other = self.both()
            alike = type(out.type) is type(other.type) or _is(out, t.NullType) or _is(other, t.NullType)
            out = merged([(_truth(out), out)], other) if alike else Value(_truth(out) | _truth(other), t.BooleanType())
        return out

    def both(self) -> Value:
        out = self.negated()
        while self.take("and"):
            out = Value(_truth(out) & _truth(self.negated()), t.BooleanType())
        return out

    def negated(self) -> Value:
        if self.take("not"):
            return Value(~_truth(self.negated()), t.BooleanType())
        return self.compared()

    def compared(self) -> Value:
        out = self.summed()
        while True:
            if op := self.take("==", "!="):
                same = _same(out, self.summed())
                out = Value(same if op == "==" else ~same, t.BooleanType())
            elif op := self.take("<", "<=", ">", ">="):
                a, b = out, self.summed()
                if not (_is(a, t.NumericType) and _is(b, t.NumericType) or _is(a, t.StringType) and _is(b, t.StringType)):
                    raise TemplateError(f"cannot order the operands of {op} in {self.code!r}")
                test = {"<": a.col < b.col, "<=": a.col <= b.col, ">": a.col > b.col, ">=": a.col >= b.col}[op]
                out = Value(F.coalesce(test, F.lit(False)), t.BooleanType())
            elif self.take("in"):
                out = Value(self.contained(out, self.summed()), t.BooleanType())
            elif self.tokens[self.at] == ("op", "not") and self.tokens[self.at + 1] == ("op", "in"):
                self.at += 2
                out = Value(~self.contained(out, self.summed()), t.BooleanType())
            elif self.take("is"):
                flip = self.take("not")
                test = self.tested(out, str(self.need("name")))
                out = Value(~test if flip else test, t.BooleanType())
            else:
                return out

    def contained(self, x: Value, where: Value) -> Column:
        if _is(where, t.StructType, t.VariantType):
            if not isinstance(x.literal, str):
                raise TemplateError(f"only a literal can be looked up with in: {self.code!r}")
            got = _member(where, x.literal)
            return F.lit(False) if _is(got, t.NullType) else got.col.isNotNull()
        if _is(where, t.MapType):
            return F.coalesce(F.map_contains_key(where.col, x.col), F.lit(False))
        if _is(where, t.ArrayType):
            return F.coalesce(F.array_contains(where.col, x.col), F.lit(False))
        return F.contains(_text(where), _text(x))

    def tested(self, v: Value, name: str) -> Column:
        there = F.lit(False) if _is(v, t.NullType) else v.col.isNotNull()
        kinds = {"string": (t.StringType,), "iterable": (t.ArrayType, t.MapType, t.StringType),
                 "mapping": (t.MapType, t.StructType), "sequence": (t.ArrayType, t.StringType)}
        if name in ("defined", "none"):
            return there if name == "defined" else ~there
        if name not in kinds:
            raise TemplateError(f"unknown test {name!r} in {self.code!r}")
        if _is(v, t.VariantType):
            kind = F.regexp_extract(F.schema_of_variant(v.col), r"^([A-Z_]+)", 1)
            return F.coalesce(kind.isin({"string": ["STRING"], "mapping": ["OBJECT"], "sequence": ["ARRAY", "STRING"],
                                         "iterable": ["ARRAY", "OBJECT", "STRING"]}[name]), F.lit(False))
        return there & F.lit(_is(v, *kinds[name]))

    def summed(self) -> Value:
        out = self.rest()
        while op := self.take("+", "-", "~"):
            other = self.rest()
            if op == "~" or op == "+" and _is(out, t.StringType, t.VariantType):
                out = Value(F.concat(_text(out), _text(other)), t.StringType())
            elif op == "+" and _is(out, t.ArrayType) and out.type == other.type:
                out = Value(F.concat(out.col, other.col), out.type)
            else:
                out = self.computed(op, out, other)
        return out

    def rest(self) -> Value:
        out = self.signed()
        while op := self.take("%"):
            out = self.computed(op, out, self.signed())
        return out

    def computed(self, op: str, a: Value, b: Value) -> Value:
        if not (_is(a, t.IntegralType) and _is(b, t.IntegralType)):
            raise TemplateError(f"cannot compute {op} in {self.code!r}")
        return Value({"+": a.col + b.col, "-": a.col - b.col, "%": F.pmod(a.col, b.col)}[op], t.LongType())

    def signed(self) -> Value:
        if self.take("-"):
            return _lit(-int(self.need("int")))
        return self.followed(self.atom())

    def atom(self) -> Value:
        kind, text = self.tokens[self.at]
        self.at += 1
        if kind in ("str", "int"):
            return _lit(text)
        if kind == "op" and text == "(":
            out = self.choice()
            self.need(")")
            return out
        if kind != "name":
            raise TemplateError(f"cannot read {text!r} in {self.code!r}")
        if text.lower() in ("true", "false", "none"):
            return _lit({"true": True, "false": False, "none": None}[text.lower()])
        if self.tokens[self.at] == ("op", "("):
            raise TemplateError(f"unknown function {text!r} in {self.code!r}")
        return self.names.get(text, undefined())

    def arguments(self) -> list[Value]:
        out = []
        if self.take("("):
            while not self.take(")"):
                out.append(self.choice())
                if not self.take(","):
                    self.need(")")
                    break
        return out

    def apply(self, table: dict, kind: str, name: str, v: Value) -> Value:
        if name not in table:
            raise TemplateError(f"unknown {kind} {name!r} in {self.code!r}")
        args = self.arguments()
        try:
            return table[name](v, *args)
        except TypeError as e:
            raise TemplateError(f"wrong arguments of {name!r} in {self.code!r}") from e

    def followed(self, v: Value) -> Value:
        while True:
            if self.take("."):
                name = str(self.need("name"))
                v = self.apply(METHODS, "method", name, v) if self.tokens[self.at] == ("op", "(") else _member(v, name)
            elif self.take("|"):
                v = self.apply(FILTERS, "filter", str(self.need("name")), v)
            elif self.take("["):
                v = self.indexed(v)
            else:
                return v

    def whole_number(self) -> int | None:
        minus = bool(self.take("-"))
        if self.tokens[self.at][0] == "int":
            n = int(self.need("int"))
            return -n if minus else n
        return None

    def indexed(self, v: Value) -> Value:
        if self.tokens[self.at][0] == "str":
            out = _member(v, str(self.need("str")))
        else:
            first = self.whole_number()
            if self.take(":"):
                out = _sliced(v, first, self.whole_number())
            elif first is None:
                raise TemplateError(f"only literal positions and names can be looked up: {self.code!r}")
            else:
                out = _at(_as_list(v) if _is(v, t.VariantType) else v, first)
        self.need("]")
        return out


def _sliced(v: Value, first: int | None, stop: int | None) -> Value:
    """Python's slice of a list."""
    v = _as_list(v)
    n = F.size(v.col)

    def place(k: int | None, default: Column) -> Column:
        if k is None:
            return default
        return F.least(F.lit(k), n) if k >= 0 else F.greatest(n + k, F.lit(0))

    a = place(first, F.lit(0))
    return Value(F.slice(v.col, a + 1, F.greatest(place(stop, n) - a, F.lit(0))), v.type)


def merged(cases: list[tuple[Column, Value]], other: Value) -> Value:
    """The value of the first case that holds; kinds must agree, but for what is not defined."""
    values = [v for _, v in cases] + [other]
    kinds = [v for v in values if not _is(v, t.NullType)]
    if not kinds:
        return undefined()
    if len({type(v.type) for v in kinds}) > 1 or len({v.type.simpleString() for v in kinds if not _is(v, t.NumericType)}) > 1:
        raise TemplateError("a variable has different types: " + ", ".join(sorted({v.type.simpleString() for v in kinds})))
    typed = lambda v: v.col.cast(kinds[0].type) if _is(v, t.NullType) else v.col
    out = F.when(cases[0][0], typed(cases[0][1]))
    for test, v in cases[1:]:
        out = out.when(test, typed(v))
    return Value(out.otherwise(typed(other)), kinds[0].type)


# ------------------------------------------------------------------ statements
@dataclass
class _Loop:
    names: list[str]
    source: str
    body: list


@dataclass
class _Branches:
    tests: list[str]
    bodies: list[list]


@dataclass
class _Set:
    name: str
    source: str


@dataclass
class _Raise:
    pass


_FOR = re.compile(r"for\s+(\w+(?:\s*,\s*\w+)?)\s+in\s+(.+)", re.S)
_SET = re.compile(r"set\s+(\w+)\s*=(?!=)\s*(.+)", re.S)
_RAISE = re.compile(r"raise_exception\s*\(.*\)", re.S)


def _tree(pieces: list[tuple[str, str]]) -> list:
    """Statements as nested lists; strings are text, ``("print", code)`` expressions."""
    body: list = []
    open_: list[tuple[str, list]] = []  # the statement's kind and the list around it
    for kind, text in pieces:
        word = text.split(None, 1)[0] if kind == "{%" and text else ""
        if kind == "text":
            body.append(text)
        elif kind == "{{":
            body.append(_Raise() if _RAISE.fullmatch(text) else ("print", text))
        elif m := _FOR.fullmatch(text):
            if re.search(r"\bif\b(?!.*\belse\b)|\brecursive\b", m[2]):
                raise TemplateError(f"a loop cannot filter or recurse: {text!r}")
            body.append(_Loop([n.strip() for n in m[1].split(",")], m[2], []))
            open_.append(("for", body))
            body = body[-1].body
        elif word == "if":
            body.append(_Branches([text[2:]], [[]]))
            open_.append(("if", body))
            body = body[-1].bodies[-1]
        elif word in ("elif", "else") and open_ and open_[-1][0] == "if":
            node = open_[-1][1][-1]
            if len(node.tests) < len(node.bodies):
                raise TemplateError(f"{word} after else")
            if word == "elif":
                node.tests.append(text[4:])
            node.bodies.append([])
            body = node.bodies[-1]
        elif word in ("endfor", "endif") and open_ and open_[-1][0] == word[3:]:
            body = open_.pop()[1]
        elif m := _SET.fullmatch(text):
            body.append(_Set(m[1], m[2]))
        else:
            raise TemplateError(f"unknown or misplaced statement {text!r}")
    if open_:
        raise TemplateError(f"{open_[-1][0]} is never closed")
    return body


def _can_fail(body: list) -> bool:
    return any(isinstance(n, _Raise) or isinstance(n, _Loop) and _can_fail(n.body)
               or isinstance(n, _Branches) and any(map(_can_fail, n.bodies)) for n in body)


def _render(body: list, names: dict[str, Value]) -> Column:
    """The text of some statements; ``names`` changes by ``set``. NULL where an exception is raised."""
    parts: list[Column] = []
    for node in body:
        if isinstance(node, str):
            parts.append(F.lit(node))
        elif isinstance(node, tuple):
            parts.append(_text(_Expression(node[1], names).whole()))
        elif isinstance(node, _Raise):
            parts.append(F.lit(None).cast("string"))
        elif isinstance(node, _Set):
            names[node.name] = _Expression(node.source, names).whole()
        elif isinstance(node, _Loop):
            parts.append(_loop(node, names))
        else:
            parts.append(_branches(node, names))
    return F.concat(*parts) if parts else F.lit("")


def _branches(node: _Branches, names: dict[str, Value]) -> Column:
    tests, texts, scopes = [_truth(_Expression(c, names).whole()) for c in node.tests], [], []
    for body in node.bodies + ([[]] if len(node.bodies) == len(node.tests) else []):
        scopes.append(dict(names))
        texts.append(_render(body, scopes[-1]))
    out = F.when(tests[0], texts[0])
    for test, text in zip(tests[1:], texts[1:]):
        out = out.when(test, text)
    for name in {n for s in scopes for n, v in s.items() if names.get(n) is not v}:
        values = [s.get(name, undefined()) for s in scopes]
        names[name] = merged(list(zip(tests, values[:-1], strict=True)), values[-1])
    return out.otherwise(texts[-1])


def _loop(node: _Loop, names: dict[str, Value]) -> Column:
    over = _as_list(_Expression(node.source, names).whole())
    if len(node.names) == 2 and not (isinstance(over.type.elementType, t.StructType)
                                     and over.type.elementType.names == ["key", "value"]):
        raise TemplateError(f"{node.source!r} has no pairs")
    n = F.size(over.col)

    def one(x: Column, i: Column) -> Column:
        scope = dict(names)  # what the body sets ends with it
        number = lambda c: Value(c.cast("bigint"), t.LongType())
        test = lambda c: Value(c, t.BooleanType())
        scope["loop"] = Value(F.lit(None), t.NullType(), fields={
            "index": number(i + 1), "index0": number(i), "length": number(n), "first": test(i == 0), "last": test(i == n - 1)})
        item = Value(x, over.type.elementType)
        for k, name in enumerate(node.names):
            scope[name] = item if len(node.names) == 1 else _member(item, ("key", "value")[k])
        return _render(node.body, scope)

    texts = F.transform(over.col, one)
    joined = F.array_join(texts, "")  # leaves out NULLs
    return F.when(~F.exists(texts, lambda x: x.isNull()), joined) if _can_fail(node.body) else joined


# ------------------------------------------------------------------ the interface
class ChatTemplate:
    """A template program; ``render`` gives its text over typed columns."""

    def __init__(self, source: str, trim_blocks: bool = True, lstrip_blocks: bool = True) -> None:
        self.tree = _tree(_pieces(source, trim_blocks, lstrip_blocks))

    def render(self, **names: Value | str | int | bool | None) -> Column:
        return _render(self.tree, {k: v if isinstance(v, Value) else _lit(v) for k, v in names.items()})


def value(df: DataFrame, column: str) -> Value:
    return Value(F.col(column), df.schema[column].dataType)


def with_template(df: DataFrame, template: ChatTemplate | str, messages: str = "messages", tools_json: str | None = None,
                  **names: str | int | bool | Value) -> DataFrame:
    """Add ``full`` (D5), ``prompt`` (D6), ``completion``, ``prefix_ok`` (D7) and ``last_role``.

    The template sees ``messages``, ``tools`` (parsed from the JSON column ``tools_json``; not defined without it or
    for an empty list), ``add_generation_prompt`` and ``names``, e.g. ``bos_token="<s>"`` or ``value(df, "column")``. The
    prompt is the template over all messages but the last, with a generation prompt; the completion is the full
    text from the prompt's length on. Rows that raise have NULL texts and a false ``prefix_ok``.
    """
    template = ChatTemplate(template) if isinstance(template, str) else template
    msgs = value(df, messages)
    tools = undefined()
    if tools_json is not None:
        text = F.col(tools_json)
        tools = Value(F.when(~text.isin("[]", "null"), F.try_parse_json(text)), t.VariantType())
    but_last = _sliced(msgs, None, -1)
    return (df.withColumn("full", template.render(messages=msgs, tools=tools, add_generation_prompt=False, **names))
              .withColumn("prompt", template.render(messages=but_last, tools=tools, add_generation_prompt=True, **names))
              .withColumn("completion", F.expr("substring(full, length(prompt) + 1)"))
              .withColumn("prefix_ok", F.coalesce(F.startswith(F.col("full"), F.col("prompt")), F.lit(False)))
              .withColumn("last_role", F.try_element_at(F.col(messages), F.lit(-1))["role"]))
