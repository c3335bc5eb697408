"""Formulas written as text.

A formula item is a short script over data set calls::

    var billed = $.sum(#dataset[value(lineitem.net), where(orderkey), filter(flag=R)]);
    if (billed > 1000) { return billed / $.count(#dataset[value(lineitem.net), where(orderkey)]); }
    return #dataset[value(orders.price)] * 0.5;

``#dataset[value(set.field), where(columns), filter(column=value, ..)]`` is a
one-to-one lookup matched on columns that both sides share (``where(a=b)``
matches the target's ``a`` with the source's ``b``); a call of the target
itself is the row's own value. ``$.sum(..)`` and ``$.average(..)`` turn a call into the
sum or average of the matching rows, ``$.name(..)`` into a list reduced by
that list function. Around the calls: numbers, quoted text, arithmetic,
comparisons, ``&& || !``, ``c ? a : b``, ``Math.abs/max/min/round/floor/ceil/pow/sqrt``, ``var``,
``if``/``else`` and ``return``.

The text only decides *what* is computed. It becomes an :class:`apportion.specs.Item`
whose inputs are the calls and whose expression is a Spark Column, so
inputs are joined and shared like those of any other formula and the arithmetic runs in Spark.

Values follow the script rules that such texts are written for: an unmatched
(null) input counts as 0 in arithmetic and in ``< <= > >=``, ``x / 0`` is an
infinity and ``0 / 0`` NaN (division and remainder give doubles, so their
result columns should be doubles), ``+`` with a quoted text joins texts, 0, NaN, null and
empty text are false. A null or empty result, or none at all, keeps the old value.
A text that is one expression is its value without ``return``.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from decimal import Decimal
from typing import Any, NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

from apportion.functions.scalar import js_div
from apportion.specs import Formula, Input, Item


class FormulaTextError(ValueError):
    """A text that cannot be read; ``position`` counts characters from 0."""

    def __init__(self, message: str, text: str, position: int):
        super().__init__(f"{message} at position {position}: {text[max(0, position - 20):position]}»{text[position:position + 20]}")
        self.position = position


class Value(NamedTuple):
    """A Column and what is known of it: ``number``, ``text``, ``truth`` or ``any`` (an input)."""

    column: Column
    kind: str

    def number(self) -> Column:
        if self.kind == "text":
            return F.coalesce(self.column.try_cast("double"), F.lit(float("nan")))
        return F.coalesce(self.column.cast("int") if self.kind == "truth" else self.column, F.lit(0))

    def text(self) -> Column:
        return F.coalesce(self.column.cast("string"), F.lit("null"))

    def truth(self) -> Column:
        if self.kind == "truth":
            return F.coalesce(self.column, F.lit(False))
        if self.kind == "text":
            return F.coalesce(F.length(self.column) > 0, F.lit(False))
        number = self.number().cast("double")
        return (number != 0) & ~F.isnan(number)


Scope = Mapping[str, Value]
Expression = Callable[[Scope], Value]

_TOKEN = re.compile(
    r"(?P<skip>\s+|//[^\n]*|/\*.*?\*/)|(?P<number>(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?)|(?P<text>\"[^\"]*\"|'[^']*')"
    r"|(?P<call>\#dataset\b)|(?P<name>\$\.\w+|[A-Za-z_][\w.]*)|(?P<sign>===|!==|==|!=|<=|>=|&&|\|\||[-+*/%<>!?:(){},;=])", re.S)
_CLAUSE = re.compile(r"\s*(value|where|filter)\s*\(((?:'[^']*'|\"[^\"]*\"|[^()'\"])*)\)\s*")
_PAIR = re.compile(r"\s*(\w+)\s*=\s*('[^']*'|\"[^\"]*\"|[^,'\"]+?)\s*(?:,|$)")
_MATCH = re.compile(r"\s*(\w+)\s*(?:=\s*(\w+)\s*)?(?:,|$)")


def _pieces(pattern: re.Pattern, body: str, text: str, at: int) -> list[tuple[str, str | None]]:
    """All of ``body`` as items of ``pattern``."""
    found, here = [], 0
    while here < len(body):
        m = pattern.match(body, here)
        if not m:
            raise FormulaTextError("not a list of columns", text, at + here)
        found.append((m.group(1), m.group(2)))
        here = m.end()
    return found


def _either(test: Column, a: Value, b: Value) -> Value:
    """``a`` where ``test`` holds, else ``b``; beside another kind a truth is 0 or 1 and a number beside a text is text."""
    if a.kind != b.kind:
        a, b = (Value(v.column.cast("int"), "number") if v.kind == "truth" else v for v in (a, b))
    if {a.kind, b.kind} == {"number", "text"}:
        a, b = (Value(v.column.cast("string"), "text") for v in (a, b))
    return Value(F.when(test, a.column).otherwise(b.column), a.kind if a.kind == b.kind else "any")


def _arithmetic(sign: str, a: Value, b: Value) -> Value:
    if sign == "+":
        if "text" in (a.kind, b.kind):
            return Value(F.concat(a.text(), b.text()), "text")
        return Value(a.number() + b.number(), "number")
    x, y = a.number(), b.number()
    if sign == "-":
        return Value(x - y, "number")
    if sign == "*":
        return Value(x * y, "number")
    if sign == "/":
        return Value(js_div(x, y), "number")
    x, y = x.cast("double"), y.cast("double")
    return Value(F.when(y == 0, F.lit(float("nan"))).otherwise(x % F.nullif(y, F.lit(0.0))), "number")


def _compared(sign: str, a: Value, b: Value) -> Value:
    if sign in ("==", "===", "!=", "!=="):
        texts = "text" in (a.kind, b.kind)
        same = a.column.cast("string").eqNullSafe(b.column.cast("string")) if texts else a.column.eqNullSafe(b.column)
        return Value(same if sign[0] == "=" else ~same, "truth")
    x, y = (a.text(), b.text()) if a.kind == b.kind == "text" else (a.number(), b.number())
    return Value({"<": x < y, "<=": x <= y, ">": x > y, ">=": x >= y}[sign], "truth")


_FUNCTIONS: dict[str, Callable[..., Column]] = {
    "Math.abs": F.abs, "Math.floor": F.floor, "Math.ceil": F.ceil, "Math.sqrt": F.sqrt, "Math.pow": F.pow,
    "Math.round": lambda x: F.floor(x + F.lit(Decimal("0.5"))),
    "Math.max": lambda *x: x[0] if len(x) == 1 else F.greatest(*x), "Math.min": lambda *x: x[0] if len(x) == 1 else F.least(*x),
}
_ONE, _TWO = ("Math.abs", "Math.floor", "Math.ceil", "Math.sqrt", "Math.round"), ("Math.pow",)
_CONSTANTS = {"null": (None, "any"), "true": (True, "truth"), "false": (False, "truth"),
              "NaN": (float("nan"), "number"), "Infinity": (float("inf"), "number")}
_KINDS = {"$.sum": "sum", "$.average": "avg"}
#: Binary signs from the loosest to the tightest.
_LEVELS = (("||",), ("&&",), ("==", "!=", "===", "!=="), ("<", "<=", ">", ">="), ("+", "-"), ("*", "/", "%"))


class _Reader:
    """Reads one item's text: ``inputs`` collects its calls, ``body`` gives its statements."""

    def __init__(self, text: str):
        self.text, self.at = text, 0
        self.inputs: dict[tuple, Input] = {}
        self.names: set[str] = set()
        self._next()

    # ---- tokens
    def _next(self) -> None:
        """The next token, in ``kind`` and ``token``."""
        while True:
            self.start = self.at
            if self.at >= len(self.text):
                self.kind, self.token = "end", ""
                return
            m = _TOKEN.match(self.text, self.at)
            if not m:
                raise FormulaTextError("unexpected character", self.text, self.at)
            self.at = m.end()
            if m.lastgroup != "skip":
                self.kind, self.token = m.lastgroup, m.group()
                return

    def _is(self, *tokens: str) -> bool:
        return self.kind in ("sign", "name") and self.token in tokens

    def _take(self, token: str) -> None:
        if not self._is(token):
            raise self._error(f"expected {token!r}")
        self._next()

    def _error(self, message: str) -> FormulaTextError:
        return FormulaTextError(message, self.text, self.start)

    # ---- statements: each takes the rest as a continuation
    def body(self) -> Callable[[Scope], Value]:
        lone = not re.search(r"\b(return|var|if)\b", self.text)
        if lone and self.kind != "end":
            value = self.expression()
            if self._is(";"):
                self._next()
            if self.kind != "end":
                raise self._error("unexpected text")
            return value
        statements = []
        while self.kind != "end":
            statements.append(self._statement())
        return lambda scope: _run(statements, scope)

    def _statement(self) -> tuple:
        if self._is("{"):
            return ("block", self._block())
        if self._is(";"):
            self._next()
            return ("block", [])
        if self._is("return"):
            self._next()
            value = None if self._is(";", "}") or self.kind == "end" else self.expression()
            self._end()
            return ("return", value)
        if self._is("if"):
            self._next()
            self._take("(")
            test = self.expression()
            self._take(")")
            yes, no = [self._statement()], []
            if self._is("else"):
                self._next()
                no = [self._statement()]
            return ("if", test, yes, no)
        declared = self._is("var")
        if declared:
            self._next()
        if self.kind != "name" or "." in self.token or (not declared and self.token not in self.names):
            raise self._error("expected a statement")
        name = self.token
        self._next()
        self._take("=")
        value = self.expression()
        self._end()
        self.names.add(name)
        return ("set", name, value)

    def _block(self) -> list:
        self._take("{")
        statements = []
        while not self._is("}"):
            if self.kind == "end":
                raise self._error("expected '}'")
            statements.append(self._statement())
        self._next()
        return statements

    def _end(self) -> None:
        if self._is(";"):
            self._next()
        elif not self._is("}") and self.kind != "end":
            raise self._error("expected ';'")

    # ---- expressions
    def expression(self) -> Expression:
        test = self._binary(0)
        if not self._is("?"):
            return test
        self._next()
        yes = self.expression()
        self._take(":")
        no = self.expression()

        def choose(scope: Scope) -> Value:
            return _either(test(scope).truth(), yes(scope), no(scope))

        return choose

    def _binary(self, level: int) -> Expression:
        if level == len(_LEVELS):
            return self._unary()
        left = self._binary(level + 1)
        while self._is(*_LEVELS[level]):
            sign = self.token
            self._next()
            left = self._joined(sign, left, self._binary(level + 1))
        return left

    @staticmethod
    def _joined(sign: str, left: Expression, right: Expression) -> Expression:
        def join(scope: Scope) -> Value:
            a, b = left(scope), right(scope)
            if sign in ("&&", "||"):
                if a.kind == b.kind == "truth":
                    return Value(a.truth() & b.truth() if sign == "&&" else a.truth() | b.truth(), "truth")
                return _either(a.truth(), b, a) if sign == "&&" else _either(a.truth(), a, b)
            return _arithmetic(sign, a, b) if sign in "+-*/%" else _compared(sign, a, b)

        return join

    def _unary(self) -> Expression:
        if not self._is("-", "+", "!"):
            return self._primary()
        sign = self.token
        self._next()
        inner = self._unary()
        if sign == "!":
            return lambda scope: Value(~inner(scope).truth(), "truth")
        return lambda scope: Value(-inner(scope).number() if sign == "-" else inner(scope).number(), "number")

    def _primary(self) -> Expression:
        token, kind = self.token, self.kind
        if kind == "number":
            self._next()
            given = Decimal(token)
            literal: Any = int(given) if re.fullmatch(r"\d+", token) else given if -given.as_tuple().exponent <= 18 and abs(given) < 10**18 else float(token)
            return lambda scope: Value(F.lit(literal), "number")
        if kind == "text":
            self._next()
            return lambda scope: Value(F.lit(token[1:-1]), "text")
        if kind == "call":
            return self._call("value", None)
        if self._is("("):
            self._next()
            inner = self.expression()
            self._take(")")
            return inner
        if kind != "name":
            raise self._error("expected a value")
        if token in _CONSTANTS:
            self._next()
            return lambda scope: Value(F.lit(_CONSTANTS[token][0]), _CONSTANTS[token][1])
        if token in _FUNCTIONS:
            return self._function(token)
        if token.startswith("$."):
            self._next()
            self._take("(")
            if self.kind != "call":
                raise self._error(f"{token} takes one #dataset[..] call")
            found = self._call(_KINDS.get(token, "list"), None if token in _KINDS else token[2:])
            self._take(")")
            return found
        if token not in self.names:
            raise self._error(f"unknown name {token!r}")
        self._next()
        return lambda scope: scope[token]

    def _function(self, name: str) -> Expression:
        start = self.start
        self._next()
        self._take("(")
        given = [self.expression()]
        while self._is(","):
            self._next()
            given.append(self.expression())
        self._take(")")
        if (name in _ONE and len(given) != 1) or (name in _TWO and len(given) != 2):
            raise FormulaTextError(f"wrong number of values for {name}", self.text, start)
        return lambda scope: Value(_FUNCTIONS[name](*[g(scope).number() for g in given]), "number")

    # ---- data set calls
    def _call(self, kind: str, fn: str | None) -> Expression:
        start, text = self.start, self.text
        m = re.compile(r"\s*\[").match(text, self.at)
        if not m:
            raise FormulaTextError("expected '['", text, self.at)
        at, clauses = m.end(), {}
        while True:
            m = _CLAUSE.match(text, at)
            if not m or m.group(1) in clauses:
                raise FormulaTextError("expected value(..), where(..) or filter(..), each once", text, at)
            clauses[m.group(1)] = (m.group(2), m.start(2))
            at = m.end()
            if text[at : at + 1] not in (",", "]"):
                raise FormulaTextError("expected ',' or ']'", text, at)
            at += 1
            if text[at - 1] == "]":
                break
        if "value" not in clauses:
            raise FormulaTextError("a call needs value(set.field)", text, start)
        value = re.fullmatch(r"\s*(\w+)\.(\w+)\s*", clauses["value"][0])
        if not value:
            raise FormulaTextError("expected value(set.field)", text, clauses["value"][1])
        on = tuple((a, b or a) for a, b in _pieces(_MATCH, clauses["where"][0], text, clauses["where"][1])) if "where" in clauses else ()
        flt = tuple((c, v.strip("'\"")) for c, v in _pieces(_PAIR, clauses["filter"][0], text, clauses["filter"][1])) if "filter" in clauses else ()
        key = (value.group(1), value.group(2), kind, fn, on, flt)
        if key not in self.inputs:
            try:
                self.inputs[key] = Input(f"in{len(self.inputs) + 1}", value.group(1), value.group(2), kind, on, flt, fn=fn)
            except ValueError as wrong:
                raise FormulaTextError(str(wrong), text, start) from None
        name = self.inputs[key].name
        self.at = at
        self._next()
        return lambda scope: scope[f"${name}"]


def _run(statements: Sequence[tuple], scope: Scope) -> Value:
    """The value that the statements return; null without ``return``."""
    if not statements:
        return Value(F.lit(None), "any")
    (what, *given), rest = statements[0], list(statements[1:])
    if what == "return":
        return given[0](scope) if given[0] else Value(F.lit(None), "any")
    if what == "block":
        return _run([*given[0], *rest], scope)
    if what == "set":
        return _run(rest, {**scope, given[0]: given[1](scope)})
    test, yes, no = given
    return _either(test(scope).truth(), _run([*yes, *rest], scope), _run([*no, *rest], scope))


def item_from_text(field: str, text: str | None) -> Item:
    """The item that sets ``field`` to the value of ``text`` (empty or null text: no value, the old one stays)."""
    reader = _Reader(text or "")
    body = reader.body()

    def column(bound: Mapping[str, Column]) -> Column:
        value = body({f"${name}": Value(c, "any") for name, c in bound.items()})
        return F.nullif(value.column, F.lit("")) if value.kind == "text" else value.column

    return Item(field, column, tuple(reader.inputs.values()))


def formula_from_text(name: str, dataset: str, items: Sequence[tuple[str, str | None]], filter: Any = None) -> Formula:
    """A formula whose items are (field, text) pairs, in order."""
    made = []
    for field, text in items:
        try:
            made.append(item_from_text(field, text))
        except FormulaTextError as wrong:
            wrong.args = (f"formula {name!r}, field {field!r}: {wrong}",)
            raise
    return Formula.of(name, dataset, made, filter=filter)
