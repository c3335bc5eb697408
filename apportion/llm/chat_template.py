"""A sandboxed chat template language, compiled to Python closures.

``{{ expression }}``, ``{% for x in xs %}``, ``{% if %} / {% elif %} / {% else %}``,
``{% set x = expression %}`` and ``{% generation %}`` (what a model is trained
on). Expressions know literals, names, mapping keys, arithmetic, comparison,
``and or not in``, ``~`` and filters; they reach no Python attribute and call
nothing. A template is parsed to a syntax tree, constant parts are folded, and
each node becomes a closure that yields ``(text, generated)`` pieces, so a
loop over a stream of messages holds one message at a time.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator, Mapping
from dataclasses import dataclass
from typing import Any

Env = dict[str, Any]
#: A piece of output and whether it is generated.
Piece = tuple[str, bool]


class TemplateError(ValueError):
    """The template cannot be parsed or asks for something outside the sandbox."""


# ---- syntax tree


@dataclass(frozen=True)
class Const:
    value: Any


@dataclass(frozen=True)
class Name:
    name: str


@dataclass(frozen=True)
class Key:
    of: Any
    key: Any


@dataclass(frozen=True)
class Unary:
    op: str
    of: Any


@dataclass(frozen=True)
class Binary:
    op: str
    left: Any
    right: Any


@dataclass(frozen=True)
class Filter:
    name: str
    of: Any
    args: tuple


@dataclass(frozen=True)
class Output:
    of: Any


@dataclass(frozen=True)
class For:
    name: str
    over: Any
    body: tuple


@dataclass(frozen=True)
class If:
    test: Any
    body: tuple
    other: tuple


@dataclass(frozen=True)
class Assign:
    name: str
    of: Any


@dataclass(frozen=True)
class Generation:
    body: tuple


# ---- control strings inside texts

_OPENING = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<\\(\\*)\|")


def escape(text: str) -> str:
    """No ``<|`` is left: each ``<``, backslashes, ``|`` gets one backslash more."""
    return _OPENING.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    """The inverse of :func:`escape`."""
    return _ESCAPED.sub(r"<\1|", text)


FILTERS: dict[str, Callable[..., Any]] = {
    "escape": lambda x: escape(str(x)),
    "trim": lambda x: str(x).strip(),
    "upper": lambda x: str(x).upper(),
    "lower": lambda x: str(x).lower(),
    "length": len,
    "default": lambda x, other="": other if x is None else x,
    "replace": lambda x, old, new: str(x).replace(old, new),
}

_BINARY: dict[str, Callable[[Any, Any], Any]] = {
    "==": lambda a, b: a == b, "!=": lambda a, b: a != b, "<": lambda a, b: a < b, ">": lambda a, b: a > b,
    "<=": lambda a, b: a <= b, ">=": lambda a, b: a >= b, "in": lambda a, b: a in b, "+": lambda a, b: a + b,
    "-": lambda a, b: a - b, "*": lambda a, b: a * b, "%": lambda a, b: a % b, "~": lambda a, b: _shown(a) + _shown(b),
}
#: Binding strength of the binary operators.
_STRENGTH = {"or": 1, "and": 2, "in": 4, "==": 4, "!=": 4, "<": 4, ">": 4, "<=": 4, ">=": 4, "~": 5, "+": 6, "-": 6, "*": 7, "%": 7}
_TOKEN = re.compile(r"""\s*(?:(\d+)|("(?:[^"\\]|\\.)*"|'(?:[^'\\]|\\.)*')|([A-Za-z]\w*)|(==|!=|<=|>=|[-+*%~<>().,|\[\]=]))""")
_UNQUOTE = {"n": "\n", "t": "\t"}


def _shown(value: Any) -> str:
    return "" if value is None else value if isinstance(value, str) else str(value)


class _Expression:
    """Precedence climbing over the tokens of one expression."""

    def __init__(self, source: str) -> None:
        self.tokens: list[tuple[str, str]] = []
        at, source = 0, source.rstrip()
        while at < len(source):
            m = _TOKEN.match(source, at)
            if not m:
                raise TemplateError(f"unexpected {source[at:]!r}")
            kind = ("int", "text", "name", "op")[m.lastindex - 1]
            self.tokens.append((kind, m[m.lastindex]))
            at = m.end()
        self.at = 0

    def peek(self) -> str | None:
        return self.tokens[self.at][1] if self.at < len(self.tokens) and self.tokens[self.at][0] != "text" else None

    def take(self, wanted: str | None = None) -> tuple[str, str]:
        if self.at >= len(self.tokens) or wanted is not None and self.peek() != wanted:
            raise TemplateError(f"expected {wanted or 'a value'}")
        self.at += 1
        return self.tokens[self.at - 1]

    def whole(self) -> Any:
        node = self.binary(0)
        if self.at < len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at][1]!r}")
        return node

    def binary(self, least: int) -> Any:
        if self.peek() == "not":
            self.take()
            left: Any = Unary("not", self.binary(3))
        else:
            left = self.unary()
        while (op := self.peek()) in _STRENGTH and _STRENGTH[op] > least:
            self.take()
            left = Binary(op, left, self.binary(_STRENGTH[op]))
        return left

    def unary(self) -> Any:
        if self.peek() == "-":
            self.take()
            return Unary("-", self.unary())
        node = self.primary()
        while (op := self.peek()) in (".", "[", "|"):
            self.take()
            if op == ".":
                node = Key(node, Const(self.take()[1]))
            elif op == "[":
                node = Key(node, self.binary(0))
                self.take("]")
            else:
                name, args = self.take()[1], []
                if name not in FILTERS:
                    raise TemplateError(f"no filter {name!r}")
                if self.peek() == "(":
                    self.take()
                    while self.peek() != ")":
                        args.append(self.binary(0))
                        if self.peek() == ",":
                            self.take()
                    self.take(")")
                node = Filter(name, node, tuple(args))
        return node

    def primary(self) -> Any:
        kind, value = self.take()
        if kind == "int":
            return Const(int(value))
        if kind == "text":
            return Const(re.sub(r"\\(.)", lambda m: _UNQUOTE.get(m[1], m[1]), value[1:-1]))
        if kind == "name":
            return Const({"true": True, "false": False, "none": None}[value]) if value in ("true", "false", "none") else Name(value)
        if value == "(":
            node = self.binary(0)
            self.take(")")
            return node
        raise TemplateError(f"unexpected {value!r}")


def parse(source: str) -> tuple:
    """The syntax tree of a template."""
    parts = re.split(r"(\{%.*?%\}|\{\{.*?\}\})", source, flags=re.S)
    for i, part in enumerate(parts):  # a dash inside a tag strips the white space beside it
        if part[:3] in ("{%-", "{{-"):
            parts[i - 1] = parts[i - 1].rstrip()
        if part[-3:] in ("-%}", "-}}"):
            parts[i + 1] = parts[i + 1].lstrip()
    at = 0

    def block(ends: tuple[str, ...]) -> tuple[tuple, str]:
        nonlocal at
        nodes: list[Any] = []
        while at < len(parts):
            part = parts[at]
            at += 1
            if part.startswith("{{"):
                nodes.append(Output(_Expression(part[2:-2].strip("-")).whole()))
            elif not part.startswith("{%"):
                if part:
                    nodes.append(Output(Const(part)))
            else:
                tag = part[2:-2].strip("-").strip()
                word, _, rest = tag.partition(" ")
                if word in ends:
                    return tuple(nodes), tag
                nodes.append(statement(word, rest))
        if ends:
            raise TemplateError(f"no {ends[-1]}")
        return tuple(nodes), ""

    def statement(word: str, rest: str) -> Any:
        if word == "for":
            m = re.fullmatch(r"\s*([A-Za-z]\w*)\s+in\s+(.+)", rest, re.S)
            if not m:
                raise TemplateError(f"for {rest!r}")
            return For(m[1], _Expression(m[2]).whole(), block(("endfor",))[0])
        if word == "if":
            test = _Expression(rest).whole()
            body, end = block(("elif", "else", "endif"))
            if end.startswith("elif"):
                return If(test, body, (statement("if", end[4:]),))
            return If(test, body, block(("endif",))[0] if end == "else" else ())
        if word == "set":
            name, _, value = rest.partition("=")
            return Assign(name.strip(), _Expression(value).whole())
        if word == "generation":
            return Generation(block(("endgeneration",))[0])
        raise TemplateError(f"unknown tag {word!r}")

    return block(())[0]


# ---- constant folding


def fold(node: Any) -> Any:
    """The node with its constant parts computed; a tuple of nodes also joins neighbouring texts and picks constant branches."""
    if isinstance(node, tuple):
        out: list[Any] = []
        for x in map(fold, node):
            for y in x if isinstance(x, tuple) else (x,):
                if isinstance(y, Output) and isinstance(y.of, Const) and out and isinstance(out[-1], Output) and isinstance(out[-1].of, Const):
                    out[-1] = Output(Const(out[-1].of.value + y.of.value))
                else:
                    out.append(y)
        return tuple(x for x in out if x != Output(Const("")))
    if isinstance(node, Output):
        of = fold(node.of)
        return Output(Const(_shown(of.value)) if isinstance(of, Const) else of)
    if isinstance(node, If):
        test = fold(node.test)
        if isinstance(test, Const):
            return fold(node.body if test.value else node.other)
        return If(test, fold(node.body), fold(node.other))
    if isinstance(node, For):
        return For(node.name, fold(node.over), fold(node.body))
    if isinstance(node, Generation):
        return Generation(fold(node.body))
    if isinstance(node, Assign):
        return Assign(node.name, fold(node.of))
    if isinstance(node, Unary):
        node = Unary(node.op, fold(node.of))
        return Const(_value(node)({})) if isinstance(node.of, Const) else node
    if isinstance(node, Binary):
        node = Binary(node.op, fold(node.left), fold(node.right))
        return Const(_value(node)({})) if isinstance(node.left, Const) and isinstance(node.right, Const) else node
    if isinstance(node, Key):
        return Key(fold(node.of), fold(node.key))
    if isinstance(node, Filter):
        node = Filter(node.name, fold(node.of), tuple(map(fold, node.args)))
        return Const(_value(node)({})) if all(isinstance(x, Const) for x in (node.of, *node.args)) else node
    return node


# ---- closures


def _value(node: Any) -> Callable[[Env], Any]:
    """A closure that computes an expression."""
    if isinstance(node, Const):
        value = node.value
        return lambda env: value
    if isinstance(node, Name):
        name = node.name
        return lambda env: env.get(name)
    if isinstance(node, Key):
        of, key = _value(node.of), _value(node.key)

        def get(env: Env) -> Any:
            x, k = of(env), key(env)
            if isinstance(x, Mapping):
                return x.get(k)
            if isinstance(x, (list, tuple, str)) and isinstance(k, int):
                return x[k] if -len(x) <= k < len(x) else None
            raise TemplateError(f"no key {k!r} here")

        return get
    if isinstance(node, Unary):
        of = _value(node.of)
        return (lambda env: not of(env)) if node.op == "not" else (lambda env: -of(env))
    if isinstance(node, Filter):
        f, of, args = FILTERS[node.name], _value(node.of), [_value(x) for x in node.args]
        return lambda env: f(of(env), *(a(env) for a in args))
    left, right = _value(node.left), _value(node.right)
    if node.op == "and":
        return lambda env: left(env) and right(env)
    if node.op == "or":
        return lambda env: left(env) or right(env)
    op = _BINARY[node.op]
    return lambda env: op(left(env), right(env))


def _closure(node: Any) -> Callable[[Env, bool], Iterator[Piece]]:
    """A closure that yields a statement's output."""
    if isinstance(node, tuple):
        steps = [_closure(x) for x in node]

        def run(env: Env, generated: bool) -> Iterator[Piece]:
            for step in steps:
                yield from step(env, generated)

        return steps[0] if len(steps) == 1 else run
    if isinstance(node, Output):
        if isinstance(node.of, Const):
            text = node.of.value
            return lambda env, generated: iter(((text, generated),))
        of = _value(node.of)
        return lambda env, generated: iter(((_shown(of(env)), generated),))
    if isinstance(node, If):
        test, body, other = _value(node.test), _closure(node.body), _closure(node.other)
        return lambda env, generated: (body if test(env) else other)(env, generated)
    if isinstance(node, Generation):
        inside = _closure(node.body)
        return lambda env, generated: inside(env, True)
    if isinstance(node, Assign):
        name, of = node.name, _value(node.of)

        def assign(env: Env, generated: bool) -> Iterator[Piece]:
            env[name] = of(env)
            return iter(())

        return assign
    name, over, body = node.name, _value(node.over), _closure(node.body)

    def loop(env: Env, generated: bool) -> Iterator[Piece]:
        inner = dict(env)
        for i, x in enumerate(over(env) or ()):
            inner[name] = x
            inner["loop"] = {"index": i + 1, "index0": i, "first": i == 0}
            yield from body(inner, generated)

    return loop


def compile_template(source: str) -> Callable[[Iterable[Mapping[str, Any]]], Iterator[Piece]]:
    """A renderer ``f(messages)`` of ``(text, generated)`` pieces; ``messages`` may be any iterable and is read once."""
    run = _closure(fold(parse(source)))
    return lambda messages: run({"messages": messages}, False)
