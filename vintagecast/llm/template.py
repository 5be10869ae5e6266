"""A small sandboxed template language, compiled to Python closures.

    {{ expr }}   {# note #}   {% set x = expr %}
    {% if expr %} ... {% elif expr %} ... {% else %} ... {% endif %}
    {% for x in expr %} ... {% endfor %}          (loop.index, .index0, .first, .last, .length)
    {% generation %} ... {% endgeneration %}      marks what a model is to learn

Expressions: strings, integers, true, false, none, names, ``a.b`` and ``a[b]``
(entries of dicts and lists only), ``+ - ~ == != < <= > >= in not and or``,
``a if c else b``, ``x is defined``, ``x | filter(args)``.  There are no
calls, no attributes of Python objects and no way to grow a value without
growing the input, so a template can only read what it is given.

``compile_template`` parses to a syntax tree, folds constants (also whole
branches) and generates one closure for each remaining node.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Any


class TemplateError(ValueError):
    pass


@dataclass(frozen=True)
class Text:
    value: str


@dataclass(frozen=True)
class Const:
    value: Any


@dataclass(frozen=True)
class Name:
    name: str


@dataclass(frozen=True)
class Op:
    kind: str
    args: tuple


@dataclass(frozen=True)
class Print:
    expr: Any


@dataclass(frozen=True)
class Assign:
    name: str
    expr: Any


@dataclass(frozen=True)
class If:
    cond: Any
    then: tuple
    other: tuple


@dataclass(frozen=True)
class For:
    name: str
    over: Any
    body: tuple


@dataclass(frozen=True)
class Generation:
    body: tuple


UNDEFINED = type("Undefined", (), {"__bool__": lambda s: False, "__repr__": lambda s: "undefined"})()
MOST_NESTED = 40


def as_text(v: Any) -> str:
    if v is None or v is UNDEFINED:
        return ""
    if isinstance(v, bool):
        return "true" if v else "false"
    if isinstance(v, (str, int)):
        return str(v)
    raise TemplateError(f"can't print a {type(v).__name__}")


def _get(v: Any, key: Any) -> Any:
    if isinstance(v, dict):
        return v.get(key, UNDEFINED)
    if isinstance(v, (list, tuple)) and isinstance(key, int) and not isinstance(key, bool):
        return v[key] if -len(v) <= key < len(v) else UNDEFINED
    return UNDEFINED


def _same(f: Callable[[Any, Any], Any]) -> Callable[[Any, Any], Any]:
    def checked(a: Any, b: Any) -> Any:
        if isinstance(a, str) is not isinstance(b, str) or not isinstance(a, (str, int)) or not isinstance(b, (str, int)):
            raise TemplateError("operands must be two texts or two numbers")
        return f(a, b)

    return checked


def _minus(a: Any, b: Any) -> int:
    if not isinstance(a, int) or not isinstance(b, int):
        raise TemplateError("- needs numbers")
    return a - b


BINARY: dict[str, Callable[[Any, Any], Any]] = {
    "+": _same(lambda a, b: a + b), "-": _minus, "~": lambda a, b: as_text(a) + as_text(b),
    "==": lambda a, b: a == b, "!=": lambda a, b: a != b,
    "<": _same(lambda a, b: a < b), "<=": _same(lambda a, b: a <= b), ">": _same(lambda a, b: a > b), ">=": _same(lambda a, b: a >= b),
    "in": lambda a, b: a in b if isinstance(b, (str, list, tuple, dict)) and (not isinstance(b, str) or isinstance(a, str)) else False,
    "get": _get,
}
FILTERS: dict[str, Callable[..., Any]] = {
    "trim": lambda v: as_text(v).strip(),
    "upper": lambda v: as_text(v).upper(),
    "lower": lambda v: as_text(v).lower(),
    "length": lambda v: len(v) if isinstance(v, (str, list, tuple, dict)) else 0,
    "default": lambda v, d="": d if v is UNDEFINED or v is None else v,
}

_TOKEN = re.compile(r"""\s*(?:(?P<str>'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*")|(?P<int>\d+)|(?P<name>[A-Za-z_]\w*)|(?P<op>==|!=|<=|>=|[-+~<>|().,\[\]=]))""", re.S)
_PART = re.compile(r"\{\{(.*?)\}\}|\{%(.*?)%\}|\{#.*?#\}", re.S)
_ESCAPES = {"n": "\n", "t": "\t", "r": "\r"}


def _tokens(source: str) -> list[tuple[str, Any]]:
    out, at, source = [], 0, source.rstrip()
    while at < len(source):
        m = _TOKEN.match(source, at)
        if not m:
            raise TemplateError(f"can't read {source[at:at + 20]!r}")
        kind, at = m.lastgroup, m.end()
        raw = m[kind]
        if kind == "str":
            raw = re.sub(r"\\(.)", lambda x: _ESCAPES.get(x[1], x[1]), raw[1:-1], flags=re.S)
        out.append((kind, int(raw) if kind == "int" else raw))
    return out


class _Expression:
    """Recursive descent over one expression's tokens."""

    def __init__(self, tokens: list[tuple[str, Any]], filters: dict):
        self.tokens, self.at, self.filters, self.depth = tokens, 0, filters, 0

    def peek(self, *values: str) -> bool:
        return self.at < len(self.tokens) and self.tokens[self.at][0] in ("op", "name") and self.tokens[self.at][1] in values

    def take(self, *values: str) -> bool:
        if self.peek(*values):
            self.at += 1
            return True
        return False

    def need(self, value: str) -> None:
        if not self.take(value):
            raise TemplateError(f"{value!r} expected")

    def next(self, kind: str) -> Any:
        if self.at >= len(self.tokens) or self.tokens[self.at][0] != kind:
            raise TemplateError(f"{kind} expected")
        self.at += 1
        return self.tokens[self.at - 1][1]

    def whole(self) -> Any:
        e = self.choice()
        if self.at < len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at][1]!r}")
        return e

    def choice(self) -> Any:
        self.depth += 1
        if self.depth > MOST_NESTED:
            raise TemplateError("nested too deep")
        e = self.disjunction()
        if self.take("if"):
            cond = self.disjunction()
            self.need("else")
            e = Op("choose", (cond, e, self.choice()))
        self.depth -= 1
        return e

    def disjunction(self) -> Any:
        e = self.conjunction()
        while self.take("or"):
            e = Op("or", (e, self.conjunction()))
        return e

    def conjunction(self) -> Any:
        e = self.negation()
        while self.take("and"):
            e = Op("and", (e, self.negation()))
        return e

    def negation(self) -> Any:
        odd = False
        while self.take("not"):
            odd = not odd
        e = self.comparison()
        return Op("not", (e,)) if odd else e

    def comparison(self) -> Any:
        e = self.sum()
        while self.peek("==", "!=", "<", "<=", ">", ">=", "in", "is", "not"):
            op = self.next(self.tokens[self.at][0])
            if op == "is":
                odd = self.take("not")
                self.need("defined")
                e = Op("defined", (e,))
                e = Op("not", (e,)) if odd else e
            elif op == "not":
                self.need("in")
                e = Op("not", (Op("in", (e, self.sum())),))
            else:
                e = Op(op, (e, self.sum()))
        return e

    def sum(self) -> Any:
        e = self.postfix()
        while self.peek("+", "-", "~"):
            e = Op(self.next("op"), (e, self.postfix()))
        return e

    def postfix(self) -> Any:
        e = self.atom()
        while True:
            if self.take("."):
                e = Op("get", (e, Const(self.next("name"))))
            elif self.take("["):
                e = Op("get", (e, self.choice()))
                self.need("]")
            elif self.take("|"):
                name, args = self.next("name"), []
                if name not in self.filters:
                    raise TemplateError(f"no filter {name!r}")
                if self.take("("):
                    while not self.take(")"):
                        args.append(self.choice())
                        if not self.peek(")"):
                            self.need(",")
                e = Op("filter", (Const(name), e, *args))
            else:
                return e

    def atom(self) -> Any:
        if self.take("("):
            e = self.choice()
            self.need(")")
            return e
        if self.take("-"):
            return Op("-", (Const(0), self.postfix()))
        if self.at >= len(self.tokens):
            raise TemplateError("expression expected")
        kind, value = self.tokens[self.at]
        self.at += 1
        if kind in ("str", "int"):
            return Const(value)
        if kind == "name":
            return Const({"true": True, "false": False, "none": None}[value.lower()]) if value.lower() in ("true", "false", "none") else Name(value)
        raise TemplateError(f"unexpected {value!r}")


def parse(source: str, filters: dict | None = None) -> tuple:
    """The syntax tree of a template: a tuple of statements."""
    filters = FILTERS | (filters or {})
    expression = lambda tokens: _Expression(tokens, filters).whole()
    parts: list[tuple[str, Any]] = []
    at = 0
    for m in _PART.finditer(source):
        if m.start() > at:
            parts.append(("text", source[at : m.start()]))
        if m[1] is not None:
            parts.append(("print", _tokens(m[1])))
        elif m[2] is not None:
            parts.append(("tag", _tokens(m[2])))
        at = m.end()
    if at < len(source):
        parts.append(("text", source[at:]))
    if any(kind == "text" and re.search(r"\{[{%#]", value) for kind, value in parts):
        raise TemplateError("a tag isn't closed")
    place = 0

    def block(ends: tuple[str, ...], depth: int) -> tuple[tuple, str, list]:
        nonlocal place
        if depth > MOST_NESTED:
            raise TemplateError("nested too deep")
        out = []
        while place < len(parts):
            kind, value = parts[place]
            place += 1
            if kind == "text":
                out.append(Text(value))
                continue
            if kind == "print":
                out.append(Print(expression(value)))
                continue
            word, rest = (value[0][1] if value else ""), value[1:]
            if word in ends:
                return tuple(out), word, rest
            if word == "set" and len(rest) > 2 and rest[0][0] == "name" and rest[1] == ("op", "="):
                out.append(Assign(rest[0][1], expression(rest[2:])))
            elif word == "for" and len(rest) > 2 and rest[0][0] == "name" and rest[1] == ("name", "in"):
                body, _, _ = block(("endfor",), depth + 1)
                out.append(For(rest[0][1], expression(rest[2:]), body))
            elif word == "generation" and not rest:
                out.append(Generation(block(("endgeneration",), depth + 1)[0]))
            elif word == "if":
                out.append(branches(rest, depth + 1))
            else:
                raise TemplateError(f"unexpected tag {word!r}")
        if ends:
            raise TemplateError(f"{' or '.join(ends)} expected")
        return tuple(out), "", []

    def branches(cond: list, depth: int) -> If:
        test = expression(cond)
        then, end, rest = block(("elif", "else", "endif"), depth)
        if end == "elif":
            return If(test, then, (branches(rest, depth + 1),))
        return If(test, then, block(("endif",), depth)[0] if end == "else" else ())

    return block((), 0)[0]


def fold(node: Any, filters: dict | None = None) -> Any:
    """Constants computed once: expressions over constants, branches whose
    condition is known, neighbouring texts."""
    filters = FILTERS | (filters or {})
    if isinstance(node, tuple):
        out: list = []
        for x in (fold(n, filters) for n in node):
            for y in x if isinstance(x, tuple) else (x,):
                if isinstance(y, Text) and out and isinstance(out[-1], Text):
                    out[-1] = Text(out[-1].value + y.value)
                elif not (isinstance(y, Text) and not y.value):
                    out.append(y)
        return tuple(out)
    if isinstance(node, Op):
        args = tuple(fold(a, filters) for a in node.args)
        first = args[0]
        if node.kind in ("and", "or") and isinstance(first, Const):
            return (args[1] if bool(first.value) == (node.kind == "and") else first)
        if node.kind == "choose" and isinstance(first, Const):
            return args[1] if first.value else args[2]
        if all(isinstance(a, Const) for a in args):
            return Const(_expr(Op(node.kind, args), filters)({}))
        return Op(node.kind, args)
    if isinstance(node, Print):
        e = fold(node.expr, filters)
        return Text(as_text(e.value)) if isinstance(e, Const) else Print(e)
    if isinstance(node, If):
        cond = fold(node.cond, filters)
        if isinstance(cond, Const):
            return fold(node.then if cond.value else node.other, filters)
        return If(cond, fold(node.then, filters), fold(node.other, filters))
    if isinstance(node, For):
        return For(node.name, fold(node.over, filters), fold(node.body, filters))
    if isinstance(node, Generation):
        return Generation(fold(node.body, filters))
    if isinstance(node, Assign):
        return Assign(node.name, fold(node.expr, filters))
    return node


def _expr(node: Any, filters: dict) -> Callable[[dict], Any]:
    if isinstance(node, Const):
        value = node.value
        return lambda scope: value
    if isinstance(node, Name):
        name = node.name
        return lambda scope: scope.get(name, UNDEFINED)
    kind = node.kind
    if kind == "filter":
        f, args = filters[node.args[0].value], [_expr(a, filters) for a in node.args[1:]]
        if len(args) == 1:
            only = args[0]
            return lambda scope: f(only(scope))
        return lambda scope: f(*[a(scope) for a in args])
    args = [_expr(a, filters) for a in node.args]
    a, b, c = (*args, None, None)[:3]
    if kind == "not":
        return lambda scope: not a(scope)
    if kind == "defined":
        return lambda scope: a(scope) is not UNDEFINED
    if kind == "and":
        return lambda scope: a(scope) and b(scope)
    if kind == "or":
        return lambda scope: a(scope) or b(scope)
    if kind == "choose":
        return lambda scope: b(scope) if a(scope) else c(scope)
    f = BINARY[kind]
    return lambda scope: f(a(scope), b(scope))


@dataclass
class Output:
    """Rendered parts, their length in code points and the marked spans."""

    parts: list[str] = field(default_factory=list)
    size: int = 0
    spans: list[tuple[int, int]] = field(default_factory=list)

    def add(self, text: str) -> None:
        self.parts.append(text)
        self.size += len(text)


def _statements(nodes: tuple, filters: dict) -> Callable[[dict, Output], None]:
    steps = [_statement(n, filters) for n in nodes]
    if len(steps) == 1:
        return steps[0]

    def run(scope: dict, out: Output) -> None:
        for step in steps:
            step(scope, out)

    return run


def _statement(node: Any, filters: dict) -> Callable[[dict, Output], None]:
    if isinstance(node, Text):
        value = node.value
        return lambda scope, out: out.add(value)
    if isinstance(node, Print):
        e = _expr(node.expr, filters)
        return lambda scope, out: out.add(as_text(e(scope)))
    if isinstance(node, Assign):
        e, name = _expr(node.expr, filters), node.name
        return lambda scope, out: scope.__setitem__(name, e(scope))
    if isinstance(node, If):
        cond, then, other = _expr(node.cond, filters), _statements(node.then, filters), _statements(node.other, filters)
        return lambda scope, out: then(scope, out) if cond(scope) else other(scope, out)
    if isinstance(node, Generation):
        body = _statements(node.body, filters)

        def generation(scope: dict, out: Output) -> None:
            start = out.size
            body(scope, out)
            if out.size > start:
                out.spans.append((start, out.size))

        return generation
    over, name, body = _expr(node.over, filters), node.name, _statements(node.body, filters)

    def loop(scope: dict, out: Output) -> None:
        items = over(scope)
        items = items if isinstance(items, (list, tuple)) else []
        n, inner = len(items), dict(scope)  # names set in a loop end with it
        for i, x in enumerate(items):
            inner[name] = x
            inner["loop"] = {"index": i + 1, "index0": i, "first": i == 0, "last": i == n - 1, "length": n}
            body(inner, out)

    return loop


def compile_template(source: str, filters: dict | None = None) -> Callable[[dict], tuple[str, list[tuple[int, int]]]]:
    """``render(values)`` -> (text, spans under generation markers, in code points)."""
    known = FILTERS | (filters or {})
    run = _statements(fold(parse(source, known), known), known)

    def render(values: dict) -> tuple[str, list[tuple[int, int]]]:
        out = Output()
        run(dict(values), out)
        return "".join(out.parts), out.spans

    return render
