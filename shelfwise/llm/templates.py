"""A small sandboxed template language, compiled to Python closures.

    text {{ expression }} {% for x in name %} {% if e %} {% elif e %} {% else %} {% endif %}
    {% endfor %} {% set name = e %} {% generation %} {% endgeneration %}

Expressions have strings, integers, true, false, none, names, ``a.b``, ``loop.first / last / index``,
``+ == != in``, ``and or not``, brackets, and filters ``e | name``.  There are no calls and no
attributes of Python objects: ``a.b`` only reads mappings, and filters come from a given table.
A template becomes a syntax tree, constants are folded, and every node becomes a closure that
yields ``(text, generated)`` pieces, ``generated`` inside of generation markers.  A loop reads its
messages one by one, so a conversation need not fit in memory.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from typing import Any

Piece = tuple[str, bool]
_TAGS = re.compile(r"(\{\{.*?\}\}|\{%.*?%\})", re.S)
_TOKENS = re.compile(r"""\s*(?:('(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*")|(\d+)|([A-Za-z_]\w*)|(==|!=|[.+|()]))""", re.S)
_ESCAPES = {"n": "\n", "t": "\t", "\\": "\\", "'": "'", '"': '"'}
_WORDS = {"true": True, "false": False, "none": None}


class TemplateError(ValueError):
    """A template that this language does not know."""


def _tokens(source: str) -> list[tuple[str, Any]]:
    out, at, source = [], 0, source.strip()
    while at < len(source):
        m = _TOKENS.match(source, at)
        if not m:
            raise TemplateError(f"cannot read {source[at:]!r}")
        text, number, name, sign = m.groups()
        if text is not None:
            out.append(("const", re.sub(r"\\(.)", lambda e: _ESCAPES.get(e[1], e[0]), text[1:-1], flags=re.S)))
        elif number is not None:
            out.append(("const", int(number)))
        elif name in _WORDS:
            out.append(("const", _WORDS[name]))
        else:
            out.append(("name", name) if name and name not in ("and", "or", "not", "in") else ("sign", name or sign))
        at = m.end()
    return out


class _Parser:
    """Recursive descent over the tokens of one expression; nodes are tuples."""

    def __init__(self, tokens: list[tuple[str, Any]]):
        self.tokens, self.at = tokens, 0

    def peek(self) -> tuple[str, Any]:
        return self.tokens[self.at] if self.at < len(self.tokens) else ("end", None)

    def take(self, sign: str) -> bool:
        if self.peek() == ("sign", sign):
            self.at += 1
            return True
        return False

    def name(self) -> str:
        kind, value = self.peek()
        if kind != "name":
            raise TemplateError(f"a name is missing before {value!r}")
        self.at += 1
        return value

    def whole(self) -> tuple:
        node = self.either()
        if self.peek()[0] != "end":
            raise TemplateError(f"unexpected {self.peek()[1]!r}")
        return node

    def either(self) -> tuple:
        node = self.both()
        while self.take("or"):
            node = ("or", node, self.both())
        return node

    def both(self) -> tuple:
        node = self.negated()
        while self.take("and"):
            node = ("and", node, self.negated())
        return node

    def negated(self) -> tuple:
        return ("not", self.negated()) if self.take("not") else self.compared()

    def compared(self) -> tuple:
        node = self.added()
        for sign in ("==", "!=", "in"):
            if self.take(sign):
                return (sign, node, self.added())
        return node

    def added(self) -> tuple:
        node = self.filtered()
        while self.take("+"):
            node = ("+", node, self.filtered())
        return node

    def filtered(self) -> tuple:
        node = self.single()
        while self.take("|"):
            node = ("filter", self.name(), node)
        return node

    def single(self) -> tuple:
        kind, value = self.peek()
        if self.take("("):
            node = self.either()
            if not self.take(")"):
                raise TemplateError("a bracket stays open")
        elif kind == "const":
            self.at += 1
            node = ("const", value)
        else:
            node = ("name", self.name())
        while self.take("."):
            node = ("get", node, self.name())
        return node


def parse(source: str) -> tuple:
    """The syntax tree of a template."""
    parts = _TAGS.split(source)
    at = 0

    def block(ends: tuple[str, ...]) -> tuple[list[tuple], str]:
        nonlocal at
        nodes: list[tuple] = []
        while at < len(parts):
            part = parts[at]
            at += 1
            if part.startswith("{{"):
                nodes.append(("show", _Parser(_tokens(part[2:-2])).whole()))
            elif part.startswith("{%"):
                word, _, rest = part[2:-2].strip().partition(" ")
                if word in ends:
                    return nodes, f"{word} {rest}".strip()
                nodes.append(statement(word, rest))
            elif part:
                nodes.append(("text", part))
        if ends:
            raise TemplateError(f"{' or '.join(ends)} is missing")
        return nodes, ""

    def statement(word: str, rest: str) -> tuple:
        if word == "for":
            p = _Parser(_tokens(rest))
            name = p.name()
            if not p.take("in"):
                raise TemplateError("for without in")
            return ("for", name, p.whole(), ("all", block(("endfor",))[0]))
        if word == "if":
            then, end = block(("elif", "else", "endif"))
            if end.startswith("elif"):
                other = [statement("if", end[4:])]
            else:
                other = block(("endif",))[0] if end == "else" else []
            return ("if", _Parser(_tokens(rest)).whole(), ("all", then), ("all", other))
        if word == "set":
            p = _Parser([t for t in _tokens(rest.replace("=", " == ", 1))])
            name = p.name()
            if not p.take("=="):
                raise TemplateError("set without =")
            return ("set", name, p.whole())
        if word == "generation":
            return ("generation", ("all", block(("endgeneration",))[0]))
        raise TemplateError(f"unknown statement {word!r}")

    return ("all", block(())[0])


_TWO: dict[str, Callable[[Any, Any], Any]] = {
    "==": lambda a, b: a == b,
    "!=": lambda a, b: a != b,
    "in": lambda a, b: a in b,
    "+": lambda a, b: a + b,
}


def fold(node: tuple, filters: dict[str, Callable[[str], str]]) -> tuple:
    """The same tree with constant expressions, branches and neighbouring texts put together."""
    kind = node[0]
    if kind in _TWO:
        a, b = fold(node[1], filters), fold(node[2], filters)
        return ("const", _TWO[kind](a[1], b[1])) if a[0] == b[0] == "const" else (kind, a, b)
    if kind in ("and", "or"):
        a, b = fold(node[1], filters), fold(node[2], filters)
        if a[0] == "const":
            return (b if a[1] else a) if kind == "and" else (a if a[1] else b)
        return (kind, a, b)
    if kind == "not":
        a = fold(node[1], filters)
        return ("const", not a[1]) if a[0] == "const" else ("not", a)
    if kind == "filter":
        if node[1] not in filters:
            raise TemplateError(f"unknown filter {node[1]!r}")
        a = fold(node[2], filters)
        return ("const", filters[node[1]](a[1])) if a[0] == "const" else ("filter", node[1], a)
    if kind == "get":
        return ("get", fold(node[1], filters), node[2])
    if kind == "show":
        a = fold(node[1], filters)
        return ("text", _shown(a[1])) if a[0] == "const" else ("show", a)
    if kind == "set":
        return ("set", node[1], fold(node[2], filters))
    if kind == "for":
        return ("for", node[1], fold(node[2], filters), fold(node[3], filters))
    if kind == "generation":
        return ("generation", fold(node[1], filters))
    if kind == "if":
        test, then, other = (fold(x, filters) for x in node[1:])
        return (then if test[1] else other) if test[0] == "const" else ("if", test, then, other)
    if kind == "all":
        out: list[tuple] = []
        for x in node[1]:
            x = fold(x, filters)
            for y in x[1] if x[0] == "all" else [x]:
                if y[0] == "text" and out and out[-1][0] == "text":
                    out[-1] = ("text", out[-1][1] + y[1])
                elif y != ("text", ""):
                    out.append(y)
        return ("all", out)
    return node


def _shown(value: Any) -> str:
    return "" if value is None else str(value)


def _value(node: tuple, filters: dict) -> Callable[[dict], Any]:
    kind = node[0]
    if kind == "const":
        return lambda env, v=node[1]: v
    if kind == "name":

        def read(env, name=node[1]):
            if name not in env:
                raise TemplateError(f"{name} is not set")
            return env[name]

        return read
    if kind == "get":
        of = _value(node[1], filters)

        def get(env, name=node[2]):
            got = of(env)
            if not isinstance(got, dict):
                raise TemplateError(f"{name} can only be read from a mapping")
            return got.get(name)

        return get
    if kind == "filter":
        inner, f = _value(node[2], filters), filters[node[1]]
        return lambda env: f(_shown(inner(env)))
    if kind == "not":
        inner = _value(node[1], filters)
        return lambda env: not inner(env)
    a, b = _value(node[1], filters), _value(node[2], filters)
    if kind == "and":
        return lambda env: a(env) and b(env)
    if kind == "or":
        return lambda env: a(env) or b(env)
    return lambda env, f=_TWO[kind]: f(a(env), b(env))


def _with_loop(items: Iterable) -> Iterator[tuple[Any, dict]]:
    """Items with their loop mapping; looks one item ahead."""
    items, index, none = iter(items), 0, object()
    now = next(items, none)
    while now is not none:
        after = next(items, none)
        index += 1
        yield now, {"index": index, "first": index == 1, "last": after is none}
        now = after


def _renderer(node: tuple, filters: dict) -> Callable[[dict, bool], Iterator[Piece]]:
    kind = node[0]
    if kind == "text":
        return lambda env, gen, t=node[1]: iter([(t, gen)])
    if kind == "show":
        value = _value(node[1], filters)
        return lambda env, gen: iter([(_shown(value(env)), gen)])
    if kind == "generation":
        inside = _renderer(node[1], filters)
        return lambda env, gen: inside(env, True)
    if kind == "if":
        test, then, other = _value(node[1], filters), _renderer(node[2], filters), _renderer(node[3], filters)
        return lambda env, gen: (then if test(env) else other)(env, gen)
    if kind == "set":
        value = _value(node[2], filters)

        def assign(env, gen, name=node[1]):
            env[name] = value(env)
            return iter(())

        return assign
    if kind == "for":
        items, body = _value(node[2], filters), _renderer(node[3], filters)

        def loop(env, gen, name=node[1]):
            for item, where in _with_loop(items(env)):
                yield from body(env | {name: item, "loop": where}, gen)

        return loop
    steps = [_renderer(x, filters) for x in node[1]]

    def every(env, gen):
        for step in steps:
            yield from step(env, gen)

    return every


def compile_template(source: str, filters: dict[str, Callable[[str], str]]) -> Callable[[dict], Iterator[Piece]]:
    """A function from variables to ``(text, generated)`` pieces."""
    render = _renderer(fold(parse(source), filters), filters)
    return lambda variables: render(dict(variables), False)
