"""A small template language for chat formats, compiled to Python closures.

`{{ expression }}` writes a value, `{% for x in y %}`, `{% if %}`, `{% elif %}`, `{% else %}`,
`{% set x = e %}` and `{% generation %}` ... `{% endgeneration %}` are statements, `{# #}` is a
comment; a dash next to the percent sign or brace strips the white space there. Expressions are
constants, names, fields (`message.role`, `message['role']`), comparisons, `+`, `~`, `in`, `and`,
`or`, `not`, parentheses and filters from a fixed list.

The sandbox: a template reaches only the names it is given, the fields of mappings and the items of
sequences (`messages[0]`, `messages[-1]`). There are no calls, no attributes of Python objects and no
loops but over given sequences.

A compiled template is a generator: it pulls messages one at a time and yields strings, `BEGIN` and
`END` around generated text, and `STEP` after each turn of an outermost loop. So a conversation of
any length is rendered in the memory of its longest message, if the template reads messages only
once and in order (`reads_once`); else it must be given a sequence.
"""

from __future__ import annotations

import operator
import re
from collections.abc import Callable, Iterator, Mapping, Sequence, Sized
from dataclasses import dataclass, fields, is_dataclass
from typing import Any

BEGIN, END, STEP = object(), object(), object()

_TAGS = re.compile(r"\{\{-?(.*?)-?\}\}|\{%-?(.*?)-?%\}|\{#.*?#\}", re.S)
_TOKENS = re.compile(
    r"""\s*(?:(?P<string>'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*")|(?P<number>\d+)"""
    r"""|(?P<name>[A-Za-z_]\w*)|(?P<op>==|!=|<=|>=|[-+~<>()\[\].|,=]))"""
)
_ESCAPES = {"n": "\n", "t": "\t", "r": "\r"}
_CONSTANTS = {"true": True, "false": False, "none": None, "True": True, "False": False, "None": None}
_COMPARE: dict[str, Callable[[Any, Any], Any]] = {
    "==": operator.eq, "!=": operator.ne, "<": operator.lt, ">": operator.gt,
    "<=": operator.le, ">=": operator.ge, "in": lambda a, b: a in b,
}


class TemplateError(ValueError):
    pass


@dataclass(frozen=True)
class Const:
    value: Any


@dataclass(frozen=True)
class Name:
    name: str


@dataclass(frozen=True)
class Apply:
    """A pure function of its arguments; folded if all of them are constants."""

    function: Callable
    args: tuple


@dataclass(frozen=True)
class Choice:
    """`and` and `or`: the second operand counts only if the first one leaves it open."""

    stop: bool
    first: Any
    second: Any


@dataclass(frozen=True)
class Write:
    value: Any


@dataclass(frozen=True)
class Assign:
    name: str
    value: Any


@dataclass(frozen=True)
class If:
    branches: tuple  # (condition, statements)


@dataclass(frozen=True)
class For:
    name: str
    over: Any
    body: tuple


@dataclass(frozen=True)
class Generation:
    body: tuple


def text_of(value: Any) -> str:
    return "" if value is None else str(value)


def _field(value: Any, key: Any) -> Any:
    if isinstance(value, Mapping):
        return value.get(key)
    if isinstance(value, Sequence) and not isinstance(value, str) and isinstance(key, int):
        return value[key] if -len(value) <= key < len(value) else None
    return None


def _length(value: Any) -> int:
    if value is not None and not isinstance(value, Sized):
        raise TemplateError(f"{type(value).__name__} has no length")
    return 0 if value is None else len(value)


def _plus(a: Any, b: Any) -> Any:
    return a + b if isinstance(a, int) and isinstance(b, int) else text_of(a) + text_of(b)


FILTERS: dict[str, Callable[[Any], Any]] = {
    "trim": lambda v: text_of(v).strip(),
    "lower": lambda v: text_of(v).lower(),
    "upper": lambda v: text_of(v).upper(),
    "length": _length,
}


class _Expression:
    """Recursive descent over the tokens of one expression."""

    def __init__(self, source: str, filters: Mapping[str, Callable]):
        self.source, self.filters, self.tokens, at = source, filters, [], 0
        source = source.strip()
        while at < len(source):
            found = _TOKENS.match(source, at)
            if not found:
                raise TemplateError(f"cannot read {source[at:]!r}")
            self.tokens.append((found.lastgroup, found[found.lastgroup]))
            at = found.end()
        self.at = 0

    def peek(self) -> str | None:
        return self.tokens[self.at][1] if self.at < len(self.tokens) else None

    def take(self, *wanted: str) -> str | None:
        if self.at < len(self.tokens):
            kind, value = self.tokens[self.at]
            if kind != "string" and value in wanted:
                self.at += 1
                return value
        return None

    def whole(self):
        value = self.either()
        if self.at < len(self.tokens):
            raise TemplateError(f"unexpected {self.peek()!r} in {self.source!r}")
        return value

    def either(self):
        left = self.both()
        while self.take("or"):
            left = Choice(True, left, self.both())
        return left

    def both(self):
        left = self.negated()
        while self.take("and"):
            left = Choice(False, left, self.negated())
        return left

    def negated(self):
        if self.take("not"):
            return Apply(operator.not_, (self.negated(),))
        left = self.joined()
        if op := self.take(*_COMPARE):
            return Apply(_COMPARE[op], (left, self.joined()))
        return left

    def joined(self):
        left = self.filtered()
        while op := self.take("+", "~"):
            join = _plus if op == "+" else lambda a, b: text_of(a) + text_of(b)
            left = Apply(join, (left, self.filtered()))
        return left

    def filtered(self):
        value = self.primary()
        while self.take("|"):
            name = self.name()
            if name not in self.filters:
                raise TemplateError(f"no filter {name!r}")
            value = Apply(self.filters[name], (value,))
        return value

    def name(self) -> str:
        if self.at >= len(self.tokens) or self.tokens[self.at][0] != "name":
            raise TemplateError(f"a name is missing in {self.source!r}")
        self.at += 1
        return self.tokens[self.at - 1][1]

    def primary(self):
        if self.at >= len(self.tokens):
            raise TemplateError(f"a value is missing in {self.source!r}")
        if self.take("("):
            value = self.either()
            if not self.take(")"):
                raise TemplateError(f"no closing parenthesis in {self.source!r}")
        else:
            kind, token = self.tokens[self.at]
            self.at += 1
            if kind == "string":
                value = Const(re.sub(r"\\(.)", lambda m: _ESCAPES.get(m[1], m[1]), token[1:-1], flags=re.S))
            elif kind == "number":
                value = Const(int(token))
            elif token == "-" and self.at < len(self.tokens) and self.tokens[self.at][0] == "number":
                value = Const(-int(self.tokens[self.at][1]))
                self.at += 1
            elif kind == "name":
                value = Const(_CONSTANTS[token]) if token in _CONSTANTS else Name(token)
            else:
                raise TemplateError(f"unexpected {token!r} in {self.source!r}")
        while op := self.take(".", "["):
            key = Const(self.name()) if op == "." else self.either()
            if op == "[" and not self.take("]"):
                raise TemplateError(f"no closing bracket in {self.source!r}")
            value = Apply(_field, (value, key))
        return value


def parse(source: str, filters: Mapping[str, Callable]) -> tuple:
    """The syntax tree: a tuple of statements."""
    parts: list[tuple[str, str]] = []
    at, strip_next = 0, False
    for tag in _TAGS.finditer(source):
        literal = source[at : tag.start()]
        if strip_next:
            literal = literal.lstrip()
        if tag[0][2] == "-":
            literal = literal.rstrip()
        parts.append(("text", literal))
        if tag[1] is not None:
            parts.append(("value", tag[1]))
        elif tag[2] is not None:
            parts.append(("tag", tag[2].strip()))
        strip_next, at = tag[0][-3] == "-", tag.end()
    parts.append(("text", source[at:].lstrip() if strip_next else source[at:]))
    body, rest, end = _block(parts, filters, ())
    if rest or end:
        raise TemplateError(f"unexpected {end!r}")
    return body


def _block(parts, filters, ends):
    """Statements up to a tag that begins with one of `ends`; what follows; that tag."""
    out = []
    while parts:
        (kind, body), parts = parts[0], parts[1:]
        if kind == "text":
            if body:
                out.append(Write(Const(body)))
            continue
        if kind == "value":
            out.append(Write(_Expression(body, filters).whole()))
            continue
        word, _, rest = body.partition(" ")
        if word in ends:
            return tuple(out), parts, body
        if word == "for":
            match = re.fullmatch(r"\s*([A-Za-z_]\w*)\s+in\s+(.+)", rest, re.S)
            if not match:
                raise TemplateError(f"cannot read {body!r}")
            inner, parts, _ = _closed(parts, filters, ("endfor",), body)
            out.append(For(match[1], _Expression(match[2], filters).whole(), inner))
        elif word == "if":
            branches, condition, end = [], _Expression(rest, filters).whole(), "if"
            while not end.startswith("endif"):
                inner, parts, end = _closed(parts, filters, ("elif", "else", "endif"), body)
                branches.append((condition, inner))
                if end.startswith("elif"):
                    condition = _Expression(end[4:], filters).whole()
                elif end.startswith("else"):
                    condition = Const(True)
            out.append(If(tuple(branches)))
        elif word == "generation":
            inner, parts, _ = _closed(parts, filters, ("endgeneration",), body)
            out.append(Generation(inner))
        elif word == "set":
            name, equals, value = rest.partition("=")
            if not equals or not name.strip().isidentifier():
                raise TemplateError(f"cannot read {body!r}")
            out.append(Assign(name.strip(), _Expression(value, filters).whole()))
        else:
            raise TemplateError(f"unknown statement {body!r}")
    return tuple(out), [], ""


def _closed(parts, filters, ends, opened):
    body, rest, end = _block(parts, filters, ends)
    if not end:
        raise TemplateError(f"{opened!r} is not closed")
    return body, rest, end


def fold(node):
    """The same tree with constant expressions computed, branches that can never run left out and
    neighbouring literals joined."""
    if isinstance(node, tuple):
        out: list = []
        for item in map(fold, node):
            if isinstance(item, tuple):  # the body of an `if` that always runs
                out.extend(item)
            else:
                out.append(item)
        joined: list = []
        for item in out:
            last = joined[-1] if joined else None
            if _literal(item) and _literal(last):
                joined[-1] = Write(Const(text_of(last.value.value) + text_of(item.value.value)))
            else:
                joined.append(item)
        return tuple(joined)
    if isinstance(node, Apply):
        args = tuple(map(fold, node.args))
        if all(isinstance(a, Const) for a in args):
            return Const(node.function(*(a.value for a in args)))
        return Apply(node.function, args)
    if isinstance(node, Choice):
        first, second = fold(node.first), fold(node.second)
        if isinstance(first, Const):
            return first if bool(first.value) == node.stop else second
        return Choice(node.stop, first, second)
    if isinstance(node, Write):
        return Write(fold(node.value))
    if isinstance(node, Assign):
        return Assign(node.name, fold(node.value))
    if isinstance(node, Generation):
        return Generation(fold(node.body))
    if isinstance(node, For):
        return For(node.name, fold(node.over), fold(node.body))
    if isinstance(node, If):
        branches = []
        for condition, body in node.branches:
            condition = fold(condition)
            if isinstance(condition, Const) and not condition.value:
                continue
            branches.append((condition, fold(body)))
            if isinstance(condition, Const):
                break
        if not branches:
            return ()
        if isinstance(branches[0][0], Const):
            return branches[0][1]
        return If(tuple(branches))
    return node


def _literal(node) -> bool:
    return isinstance(node, Write) and isinstance(node.value, Const)


def _value(node) -> Callable[[dict], Any]:
    if isinstance(node, Const):
        constant = node.value
        return lambda env: constant
    if isinstance(node, Name):
        name = node.name
        return lambda env: env.get(name)
    if isinstance(node, Choice):
        stop, first, second = node.stop, _value(node.first), _value(node.second)
        return lambda env: a if bool(a := first(env)) == stop else second(env)
    function, args = node.function, [_value(a) for a in node.args]
    if len(args) == 1:
        (only,) = args
        return lambda env: function(only(env))
    left, right = args
    return lambda env: function(left(env), right(env))


def _run(nodes: tuple, outermost: bool) -> Callable[[dict], Iterator]:
    """One generator function for a sequence of statements."""
    steps = [_statement(node, outermost) for node in nodes]

    def run(env: dict) -> Iterator:
        for step in steps:
            yield from step(env)

    return run


def _statement(node, outermost: bool) -> Callable[[dict], Iterator]:
    if isinstance(node, Write):
        value = _value(node.value)

        def write(env):
            yield text_of(value(env))

        return write
    if isinstance(node, Assign):
        name, value = node.name, _value(node.value)

        def assign(env):
            env[name] = value(env)
            return iter(())

        return assign
    if isinstance(node, Generation):
        body = _run(node.body, False)

        def generation(env):
            yield BEGIN
            yield from body(env)
            yield END

        return generation
    if isinstance(node, If):
        branches = [(_value(condition), _run(body, False)) for condition, body in node.branches]

        def choose(env):
            for condition, body in branches:
                if condition(env):
                    yield from body(env)
                    return

        return choose
    name, over, body = node.name, _value(node.over), _run(node.body, False)

    def loop(env):
        items = iter(over(env) or ())
        missing = object()
        before, now, index = None, next(items, missing), 0
        while now is not missing:
            after = next(items, missing)
            state = {
                "index0": index, "index": index + 1, "first": index == 0,
                "last": after is missing, "previtem": before,
            }
            yield from body(env | {name: now, "loop": state})
            if outermost:
                yield STEP
            before, now, index = now, after, index + 1

    return loop


def compile_template(
    source: str, filters: Mapping[str, Callable[[Any], Any]] | None = None
) -> Callable[..., Iterator]:
    """A function of the template's names that renders it; `filters` extend the fixed list."""
    run = _run(fold(parse(source, FILTERS | dict(filters or {}))), True)
    return lambda **names: run(dict(names))


def reads_once(
    source: str, name: str, filters: Mapping[str, Callable[[Any], Any]] | None = None
) -> bool:
    """Whether the template reads `name` by one loop that runs once, and in no other way."""
    uses, loops = _reads(fold(parse(source, FILTERS | dict(filters or {}))), name, False)
    return uses == loops <= 1


def _reads(node, name: str, inside: bool) -> tuple[int, int]:
    """How often a name is read below a node, and how often of that by a loop over it that is not
    inside another loop."""
    if isinstance(node, Name):
        return int(node.name == name), 0
    own = int(isinstance(node, For) and node.over == Name(name) and not inside)
    if isinstance(node, tuple):
        parts = node
    elif is_dataclass(node):
        parts = tuple(getattr(node, field.name) for field in fields(node))
    else:
        return 0, 0
    below = [_reads(part, name, inside or isinstance(node, For)) for part in parts]
    return sum(uses for uses, _ in below), own + sum(loops for _, loops in below)
