"""A small template language: parsed to a tree, folded, and compiled to generators.

Text is copied; ``{{ expression }}`` is rendered; ``{% for x in list %}``,
``{% if c %}`` / ``{% elif c %}`` / ``{% else %}``, ``{% generation %}`` and the
matching ``{% end… %}`` tags give structure. Expressions know names, fields of
records (``message.text``), text and whole numbers, ``~`` (join as text), ``==``,
``!=``, ``and``, ``or``, ``not``, brackets and filters (``x | trim``). There are no
calls, no attributes of Python objects and no other way out of the data given, so a
template from anywhere can be rendered.

Rendering yields pairs of a chunk of text and whether a generation block holds it.
A list may be any iterator: a loop takes one element ahead, for ``loop.last``, and
keeps none, so conversations of any length are rendered in bounded memory.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator, Mapping
from dataclasses import dataclass
from typing import Any

Chunk = tuple[str, bool]
Filters = Mapping[str, Callable[[str], str]]

FILTERS: Filters = {"trim": str.strip, "upper": str.upper, "lower": str.lower}


class TemplateError(ValueError):
    """A template that cannot be parsed, or names what it was not given."""


# -- the tree ---------------------------------------------------------------------


@dataclass(frozen=True)
class Const:
    value: Any


@dataclass(frozen=True)
class Name:
    path: tuple[str, ...]


@dataclass(frozen=True)
class Operation:
    """``not``, ``and``, ``or``, ``==``, ``!=`` or ``~`` over its operands."""

    kind: str
    operands: tuple[Any, ...]


@dataclass(frozen=True)
class Filtered:
    filter: str
    operand: Any


@dataclass(frozen=True)
class Output:
    expression: Any


@dataclass(frozen=True)
class If:
    condition: Any
    then: tuple[Any, ...]
    otherwise: tuple[Any, ...]


@dataclass(frozen=True)
class For:
    name: str
    items: Any
    body: tuple[Any, ...]


@dataclass(frozen=True)
class Generation:
    body: tuple[Any, ...]


# -- parsing ----------------------------------------------------------------------

_PIECES = re.compile(r"\{\{(.*?)\}\}|\{%-?(.*?)-?%\}", re.DOTALL)
_TOKEN = re.compile(r"""\s*(?:("(?:[^"\\]|\\.)*"|'(?:[^'\\]|\\.)*')|(\d+)|([A-Za-z_]\w*)|(==|!=|[~|().]))""")
_ESCAPE = {"n": "\n", "t": "\t"}


class _Expression:
    """Recursive descent over the tokens of one expression."""

    def __init__(self, source: str):
        self.source, self.tokens, at = source.strip(), [], 0
        while at < len(self.source):
            found = _TOKEN.match(self.source, at)
            if not found:
                raise TemplateError(f"cannot read {self.source[at:]!r}")
            self.tokens.append((found.lastindex, found.group(found.lastindex)))
            at = found.end()
        self.at = 0

    def parse(self) -> Any:
        tree = self._or()
        if self.at != len(self.tokens):
            raise TemplateError(f"cannot read the end of {self.source!r}")
        return tree

    def _take(self, *texts: str) -> str | None:
        if self.at < len(self.tokens) and self.tokens[self.at][0] != 1 and self.tokens[self.at][1] in texts:
            self.at += 1
            return self.tokens[self.at - 1][1]
        return None

    def _chain(self, below: Callable[[], Any], *kinds: str) -> Any:
        tree = below()
        while kind := self._take(*kinds):
            tree = Operation(kind, (tree, below()))
        return tree

    def _or(self) -> Any:
        return self._chain(self._and, "or")

    def _and(self) -> Any:
        return self._chain(self._not, "and")

    def _not(self) -> Any:
        return Operation("not", (self._not(),)) if self._take("not") else self._compare()

    def _compare(self) -> Any:
        return self._chain(self._join, "==", "!=")

    def _join(self) -> Any:
        return self._chain(self._filtered, "~")

    def _filtered(self) -> Any:
        tree = self._atom()
        while self._take("|"):
            kind, name = self._next()
            if kind != 3:
                raise TemplateError(f"{name!r} is no filter")
            tree = Filtered(name, tree)
        return tree

    def _next(self) -> tuple[int, str]:
        if self.at == len(self.tokens):
            raise TemplateError(f"{self.source!r} ends too early")
        self.at += 1
        return self.tokens[self.at - 1]

    def _atom(self) -> Any:
        kind, text = self._next()
        if kind == 1:
            return Const(re.sub(r"\\(.)", lambda m: _ESCAPE.get(m[1], m[1]), text[1:-1], flags=re.DOTALL))
        if kind == 2:
            return Const(int(text))
        if kind == 3:
            path = [text]
            while self._take("."):
                kind, field = self._next()
                if kind != 3:
                    raise TemplateError(f"{field!r} is no field")
                path.append(field)
            return Name(tuple(path))
        if text == "(":
            tree = self._or()
            if not self._take(")"):
                raise TemplateError(f"{self.source!r} lacks a bracket")
            return tree
        raise TemplateError(f"{text!r} is out of place in {self.source!r}")


def parse(source: str) -> tuple[Any, ...]:
    """The tree of a template, as a sequence of nodes."""
    parts, at = [], 0
    for found in _PIECES.finditer(source):
        if found.start() > at:
            parts.append(("text", source[at : found.start()]))
        parts.append(("out", found[1]) if found[1] is not None else ("tag", found[2].strip()))
        at = found.end()
    if at < len(source):
        parts.append(("text", source[at:]))
    body, stop, rest = _block(parts, 0, ())
    if rest != len(parts):
        raise TemplateError(f"{stop} has no beginning")
    return body


def _block(parts: list[tuple[str, str]], at: int, ends: tuple[str, ...]) -> tuple[tuple[Any, ...], str, int]:
    """Nodes up to a tag whose first word is in ``ends``, that tag, and its place."""
    nodes = []
    while at < len(parts):
        kind, text = parts[at]
        at += 1
        if kind == "text":
            nodes.append(Output(Const(text)))
            continue
        if kind == "out":
            nodes.append(Output(_Expression(text).parse()))
            continue
        word, _, rest = text.partition(" ")
        if word in ends:
            return tuple(nodes), text, at
        if word == "if":
            node, at = _if(parts, at, rest)
        elif word == "for":
            found = re.fullmatch(r"\s*([A-Za-z_]\w*)\s+in\s+(.+)", rest, re.DOTALL)
            if not found:
                raise TemplateError(f"cannot read {text!r}")
            body, _, at = _block(parts, at, ("endfor",))
            node = For(found[1], _Expression(found[2]).parse(), body)
        elif word == "generation":
            body, _, at = _block(parts, at, ("endgeneration",))
            node = Generation(body)
        else:
            raise TemplateError(f"unknown or misplaced tag {text!r}")
        nodes.append(node)
    if ends:
        raise TemplateError(f"{' or '.join(ends)} is missing")
    return tuple(nodes), "", at


def _if(parts: list[tuple[str, str]], at: int, condition: str) -> tuple[If, int]:
    then, stop, at = _block(parts, at, ("elif", "else", "endif"))
    word, _, rest = stop.partition(" ")
    otherwise: tuple[Any, ...] = ()
    if word == "elif":
        inner, at = _if(parts, at, rest)
        otherwise = (inner,)
    elif word == "else":
        otherwise, _, at = _block(parts, at, ("endif",))
    return If(_Expression(condition).parse(), then, otherwise), at


# -- folding ----------------------------------------------------------------------


def _text(value: Any) -> str:
    return "" if value is None else value if isinstance(value, str) else str(value)


_OPERATIONS: dict[str, Callable[..., Any]] = {
    "not": lambda a: not a,
    "and": lambda a, b: a and b,
    "or": lambda a, b: a or b,
    "==": lambda a, b: a == b,
    "!=": lambda a, b: a != b,
    "~": lambda a, b: _text(a) + _text(b),
}


def fold_expression(tree: Any, filters: Filters) -> Any:
    """Replace what has constant operands by its value."""
    if isinstance(tree, Operation):
        operands = tuple(fold_expression(x, filters) for x in tree.operands)
        if all(isinstance(x, Const) for x in operands):
            return Const(_OPERATIONS[tree.kind](*(x.value for x in operands)))
        return Operation(tree.kind, operands)
    if isinstance(tree, Filtered):
        if tree.filter not in filters:
            raise TemplateError(f"there is no filter {tree.filter}")
        operand = fold_expression(tree.operand, filters)
        if isinstance(operand, Const):
            return Const(filters[tree.filter](_text(operand.value)))
        return Filtered(tree.filter, operand)
    return tree


def fold(nodes: Iterable[Any], filters: Filters) -> tuple[Any, ...]:
    """Fold expressions, keep only the branches that can be taken, join adjacent text."""
    out: list[Any] = []
    for node in nodes:
        if isinstance(node, Output):
            found = [Output(fold_expression(node.expression, filters))]
        elif isinstance(node, If):
            condition = fold_expression(node.condition, filters)
            then, otherwise = fold(node.then, filters), fold(node.otherwise, filters)
            if isinstance(condition, Const):
                found = list(then if condition.value else otherwise)
            else:
                found = [If(condition, then, otherwise)]
        elif isinstance(node, For):
            found = [For(node.name, fold_expression(node.items, filters), fold(node.body, filters))]
        else:
            body = fold(node.body, filters)
            found = [Generation(body)] if body else []
        for one in found:
            last = out[-1] if out else None
            if isinstance(one, Output) and isinstance(one.expression, Const):
                text = _text(one.expression.value)
                if isinstance(last, Output) and isinstance(last.expression, Const):
                    out[-1] = Output(Const(last.expression.value + text))
                elif text:
                    out.append(Output(Const(text)))
            else:
                out.append(one)
    return tuple(out)


# -- closures ---------------------------------------------------------------------


def _value(tree: Any, filters: Filters) -> Callable[[dict], Any]:
    if isinstance(tree, Const):
        return lambda scope, value=tree.value: value
    if isinstance(tree, Name):

        def look(scope: dict, path=tree.path) -> Any:
            value: Any = scope
            for field in path:
                if not isinstance(value, Mapping) or field not in value:
                    raise TemplateError(f"there is no {'.'.join(path)}")
                value = value[field]
            return value

        return look
    if isinstance(tree, Filtered):
        inner, apply = _value(tree.operand, filters), filters[tree.filter]
        return lambda scope: apply(_text(inner(scope)))
    operands = [_value(x, filters) for x in tree.operands]
    if tree.kind in ("and", "or"):
        left, right = operands
        if tree.kind == "and":
            return lambda scope: left(scope) and right(scope)
        return lambda scope: left(scope) or right(scope)
    apply = _OPERATIONS[tree.kind]
    return lambda scope: apply(*(f(scope) for f in operands))


def _sequence(nodes: Iterable[Any], filters: Filters, masked: bool) -> Callable[[dict], Iterator[Chunk]]:
    steps = [_step(node, filters, masked) for node in nodes]

    def run(scope: dict) -> Iterator[Chunk]:
        for step in steps:
            yield from step(scope)

    return run


def _step(node: Any, filters: Filters, masked: bool) -> Callable[[dict], Iterator[Chunk]]:
    if isinstance(node, Output):
        if isinstance(node.expression, Const):
            chunks = ((node.expression.value, masked),)
            return lambda scope: iter(chunks)
        value = _value(node.expression, filters)
        return lambda scope: iter(((_text(value(scope)), masked),))
    if isinstance(node, Generation):
        return _sequence(node.body, filters, True)
    if isinstance(node, If):
        condition = _value(node.condition, filters)
        then, otherwise = _sequence(node.then, filters, masked), _sequence(node.otherwise, filters, masked)
        return lambda scope: then(scope) if condition(scope) else otherwise(scope)

    items, body, name = _value(node.items, filters), _sequence(node.body, filters, masked), node.name

    def loop(scope: dict) -> Iterator[Chunk]:
        ahead = iter(items(scope))
        nothing = object()
        item = next(ahead, nothing)
        index = 0
        while item is not nothing:
            following = next(ahead, nothing)
            index += 1
            state = {"index": index, "first": index == 1, "last": following is nothing}
            yield from body({**scope, name: item, "loop": state})
            item = following

    return loop


def compile_template(source: str, filters: Filters = FILTERS) -> Callable[[dict], Iterator[Chunk]]:
    """A function from variables to chunks of text, each with its generation mark."""
    return _sequence(fold(parse(source), filters), filters, False)
