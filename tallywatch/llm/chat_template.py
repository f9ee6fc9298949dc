"""Compiler for a small, sandboxed template language (chat formats).

Source text is parsed into a syntax tree, constants are folded, and the tree becomes nested Python generator closures.
The language has ``{{ expression }}``, ``{% for x in xs %}``, ``{% if %}/{% elif %}/{% else %}`` and
``{% generation %}``, whose output is marked as text to be learned. Expressions have literals, names, ``a.b`` and
``a[b]`` (keys of mappings and items of lists only), ``== != and or not``, ``~`` (join as text) and ``| filter``.
There are no calls and no attributes, so a template reaches nothing but the values and filters that it is given.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator, Mapping
from dataclasses import dataclass

Piece = tuple[str, bool]
Program = Callable[[dict], Iterator[Piece]]


class TemplateError(ValueError):
    """The template's source is wrong, or it asks for something it may not have."""


# ---- tree ---------------------------------------------------------------------------------------

@dataclass(frozen=True)
class Const:
    value: object


@dataclass(frozen=True)
class Name:
    name: str


@dataclass(frozen=True)
class Item:
    of: object
    key: object


@dataclass(frozen=True)
class Op:
    """``==``, ``!=``, ``and``, ``or``, ``not``, ``~`` or ``|name`` on its arguments."""

    kind: str
    args: tuple


@dataclass(frozen=True)
class Text:
    text: str


@dataclass(frozen=True)
class Print:
    expr: object


@dataclass(frozen=True)
class For:
    name: str
    items: object
    body: tuple


@dataclass(frozen=True)
class If:
    branches: tuple
    otherwise: tuple


@dataclass(frozen=True)
class Generation:
    body: tuple


# ---- parsing ------------------------------------------------------------------------------------

_PARTS = re.compile(r"\{\{(.*?)\}\}|\{%(.*?)%\}", re.S)
_TOKEN = re.compile(r"""\s*(?:(?P<str>"(?:[^"\\]|\\.)*"|'(?:[^'\\]|\\.)*')|(?P<int>\d+)|(?P<name>[A-Za-z_]\w*)|(?P<op>==|!=|[.\[\]()|~]))""")
_ESCAPES = {"n": "\n", "t": "\t"}
_WORDS = {"true": True, "false": False, "none": None}


def _unquoted(quoted: str) -> str:
    return re.sub(r"\\(.)", lambda m: _ESCAPES.get(m[1], m[1]), quoted[1:-1], flags=re.S)


class _Expression:
    """Recursive descent over one expression; ``|`` binds tightest, then ``~``, comparison, not, and, or."""

    def __init__(self, source: str):
        self.tokens, at, source = [], 0, source.rstrip()
        while at < len(source):
            m = _TOKEN.match(source, at)
            if not m:
                raise TemplateError(f"can't read {source[at:]!r}")
            self.tokens.append((m.lastgroup, m[m.lastgroup]))
            at = m.end()
        self.at = 0

    def take(self, *texts: str) -> str | None:
        if self.at < len(self.tokens) and self.tokens[self.at][0] in ("op", "name") and self.tokens[self.at][1] in texts:
            self.at += 1
            return self.tokens[self.at - 1][1]
        return None

    def need(self, text: str) -> None:
        if not self.take(text):
            raise TemplateError(f"{text!r} is missing")

    def next(self, *kinds: str) -> tuple[str, str]:
        if self.at >= len(self.tokens) or self.tokens[self.at][0] not in kinds:
            raise TemplateError(f"expected {' or '.join(kinds)}")
        self.at += 1
        return self.tokens[self.at - 1]

    def whole(self) -> object:
        tree = self.chain("or", lambda: self.chain("and", self.negation))
        if self.at < len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at][1]!r}")
        return tree

    def chain(self, word: str, part: Callable[[], object]) -> object:
        args = [part()]
        while self.take(word):
            args.append(part())
        return args[0] if len(args) == 1 else Op(word, tuple(args))

    def negation(self) -> object:
        return Op("not", (self.negation(),)) if self.take("not") else self.comparison()

    def comparison(self) -> object:
        left = self.chain("~", self.filtered)
        if sign := self.take("==", "!="):
            return Op(sign, (left, self.chain("~", self.filtered)))
        return left

    def filtered(self) -> object:
        tree = self.lookup()
        while self.take("|"):
            tree = Op("|" + self.next("name")[1], (tree,))
        return tree

    def lookup(self) -> object:
        if self.take("("):
            tree = self.chain("or", lambda: self.chain("and", self.negation))
            self.need(")")
        else:
            kind, text = self.next("str", "int", "name")
            if kind == "name":
                tree = Const(_WORDS[text]) if text in _WORDS else Name(text)
            else:
                tree = Const(_unquoted(text) if kind == "str" else int(text))
        while sign := self.take(".", "["):
            if sign == ".":
                tree = Item(tree, Const(self.next("name")[1]))
            else:
                tree = Item(tree, self.chain("~", self.filtered))
                self.need("]")
        return tree


def parse(source: str) -> tuple:
    """The template's syntax tree: a tuple of nodes."""
    parts: list[tuple[str, str]] = []
    at = 0
    for m in _PARTS.finditer(source):
        parts.append(("text", source[at : m.start()]))
        parts.append(("print", m[1]) if m[1] is not None else ("tag", m[2].strip()))
        at = m.end()
    parts.append(("text", source[at:]))
    nodes, rest, ended = _block(parts, 0, ())
    return nodes


def _block(parts: list, at: int, ends: tuple) -> tuple[tuple, int, str]:
    nodes: list = []
    while at < len(parts):
        kind, body = parts[at]
        at += 1
        if kind == "text":
            nodes += [Text(body)] if body else []
            continue
        if kind == "print":
            nodes.append(Print(_Expression(body).whole()))
            continue
        word = body.split(None, 1)[0] if body else ""
        if word in ends:
            return tuple(nodes), at, body
        if word == "for" and (m := re.fullmatch(r"for\s+([A-Za-z_]\w*)\s+in\s+(.+)", body, re.S)):
            inner, at, _ = _block(parts, at, ("endfor",))
            nodes.append(For(m[1], _Expression(m[2]).whole(), inner))
        elif word == "if":
            branches, otherwise, test = [], (), body[2:]
            while True:
                inner, at, end = _block(parts, at, ("elif", "else", "endif"))
                branches.append((_Expression(test).whole(), inner))
                if not end.startswith("elif"):
                    break
                test = end[4:]
            if end == "else":
                otherwise, at, _ = _block(parts, at, ("endif",))
            nodes.append(If(tuple(branches), otherwise))
        elif body == "generation":
            inner, at, _ = _block(parts, at, ("endgeneration",))
            nodes.append(Generation(inner))
        else:
            raise TemplateError(f"unknown tag {body!r}")
    if ends:
        raise TemplateError(f"{ends[-1]} is missing")
    return tuple(nodes), at, ""


# ---- constant folding ---------------------------------------------------------------------------

def fold_expression(tree: object, filters: Mapping) -> object:
    """The same expression with every part that has only constants already worked out."""
    if isinstance(tree, Item):
        tree = Item(fold_expression(tree.of, filters), fold_expression(tree.key, filters))
    elif isinstance(tree, Op):
        tree = Op(tree.kind, tuple(fold_expression(x, filters) for x in tree.args))
        if all(isinstance(x, Const) for x in tree.args):
            return Const(_expression(tree, filters)({}))
    return tree


def fold(nodes: tuple, filters: Mapping) -> tuple:
    """The same nodes with constants folded, decided branches chosen and neighbouring texts joined."""
    out: list = []

    def add(node) -> None:
        if isinstance(node, Text) and out and isinstance(out[-1], Text):
            out[-1] = Text(out[-1].text + node.text)
        elif not (isinstance(node, Text) and not node.text):
            out.append(node)

    for node in nodes:
        if isinstance(node, Print):
            expr = fold_expression(node.expr, filters)
            add(Text(_shown(expr.value)) if isinstance(expr, Const) else Print(expr))
        elif isinstance(node, For):
            add(For(node.name, fold_expression(node.items, filters), fold(node.body, filters)))
        elif isinstance(node, Generation):
            if body := fold(node.body, filters):
                add(Generation(body))
        elif isinstance(node, If):
            open_branches: list = []
            otherwise = fold(node.otherwise, filters)
            for test, body in node.branches:
                test = fold_expression(test, filters)
                if not isinstance(test, Const):
                    open_branches.append((test, fold(body, filters)))
                elif test.value:
                    otherwise = fold(body, filters)
                    break
            if open_branches:
                add(If(tuple(open_branches), otherwise))
            else:
                for x in otherwise:
                    add(x)
        else:
            add(node)
    return tuple(out)


# ---- closures -----------------------------------------------------------------------------------

def _shown(value: object) -> str:
    return "" if value is None else str(value)


def _looked_up(of: object, key: object) -> object:
    if isinstance(of, Mapping):
        return of.get(key)
    if isinstance(of, (list, tuple)) and isinstance(key, int):
        return of[key] if -len(of) <= key < len(of) else None
    raise TemplateError(f"no items in a {type(of).__name__}")


def _expression(tree: object, filters: Mapping) -> Callable[[dict], object]:
    if isinstance(tree, Const):
        value = tree.value
        return lambda scope: value
    if isinstance(tree, Name):
        name = tree.name
        return lambda scope: scope.get(name)
    if isinstance(tree, Item):
        of, key = _expression(tree.of, filters), _expression(tree.key, filters)
        return lambda scope: _looked_up(of(scope), key(scope))
    args = [_expression(x, filters) for x in tree.args]
    if tree.kind.startswith("|"):
        if tree.kind[1:] not in filters:
            raise TemplateError(f"no filter {tree.kind[1:]!r}")
        change, (arg,) = filters[tree.kind[1:]], args
        return lambda scope: change(arg(scope))
    if tree.kind == "~":
        return lambda scope: "".join(_shown(f(scope)) for f in args)
    if tree.kind == "not":
        return lambda scope: not args[0](scope)
    if tree.kind == "and":
        return lambda scope: all(f(scope) for f in args)
    if tree.kind == "or":
        return lambda scope: any(f(scope) for f in args)
    same = tree.kind == "=="
    return lambda scope: (args[0](scope) == args[1](scope)) is same


def _with_loop(items: Iterable) -> Iterator[tuple[object, dict]]:
    """Items with what a template may know of the loop; reads one item ahead."""
    source = iter(items)
    missing = object()
    item, index = next(source, missing), 0
    while item is not missing:
        following = next(source, missing)
        yield item, {"index": index + 1, "first": index == 0, "last": following is missing}
        item, index = following, index + 1


def _program(nodes: tuple, filters: Mapping, learned: bool) -> Program:
    steps: list[Program] = []
    for node in nodes:
        if isinstance(node, Text):
            steps.append(lambda scope, piece=(node.text, learned): iter((piece,)))
        elif isinstance(node, Print):
            steps.append(lambda scope, f=_expression(node.expr, filters): iter(((_shown(f(scope)), learned),)))
        elif isinstance(node, Generation):
            steps.append(_program(node.body, filters, True))
        elif isinstance(node, For):
            def loop(scope, name=node.name, items=_expression(node.items, filters), body=_program(node.body, filters, learned)):
                for item, about in _with_loop(items(scope) or ()):
                    yield from body(scope | {name: item, "loop": about})
            steps.append(loop)
        else:
            tests = [(_expression(t, filters), _program(b, filters, learned)) for t, b in node.branches]

            def choose(scope, tests=tests, otherwise=_program(node.otherwise, filters, learned)):
                return next((body for test, body in tests if test(scope)), otherwise)(scope)
            steps.append(choose)

    def run(scope: dict) -> Iterator[Piece]:
        for step in steps:
            yield from step(scope)

    return run


def compile_template(source: str, filters: Mapping[str, Callable]) -> Program:
    """A function from values to (text, is it to be learned) pieces. It reads what it loops over once, item by item."""
    return _program(fold(parse(source), filters), filters, False)
