"""A small sandboxed template language, compiled to Python closures.

Text stands for itself; ``{{ expression }}`` writes a value; ``{% for x in messages %}``,
``{% if %}``, ``{% elif %}``, ``{% else %}`` and ``{% generation %}`` (text the model is
trained on) open blocks that ``{% end... %}`` closes. Expressions are strings, names,
``x.role``, ``x.text``, ``loop.first``, ``loop.last``, ``==``, ``!=``, ``not``, ``and``,
``or``, ``+`` and filters after ``|``. There are no calls, no other attributes and no
names but those given, so a template reaches nothing else.

A template is parsed to a syntax tree; whatever depends on constants alone is computed
then, branches that can't be taken go, and neighbouring texts merge. Each node left
becomes a closure that yields pieces of output, each with whether it is generated.
Messages are read one ahead and never held together.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

Piece = tuple[str, bool]
Env = dict[str, object]

FIELDS = frozenset({"role", "text", "first", "last"})


class TemplateError(ValueError):
    """The template is not in the language."""


@dataclass(frozen=True)
class Const:
    value: object


@dataclass(frozen=True)
class Name:
    name: str


@dataclass(frozen=True)
class Field:
    of: str
    name: str


@dataclass(frozen=True)
class Filter:
    name: str
    of: object


@dataclass(frozen=True)
class Op:
    name: str
    args: tuple


@dataclass(frozen=True)
class Text:
    text: str


@dataclass(frozen=True)
class Write:
    value: object


@dataclass(frozen=True)
class For:
    name: str
    over: str
    body: tuple


@dataclass(frozen=True)
class If:
    test: object
    then: tuple
    other: tuple


@dataclass(frozen=True)
class Generation:
    body: tuple


_TAG = re.compile(r"\{\{(.*?)\}\}|\{%(.*?)%\}", re.S)
_TOKEN = re.compile(r"\s*(?:('[^']*'|\"[^\"]*\")|(==|!=|[+|.()])|([A-Za-z]\w*))")

OPERATIONS: dict[str, Callable] = {
    "==": lambda a, b: a == b,
    "!=": lambda a, b: a != b,
    "+": lambda a, b: str(a) + str(b),
    "not": lambda a: not a,
}


class _Expression:
    """Recursive descent over an expression's tokens, loosest binding first."""

    def __init__(self, source: str, filters: dict[str, Callable[[str], str]]):
        self.tokens, self.filters, at = [], filters, 0
        source = source.strip()
        while at < len(source):
            if not (found := _TOKEN.match(source, at)):
                raise TemplateError(f"cannot read {source[at:]!r}")
            self.tokens.append(found[0].strip())
            at = found.end()
        self.at = 0

    def parse(self):
        tree = self.either()
        if self.at < len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at]!r}")
        return tree

    def next(self, *wanted: str) -> str | None:
        if self.at < len(self.tokens) and (not wanted or self.tokens[self.at] in wanted):
            self.at += 1
            return self.tokens[self.at - 1]
        return None

    def either(self):
        tree = self.both()
        while self.next("or"):
            tree = Op("or", (tree, self.both()))
        return tree

    def both(self):
        tree = self.negated()
        while self.next("and"):
            tree = Op("and", (tree, self.negated()))
        return tree

    def negated(self):
        return Op("not", (self.negated(),)) if self.next("not") else self.compared()

    def compared(self):
        tree = self.joined()
        if op := self.next("==", "!="):
            tree = Op(op, (tree, self.joined()))
        return tree

    def joined(self):
        tree = self.filtered()
        while self.next("+"):
            tree = Op("+", (tree, self.filtered()))
        return tree

    def filtered(self):
        tree = self.atom()
        while self.next("|"):
            if (name := self.next()) not in self.filters:
                raise TemplateError(f"no filter {name!r}")
            tree = Filter(name, tree)
        return tree

    def atom(self):
        token = self.next()
        if token == "(":
            tree = self.either()
            if not self.next(")"):
                raise TemplateError("a bracket is open")
            return tree
        if token is None or not re.match(r"['\"A-Za-z]", token):
            raise TemplateError(f"unexpected {token!r}")
        if token[0] in "'\"":
            return Const(token[1:-1])
        if not self.next("."):
            return Name(token)
        if (field := self.next()) not in FIELDS:
            raise TemplateError(f"no field {field!r}")
        return Field(token, field)


def parse(source: str, filters: dict[str, Callable[[str], str]]) -> tuple:
    """The template's syntax tree: a tuple of nodes."""
    stack: list[tuple[str, object, list]] = [("", None, [])]

    def close(kind: str) -> tuple[object, list]:
        if stack[-1][0] != kind:
            raise TemplateError(f"end of {kind} inside {stack[-1][0] or 'the template'}")
        _, head, body = stack.pop()
        return head, body

    def close_if() -> None:
        """``elif`` opened further ones inside ``else``; one end closes them all."""
        node: tuple = ()
        while True:
            if stack[-1][0] not in ("if", "elif", "else"):
                raise TemplateError("end of if without if")
            kind, head, body = stack.pop()
            if kind == "else":
                node = tuple(body)
            else:
                node = (If(head, tuple(body), node),)
                if kind == "if":
                    stack[-1][2].extend(node)
                    return

    at = 0
    for tag in _TAG.finditer(source):
        if tag.start() > at:
            stack[-1][2].append(Text(source[at : tag.start()]))
        at = tag.end()
        if tag[1] is not None:
            stack[-1][2].append(Write(_Expression(tag[1], filters).parse()))
            continue
        word, _, rest = tag[2].strip().partition(" ")
        if word == "for":
            if not (found := re.fullmatch(r"([A-Za-z]\w*)\s+in\s+([A-Za-z]\w*)", rest.strip())):
                raise TemplateError(f"cannot read for {rest!r}")
            stack.append(("for", (found[1], found[2]), []))
        elif word in ("if", "elif"):
            if word == "elif" and stack[-1][0] not in ("if", "elif"):
                raise TemplateError("elif without if")
            stack.append((word, _Expression(rest, filters).parse(), []))
        elif word == "else":
            if stack[-1][0] not in ("if", "elif"):
                raise TemplateError("else without if")
            stack.append(("else", None, []))
        elif word == "generation":
            stack.append(("generation", None, []))
        elif word == "endfor":
            (name, over), body = close("for")
            stack[-1][2].append(For(name, over, tuple(body)))
        elif word == "endif":
            close_if()
        elif word == "endgeneration":
            _, body = close("generation")
            stack[-1][2].append(Generation(tuple(body)))
        else:
            raise TemplateError(f"unknown tag {word!r}")
    if at < len(source):
        stack[-1][2].append(Text(source[at:]))
    if len(stack) > 1:
        raise TemplateError(f"{stack[-1][0]} is open")
    return tuple(stack[0][2])


def fold(tree, constants: Env, filters: dict[str, Callable[[str], str]]):
    """The tree with everything computed that constants decide; same output for all messages."""
    again = lambda x: fold(x, constants, filters)
    match tree:
        case tuple():
            out: list = []
            for node in (y for x in tree for y in _spliced(again(x))):
                if isinstance(node, Text) and out and isinstance(out[-1], Text):
                    node = Text(out.pop().text + node.text)
                if node != Text(""):
                    out.append(node)
            return tuple(out)
        case Name(name) if name in constants:
            return Const(constants[name])
        case Filter(name, of):
            of = again(of)
            return Const(filters[name](str(of.value))) if isinstance(of, Const) else Filter(name, of)
        case Op(name, args):
            args = tuple(again(a) for a in args)
            if name in ("and", "or") and isinstance(args[0], Const):
                return args[1] if bool(args[0].value) == (name == "and") else args[0]
            known = name in OPERATIONS and all(isinstance(a, Const) for a in args)
            return Const(OPERATIONS[name](*(a.value for a in args))) if known else Op(name, args)
        case Write(value):
            value = again(value)
            return Text(str(value.value)) if isinstance(value, Const) else Write(value)
        case If(test, then, other):
            test = again(test)
            if isinstance(test, Const):
                return again(then if test.value else other)
            return If(test, again(then), again(other))
        case For(name, over, body):
            return For(name, over, again(body))
        case Generation(body):
            return Generation(again(body))
    return tree


def _spliced(node) -> tuple:
    return node if isinstance(node, tuple) else (node,)


def _value(tree, filters: dict[str, Callable[[str], str]]) -> Callable[[Env], object]:
    match tree:
        case Const(value):
            return lambda env: value
        case Name(name):
            return lambda env: env[name]
        case Field(of, name):
            return lambda env: env[of][name]
        case Filter(name, of):
            inner, change = _value(of, filters), filters[name]
            return lambda env: change(str(inner(env)))
        case Op("and", (a, b)):
            left, right = _value(a, filters), _value(b, filters)
            return lambda env: left(env) and right(env)
        case Op("or", (a, b)):
            left, right = _value(a, filters), _value(b, filters)
            return lambda env: left(env) or right(env)
        case Op(name, args):
            operation, inner = OPERATIONS[name], [_value(a, filters) for a in args]
            return lambda env: operation(*(x(env) for x in inner))
    raise TemplateError(f"cannot compile {tree!r}")


def _looped(items: Iterable) -> Iterator[tuple[object, dict[str, bool]]]:
    """Each item with whether it is the first and the last, reading one ahead."""
    items, first, nothing = iter(items), True, object()
    item = next(items, nothing)
    while item is not nothing:
        following = next(items, nothing)
        yield item, {"first": first, "last": following is nothing}
        item, first = following, False


def _pieces(tree, filters: dict[str, Callable[[str], str]], generated: bool) -> Callable[[Env], Iterator[Piece]]:
    match tree:
        case tuple():
            nodes = [_pieces(node, filters, generated) for node in tree]

            def all_of(env: Env) -> Iterator[Piece]:
                for node in nodes:
                    yield from node(env)

            return all_of
        case Text(text):
            piece = ((text, generated),)
            return lambda env: iter(piece)
        case Write(value):
            inner = _value(value, filters)
            return lambda env: iter(((str(inner(env)), generated),))
        case If(test, then, other):
            holds, yes, no = _value(test, filters), _pieces(then, filters, generated), _pieces(other, filters, generated)
            return lambda env: yes(env) if holds(env) else no(env)
        case Generation(body):
            return _pieces(body, filters, True)
        case For(name, over, body):
            inside = _pieces(body, filters, generated)

            def each(env: Env) -> Iterator[Piece]:
                for item, loop in _looped(env[over]):
                    yield from inside({**env, name: item, "loop": loop})

            return each
    raise TemplateError(f"cannot compile {tree!r}")


def compiled(source: str, constants: Env, filters: dict[str, Callable[[str], str]]) -> Callable[[Iterable[dict]], Iterator[Piece]]:
    """Renders messages ({role, text} each) to pieces of output and whether each is generated."""
    render = _pieces(fold(parse(source, filters), constants, filters), filters, False)
    return lambda messages: render({"messages": messages})
