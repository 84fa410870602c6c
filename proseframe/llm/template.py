"""A compiler for a small sandboxed template language.

    text  {{ expression }}  {# comment #}
    {% for x in expression %} ... {% endfor %}      loop.index, loop.index0, loop.first, loop.last
    {% if e %} ... {% elif e %} ... {% else %} ... {% endif %}
    {% set name = expression %}
    {% generation %} ... {% endgeneration %}        marks what a model is to learn to write

Expressions: strings, integers, true, false, none, names, ``a.b`` and ``a[b]``
(entries of mappings and lists only), ``| filter(arguments)``, ``not``,
``* % + - ~``, comparisons, ``in``, ``and``, ``or``, ``a if c else b``, parentheses.

Source is parsed into a syntax tree, constant parts are folded, and each node
becomes a Python closure. A rendering yields (text, marked) pieces as it goes,
so a loop may run over an iterator without holding it. There is no way to reach
a Python attribute, call anything but a listed filter, or write outside a loop's
own names.
"""

from __future__ import annotations

import operator
import re
from collections.abc import Callable, Iterator, Mapping
from typing import Any, NamedTuple


class TemplateError(ValueError):
    """The template's text is wrong, or it does what the sandbox forbids."""


class Const(NamedTuple):
    value: Any


class Name(NamedTuple):
    name: str


class Entry(NamedTuple):
    of: Any
    key: Any


class Apply(NamedTuple):
    """A filter or operator by its name, on argument nodes."""

    name: str
    args: tuple


class Choice(NamedTuple):
    """The first branch whose condition holds: ``value if test else other``, and, or."""

    kind: str
    args: tuple


class Text(NamedTuple):
    text: str


class Show(NamedTuple):
    value: Any


class For(NamedTuple):
    name: str
    over: Any
    body: tuple


class If(NamedTuple):
    branches: tuple  # of (condition, body)


class Set(NamedTuple):
    name: str
    value: Any


class Generation(NamedTuple):
    body: tuple


def _shown(value: Any) -> str:
    if value is None:
        return ""
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, str | int | float):
        return str(value)
    raise TemplateError(f"a {type(value).__name__} cannot be shown")


def _entry(of: Any, key: Any) -> Any:
    if isinstance(of, Mapping):
        return of.get(key)
    if isinstance(of, list | tuple | str) and isinstance(key, int):
        return of[key] if -len(of) <= key < len(of) else None
    return None


def _times(a: Any, b: Any) -> Any:
    if not (isinstance(a, int) and isinstance(b, int)):
        raise TemplateError("only integers can be multiplied")
    return a * b


def _rest(a: Any, b: Any) -> Any:
    if not (isinstance(a, int) and isinstance(b, int)):
        raise TemplateError("% needs integers")
    return a % b


OPERATORS: dict[str, Callable] = {
    "==": operator.eq,
    "!=": operator.ne,
    "<": operator.lt,
    "<=": operator.le,
    ">": operator.gt,
    ">=": operator.ge,
    "in": lambda a, b: a in b,
    "+": operator.add,
    "-": operator.sub,
    "*": _times,
    "%": _rest,
    "~": lambda a, b: _shown(a) + _shown(b),
    "not": operator.not_,
    "negative": operator.neg,
}

FILTERS: dict[str, Callable] = {
    "trim": lambda s: _shown(s).strip(),
    "upper": lambda s: _shown(s).upper(),
    "lower": lambda s: _shown(s).lower(),
    "length": len,
    "default": lambda v, other="": other if v is None else v,
    "replace": lambda s, old, new: _shown(s).replace(old, new),
    "join": lambda values, by="": by.join(map(_shown, values)),
}

_PART = re.compile(r"\{\{-?(.*?)-?\}\}|\{%-?(.*?)-?%\}|\{#.*?#\}", re.S)
_TOKEN = re.compile(r"""\s*(?:("(?:[^"\\]|\\.)*"|'(?:[^'\\]|\\.)*')|(\d+)|([A-Za-z_]\w*)|(==|!=|<=|>=|[<>+\-*%~|.,()\[\]=]))""", re.S)
_ESCAPES = {"n": "\n", "t": "\t", "r": "\r"}
_WORDS = {"true": True, "false": False, "none": None, "True": True, "False": False, "None": None}


class _Expression:
    """A recursive descent over the tokens of one tag."""

    def __init__(self, source: str, filters: Mapping[str, Callable]):
        self.filters, self.at, self.tokens = filters, 0, []
        place = 0
        source = source.rstrip()
        while place < len(source):
            found = _TOKEN.match(source, place)
            if not found:
                raise TemplateError(f"cannot read {source[place:place + 20]!r}")
            self.tokens.append((found.lastindex, found[found.lastindex]))
            place = found.end()

    def peek(self) -> str | None:
        return self.tokens[self.at][1] if self.at < len(self.tokens) and self.tokens[self.at][0] != 1 else None

    def take(self, *wanted: str) -> str | None:
        if self.peek() in wanted:
            self.at += 1
            return self.tokens[self.at - 1][1]
        return None

    def need(self, wanted: str) -> None:
        if not self.take(wanted):
            raise TemplateError(f"{wanted!r} is missing")

    def name(self) -> str:
        kind, word = self.tokens[self.at] if self.at < len(self.tokens) else (0, "")
        if kind != 3 or word.startswith("_"):
            raise TemplateError(f"{word!r} is no name that a template may use")
        self.at += 1
        return word

    def end(self) -> None:
        if self.at != len(self.tokens):
            raise TemplateError(f"{self.tokens[self.at][1]!r} is not expected here")

    def whole(self) -> Any:
        value = self.choice()
        self.end()
        return value

    def choice(self) -> Any:
        value = self.either()
        if self.take("if"):
            test = self.either()
            self.need("else")
            return Choice("if", (test, value, self.choice()))
        return value

    def either(self) -> Any:
        value = self.both()
        while self.take("or"):
            value = Choice("or", (value, self.both()))
        return value

    def both(self) -> Any:
        value = self.negated()
        while self.take("and"):
            value = Choice("and", (value, self.negated()))
        return value

    def negated(self) -> Any:
        if self.take("not"):
            return Apply("not", (self.negated(),))
        return self.compared()

    def compared(self) -> Any:
        value = self.summed()
        while True:
            if sign := self.take("==", "!=", "<", "<=", ">", ">=", "in"):
                value = Apply(sign, (value, self.summed()))
            elif self.peek() == "not" and self.at + 1 < len(self.tokens) and self.tokens[self.at + 1][1] == "in":
                self.at += 2
                value = Apply("not", (Apply("in", (value, self.summed())),))
            else:
                return value

    def summed(self) -> Any:
        value = self.product()
        while sign := self.take("+", "-", "~"):
            value = Apply(sign, (value, self.product()))
        return value

    def product(self) -> Any:
        value = self.signed()
        while sign := self.take("*", "%"):
            value = Apply(sign, (value, self.signed()))
        return value

    def signed(self) -> Any:
        return Apply("negative", (self.signed(),)) if self.take("-") else self.entry()

    def entry(self) -> Any:
        value = self.atom()
        while True:
            if self.take("."):
                value = Entry(value, Const(self.name()))
            elif self.take("["):
                value = Entry(value, self.choice())
                self.need("]")
            elif self.take("|"):
                name = self.name()
                if name not in self.filters:
                    raise TemplateError(f"there is no filter {name!r}")
                args = [value]
                if self.take("("):
                    while not self.take(")"):
                        args.append(self.choice())
                        if self.peek() != ")":
                            self.need(",")
                value = Apply("|" + name, tuple(args))
            else:
                return value

    def atom(self) -> Any:
        if self.at >= len(self.tokens):
            raise TemplateError("an expression ends too early")
        kind, word = self.tokens[self.at]
        if kind == 1:
            self.at += 1
            return Const(re.sub(r"\\(.)", lambda m: _ESCAPES.get(m[1], m[1]), word[1:-1], flags=re.S))
        if kind == 2:
            self.at += 1
            return Const(int(word))
        if self.take("("):
            value = self.choice()
            self.need(")")
            return value
        if word in _WORDS:
            self.at += 1
            return Const(_WORDS[word])
        return Name(self.name())


def parse(source: str, filters: Mapping[str, Callable] = FILTERS) -> tuple:
    """The syntax tree: a tuple of statement nodes."""
    pieces: list[tuple[str, str]] = []
    place, strip = 0, False
    for found in _PART.finditer(source):
        text = source[place : found.start()]
        text = text.lstrip() if strip else text
        pieces.append(("text", text.rstrip() if found[0][2:3] == "-" else text))
        strip, place = found[0][-3:-2] == "-", found.end()
        if found[1] is not None:
            pieces.append(("show", found[1]))
        elif found[2] is not None:
            pieces.append(("tag", found[2].strip()))
    pieces.append(("text", source[place:].lstrip() if strip else source[place:]))
    at = 0

    def block(ends: tuple[str, ...]) -> tuple[tuple, str, str]:
        nonlocal at
        body: list = []
        while at < len(pieces):
            kind, content = pieces[at]
            at += 1
            if kind == "text":
                if re.search(r"\{[{%#]", content):
                    raise TemplateError("a tag does not end")
                body.append(Text(content))
            elif kind == "show":
                body.append(Show(_Expression(content, filters).whole()))
            else:
                word, _, rest = content.partition(" ")
                if word in ends:
                    return tuple(body), word, rest
                body.append(statement(word, rest))
        if ends:
            raise TemplateError(f"{ends[-1]!r} is missing")
        return tuple(body), "", ""

    def statement(word: str, rest: str) -> Any:
        e = _Expression(rest, filters)
        if word == "for":
            name = e.name()
            e.need("in")
            over = e.whole()
            return For(name, over, block(("endfor",))[0])
        if word == "if":
            branches, test = [], e.whole()
            while True:
                body, closed, rest = block(("elif", "else", "endif"))
                branches.append((test, body))
                if closed == "endif":
                    return If(tuple(branches))
                test = Const(True) if closed == "else" else _Expression(rest, filters).whole()
                if closed == "else":
                    branches.append((test, block(("endif",))[0]))
                    return If(tuple(branches))
        if word == "set":
            name = e.name()
            e.need("=")
            return Set(name, e.whole())
        if word == "generation" and not rest:
            return Generation(block(("endgeneration",))[0])
        raise TemplateError(f"there is no tag {word!r}")

    return block(())[0]


def _value(node: Any, filters: Mapping[str, Callable]) -> Callable[[dict], Any]:
    """The closure that computes an expression from the names in scope."""
    if isinstance(node, Const):
        return lambda scope, value=node.value: value
    if isinstance(node, Name):
        return lambda scope, name=node.name: scope.get(name)
    if isinstance(node, Entry):
        of, key = _value(node.of, filters), _value(node.key, filters)
        return lambda scope: _entry(of(scope), key(scope))
    args = [_value(a, filters) for a in node.args]
    if isinstance(node, Apply):
        call = filters[node.name[1:]] if node.name.startswith("|") else OPERATORS[node.name]
        if len(args) == 1:
            only = args[0]
            return lambda scope: call(only(scope))
        return lambda scope: call(*[a(scope) for a in args])
    if node.kind == "if":
        test, yes, no = args
        return lambda scope: yes(scope) if test(scope) else no(scope)
    first, second = args
    if node.kind == "or":
        return lambda scope: first(scope) or second(scope)
    return lambda scope: first(scope) and second(scope)


def fold_value(node: Any, filters: Mapping[str, Callable]) -> Any:
    """The expression with its constant parts computed."""
    if isinstance(node, Const | Name):
        return node
    if isinstance(node, Entry):
        node = Entry(fold_value(node.of, filters), fold_value(node.key, filters))
        fixed = isinstance(node.of, Const) and isinstance(node.key, Const)
    else:
        node = node._replace(args=tuple(fold_value(a, filters) for a in node.args))
        if isinstance(node, Choice) and isinstance(node.args[0], Const):
            test = node.args[0].value
            if node.kind == "if":
                return node.args[1] if test else node.args[2]
            return node.args[1] if bool(test) == (node.kind == "and") else node.args[0]
        fixed = all(isinstance(a, Const) for a in node.args)
    if not fixed:
        return node
    try:
        return Const(_value(node, filters)({}))
    except (TypeError, ZeroDivisionError) as e:
        raise TemplateError(f"a constant expression fails: {e}") from e


def fold(body: tuple, filters: Mapping[str, Callable] = FILTERS) -> tuple:
    """The tree with constants computed, dead branches gone and neighbouring texts joined."""
    out: list = []

    def add(node: Any) -> None:
        if isinstance(node, Text) and out and isinstance(out[-1], Text):
            out[-1] = Text(out[-1].text + node.text)
        elif not (isinstance(node, Text) and not node.text):
            out.append(node)

    for node in body:
        if isinstance(node, Show):
            value = fold_value(node.value, filters)
            add(Text(_shown(value.value)) if isinstance(value, Const) else Show(value))
        elif isinstance(node, For):
            add(For(node.name, fold_value(node.over, filters), fold(node.body, filters)))
        elif isinstance(node, Generation):
            add(Generation(fold(node.body, filters)))
        elif isinstance(node, Set):
            add(Set(node.name, fold_value(node.value, filters)))
        elif isinstance(node, If):
            branches = []
            for test, inner in node.branches:
                test = fold_value(test, filters)
                if isinstance(test, Const) and not test.value:
                    continue
                branches.append((test, fold(inner, filters)))
                if isinstance(test, Const):
                    break
            if branches and isinstance(branches[0][0], Const):
                for inner in branches[0][1]:
                    add(inner)
            elif branches:
                add(If(tuple(branches)))
        else:
            add(node)
    return tuple(out)


Piece = tuple[str, bool]


def _looped(values: Any) -> Iterator[tuple[Any, dict]]:
    """Each value with what ``loop`` tells about it; looks one value ahead."""
    if isinstance(values, str | Mapping) or values is None:
        raise TemplateError("a loop needs a list")
    values = iter(values)
    nothing = object()
    value, index = next(values, nothing), 0
    while value is not nothing:
        after = next(values, nothing)
        yield value, {"index0": index, "index": index + 1, "first": index == 0, "last": after is nothing}
        value, index = after, index + 1


def _statements(body: tuple, filters: Mapping[str, Callable], marked: bool = False) -> Callable[[dict], Iterator[Piece]]:
    """The closure that renders a body."""
    steps = [_statement(node, filters, marked) for node in body]
    if len(steps) == 1:
        return steps[0]

    def run(scope: dict) -> Iterator[Piece]:
        for step in steps:
            yield from step(scope)

    return run


def _statement(node: Any, filters: Mapping[str, Callable], marked: bool) -> Callable[[dict], Iterator[Piece]]:
    if isinstance(node, Text):
        piece = ((node.text, marked),)
        return lambda scope: iter(piece)
    if isinstance(node, Show):
        value = _value(node.value, filters)
        return lambda scope: iter(((_shown(value(scope)), marked),))
    if isinstance(node, Generation):
        if marked:
            raise TemplateError("generation marks cannot be nested")
        return _statements(node.body, filters, True)
    if isinstance(node, Set):
        value = _value(node.value, filters)

        def assign(scope: dict) -> Iterator[Piece]:
            scope[node.name] = value(scope)
            return iter(())

        return assign
    if isinstance(node, If):
        branches = [(_value(test, filters), _statements(body, filters, marked)) for test, body in node.branches]

        def choose(scope: dict) -> Iterator[Piece]:
            for test, run in branches:
                if test(scope):
                    return run(scope)
            return iter(())

        return choose
    over, body = _value(node.over, filters), _statements(node.body, filters, marked)

    def loop(scope: dict) -> Iterator[Piece]:
        for value, about in _looped(over(scope)):
            yield from body({**scope, node.name: value, "loop": about})

    return loop


def compile_template(source: str, filters: Mapping[str, Callable] | None = None) -> Callable[..., Iterator[Piece]]:
    """A function that renders the template with the given names, as (text, marked) pieces."""
    known = {**FILTERS, **(filters or {})}
    run = _statements(fold(parse(source, known), known), known)
    return lambda **names: run(dict(names))
