"""A small sandboxed template language for conversations, compiled to Python closures.

``{{ expression }}`` prints, ``{% if %} {% elif %} {% else %} {% endif %}`` chooses, ``{% for m in messages %} {% endfor %}``
repeats, ``{% set x = expression %}`` names a value (within a loop, for one turn), ``{% generation %} {% endgeneration %}``
marks what the model is to learn, ``{# #}`` is a comment; a ``-`` inside a tag's bracket strips white space on that side.
Expressions have strings, whole numbers, ``true false none``, names, fields (``m.role``, ``m['role']``), ``loop.index index0
first last``, filters (``| trim``), ``~ + - * // %``, comparisons, ``in``, ``and or not`` and ``a if c else b``.

Sandboxed: there are no calls, attributes or imports, fields are looked up in dictionaries only, names must be known when the
template is compiled, and loops go over ``messages`` and don't nest, so a rendering ends in time linear in its messages.

A template is parsed to a tree of tuples, folded (constant expressions and branches, neighbouring texts) and turned into
closures.  A rendering is an iterator of (text, is learned) pieces with ``TURN`` after every turn of the loop; ``messages`` is
read as a stream, one ahead, where the template uses it in one loop only.  Missing fields and ``none`` print as nothing.
"""

from __future__ import annotations

import operator
import re
from collections.abc import Callable, Iterable, Iterator
from itertools import chain

TURN = (None, False)
MOST_CHARACTERS, MOST_DEPTH = 1 << 16, 40
_TAG = re.compile(r"\{\{-?|\{%-?|\{#-?")
_CLOSE = {"{{": re.compile(r"-?\}\}"), "{%": re.compile(r"-?%\}"), "{#": re.compile(r"-?#\}")}
_TOKEN = re.compile(r"\s*(?:(\d+)|([A-Za-z_]\w*)|('(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\")|(==|!=|<=|>=|//|[-+*%~<>.|()\[\]=]))", re.S)
_STRING_ESCAPES = {"n": "\n", "t": "\t", "r": "\r"}


class TemplateError(ValueError):
    """The template isn't part of the language."""


def escape(text: str) -> str:
    """No ``<|`` is left, so no text can hold a control string; ``unescape`` gives the text back."""
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def escape_line(text: str) -> str:
    return escape(text).replace("\n", "\\n")


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], text, flags=re.S) if "\\" in text else text


def shown(value) -> str:
    return "" if value is None else value if isinstance(value, str) else str(value).lower() if isinstance(value, bool) else str(value)


FILTERS: dict[str, Callable] = {
    "trim": lambda v: shown(v).strip(), "upper": lambda v: shown(v).upper(), "lower": lambda v: shown(v).lower(), "length": lambda v: len(v or ""),
    "escape": lambda v: escape(shown(v)), "escape_line": lambda v: escape_line(shown(v)), "string": shown,
}
_COMPARE = {"==": operator.eq, "!=": operator.ne, "<": operator.lt, "<=": operator.le, ">": operator.gt, ">=": operator.ge, "in": lambda a, b: a in b, "not in": lambda a, b: a not in b}
_CONCAT = lambda a, b: shown(a) + shown(b)
_BINARY = [{"~": _CONCAT}, {"+": operator.add, "-": operator.sub}, {"*": operator.mul, "//": operator.floordiv, "%": operator.mod}]


# --- parsing

class _Expression:
    """Recursive descent over the tokens of one tag."""

    def __init__(self, source: str):
        self.tokens, at, source = [], 0, source.rstrip()
        while at < len(source):
            m = _TOKEN.match(source, at)
            if not m:
                raise TemplateError(f"unexpected {source[at:at + 20]!r}")
            number, name, string, sign = m.groups()
            if number:
                self.tokens.append(("const", int(number)))
            elif string:
                self.tokens.append(("const", re.sub(r"\\(.)", lambda e: _STRING_ESCAPES.get(e[1], e[1]), string[1:-1], flags=re.S)))
            else:
                self.tokens.append(("name", name) if name else ("sign", sign))
            at = m.end()
        self.at = self.depth = 0

    def peek(self):
        return self.tokens[self.at] if self.at < len(self.tokens) else ("end", None)

    def take(self, *wanted: str) -> str | None:
        kind, value = self.peek()
        if kind in ("name", "sign") and value in wanted:
            self.at += 1
            return value
        return None

    def need(self, wanted: str) -> None:
        if not self.take(wanted):
            raise TemplateError(f"{wanted!r} expected, not {self.peek()[1]!r}")

    def name(self) -> str:
        kind, value = self.peek()
        if kind != "name":
            raise TemplateError(f"a name expected, not {value!r}")
        self.at += 1
        return value

    def end(self) -> None:
        if self.at < len(self.tokens):
            raise TemplateError(f"unexpected {self.peek()[1]!r}")

    def whole(self):
        tree = self.choice()
        self.end()
        return tree

    def choice(self):
        self.depth += 1
        if self.depth > MOST_DEPTH:
            raise TemplateError("nested too deeply")
        value = self.either()
        if self.take("if"):
            test = self.either()
            value = ("choice", test, value, self.choice() if self.take("else") else ("const", None))
        self.depth -= 1
        return value

    def either(self):
        value = self.both()
        while self.take("or"):
            value = ("or", value, self.both())
        return value

    def both(self):
        value = self.negated()
        while self.take("and"):
            value = ("and", value, self.negated())
        return value

    def negated(self):
        n = 0
        while self.take("not"):
            n += 1
        value = self.comparison()
        return ("not", value) if n % 2 else ("not", ("not", value)) if n else value

    def comparison(self):
        value = self.binary(0)
        while True:
            sign = self.take("==", "!=", "<", "<=", ">", ">=", "in")
            if not sign and self.take("not"):
                self.need("in")
                sign = "not in"
            if not sign:
                return value
            value = ("op", _COMPARE[sign], value, self.binary(0))

    def binary(self, level: int):
        if level == len(_BINARY):
            return self.postfix()
        value = self.binary(level + 1)
        while sign := self.take(*_BINARY[level]):
            value = ("op", _BINARY[level][sign], value, self.binary(level + 1))
        return value

    def postfix(self):
        value = self.primary()
        while sign := self.take(".", "[", "|"):
            if sign == ".":
                value = ("field", value, self.name())
            elif sign == "|":
                name = self.name()
                if name not in FILTERS:
                    raise TemplateError(f"no filter {name!r}")
                value = ("filter", FILTERS[name], value)
            else:
                kind, key = self.peek()
                if kind != "const" or not isinstance(key, str):
                    raise TemplateError("only fields given as strings can be looked up")
                self.at += 1
                self.need("]")
                value = ("field", value, key)
        return value

    def primary(self):
        kind, value = self.peek()
        if self.take("("):
            inner = self.choice()
            self.need(")")
            return inner
        if self.take("-"):
            return ("op", operator.sub, ("const", 0), self.postfix())
        if kind not in ("const", "name"):
            raise TemplateError(f"a value expected, not {value!r}")
        self.at += 1
        if kind == "const":
            return ("const", value)
        fixed = {"true": True, "false": False, "none": None}
        return ("const", fixed[value]) if value in fixed else ("name", value)


def _pieces(source: str) -> list[tuple[str, str]]:
    """(kind, content) of texts and tags, with white space stripped where a tag asks for it."""
    out, at, strip = [], 0, False
    while True:
        m = _TAG.search(source, at)
        text = source[at: m.start() if m else len(source)]
        text = text.lstrip() if strip else text
        if m and m[0].endswith("-"):
            text = text.rstrip()
        if text:
            out.append(("text", text))
        if not m:
            return out
        kind = m[0][:2]
        # A closing bracket inside a string doesn't close the tag.
        body = re.compile(r"(?:'(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\"|.)*?(" + _CLOSE[kind].pattern + ")", re.S).match(source, m.end()) if kind != "{#" else None
        if kind == "{#":
            close = _CLOSE[kind].search(source, m.end())
            if not close:
                raise TemplateError("comment without end")
            at, strip = close.end(), close[0].startswith("-")
            continue
        if not body:
            raise TemplateError(f"{m[0]} without end")
        out.append((kind, source[m.end(): body.start(1)]))
        at, strip = body.end(), body[1].startswith("-")


def parse(source: str) -> list:
    """Syntax tree: a list of ("text", s), ("print", e), ("if", [(test, body)…], otherwise), ("for", name, e, body), ("set", name, e), ("learn", body)."""
    if len(source) > MOST_CHARACTERS:
        raise TemplateError("template too long")
    pieces = _pieces(source)
    at = 0

    def body(until: tuple[str, ...], depth: int):
        nonlocal at
        if depth > MOST_DEPTH:
            raise TemplateError("nested too deeply")
        out = []
        while at < len(pieces):
            kind, content = pieces[at]
            at += 1
            if kind == "text":
                out.append(("text", content))
                continue
            e = _Expression(content)
            if kind == "{{":
                out.append(("print", e.whole()))
                continue
            word = e.name()
            if word in until:
                return out, word, e
            if word == "set":
                name = e.name()
                e.need("=")
                out.append(("set", name, e.whole()))
            elif word == "for":
                name = e.name()
                e.need("in")
                target = e.whole()
                inner, _, closing = body(("endfor",), depth + 1)
                closing.end()
                out.append(("for", name, target, inner))
            elif word == "if":
                cases, otherwise, word, test = [], [], "elif", e.whole()
                while word == "elif":
                    inner, word, closing = body(("elif", "else", "endif"), depth + 1)
                    cases.append((test, inner))
                    if word == "elif":
                        test = closing.whole()
                    else:
                        closing.end()
                if word == "else":
                    otherwise, _, closing = body(("endif",), depth + 1)
                    closing.end()
                out.append(("if", cases, otherwise))
            elif word == "generation":
                e.end()
                inner, _, closing = body(("endgeneration",), depth + 1)
                closing.end()
                out.append(("learn", inner))
            else:
                raise TemplateError(f"unexpected tag {word!r}")
        if until:
            raise TemplateError(f"{until[-1]!r} is missing")
        return out, None, None

    return body((), 0)[0]


# --- folding

def fold_expression(tree, constants: dict):
    """The expression with everything that is constant worked out."""
    kind = tree[0]
    if kind == "const":
        return tree
    if kind == "name":
        return ("const", constants[tree[1]]) if tree[1] in constants else tree
    if kind in ("and", "or"):
        a = fold_expression(tree[1], constants)
        if a[0] == "const":
            return fold_expression(tree[2], constants) if bool(a[1]) == (kind == "and") else a
        return (kind, a, fold_expression(tree[2], constants))
    if kind == "choice":
        test = fold_expression(tree[1], constants)
        if test[0] == "const":
            return fold_expression(tree[2 if test[1] else 3], constants)
        return ("choice", test, *(fold_expression(t, constants) for t in tree[2:]))
    parts = [fold_expression(t, constants) if isinstance(t, tuple) else t for t in tree[1:]]
    trees = [p for p in parts if isinstance(p, tuple)]
    if all(p[0] == "const" for p in trees):
        try:
            return ("const", expression((kind, *parts))({}))
        except (TypeError, ArithmeticError, ValueError) as wrong:
            raise TemplateError(str(wrong)) from wrong
    return (kind, *parts)


def fold(body: list, constants: dict) -> list:
    """The tree with constant branches decided, constant output turned into text, and neighbouring texts joined."""
    out: list = []

    def text(value: str) -> None:
        if out and out[-1][0] == "text":
            out[-1] = ("text", out[-1][1] + value)
        elif value:
            out.append(("text", value))

    def add(nodes: list) -> None:
        for node in nodes:
            text(node[1]) if node[0] == "text" else out.append(node)

    known = dict(constants)
    for node in body:
        if node[0] == "text":
            text(node[1])
        elif node[0] == "print":
            # a ~ b prints a, then b, so that its constant parts join the texts around.
            todo = [fold_expression(node[1], known)]
            while todo:
                e = todo.pop()
                if e[0] == "op" and e[1] is _CONCAT:
                    todo += [e[3], e[2]]
                else:
                    text(shown(e[1])) if e[0] == "const" else out.append(("print", e))
        elif node[0] == "set":
            known.pop(node[1], None)
            out.append(("set", node[1], fold_expression(node[2], known)))
        elif node[0] == "learn":
            inner = fold(node[1], known)
            if inner:
                out.append(("learn", inner))
        elif node[0] == "for":
            inner = {k: v for k, v in known.items() if k not in (node[1], "loop") and k not in _assigned(node[3])}
            out.append(("for", node[1], fold_expression(node[2], known), fold(node[3], inner)))
        else:
            cases, otherwise, decided = [], node[2], False
            for test, inner in node[1]:
                test = fold_expression(test, known)
                if test[0] != "const":
                    cases.append((test, fold(inner, known)))
                elif test[1]:
                    otherwise, decided = inner, True
                    break
            if cases:
                out.append(("if", cases, fold(otherwise, known)))
            elif decided or otherwise:
                add(fold(otherwise, known))
            for name in _assigned([node]):
                known.pop(name, None)
    return out


def _assigned(body: list) -> set[str]:
    """Names that the nodes set in their own scope."""
    out: set[str] = set()
    for node in body:
        if node[0] == "set":
            out.add(node[1])
        elif node[0] == "learn":
            out |= _assigned(node[1])
        elif node[0] == "if":
            out |= set().union(*(_assigned(b) for _, b in node[1]), _assigned(node[2]))
    return out


# --- closures

def _field(value, name: str):
    return value.get(name) if isinstance(value, dict) else None


def expression(tree) -> Callable[[dict], object]:
    kind = tree[0]
    if kind == "const":
        value = tree[1]
        return lambda scope: value
    if kind == "name":
        name = tree[1]
        return lambda scope: scope.get(name)
    if kind == "choice":
        test, a, b = map(expression, tree[1:])
        return lambda scope: a(scope) if test(scope) else b(scope)
    if kind in ("and", "or"):
        a, b = map(expression, tree[1:])
        return (lambda scope: a(scope) and b(scope)) if kind == "and" else (lambda scope: a(scope) or b(scope))
    if kind == "not":
        a = expression(tree[1])
        return lambda scope: not a(scope)
    if kind == "field":
        a, name = expression(tree[1]), tree[2]
        return lambda scope: _field(a(scope), name)
    if kind == "filter":
        fn, a = tree[1], expression(tree[2])
        return lambda scope: fn(a(scope))
    fn, a, b = tree[1], expression(tree[2]), expression(tree[3])
    return lambda scope: fn(a(scope), b(scope))


def _statement(node) -> Callable[[dict, bool], Iterator]:
    kind = node[0]
    if kind == "text":
        value = node[1]

        def text(scope, learned):
            yield value, learned

        return text
    if kind == "print":
        value = expression(node[1])

        def output(scope, learned):
            yield shown(value(scope)), learned

        return output
    if kind == "set":
        name, value = node[1], expression(node[2])

        def assign(scope, learned):
            scope[name] = value(scope)
            yield from ()

        return assign
    if kind == "learn":
        inner = block(node[1])
        return lambda scope, learned: inner(scope, True)
    if kind == "if":
        cases, otherwise = [(expression(t), block(b)) for t, b in node[1]], block(node[2])

        def choose(scope, learned):
            for test, inner in cases:
                if test(scope):
                    return inner(scope, learned)
            return otherwise(scope, learned)

        return choose
    name, inner = node[1], block(node[3])

    def repeat(scope, learned):
        turns, index = iter(scope["messages"]), 0
        message = next(turns, None)
        while message is not None:
            following = next(turns, None)
            loop = {"index0": index, "index": index + 1, "first": index == 0, "last": following is None}
            yield from inner({**scope, name: message, "loop": loop}, learned)
            yield TURN
            message, index = following, index + 1

    return repeat


def block(body: list) -> Callable[[dict, bool], Iterator]:
    parts = [_statement(node) for node in body]
    if len(parts) == 1:
        return parts[0]
    return lambda scope, learned: chain.from_iterable(part(scope, learned) for part in parts)


def _names(tree) -> Iterator[str]:
    """Names that an expression reads."""
    if isinstance(tree, tuple):
        if tree[0] == "name":
            yield tree[1]
        elif tree[0] != "const":
            for part in tree[1:]:
                yield from _names(part)


def _check(body: list, known: set[str], in_loop: bool, reads: list[str]) -> None:
    """Every name is known where it is read; loops go over messages and don't nest.  ``reads`` gathers uses of messages."""
    def read(tree):
        for name in _names(tree):
            if name not in known:
                raise TemplateError(f"unknown name {name!r}")
            if name == "messages":
                reads.append("value")

    for node in body:
        if node[0] == "print":
            read(node[1])
        elif node[0] == "set":
            read(node[2])
            if node[1] in ("messages", "loop"):
                raise TemplateError(f"{node[1]!r} can't be set")
            known.add(node[1])
        elif node[0] == "learn":
            _check(node[1], known, in_loop, reads)
        elif node[0] == "if":
            for test, inner in node[1]:
                read(test)
                _check(inner, known, in_loop, reads)
            _check(node[2], known, in_loop, reads)
        elif node[0] == "for":
            if node[2] != ("name", "messages") or in_loop:
                raise TemplateError("loops go over messages and don't nest")
            reads.append("loop")
            _check(node[3], known | {node[1], "loop"}, True, reads)


def compile_template(source: str, names: Iterable[str] = (), constants: dict | None = None) -> Callable[..., Iterator[tuple[str | None, bool]]]:
    """``render(messages, **values)`` of a template that may read ``messages``, the given names, and constants."""
    constants = dict(constants or {})
    tree = parse(source)
    reads: list[str] = []
    _check(tree, {"messages", *names, *constants}, False, reads)
    run = block(fold(tree, constants))
    stream = reads in ([], ["loop"])

    def render(messages: Iterable[dict], **values):
        return run({**constants, **values, "messages": messages if stream else tuple(messages)}, False)

    return render
