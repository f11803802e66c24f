"""A sandboxed template language for chats, compiled to Python closures.

    {{ expression }}   {% for x in name %} ... {% endfor %}   {% if e %} ... {% elif e %} ... {% else %} ... {% endif %}
    {% generation %} ... {% endgeneration %}   {# comment #}

Expressions: strings, whole numbers, true, false, names, fields (a.b), ==, !=, not, and, or, +, parentheses and filters
(e | name). Names are looked up in what is passed in, fields in dictionaries, filters in a given table; there are no
calls, so a template reaches nothing else. Text is rendered piece by piece: a loop over a long conversation holds two
turns at a time. Pieces under a generation marker are flagged.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from itertools import chain

Piece = tuple[str, bool]
Render = Callable[[dict, bool], Iterator[Piece]]
_TAGS = re.compile(r"(\{\{.*?\}\}|\{%.*?%\}|\{#.*?#\})", re.S)
_TOKEN = re.compile(r"""\s*(?:(?P<str>'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*")|(?P<int>\d+)|(?P<name>[A-Za-z_]\w*)|(?P<op>==|!=|[().|+]))""")
_ESCAPES = {"n": "\n", "t": "\t", "r": "\r"}


class TemplateError(ValueError):
    pass


class _Expression:
    """Recursive descent: or, and, not, comparison, sum, filter, atom. Nodes are tuples whose first item is the kind."""

    def __init__(self, source: str):
        self.left, at = [], 0
        source = source.strip()
        while at < len(source):
            if not (m := _TOKEN.match(source, at)):
                raise TemplateError(f"unreadable: {source[at:]!r}")
            self.left.append((m.lastgroup, m[m.lastgroup]))
            at = m.end()
        self.left.append(("end", ""))

    def take(self, *wanted: str) -> str | None:
        if self.left[0][0] in ("op", "name") and self.left[0][1] in wanted:
            return self.left.pop(0)[1]
        return None

    def whole(self) -> tuple:
        e = self.either()
        if self.left[0][0] != "end":
            raise TemplateError(f"unexpected {self.left[0][1]!r}")
        return e

    def either(self) -> tuple:
        e = self.both()
        while self.take("or"):
            e = ("or", e, self.both())
        return e

    def both(self) -> tuple:
        e = self.negated()
        while self.take("and"):
            e = ("and", e, self.negated())
        return e

    def negated(self) -> tuple:
        return ("not", self.negated()) if self.take("not") else self.compared()

    def compared(self) -> tuple:
        e = self.summed()
        while op := self.take("==", "!="):
            e = (op, e, self.summed())
        return e

    def summed(self) -> tuple:
        e = self.filtered()
        while self.take("+"):
            e = ("+", e, self.filtered())
        return e

    def filtered(self) -> tuple:
        e = self.atom()
        while op := self.take(".", "|"):
            kind, name = self.left.pop(0)
            if kind != "name":
                raise TemplateError(f"a name must follow {op!r}")
            e = ("field" if op == "." else "filter", e, name)
        return e

    def atom(self) -> tuple:
        kind, text = self.left.pop(0)
        if kind == "str":
            return ("const", re.sub(r"\\(.)", lambda m: _ESCAPES.get(m[1], m[1]), text[1:-1], flags=re.S))
        if kind == "int":
            return ("const", int(text))
        if kind == "name":
            return ("const", text == "true") if text in ("true", "false") else ("name", text)
        if text == "(":
            e = self.either()
            if not self.take(")"):
                raise TemplateError("missing )")
            return e
        raise TemplateError(f"unexpected {text or 'end'!r}")


_OPERATIONS = {"==": lambda a, b: a == b, "!=": lambda a, b: a != b, "+": lambda a, b: str(a) + str(b) if isinstance(a, str) or isinstance(b, str) else a + b, "and": lambda a, b: a and b, "or": lambda a, b: a or b}


def fold(e: tuple, filters: dict[str, Callable]) -> tuple:
    """Constant parts of an expression, computed."""
    if e[0] in ("const", "name"):
        return e
    parts = [fold(x, filters) if isinstance(x, tuple) else x for x in e[1:]]
    if e[0] == "filter" and e[2] not in filters:
        raise TemplateError(f"no filter {e[2]!r}")
    if all(x[0] == "const" for x in parts if isinstance(x, tuple)) and e[0] != "field":
        if e[0] == "filter":
            return ("const", filters[e[2]](parts[0][1]))
        return ("const", not parts[0][1] if e[0] == "not" else _OPERATIONS[e[0]](parts[0][1], parts[1][1]))
    return (e[0], *parts)


def parse(source: str) -> list[tuple]:
    """The syntax tree of a template: a list of nodes text, out, for, if and generation."""
    root: list[tuple] = []
    open_tags: list[tuple[str, list]] = [("", root)]
    for part in _TAGS.split(source):
        body = open_tags[-1][1]
        if part.startswith("{{"):
            body.append(("out", _Expression(part[2:-2]).whole()))
        elif part.startswith("{%"):
            tag, _, rest = part[2:-2].strip(" \n-").partition(" ")
            if tag == "for":
                if not (m := re.fullmatch(r"\s*([A-Za-z_]\w*)\s+in\s+([A-Za-z_]\w*)\s*", rest)):
                    raise TemplateError(f"unreadable loop: {rest!r}")
                body.append(("for", m[1], m[2], inner := []))
                open_tags.append(("endfor", inner))
            elif tag == "generation":
                body.append(("generation", inner := []))
                open_tags.append(("endgeneration", inner))
            elif tag == "if":
                body.append(("if", cases := [(_Expression(rest).whole(), inner := [])]))
                open_tags += [("endif", cases), ("case", inner)]
            elif tag in ("elif", "else") and open_tags[-1][0] == "case":
                open_tags.pop()
                test = _Expression(rest).whole() if tag == "elif" else ("const", True)
                open_tags[-1][1].append((test, inner := []))
                open_tags.append(("case", inner))
            else:
                if tag == "endif" and open_tags[-1][0] == "case":
                    open_tags.pop()
                if open_tags.pop()[0] != tag:
                    raise TemplateError(f"unexpected {tag!r}")
        elif part and not part.startswith("{#"):
            body.append(("text", part))
    if len(open_tags) > 1:
        raise TemplateError(f"missing {open_tags[-1][0]!r}")
    return root


def simplify(nodes: list[tuple], filters: dict[str, Callable]) -> list[tuple]:
    """Folds expressions, drops branches that can't be taken, and joins neighbouring texts."""
    out: list[tuple] = []
    for n in nodes:
        if n[0] == "out":
            e = fold(n[1], filters)
            n = ("text", str(e[1])) if e[0] == "const" else ("out", e)
        elif n[0] == "for":
            n = (*n[:3], simplify(n[3], filters))
        elif n[0] == "generation":
            n = ("generation", simplify(n[1], filters))
        elif n[0] == "if":
            cases = []
            for test, inner in n[1]:
                e = fold(test, filters)
                if e[0] != "const" or e[1]:
                    cases.append((e, simplify(inner, filters)))
                if e[0] == "const" and e[1]:
                    break
            if cases and cases[0][0][0] == "const":
                out += cases[0][1]
                continue
            n = ("if", cases)
        if n[0] == "text" and out and out[-1][0] == "text":
            out[-1] = ("text", out[-1][1] + n[1])
        else:
            out.append(n)
    return out


def _value(e: tuple, filters: dict[str, Callable]) -> Callable[[dict], object]:
    kind = e[0]
    if kind == "const":
        return lambda env, x=e[1]: x
    if kind == "name":
        return lambda env, x=e[1]: env[x]
    a = _value(e[1], filters)
    if kind == "field":
        return lambda env, x=e[2]: a(env)[x]
    if kind == "filter":
        return lambda env, f=filters[e[2]]: f(a(env))
    if kind == "not":
        return lambda env: not a(env)
    b = _value(e[2], filters)
    if kind == "and":
        return lambda env: a(env) and b(env)
    if kind == "or":
        return lambda env: a(env) or b(env)
    return lambda env, f=_OPERATIONS[kind]: f(a(env), b(env))


def _node(n: tuple, filters: dict[str, Callable]) -> Render:
    kind = n[0]
    if kind == "text":
        return lambda env, flag, x=n[1]: iter([(x, flag)])
    if kind == "out":
        f = _value(n[1], filters)
        return lambda env, flag: iter([(str(f(env)), flag)])
    if kind == "generation":
        inner = _body(n[1], filters)
        return lambda env, flag: inner(env, True)
    if kind == "if":
        cases = [(_value(t, filters), _body(x, filters)) for t, x in n[1]]
        return lambda env, flag: next((x(env, flag) for t, x in cases if t(env)), iter(()))
    _, name, source, inside = n
    inner = _body(inside, filters)

    def loop(env: dict, flag: bool) -> Iterator[Piece]:
        items: Iterator = iter(env[source])
        ahead = next(items, loop)
        k = 0
        while ahead is not loop:
            item, ahead = ahead, next(items, loop)
            yield from inner({**env, name: item, "loop": {"index0": k, "index": k + 1, "first": k == 0, "last": ahead is loop}}, flag)
            k += 1

    return loop


def _body(nodes: list[tuple], filters: dict[str, Callable]) -> Render:
    parts = [_node(n, filters) for n in nodes]
    return lambda env, flag: chain.from_iterable(p(env, flag) for p in parts)


def compile_template(source: str, filters: dict[str, Callable] | None = None) -> Callable[..., Iterator[Piece]]:
    """A function of the template's names that gives pieces of text, each with whether a generation marker covers it."""
    filters = filters or {}
    render = _body(simplify(parse(source), filters), filters)
    return lambda **names: render(names, False)


def mark(pieces: Iterable[Piece]) -> tuple[str, list[tuple[int, int]]]:
    """The whole text and the spans (in code points) that are under generation markers."""
    text, spans, at = [], [], 0
    for x, flag in pieces:
        if flag:
            spans.append((at, at + len(x)))
        text.append(x)
        at += len(x)
    return "".join(text), spans
