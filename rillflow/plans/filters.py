"""The filter language: text to syntax tree to Column.

    filter := [ terms ]
    terms  := term { (AND | OR) term }          equal precedence, from the left
    term   := NOT term | "(" terms ")" | true | false | test
    test   := name op literal | name [NOT] IN "[" literal, … "]" | host … | port …

Deviations from a literal reading of other implementations of this language,
all of them deliberate: ``=<`` and ``=>`` work like ``<=`` and ``>=``; signed
and unsigned integers compare as numbers; ``!=`` on floats is the negation of
``==``; protocol names resolve under NOT too; in ``host`` with a prefix both
sides are always looked at. An unknown column or a literal of a wrong type
makes the test false, and a warning is logged.
"""

from __future__ import annotations

import ipaddress
import logging
import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import ip as ips
from ..functions.scalar import PROTOCOLS
from ..schema import INTEGERS, kinds

log = logging.getLogger(__name__)
EPSILON = 1e-8


class FilterError(ValueError):
    """The text isn't a filter."""


@dataclass(frozen=True)
class Token:
    kind: str
    text: str


@dataclass(frozen=True)
class Both:
    op: str
    left: object
    right: object


@dataclass(frozen=True)
class Not:
    inner: object


@dataclass(frozen=True)
class Truth:
    value: bool


@dataclass(frozen=True)
class Test:
    name: str
    op: str
    value: object


_IP = r"(?:\d{1,3}(?:\.\d{1,3}){3}|(?:[0-9A-Fa-f]{0,4}:){2,7}(?:\d{1,3}(?:\.\d{1,3}){3}|[0-9A-Fa-f]{0,4}))"
_TOKENS = [
    ("space", r"\s+"),
    ("time", r"\"?\d{4}-\d{1,2}-\d{1,2}T\d{1,2}:\d{1,2}:\d{1,2}(?:\.\d+)?\"?"),
    ("net", _IP + r"/\d{1,3}"),
    ("ip", _IP + r"(?![\w:.])"),
    ("float", r"[+-]?\d+\.\d+"),
    ("int", r"[+-]?\d+"),
    ("text", r"\"(?:[^\"\\]|\\.)*\"|'(?:[^'\\]|\\.)*'"),
    ("regex", r"=~|~="),
    ("cmp", r"==|=<|=>|<=|>=|!=|<>|=|<|>"),
    ("and", r"&&|AND\b|and\b"),
    ("or", r"\|\||OR\b|or\b"),
    ("not", r"!|NOT\b|not\b"),
    ("in", r"IN\b|in\b"),
    ("true", r"TRUE\b|True\b|true\b"),
    ("false", r"FALSE\b|False\b|false\b"),
    ("mark", r"[()\[\],]"),
    ("name", r"[A-Za-z][A-Za-z0-9_]*"),
]
_SCAN = re.compile("|".join(f"(?P<{k}>{p})" for k, p in _TOKENS))
_OPS = {"=": "==", "<>": "!=", "=<": "<=", "=>": ">="}


def tokens(text: str) -> list[Token]:
    out, at = [], 0
    while at < len(text):
        m = _SCAN.match(text, at)
        if not m:
            raise FilterError(f"unexpected {text[at : at + 10]!r} at {at}")
        if m.lastgroup != "space":
            out.append(Token(m.lastgroup, m[0]))
        at = m.end()
    return out


class _Parser:
    def __init__(self, text: str):
        self.rest = tokens(text)

    def peek(self) -> Token:
        return self.rest[0] if self.rest else Token("end", "")

    def take(self, kind: str, text: str | None = None) -> Token:
        t = self.peek()
        if t.kind != kind or text not in (None, t.text):
            raise FilterError(f"expected {text or kind}, found {t.text or 'the end'!r}")
        return self.rest.pop(0)

    def all(self):
        if not self.rest:
            return Truth(True)
        tree = self.terms()
        self.take("end") if self.rest else None
        return tree

    def terms(self):
        left = self.term()
        while self.peek().kind in ("and", "or"):
            op = self.rest.pop(0).kind
            left = Both(op, left, self.term())
        return left

    def term(self):
        t = self.peek()
        if t.kind == "not":
            self.rest.pop(0)
            return Not(self.term())
        if t.kind in ("true", "false"):
            self.rest.pop(0)
            return Truth(t.kind == "true")
        if t == Token("mark", "("):
            self.rest.pop(0)
            inner = self.terms()
            self.take("mark", ")")
            return inner
        return self.test()

    def test(self):
        name = self.take("name").text
        t = self.peek()
        if t.kind == "not" and len(self.rest) > 1 and self.rest[1].kind == "in":
            self.rest.pop(0)
            self.rest.pop(0)
            return Not(Test(name, "in", self.list()))
        if t.kind in ("in", "cmp") and len(self.rest) > 1 and self.rest[1] == Token("mark", "["):
            self.rest.pop(0)
            return Test(name, "in", self.list())
        if t.kind == "regex":
            self.rest.pop(0)
            return Test(name, "=~", self.literal())
        op = self.take("cmp").text
        return Test(name, _OPS.get(op, op), self.literal())

    def literal(self) -> Token:
        t = self.peek()
        if t.kind == "name" and t.text.lower() in PROTOCOLS:
            self.rest.pop(0)
            return Token("text", t.text)
        if t.kind not in ("time", "net", "ip", "float", "int", "text"):
            raise FilterError(f"expected a value, found {t.text or 'the end'!r}")
        self.rest.pop(0)
        if t.kind == "text":
            return Token("text", re.sub(r"\\(.)", r"\1", t.text[1:-1]) if t.text[1:-1].find("\\\"") >= 0 else t.text[1:-1])
        if t.kind == "time":
            return Token("time", t.text.strip('"'))
        return self.checked(t)

    @staticmethod
    def checked(t: Token) -> Token:
        try:
            if t.kind == "ip":
                ipaddress.ip_address(t.text)
            elif t.kind == "net":
                ipaddress.ip_network(t.text, strict=False)
        except ValueError as e:
            raise FilterError(str(e)) from e
        return t

    def list(self) -> tuple[Token, ...]:
        self.take("mark", "[")
        values = [self.literal()]
        while self.peek() == Token("mark", ","):
            self.rest.pop(0)
            values.append(self.literal())
        self.take("mark", "]")
        families = {{"ip": "net", "int": "float"}.get(v.kind, v.kind) for v in values}
        if len(families) > 1:
            raise FilterError("values of different types in a list")
        return tuple(values)


def parse(text: str):
    """The syntax tree of a filter; the empty filter is always true."""
    return _Parser(text).all()


def _compare(column: Column, op: str, value) -> Column:
    return {"==": column == value, "!=": column != value, "<": column < value, "<=": column <= value, ">": column > value, ">=": column >= value}[op]


def _false(why: str) -> Column:
    log.warning("%s: the test is false", why)
    return F.lit(False)


def _address(column: Column, op: str, t: Token) -> Column:
    if t.kind == "ip":
        return ips.compare(column, op, ips.packed(t.text))
    low, high, _, _ = ips.network(t.text)
    inside = ips.within(column, t.text)
    other = F.octet_length(column) != len(low)
    if op == "==":
        return inside
    if op == "!=":
        return ~inside
    below = ips.compare(column, "<", low)
    above = ips.compare(column, ">", high)
    return {"<": other | below, ">": other | above, "<=": inside | (~other & below), ">=": inside | (~other & above)}[op]


def _time(text: str) -> Column:
    date, clock = text.split("T")
    y, m, d = date.split("-")
    h, mi, s = clock.split(":")
    return F.lit(f"{y}-{int(m):02d}-{int(d):02d} {int(h):02d}:{int(mi):02d}:{float(s):09.6f}").try_cast("timestamp_ntz")


def _one(column: Column, kind: str, op: str, t: Token, name: str) -> Column:
    if kind in INTEGERS:
        if t.kind == "int":
            return _compare(column, op, F.lit(int(t.text)))
        if t.kind == "text" and name == "PROTOCOL":
            return _compare(column, op, F.lit(PROTOCOLS.get(t.text.lower(), 0)))
    elif kind in ("float", "double"):
        if t.kind in ("float", "int"):
            value = F.lit(float(t.text))
            near = F.abs(column.cast("double") - value) < EPSILON
            return {"==": near, "!=": ~near}.get(op, _compare(column.cast("double"), op, value))
    elif kind == "time":
        if t.kind == "time":
            return F.coalesce(_compare(column.cast("timestamp_ntz"), op, _time(t.text)), F.lit(False))
    elif kind == "ipaddr":
        if t.kind in ("ip", "net"):
            return _address(column, op, t)
    elif kind in ("string", "char", "bytes") and t.kind == "text":
        if op == "=~":
            return column.cast("string").rlike(t.text)
        if op in ("==", "!="):
            return _compare(column.cast("string"), op, F.lit(t.text))
    return _false(f"{name} {op} {t.text}")


def _any(columns: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, columns)


def _in(column: Column, kind: str, values: tuple[Token, ...], name: str) -> Column:
    if kind in INTEGERS and all(v.kind == "int" for v in values):
        return column.isin(*[int(v.text) for v in values])
    if kind == "ipaddr" and all(v.kind == "ip" for v in values):
        return column.isin(*[bytearray(ips.packed(v.text)) for v in values])
    return _any([_one(column, kind, "==", v, name) for v in values])


def compile_tree(tree, types: dict[str, str]) -> Column:
    """The Column of a syntax tree over columns of these record types."""
    if isinstance(tree, Truth):
        return F.lit(tree.value)
    if isinstance(tree, Not):
        return ~compile_tree(tree.inner, types)
    if isinstance(tree, Both):
        left, right = compile_tree(tree.left, types), compile_tree(tree.right, types)
        return left & right if tree.op == "and" else left | right
    if tree.name in ("host", "port") and tree.name not in types:
        pair = ("SRC_IP", "DST_IP") if tree.name == "host" else ("SRC_PORT", "DST_PORT")
        if any(c not in types for c in pair):
            return _false(f"{tree.name} needs {pair[0]} and {pair[1]}")
        source, target = F.col(pair[0]), F.col(pair[1])
        kind = types[pair[0]]
        if tree.op == "in":
            return _in(source, kind, tree.value, pair[0]) | _in(target, kind, tree.value, pair[1])
        if tree.name == "port":
            return _one(source, kind, tree.op, tree.value, pair[0]) | _one(target, kind, tree.op, tree.value, pair[1])
        if tree.value.kind not in ("ip", "net"):
            return _false(f"host {tree.op} {tree.value.text}")
        equal = _address(source, "==", tree.value) | _address(target, "==", tree.value)
        lower = ~equal & (_address(source, "<", tree.value) | _address(target, "<", tree.value))
        return {"==": equal, "!=": ~equal, "<": lower, "<=": equal | lower, ">": ~equal & ~lower, ">=": ~lower}[tree.op]
    if tree.name not in types:
        return _false(f"unknown column {tree.name}")
    column, kind = F.col(tree.name), types[tree.name]
    if tree.op == "in":
        return _in(column, kind, tree.value, tree.name)
    return _one(column, kind, tree.op, tree.value, tree.name)


def condition(df: DataFrame, text: str) -> Column:
    return compile_tree(parse(text), kinds(df))


def matching(df: DataFrame, text: str) -> DataFrame:
    """The rows that meet the filter."""
    return df.where(condition(df, text))
