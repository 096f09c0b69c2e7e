"""Chat formatting: a small sandboxed template language, compiled to Python closures.

Text, ``{{ expression }}``, ``{% if %} {% elif %} {% else %} {% endif %}``, ``{% for x in xs %} {% endfor %}``, ``{% set x = expression %}``
and ``{% generation %} {% endgeneration %}``, which marks text under the loss mask. Expressions have literals, names, ``a.b`` and ``a[b]`` on
dictionaries and lists only, ``+ - * % ~``, comparisons, ``in``, ``and or not``, ``a if c else b`` and the filters below. There are no
calls, no Python attributes and no names but those given, so a template can reach nothing else.

Template -> syntax tree -> folded tree (constant parts become text) -> closures that append to a list of pieces.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


#: Control strings of the format; in texts and roles they are replaced by a backslash and the letter of their place, a backslash by two.
CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]", "[ROLE]", "[/ROLE]", "[END]")
_ESCAPED = re.compile("|".join(map(re.escape, ("\\", *CONTROLS))))
_CODES = {"\\": "\\\\"} | {control: "\\" + chr(97 + k) for k, control in enumerate(CONTROLS)}
_PLAIN = {code: text for text, code in _CODES.items()}
_CODE = re.compile(r"\\.", re.S)

TEMPLATE = (
    "{% if first %}<s>{% endif %}"
    "{% for turn in turns %}"
    "{% if turn.role == 'user' %}[INST] {{ turn.text | escape }} [/INST]"
    "{% elif turn.role == 'assistant' %}{% generation %}{{ turn.text | escape }}{% endgeneration %}</s>"
    "{% else %}[ROLE]{{ turn.role | escape }}[/ROLE]{{ turn.text | escape }}[END]{% endif %}"
    "{% endfor %}"
)
_TURN = re.compile(r"\[INST\] (.*?) \[/INST\]|\[ROLE\](.*?)\[/ROLE\](.*?)\[END\]|(.*?)</s>", re.S)

#: A conversation is rendered in parts of about so many characters, so that memory follows the part.
PART_CHARS = 1_000_000


def escape(text: str) -> str:
    return _ESCAPED.sub(lambda m: _CODES[m[0]], text)


def unescape(text: str) -> str:
    return _CODE.sub(lambda m: _PLAIN.get(m[0], m[0]), text)


FILTERS: dict[str, Callable] = {
    "escape": lambda x: escape(str(x)),
    "trim": lambda x: str(x).strip(),
    "upper": lambda x: str(x).upper(),
    "lower": lambda x: str(x).lower(),
    "length": len,
    "string": str,
    "first": lambda x: x[0] if x else None,
    "last": lambda x: x[-1] if x else None,
    "default": lambda x, other="": other if x is None else x,
    "replace": lambda x, old, new: str(x).replace(old, new),
}


class TemplateError(ValueError):
    """A template that does not parse, or an operation that the sandbox does not have."""


# ---------------------------------------------------------------- syntax tree


@dataclass(frozen=True)
class Const:
    value: Any


@dataclass(frozen=True)
class Name:
    name: str


@dataclass(frozen=True)
class Get:
    of: Any
    key: Any


@dataclass(frozen=True)
class Op:
    sign: str
    args: tuple


@dataclass(frozen=True)
class Filter:
    name: str
    args: tuple


@dataclass(frozen=True)
class Emit:
    value: Any


@dataclass(frozen=True)
class If:
    branches: tuple  # of (condition, body)
    other: tuple


@dataclass(frozen=True)
class For:
    name: str
    over: Any
    body: tuple


@dataclass(frozen=True)
class Set:
    name: str
    value: Any


@dataclass(frozen=True)
class Generation:
    body: tuple


_PARTS = re.compile(r"\{\{(.*?)\}\}|\{%-?(.*?)-?%\}|\{#.*?#\}", re.S)
_TOKENS = re.compile(r"\s*(?:(\d+)|('(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\")|([A-Za-z_]\w*)|(==|!=|<=|>=|[-+*%~<>|.,()\[\]=]))", re.S)
_LITERALS = {"true": True, "false": False, "none": None, "True": True, "False": False, "None": None}
_ESCAPES = {"n": "\n", "t": "\t", "r": "\r"}


class _Expression:
    """Precedence-climbing parser of one expression."""

    LEVELS = (("or",), ("and",), ("not",), ("==", "!=", "<", ">", "<=", ">=", "in"), ("+", "-", "~"), ("*", "%"))

    def __init__(self, text: str):
        self.tokens: list[tuple[str, Any]] = []
        at = 0
        text = text.strip()
        while at < len(text):
            found = _TOKENS.match(text, at)
            if not found:
                raise TemplateError(f"cannot read {text[at:]!r}")
            number, string, name, sign = found.groups()
            if number:
                self.tokens.append(("const", int(number)))
            elif string:
                self.tokens.append(("const", re.sub(r"\\(.)", lambda m: _ESCAPES.get(m[1], m[1]), string[1:-1], flags=re.S)))
            elif name in _LITERALS:
                self.tokens.append(("const", _LITERALS[name]))
            else:
                self.tokens.append(("name", name) if name else ("sign", sign))
            at = found.end()
        self.at = 0

    def peek(self) -> Any:
        return self.tokens[self.at][1] if self.at < len(self.tokens) and self.tokens[self.at][0] != "const" else None

    def take(self, *wanted: str) -> Any:
        if self.peek() in wanted and self.peek() is not None:
            self.at += 1
            return self.tokens[self.at - 1][1]
        return None

    def need(self, wanted: str) -> None:
        if not self.take(wanted):
            raise TemplateError(f"expected {wanted!r}")

    def whole(self) -> Any:
        out = self.choice()
        if self.at < len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at][1]!r}")
        return out

    def choice(self) -> Any:
        value = self.level(0)
        if self.take("if"):
            condition = self.level(0)
            self.need("else")
            return Op("if", (condition, value, self.choice()))
        return value

    def level(self, depth: int) -> Any:
        if depth == len(self.LEVELS):
            return self.postfix()
        if self.LEVELS[depth] == ("not",):
            return Op("not", (self.level(depth),)) if self.take("not") else self.level(depth + 1)
        left = self.level(depth + 1)
        while sign := self.take(*self.LEVELS[depth]):
            left = Op(sign, (left, self.level(depth + 1)))
        return left

    def postfix(self) -> Any:
        value = self.primary()
        while True:
            if self.take("."):
                value = Get(value, Const(self.word()))
            elif self.take("["):
                value = Get(value, self.choice())
                self.need("]")
            elif self.take("|"):
                name, args = self.word(), [value]
                if name not in FILTERS:
                    raise TemplateError(f"no filter {name!r}")
                if self.take("("):
                    while not self.take(")"):
                        args.append(self.choice())
                        self.take(",")
                value = Filter(name, tuple(args))
            else:
                return value

    def word(self) -> str:
        if self.at < len(self.tokens) and self.tokens[self.at][0] == "name":
            self.at += 1
            return self.tokens[self.at - 1][1]
        raise TemplateError("expected a name")

    def primary(self) -> Any:
        if self.at >= len(self.tokens):
            raise TemplateError("expression ends early")
        kind, value = self.tokens[self.at]
        if kind == "const":
            self.at += 1
            return Const(value)
        if self.take("("):
            inner = self.choice()
            self.need(")")
            return inner
        if self.take("-"):
            return Op("-", (Const(0), self.postfix()))
        return Name(self.word())


def parse(template: str) -> tuple:
    """Syntax tree of a template."""
    parts: list[tuple[str, str]] = []
    at = 0
    for found in _PARTS.finditer(template):
        if found.start() > at:
            parts.append(("text", template[at : found.start()]))
        if found[1] is not None:
            parts.append(("emit", found[1]))
        elif found[2] is not None:
            parts.append(("tag", found[2].strip()))
        at = found.end()
    if at < len(template):
        parts.append(("text", template[at:]))
    place = 0

    def block(*ends: str) -> tuple[tuple, str]:
        nonlocal place
        out = []
        while place < len(parts):
            kind, text = parts[place]
            place += 1
            if kind == "text":
                out.append(Emit(Const(text)))
                continue
            if kind == "emit":
                out.append(Emit(_Expression(text).whole()))
                continue
            word, _, rest = text.partition(" ")
            if word in ends:
                return tuple(out), text
            if word == "if":
                branches, condition = [], rest
                while True:
                    body, end = block("elif", "else", "endif")
                    branches.append((_Expression(condition).whole(), body))
                    if end.startswith("elif"):
                        condition = end[4:]
                        continue
                    other = block("endif")[0] if end == "else" else ()
                    break
                out.append(If(tuple(branches), other))
            elif word == "for":
                found = re.fullmatch(r"\s*([A-Za-z_]\w*)\s+in\s+(.*)", rest, re.S)
                if not found:
                    raise TemplateError(f"cannot read for {rest!r}")
                out.append(For(found[1], _Expression(found[2]).whole(), block("endfor")[0]))
            elif word == "set":
                found = re.fullmatch(r"\s*([A-Za-z_]\w*)\s*=(.*)", rest, re.S)
                if not found:
                    raise TemplateError(f"cannot read set {rest!r}")
                out.append(Set(found[1], _Expression(found[2]).whole()))
            elif word == "generation":
                out.append(Generation(block("endgeneration")[0]))
            else:
                raise TemplateError(f"unexpected tag {text!r}")
        if ends:
            raise TemplateError(f"missing {ends[-1]}")
        return tuple(out), ""

    return block()[0]


# ---------------------------------------------------------------- folding and closures


def _text(value: Any) -> str:
    return "" if value is None else str(value)


_SIGNS: dict[str, Callable] = {
    "+": lambda a, b: a + b,
    "-": lambda a, b: a - b,
    "*": lambda a, b: a * b,
    "%": lambda a, b: a % b,
    "~": lambda a, b: _text(a) + _text(b),
    "==": lambda a, b: a == b,
    "!=": lambda a, b: a != b,
    "<": lambda a, b: a < b,
    ">": lambda a, b: a > b,
    "<=": lambda a, b: a <= b,
    ">=": lambda a, b: a >= b,
    "in": lambda a, b: a in b,
    "not": lambda a: not a,
}


def _lookup(of: Any, key: Any) -> Any:
    if isinstance(of, dict):
        return of.get(key)
    if isinstance(of, list | tuple | str) and isinstance(key, int):
        return of[key] if -len(of) <= key < len(of) else None
    return None


def fold(node: Any) -> Any:
    """The tree with constant expressions computed, dead branches cut and neighbouring texts joined."""
    if isinstance(node, tuple):
        out: list = []
        for item in map(fold, node):
            for part in item if isinstance(item, tuple) else (item,):
                if isinstance(part, Emit) and isinstance(part.value, Const):
                    part = Emit(Const(_text(part.value.value)))
                    if out and isinstance(out[-1], Emit) and isinstance(out[-1].value, Const):
                        out[-1] = Emit(Const(out[-1].value.value + part.value.value))
                        continue
                    if not part.value.value:
                        continue
                out.append(part)
        return tuple(out)
    if isinstance(node, Op):
        args = tuple(map(fold, node.args))
        if node.sign == "if" and isinstance(args[0], Const):
            return args[1] if args[0].value else args[2]
        if node.sign in ("and", "or") and isinstance(args[0], Const):
            return args[1] if bool(args[0].value) == (node.sign == "and") else args[0]
        if node.sign in _SIGNS and all(isinstance(a, Const) for a in args):
            return Const(_SIGNS[node.sign](*(a.value for a in args)))
        return Op(node.sign, args)
    if isinstance(node, Filter):
        args = tuple(map(fold, node.args))
        return Const(FILTERS[node.name](*(a.value for a in args))) if all(isinstance(a, Const) for a in args) else Filter(node.name, args)
    if isinstance(node, Get):
        of, key = fold(node.of), fold(node.key)
        return Const(_lookup(of.value, key.value)) if isinstance(of, Const) and isinstance(key, Const) else Get(of, key)
    if isinstance(node, Emit):
        return Emit(fold(node.value))
    if isinstance(node, Set):
        return Set(node.name, fold(node.value))
    if isinstance(node, For):
        return For(node.name, fold(node.over), fold(node.body))
    if isinstance(node, Generation):
        return Generation(fold(node.body))
    if isinstance(node, If):
        branches, other = [], fold(node.other)
        for condition, body in node.branches:
            condition = fold(condition)
            if isinstance(condition, Const):
                if condition.value:
                    other = fold(body)
                    break
                continue
            branches.append((condition, fold(body)))
        return If(tuple(branches), other) if branches else other
    return node


def _value(node: Any) -> Callable[[dict], Any]:
    if isinstance(node, Const):
        constant = node.value
        return lambda scope: constant
    if isinstance(node, Name):
        name = node.name
        return lambda scope: scope.get(name)
    if isinstance(node, Get):
        of, key = _value(node.of), _value(node.key)
        return lambda scope: _lookup(of(scope), key(scope))
    args = [_value(a) for a in node.args]
    if isinstance(node, Filter):
        run = FILTERS[node.name]
        return lambda scope: run(*(a(scope) for a in args))
    if node.sign == "if":
        return lambda scope: args[1](scope) if args[0](scope) else args[2](scope)
    if node.sign == "and":
        return lambda scope: args[0](scope) and args[1](scope)
    if node.sign == "or":
        return lambda scope: args[0](scope) or args[1](scope)
    run = _SIGNS[node.sign]
    return lambda scope: run(*(a(scope) for a in args))


class _Out:
    def __init__(self) -> None:
        self.parts: list[str] = []
        self.chars = 0
        self.spans: list[tuple[int, int]] = []


def _body(nodes: tuple) -> Callable[[dict, _Out], None]:
    steps = [_step(node) for node in nodes]

    def run(scope: dict, out: _Out) -> None:
        for step in steps:
            step(scope, out)

    return run


def _step(node: Any) -> Callable[[dict, _Out], None]:
    if isinstance(node, Emit):
        value = _value(node.value)

        def emit(scope: dict, out: _Out) -> None:
            text = _text(value(scope))
            out.parts.append(text)
            out.chars += len(text)

        return emit
    if isinstance(node, Set):
        name, value = node.name, _value(node.value)

        def assign(scope: dict, out: _Out) -> None:
            scope[name] = value(scope)

        return assign
    if isinstance(node, Generation):
        inner = _body(node.body)

        def generate(scope: dict, out: _Out) -> None:
            start = out.chars
            inner(scope, out)
            out.spans.append((start, out.chars))

        return generate
    if isinstance(node, If):
        branches = [(_value(condition), _body(body)) for condition, body in node.branches]
        other = _body(node.other)

        def choose(scope: dict, out: _Out) -> None:
            for condition, body in branches:
                if condition(scope):
                    return body(scope, out)
            return other(scope, out)

        return choose
    name, over, inner = node.name, _value(node.over), _body(node.body)

    def loop(scope: dict, out: _Out) -> None:
        items = over(scope) or []
        if not isinstance(items, list | tuple):
            raise TemplateError("for needs a list")
        for k, item in enumerate(items):
            inner({**scope, name: item, "loop": {"index0": k, "index": k + 1, "first": k == 0, "last": k == len(items) - 1}}, out)

    return loop


def compile_template(template: str) -> Callable[[dict], tuple[str, list[tuple[int, int]]]]:
    """A function from names to the rendered text and the character spans under the loss mask."""
    run = _body(fold(parse(template)))

    def render(names: dict) -> tuple[str, list[tuple[int, int]]]:
        out = _Out()
        run(dict(names), out)
        return "".join(out.parts), out.spans

    return render


# ---------------------------------------------------------------- jobs

FORMATTED = "conv_id long, part int, formatted string, spans array<struct<start:int,stop:int>>"
READ_BACK = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
_NO_CONVERSATION = -(1 << 63)


def format_conversations(turns: DataFrame, template: str = TEMPLATE, part_chars: int = PART_CHARS) -> DataFrame:
    """Rendered conversations: conv_id, part, formatted, spans (character spans under the loss mask, within the part).

    Turns are ordered by turn, then role and text (missing values first); a null role or text is empty; repeated rows are turns of their own. Rows without conv_id form one
    conversation. A conversation longer than ``part_chars`` characters comes in several parts, in order, of which only the first has ``first`` set and only
    the last ``last``; one task streams it and holds one part. Other columns are not read; an empty table gives no rows.
    """
    slim = turns.select(
        F.coalesce(F.col("conv_id").cast("long"), F.lit(_NO_CONVERSATION)).alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    ordered = slim.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        render = compile_template(template)
        current, part, held, size = None, 0, [], 0
        rows: list[tuple] = []

        def close(last: bool) -> None:
            text, spans = render({"turns": held, "first": part == 0, "last": last})
            conv = None if current == _NO_CONVERSATION else current
            rows.append((conv, part, text, [{"start": a, "stop": b} for a, b in spans]))

        def flush() -> pa.RecordBatch:
            kind = pa.struct([("start", pa.int32()), ("stop", pa.int32())])
            columns = list(zip(*rows))
            rows.clear()
            types = (pa.int64(), pa.int32(), pa.string(), pa.list_(kind))
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)], ["conv_id", "part", "formatted", "spans"]
            )

        for batch in batches:
            columns = [batch.column(name).to_pylist() for name in ("conv_id", "role", "text")]
            for conv, role, text in zip(*columns):
                if held and conv != current:
                    close(True)
                    held, size, part = [], 0, 0
                elif held and size >= part_chars:
                    close(False)
                    held, size, part = [], 0, part + 1
                    yield flush()
                current = conv
                held.append({"role": role, "text": text})
                size += len(text)
            if rows:
                yield flush()
        if held:
            close(True)
            yield flush()

    return ordered.mapInArrow(run, FORMATTED)


def turns_of(formatted: str) -> Iterator[tuple[str, str]]:
    """Role and text of each turn of a text in the standard template."""
    for user, role, text, answer in (m.groups() for m in _TURN.finditer(formatted.removeprefix("<s>"))):
        if user is not None:
            yield "user", unescape(user)
        elif role is not None:
            yield unescape(role), unescape(text)
        else:
            yield "assistant", unescape(answer)


def read_back(formatted: DataFrame) -> DataFrame:
    """Figures of each conversation, read from the output of :func:`format_conversations` (parts in its order).

    Returns conv_id, n_turns, turns_sha256 (role, newline, text, newline per turn), loss_chars and loss_sha256 (text under the loss mask, unescaped),
    formatted_chars.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        types = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
        state: list | None = None

        def result(states: list[list]) -> pa.RecordBatch:
            rows = [(c, n, a.hexdigest(), chars, b.hexdigest(), total) for c, n, a, chars, b, total in states]
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), types)], names)

        for batch in batches:
            done = []
            columns = [batch.column(name).to_pylist() for name in ("conv_id", "part", "formatted", "spans")]
            for conv, part, text, spans in zip(*columns):
                if part == 0:
                    if state:
                        done.append(state)
                    state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, said in turns_of(text):
                    state[1] += 1
                    state[2].update(f"{role}\n{said}\n".encode())
                for span in spans:
                    learned = unescape(text[span["start"] : span["stop"]])
                    state[3] += len(learned)
                    state[4].update(learned.encode())
                state[5] += len(text)
            if done:
                yield result(done)
        if state:
            yield result([state])

    return formatted.mapInArrow(run, READ_BACK)


ORACLE_SQL = r"""
with turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -1, 0, 'user', '</s>[INST] ok [/INST]'
  union all select -1, 1, 'assistant', '</s>[INST] ok [/INST]'
),
sized as (
  select *, length(regexp_replace(text, '\\|<s>|</s>|\[/?INST\]|\[/?ROLE\]|\[END\]', 'xx', 'g')) as text_chars,
    length(regexp_replace(role, '\\|<s>|</s>|\[/?INST\]|\[/?ROLE\]|\[END\]', 'xx', 'g')) as role_chars
  from turns
)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
  coalesce(sum(length(text)) filter (where role = 'assistant'), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (where role = 'assistant'), '')) as loss_sha256,
  (3 + sum(text_chars + case role when 'user' then 15 when 'assistant' then 4 else 18 + role_chars end))::bigint as formatted_chars
from sized group by conv_id
"""
