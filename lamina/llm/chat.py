"""Chat formatting with a compiled, sandboxed template language.

A template is text with {{ expression }}, {% for x in name %}, {% if %} {% elif %} {% else %},
and {% generation %} ... {% endgeneration %}, which marks what a model is trained on.
Expressions are names, one attribute level (turn.text), string and whole-number literals, ==,
!=, +, and, or, not, parentheses and the filters FILTERS; there are no calls, no indexing and
no access to Python objects.  The source is parsed into a syntax tree, constant parts are
folded (joined text, constant expressions and filters, branches whose test is known), and
each node becomes a Python closure that writes to an output with a generation mark.

Text from users can hold the template's own control strings.  The filter escape makes them
harmless reversibly: a backslash is doubled, and one is put behind the first character of
each control string; parse_turns takes them out again.

A template runs over a whole conversation, so that what stands outside its loops comes once.
The messages are a stream of rows sorted by conversation and turn within a partition: a
template with one loop over them takes a row at a time, and a conversation of any number of
turns is never held.  A template that uses the messages otherwise (in two loops, one inside
another, or in a test) has them as a list of one conversation.

Cases: null text or role is empty; turns with equal numbers come in the order of role, then
text; null conv_id is a conversation of its own; no rows give no conversations; further columns
are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _io

CONTROL = ("<s>", "</s>", "[INST]", "[/INST]", "<<ROLE>>", "<</ROLE>>")
_CONTROL = re.compile("|".join(re.escape(c) for c in CONTROL))
_ESCAPED = re.compile(r"\\(.)", re.S)

TEMPLATE = (
    "{% for turn in messages %}"
    "{% if turn.role == 'user' %}<s>[INST] {{ turn.text | escape }} [/INST]"
    "{% elif turn.role == 'assistant' %} {% generation %}{{ turn.text | escape }}{% endgeneration %}</s>"
    "{% else %}<<ROLE>>{{ turn.role | escape }}<</ROLE>>{{ turn.text | escape }}</s>"
    "{% endif %}{% endfor %}"
)


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: m[0][0] + "\\" + m[0][1:], text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


FILTERS: dict[str, Callable[[str], str]] = {"escape": escape, "trim": lambda s: s.strip(), "upper": lambda s: s.upper(), "lower": lambda s: s.lower()}


class TemplateError(ValueError):
    pass


# Syntax tree.  Expressions: Const, Name, Op, Filter.  Statements: Text, Out, For, If, Gen.
@dataclass(frozen=True)
class Const:
    value: object


@dataclass(frozen=True)
class Name:
    path: tuple[str, ...]


@dataclass(frozen=True)
class Op:
    kind: str
    args: tuple


@dataclass(frozen=True)
class Filter:
    name: str
    arg: object


@dataclass(frozen=True)
class Text:
    text: str


@dataclass(frozen=True)
class Out:
    expr: object


@dataclass(frozen=True)
class For:
    var: str
    over: str
    body: tuple


@dataclass(frozen=True)
class If:
    arms: tuple  # of (test, body)


@dataclass(frozen=True)
class Gen:
    body: tuple


_TAG = re.compile(r"\{\{(.*?)\}\}|\{%(.*?)%\}", re.S)
_TOKEN = re.compile(r"\s*(?:('(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\")|(\d+)|([A-Za-z_]\w*(?:\.[A-Za-z_]\w*)?)|(==|!=|[+|()]))", re.S)
_WORDS = {"and", "or", "not"}


class _Expression:
    """Precedence from loose to tight: or, and, not, comparison, +, filters."""

    def __init__(self, source: str):
        self.tokens, at, source = [], 0, source.strip()
        while at < len(source):
            m = _TOKEN.match(source, at)
            if not m:
                raise TemplateError(f"can't read {source[at:]!r}")
            self.tokens.append(m)
            at = m.end()
        self.at = 0

    def peek(self) -> str | None:
        return self.tokens[self.at][0].strip() if self.at < len(self.tokens) else None

    def take(self, *wanted: str) -> str | None:
        if self.peek() in wanted:
            self.at += 1
            return self.tokens[self.at - 1][0].strip()
        return None

    def whole(self):
        out = self.either()
        if self.peek() is not None:
            raise TemplateError(f"unexpected {self.peek()!r}")
        return out

    def either(self):
        out = self.both()
        while self.take("or"):
            out = Op("or", (out, self.both()))
        return out

    def both(self):
        out = self.negation()
        while self.take("and"):
            out = Op("and", (out, self.negation()))
        return out

    def negation(self):
        return Op("not", (self.negation(),)) if self.take("not") else self.comparison()

    def comparison(self):
        out = self.addition()
        if kind := self.take("==", "!="):
            out = Op(kind, (out, self.addition()))
        return out

    def addition(self):
        out = self.filtered()
        while self.take("+"):
            out = Op("+", (out, self.filtered()))
        return out

    def filtered(self):
        out = self.atom()
        while self.take("|"):
            name = self.peek()
            if name not in FILTERS:
                raise TemplateError(f"no filter {name!r}")
            self.at += 1
            out = Filter(name, out)
        return out

    def atom(self):
        if self.take("("):
            out = self.either()
            if not self.take(")"):
                raise TemplateError("a parenthesis isn't closed")
            return out
        if self.at >= len(self.tokens):
            raise TemplateError("an expression ends too early")
        m = self.tokens[self.at]
        self.at += 1
        if m[1]:
            return Const(re.sub(r"\\(.)", lambda e: {"n": "\n", "t": "\t"}.get(e[1], e[1]), m[1][1:-1]))
        if m[2]:
            return Const(int(m[2]))
        if m[3] and m[3] not in _WORDS:
            path = tuple(m[3].split("."))
            if any(p.startswith("_") for p in path):
                raise TemplateError(f"{m[3]!r} isn't allowed")
            return Name(path)
        raise TemplateError(f"unexpected {m[0].strip()!r}")


def parse(source: str) -> tuple:
    """The syntax tree of a template."""
    parts, at = [], 0
    for m in _TAG.finditer(source):
        if m.start() > at:
            parts.append(("text", source[at : m.start()]))
        parts.append(("out", m[1]) if m[1] is not None else ("tag", m[2].strip()))
        at = m.end()
    if at < len(source):
        parts.append(("text", source[at:]))
    parts.reverse()

    def body(*ends: str) -> tuple[tuple, str]:
        out = []
        while parts:
            kind, text = parts.pop()
            word = text.split(None, 1)[0] if kind == "tag" and text else ""
            if kind == "text":
                out.append(Text(text))
            elif kind == "out":
                out.append(Out(_Expression(text).whole()))
            elif word in ends:
                return tuple(out), text
            elif word == "for":
                m = re.fullmatch(r"for\s+([A-Za-z]\w*)\s+in\s+([A-Za-z]\w*)", text)
                if not m:
                    raise TemplateError(f"can't read {text!r}")
                out.append(For(m[1], m[2], body("endfor")[0]))
            elif word == "if":
                arms, test = [], text[2:]
                while True:
                    inner, end = body("elif", "else", "endif")
                    arms.append((_Expression(test).whole(), inner))
                    if end.startswith("elif"):
                        test = end[4:]
                    elif end == "else":
                        arms.append((Const(True), body("endif")[0]))
                        break
                    else:
                        break
                out.append(If(tuple(arms)))
            elif word == "generation":
                out.append(Gen(body("endgeneration")[0]))
            else:
                raise TemplateError(f"unexpected tag {text!r}")
        if ends:
            raise TemplateError(f"{ends[-1]} is missing")
        return tuple(out), ""

    return body()[0]


def fold_expression(e):
    """e with its constant parts computed."""
    if isinstance(e, Filter):
        arg = fold_expression(e.arg)
        return Const(FILTERS[e.name](str(arg.value))) if isinstance(arg, Const) else Filter(e.name, arg)
    if isinstance(e, Op):
        args = tuple(fold_expression(a) for a in e.args)
        if all(isinstance(a, Const) for a in args):
            return Const(_apply(e.kind, [lambda scope, v=a.value: v for a in args], {}))
        if e.kind in ("and", "or") and isinstance(args[0], Const):
            return args[1] if bool(args[0].value) == (e.kind == "and") else args[0]
        return Op(e.kind, args)
    return e


def fold(nodes: tuple) -> tuple:
    """nodes with constants computed, neighbouring text joined, and branches of known tests chosen."""
    out: list = []

    def put(node) -> None:
        if isinstance(node, Text) and out and isinstance(out[-1], Text):
            out[-1] = Text(out[-1].text + node.text)
        elif not (isinstance(node, Text) and not node.text):
            out.append(node)

    for node in nodes:
        if isinstance(node, Out):
            e = fold_expression(node.expr)
            put(Text(str(e.value)) if isinstance(e, Const) else Out(e))
        elif isinstance(node, For):
            put(For(node.var, node.over, fold(node.body)))
        elif isinstance(node, Gen):
            put(Gen(fold(node.body)))
        elif isinstance(node, If):
            arms = []
            for test, inner in node.arms:
                test = fold_expression(test)
                if isinstance(test, Const) and not test.value:
                    continue
                arms.append((test, fold(inner)))
                if isinstance(test, Const):
                    break
            if arms and isinstance(arms[0][0], Const):
                for n in arms[0][1]:
                    put(n)
            elif arms:
                put(If(tuple(arms)))
        else:
            put(node)
    return tuple(out)


def _apply(kind: str, args: list[Callable], scope: dict):
    a = args[0](scope)
    if kind == "not":
        return not a
    if kind == "and":
        return a and args[1](scope)
    if kind == "or":
        return a or args[1](scope)
    b = args[1](scope)
    if kind == "+":
        return a + b if isinstance(a, int) and isinstance(b, int) else str(a) + str(b)
    return (a == b) if kind == "==" else (a != b)


def _expression(e) -> Callable[[dict], object]:
    if isinstance(e, Const):
        return lambda scope: e.value
    if isinstance(e, Name):
        if len(e.path) == 1:
            key = e.path[0]
            return lambda scope: scope.get(key, "")
        one, two = e.path
        return lambda scope: scope[one].get(two, "") if isinstance(scope.get(one), dict) else ""
    if isinstance(e, Filter):
        f, arg = FILTERS[e.name], _expression(e.arg)
        return lambda scope: f(str(arg(scope)))
    args = [_expression(a) for a in e.args]
    kind = e.kind
    return lambda scope: _apply(kind, args, scope)


Piece = tuple[str, bool]  # text, and whether it is under the generation mark


def _statement(node) -> Callable[[dict, bool], Iterator[Piece]]:
    if isinstance(node, Text):

        def run(scope, marked):
            yield node.text, marked
    elif isinstance(node, Out):
        value = _expression(node.expr)

        def run(scope, marked):
            yield str(value(scope)), marked
    elif isinstance(node, Gen):
        inner = _body(node.body)

        def run(scope, marked):
            yield from inner(scope, True)
    elif isinstance(node, For):
        inner, var, over = _body(node.body), node.var, node.over

        def run(scope, marked):
            for x in scope.get(over, ()):
                yield from inner({**scope, var: x}, marked)
    else:
        arms = [(_expression(t), _body(b)) for t, b in node.arms]

        def run(scope, marked):
            for test, inner in arms:
                if test(scope):
                    yield from inner(scope, marked)
                    return

    return run


def _body(nodes: tuple) -> Callable[[dict, bool], Iterator[Piece]]:
    runs = [_statement(n) for n in nodes]

    def run(scope, marked):
        for r in runs:
            yield from r(scope, marked)

    return run


def takes_stream(nodes: tuple) -> bool:
    """Whether a template reads messages in one loop, once, and nowhere else."""

    def uses(e) -> int:
        if isinstance(e, Name):
            return 2 * (e.path[0] == "messages")
        if isinstance(e, Filter):
            return uses(e.arg)
        return sum(uses(a) for a in e.args) if isinstance(e, Op) else 0

    def count(nodes: tuple, depth: int) -> int:
        n = 0
        for x in nodes:
            if isinstance(x, Out):
                n += uses(x.expr)
            elif isinstance(x, For):
                n += (x.over == "messages") * (2 if depth else 1) + count(x.body, depth + 1)
            elif isinstance(x, Gen):
                n += count(x.body, depth)
            elif isinstance(x, If):
                n += sum(uses(t) + count(b, depth) for t, b in x.arms)
        return n

    return count(nodes, 0) <= 1


def compile_template(source: str) -> Callable[[Iterator[dict]], Iterator[Piece]]:
    """A function from messages (dicts of role and text, any iterable) to pieces of text with their generation mark."""
    tree = fold(parse(source))
    run, stream = _body(tree), takes_stream(tree)
    return lambda messages: run({"messages": messages if stream else list(messages)}, False)


def render(source: str, messages: list[dict]) -> tuple[str, list[tuple[int, int]]]:
    """The whole text and the generation spans in it (code points)."""
    text, spans, at = [], [], 0
    for piece, marked in compile_template(source)(messages):
        if marked and piece:
            if spans and spans[-1][1] == at:
                spans[-1] = (spans[-1][0], at + len(piece))
            else:
                spans.append((at, at + len(piece)))
        text.append(piece)
        at += len(piece)
    return "".join(text), spans


_TURN = re.compile(r"<s>\[INST\] (?P<user>.*?) \[/INST\](?=<s>\[INST\]| |<<ROLE>>|\Z)| (?P<bot>.*?)</s>|<<ROLE>>(?P<role>.*?)<</ROLE>>(?P<other>.*?)</s>", re.S)


def parse_turns(text: str) -> Iterator[tuple[str, str]]:
    """(role, text) of every turn of a text that TEMPLATE made."""
    at = 0
    while at < len(text):
        m = _TURN.match(text, at)
        if not m:
            raise ValueError(f"no turn at {at}")
        if m["user"] is not None:
            yield "user", unescape(m["user"])
        elif m["bot"] is not None:
            yield "assistant", unescape(m["bot"])
        else:
            yield unescape(m["role"]), unescape(m["other"])
        at = m.end()


_FORMATTED = pa.schema([("conv_id", pa.int64()), ("part", pa.int64()), ("text", pa.string()), ("marks", pa.list_(pa.int64()))])


def sorted_turns(conversations: DataFrame) -> DataFrame:
    """Rows of a conversation together in one partition and in order."""
    c = _io.keyed(conversations, "conv_id", "turn", "role", "text").select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return c.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")


def format_conversations(conversations: DataFrame, template: str = TEMPLATE, part_chars: int = 1 << 22) -> DataFrame:
    """conv_id, part, text and marks (begin and end of generation spans in turn).

    A conversation's text is the texts of its parts in order: parts close before a turn once they
    hold part_chars code points, so that only longer conversations have more than one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled = compile_template(template)
        rows = ((conv, role, text) for batch in batches for conv, role, text in zip(*(batch.column(n).to_pylist() for n in ("conv_id", "role", "text")), strict=True))
        ahead = next(rows, None)

        def turns(conv: int | None) -> Iterator[dict]:
            """The rest of the conversation that ahead is in."""
            nonlocal ahead
            while ahead is not None and ahead[0] == conv:
                _, role, text = ahead
                ahead = next(rows, None)
                yield {"role": role, "text": text}

        out, held = [], 0
        while ahead is not None:
            conv, part, text, marks, at, fresh = ahead[0], 0, [], [], 0, False

            def told(messages: Iterator[dict]) -> Iterator[dict]:
                nonlocal fresh
                for m in messages:
                    fresh = True
                    yield m

            own = turns(conv)
            for piece, marked in compiled(told(own)):
                if fresh and at >= part_chars:
                    out.append((conv, part, "".join(text), marks))
                    part, text, marks, at = part + 1, [], [], 0
                    if held > part_chars:
                        yield _io.batch(_FORMATTED, *(list(c) for c in zip(*out, strict=True)))
                        out, held = [], 0
                fresh = False
                if marked and piece:
                    marks += [at, at + len(piece)]
                text.append(piece)
                at += len(piece)
                held += len(piece)
            for _ in own:  # turns that the template didn't ask for
                pass
            out.append((conv, part, "".join(text), marks))
            if held > part_chars or len(out) >= 4096:
                yield _io.batch(_FORMATTED, *(list(c) for c in zip(*out, strict=True)))
                out, held = [], 0
        if out:
            yield _io.batch(_FORMATTED, *(list(c) for c in zip(*out, strict=True)))

    return sorted_turns(conversations).mapInArrow(run, _io.ddl(_FORMATTED))


_DIGEST = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])


def digest_formatted(formatted: DataFrame) -> DataFrame:
    """What is read back from format_conversations' rows, whose conversations stand together and in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: list | None = None
        out: list[tuple] = []

        def close() -> None:
            if own is not None:
                out.append((own[0], own[1], own[2].hexdigest(), own[3], own[4].hexdigest(), own[5]))

        for batch in batches:
            for conv, part, text, marks in zip(*(batch.column(n).to_pylist() for n in _FORMATTED.names), strict=True):
                if own is None or part == 0:
                    close()
                    own = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, said in parse_turns(text):
                    own[1] += 1
                    own[2].update(f"{role}\n{said}\n".encode())
                for a, b in zip(marks[::2], marks[1::2], strict=True):
                    loss = unescape(text[a:b])
                    own[3] += len(loss)
                    own[4].update(loss.encode())
                own[5] += len(text)
            if out:
                yield _io.batch(_DIGEST, *(list(c) for c in zip(*out, strict=True)))
                out = []
        close()
        if out:
            yield _io.batch(_DIGEST, *(list(c) for c in zip(*out, strict=True)))

    return formatted.mapInArrow(run, _io.ddl(_DIGEST))
