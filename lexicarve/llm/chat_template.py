r"""Chat formatting with a compiled template language.

A template is parsed into a syntax tree, constant expressions are folded
(adjacent text is joined, branches with a constant test are dropped) and
the tree is turned into Python closures, each a generator of (text, loss)
chunks. Rendering is lazy: a ``for`` loop over the messages pulls one
message at a time, so a conversation of any length needs memory for one
message. ``{% generation %}`` marks what the loss mask covers.

The language: ``{{ expr }}``, ``{% if / elif / else / endif %}``,
``{% for x in expr %} ... {% endfor %}`` with ``loop.first``, ``loop.last``
and ``loop.index``, ``{% set x = expr %}``, ``{% generation %}``,
``{# comment #}`` and ``-`` to trim white space. Expressions have
literals, names, ``a.b``, ``a['b']``, filters, ``~``, ``+``, comparisons,
``in``, ``and``, ``or``, ``not`` and ``a if b else c``. It is sandboxed:
there are no calls, attributes are dictionary keys, names are those given
to the template, loops run over given sequences, and filters are listed.

Texts are escaped reversibly: a backslash is doubled and a control string
gets a backslash after its first character, so no text can look like a
marker. ``read_back`` parses formatted text into turns again.

Spark: rows are partitioned by conversation and sorted by turn once;
formatting and reading back are streamed over the sorted rows.

Defined cases: a null text or role is empty; turns with equal numbers are
ordered by role and text (null first); rows with a null conversation id
form one conversation; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_arrow

TURN, END = "<|turn|>", "<|end|>"
# Strings that chat models read as control. "<|" opens every marker of that form.
CONTROL = ["<|", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"]
_ESCAPE = re.compile("|".join(re.escape(c) for c in ["\\", *CONTROL]))
_UNESCAPE = re.compile(r"\\(\\|n|)")

CHAT = ("{# one turn after the other; the loss covers what the assistant says #}"
        "{% for m in messages %}{{ '<|' ~ 'turn' ~ '|>' }}{{ m.role | escape_line }}\n"
        "{%- set own = m.text | escape %}{{ '\\n' }}"
        "{% if m.role == 'assistant' %}{% generation %}{{ own }}{% endgeneration %}{% else %}{{ own }}{% endif %}"
        "<|end|>{% endfor %}")


class TemplateError(ValueError):
    pass


def escape(text: str) -> str:
    return _ESCAPE.sub(lambda m: "\\\\" if m[0] == "\\" else f"{m[0][0]}\\{m[0][1:]}", text)


def escape_line(text: str) -> str:
    """Also keeps the text on one line."""
    return escape(text).replace("\n", "\\n")


def unescape(text: str) -> str:
    return _UNESCAPE.sub(lambda m: {"\\": "\\", "n": "\n", "": ""}[m[1]], text) if "\\" in text else text


FILTERS: dict[str, Callable[[str], object]] = {
    "escape": escape, "escape_line": escape_line, "trim": str.strip, "upper": str.upper, "lower": str.lower,
    "length": len, "string": str,
}


# --- syntax tree ---------------------------------------------------------------------------------------------------

@dataclass
class Const:
    value: object


@dataclass
class Name:
    name: str


@dataclass
class Get:
    of: object
    key: object


@dataclass
class Filter:
    of: object
    name: str


@dataclass
class Op:
    op: str
    args: list


@dataclass
class Text:
    text: str


@dataclass
class Output:
    expr: object


@dataclass
class If:
    branches: list  # (test or None, body)


@dataclass
class For:
    var: str
    over: object
    body: list


@dataclass
class Set:
    var: str
    expr: object


@dataclass
class Generation:
    body: list


# --- parser --------------------------------------------------------------------------------------------------------

_PART = re.compile(r"\{\{-?(.*?)-?\}\}|\{%-?(.*?)-?%\}|\{#-?(.*?)-?#\}", re.S)
_TOKEN = re.compile(r"""\s*(?:('(?:\\.|[^'\\])*'|"(?:\\.|[^"\\])*")|(\d+(?:\.\d+)?)|([A-Za-z_]\w*)|(==|!=|<=|>=|[<>~+|.()\[\]=]))""", re.S)
_STRING = {"n": "\n", "t": "\t", "r": "\r"}


class _Expr:
    """Recursive-descent parser of one expression."""

    def __init__(self, source: str):
        self.tokens, at, source = [], 0, source.rstrip()
        while at < len(source):
            m = _TOKEN.match(source, at)
            if not m:
                raise TemplateError(f"unexpected {source[at:at + 10]!r}")
            self.tokens.append((m.lastindex, m[m.lastindex]))
            at = m.end()
        self.at = 0

    def peek(self):
        return self.tokens[self.at] if self.at < len(self.tokens) else (0, "")

    def eat(self, *values):
        if self.peek()[0] in (3, 4) and self.peek()[1] in values:
            self.at += 1
            return self.tokens[self.at - 1][1]
        return None

    def need(self, value):
        if not self.eat(value):
            raise TemplateError(f"expected {value!r}, found {self.peek()[1]!r}")

    def name(self) -> str:
        kind, value = self.peek()
        if kind != 3:
            raise TemplateError(f"expected a name, found {value!r}")
        self.at += 1
        return value

    def end(self):
        if self.at < len(self.tokens):
            raise TemplateError(f"unexpected {self.peek()[1]!r}")

    def expr(self):
        value = self.either()
        if self.eat("if"):
            test = self.either()
            self.need("else")
            return Op("cond", [test, value, self.expr()])
        return value

    def either(self):
        value = self.both()
        while self.eat("or"):
            value = Op("or", [value, self.both()])
        return value

    def both(self):
        value = self.negated()
        while self.eat("and"):
            value = Op("and", [value, self.negated()])
        return value

    def negated(self):
        if self.eat("not"):
            return Op("not", [self.negated()])
        value = self.joined()
        while op := self.eat("==", "!=", "<", "<=", ">", ">=", "in", "not"):
            if op == "not":
                self.need("in")
                value = Op("not", [Op("in", [value, self.joined()])])
            else:
                value = Op(op, [value, self.joined()])
        return value

    def joined(self):
        value = self.postfix()
        while op := self.eat("~", "+"):
            value = Op(op, [value, self.postfix()])
        return value

    def postfix(self):
        value = self.primary()
        while op := self.eat(".", "[", "|"):
            if op == ".":
                value = Get(value, Const(self.name()))
            elif op == "[":
                value = Get(value, self.expr())
                self.need("]")
            else:
                name = self.name()
                if name not in FILTERS:
                    raise TemplateError(f"no filter {name!r}")
                value = Filter(value, name)
        return value

    def primary(self):
        kind, value = self.peek()
        if self.eat("("):
            inner = self.expr()
            self.need(")")
            return inner
        self.at += 1
        if kind == 1:
            return Const(re.sub(r"\\(.)", lambda m: _STRING.get(m[1], m[1]), value[1:-1], flags=re.S))
        if kind == 2:
            return Const(float(value) if "." in value else int(value))
        if kind == 3:
            words = {"true": True, "false": False, "none": None}
            return Const(words[value.lower()]) if value.lower() in words else Name(value)
        raise TemplateError(f"unexpected {value!r}")


def _expression(source: str):
    p = _Expr(source)
    out = p.expr()
    p.end()
    return out


def parse(template: str) -> list:
    """Syntax tree of a template: a list of statements."""
    parts, at = [], 0
    for m in _PART.finditer(template):
        text = template[at:m.start()]
        parts.append(["text", text.rstrip() if m[0][2] == "-" else text])
        parts.append([("expr", "stmt", "note")[m.lastindex - 1], m[m.lastindex].strip()])
        at = m.end()
        if m[0][-3] == "-":
            at += len(template[at:]) - len(template[at:].lstrip())
    parts.append(["text", template[at:]])
    body, stop, rest = _body(parts, 0, ())
    return body


def _body(parts: list, at: int, until: tuple):
    out = []
    while at < len(parts):
        kind, value = parts[at]
        at += 1
        if kind == "text" and value:
            out.append(Text(value))
        elif kind == "expr":
            out.append(Output(_expression(value)))
        elif kind == "stmt":
            word, _, rest = value.partition(" ")
            if word in until:
                return out, (word, rest), at
            if word == "if":
                branches, test = [], _expression(rest)
                while True:
                    body, (word, rest), at = _body(parts, at, ("elif", "else", "endif"))
                    branches.append((test, body))
                    if word == "endif":
                        break
                    test = _expression(rest) if word == "elif" else None
                out.append(If(branches))
            elif word == "for":
                p = _Expr(rest)
                var = p.name()
                p.need("in")
                over = p.expr()
                p.end()
                body, _, at = _body(parts, at, ("endfor",))
                out.append(For(var, over, body))
            elif word == "set":
                p = _Expr(rest)
                var = p.name()
                p.need("=")
                expr = p.expr()
                p.end()
                out.append(Set(var, expr))
            elif word == "generation":
                body, _, at = _body(parts, at, ("endgeneration",))
                out.append(Generation(body))
            else:
                raise TemplateError(f"unknown statement {word!r}")
    if until:
        raise TemplateError(f"missing {until[-1]!r}")
    return out, ("", ""), at


# --- constant folding ----------------------------------------------------------------------------------------------

def fold_expr(e):
    if isinstance(e, Get):
        e = Get(fold_expr(e.of), fold_expr(e.key))
    elif isinstance(e, Filter):
        e = Filter(fold_expr(e.of), e.name)
        if isinstance(e.of, Const):
            return Const(_value(e)({}))
    elif isinstance(e, Op):
        e = Op(e.op, [fold_expr(a) for a in e.args])
        if all(isinstance(a, Const) for a in e.args):
            return Const(_value(e)({}))
        if e.op == "cond" and isinstance(e.args[0], Const):
            return e.args[1] if e.args[0].value else e.args[2]
    return e


def fold(body: list) -> list:
    """The same statements with constants worked out and neighbouring text joined."""
    out: list = []

    def put(node):
        if isinstance(node, Text) and out and isinstance(out[-1], Text):
            out[-1] = Text(out[-1].text + node.text)
        elif not (isinstance(node, Text) and not node.text):
            out.append(node)

    for node in body:
        if isinstance(node, Output):
            e = fold_expr(node.expr)
            put(Text(_shown(e.value)) if isinstance(e, Const) else Output(e))
        elif isinstance(node, If):
            branches = []
            for test, inner in node.branches:
                test = fold_expr(test) if test is not None else None
                if isinstance(test, Const) and not test.value:
                    continue
                test = None if isinstance(test, Const) else test
                branches.append((test, fold(inner)))
                if test is None:
                    break
            if branches and branches[0][0] is None:
                for inner in branches[0][1]:
                    put(inner)
            elif branches:
                put(If(branches))
        elif isinstance(node, For):
            put(For(node.var, fold_expr(node.over), fold(node.body)))
        elif isinstance(node, Set):
            put(Set(node.var, fold_expr(node.expr)))
        elif isinstance(node, Generation):
            put(Generation(fold(node.body)))
        else:
            put(node)
    return out


# --- closures ------------------------------------------------------------------------------------------------------

def _shown(value) -> str:
    return "" if value is None else str(value)


_BINARY = {
    "==": lambda a, b: a == b, "!=": lambda a, b: a != b, "<": lambda a, b: a < b, "<=": lambda a, b: a <= b,
    ">": lambda a, b: a > b, ">=": lambda a, b: a >= b, "in": lambda a, b: a in b,
    "~": lambda a, b: _shown(a) + _shown(b), "+": lambda a, b: a + b,
}


def _value(e) -> Callable[[dict], object]:
    """Closure that works out an expression in a context."""
    if isinstance(e, Const):
        v = e.value
        return lambda ctx: v
    if isinstance(e, Name):
        name = e.name
        return lambda ctx: ctx.get(name)
    if isinstance(e, Get):
        of, key = _value(e.of), _value(e.key)

        def get(ctx):
            found, k = of(ctx), key(ctx)
            if isinstance(found, dict):
                return found.get(k)
            if isinstance(found, list) and isinstance(k, int):
                return found[k] if -len(found) <= k < len(found) else None
            return None
        return get
    if isinstance(e, Filter):
        of, fn = _value(e.of), FILTERS[e.name]
        return lambda ctx: fn(_shown(of(ctx)))
    args = [_value(a) for a in e.args]
    if e.op == "cond":
        return lambda ctx: args[1](ctx) if args[0](ctx) else args[2](ctx)
    if e.op == "not":
        return lambda ctx: not args[0](ctx)
    if e.op == "and":
        return lambda ctx: args[0](ctx) and args[1](ctx)
    if e.op == "or":
        return lambda ctx: args[0](ctx) or args[1](ctx)
    fn = _BINARY[e.op]
    return lambda ctx: fn(args[0](ctx), args[1](ctx))


Chunks = Iterator[tuple[str, bool]]


def _block(body: list) -> Callable[[dict], Chunks]:
    steps = [_statement(node) for node in body]

    def run(ctx):
        for step in steps:
            yield from step(ctx)
    return run


def _statement(node) -> Callable[[dict], Chunks]:
    if isinstance(node, Text):
        chunk = ((node.text, False),)
        return lambda ctx: chunk
    if isinstance(node, Output):
        value = _value(node.expr)
        return lambda ctx: ((_shown(value(ctx)), False),)
    if isinstance(node, If):
        branches = [(_value(t) if t is not None else None, _block(b)) for t, b in node.branches]

        def choose(ctx):
            for test, body in branches:
                if test is None or test(ctx):
                    return body(ctx)
            return ()
        return choose
    if isinstance(node, For):
        over, body, var = _value(node.over), _block(node.body), node.var

        def loop(ctx):
            items = iter(over(ctx) or ())
            item, index = next(items, None), 1
            while item is not None:  # one item is read ahead to know the last
                after = next(items, None)
                inner = ctx | {var: item, "loop": {"first": index == 1, "last": after is None, "index": index}}
                yield from body(inner)
                item, index = after, index + 1
        return loop
    if isinstance(node, Set):
        value, var = _value(node.expr), node.var

        def assign(ctx):
            ctx[var] = value(ctx)
            return ()
        return assign
    body = _block(node.body)
    return lambda ctx: ((text, True) for text, _ in body(ctx))


def compile_template(template: str) -> Callable[[dict], Chunks]:
    """Renderer of a template: takes the context, yields (text, covered by the loss mask)."""
    return _block(fold(parse(template)))


# --- Spark ---------------------------------------------------------------------------------------------------------

def _batches(rows: Iterator[tuple], names: list[str], types: list, limit: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Rows in record batches of about ``limit`` characters."""
    held, size = [], 0
    for r in rows:
        held.append(r)
        size += 64 + sum(len(x) for x in r if isinstance(x, str))
        if size >= limit:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names=names)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names=names)


def _groups(rows: Iterator[tuple]) -> Iterator[tuple[object, Iterator[tuple]]]:
    """Runs of rows with the same first field, lazily."""
    import itertools

    return itertools.groupby(rows, key=lambda r: r[0])


def _rows(batches) -> Iterator[tuple]:
    for b in batches:
        yield from zip(*(c.to_pylist() for c in b.columns))


def _merged(chunks: Chunks) -> Chunks:
    """Neighbouring chunks of one kind joined."""
    text, kind = [], False
    for t, loss in chunks:
        if t:
            if loss != kind and text:
                yield "".join(text), kind
                text = []
            kind = loss
            text.append(t)
            if not loss and sum(map(len, text)) >= 1 << 16:
                yield "".join(text), kind
                text = []
    if text:
        yield "".join(text), kind


def format_conversations(rows: DataFrame, template: str = CHAT, conv: str = "conv_id", turn: str = "turn",
                         role: str = "role", text: str = "text") -> DataFrame:
    """(conv, piece, text, loss): the formatted conversation is the pieces' text in order; ``loss`` marks the mask."""
    d = rows.select(F.col(conv).alias("c"), F.col(turn).alias("n"), F.col(role).alias("r"), F.col(text).alias("t"))
    kind = d.schema["c"].dataType.simpleString()
    d = d.repartition("c").sortWithinPartitions("c", "n", "r", "t").select("c", "r", "t")

    def run(batches):
        render = compile_template(template)
        arrow = None

        def pieces(rows):
            for c, own in _groups(rows):
                messages = ({"role": r or "", "text": t or ""} for _, r, t in own)
                for i, (t, loss) in enumerate(_merged(render({"messages": messages}))):
                    yield c, i, t, loss

        for b in _peeked(batches):
            if arrow is None:
                arrow = b.type
                continue
            yield from _batches(pieces(_rows(b.rest)), ["c", "piece", "text", "loss"], [arrow, pa.int64(), pa.string(), pa.bool_()])

    out = in_arrow(d, run, f"c {kind}, piece long, text string, loss boolean")
    return out.withColumnRenamed("c", conv)


class _Peek:
    def __init__(self, type=None, rest=None):
        self.type, self.rest = type, rest


def _peeked(batches):
    """The type of the first column, then the batches."""
    import itertools

    batches = iter(batches)
    first = next(batches, None)
    if first is not None:
        yield _Peek(type=first.column(0).type)
        yield _Peek(rest=itertools.chain([first], batches))


def read_turns(chunks: Iterator[tuple[str, bool]]) -> Iterator[tuple[str, str]]:
    """(role, text) of each turn of a formatted conversation, read from its markers."""
    held = ""
    for t, _ in chunks:
        held += t
        while (at := held.find(END)) >= 0:
            head, _, body = held[:at].partition("\n")
            if not head.startswith(TURN):
                raise ValueError("a turn does not start with its marker")
            yield unescape(head[len(TURN):]), unescape(body)
            held = held[at + len(END):]
    if held:
        raise ValueError("text after the last turn")


def read_back(pieces: DataFrame, conv: str = "conv_id") -> DataFrame:
    """(conv, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars) from formatted pieces.

    Streams over pieces that are still in order, as ``format_conversations`` returns them.
    """
    d = pieces.select(F.col(conv).alias("c"), "text", "loss")
    schema = (f"c {d.schema['c'].dataType.simpleString()}, n_turns long, turns_sha256 string, loss_chars long, "
              "loss_sha256 string, formatted_chars long")

    def digests(rows):
        for c, own in _groups(rows):
            loss, turns, n_loss, n_all, n = hashlib.sha256(), hashlib.sha256(), 0, 0, 0

            def watched():
                nonlocal n_loss, n_all
                for _, t, covered in own:
                    n_all += len(t)
                    if covered:
                        plain = unescape(t)
                        n_loss += len(plain)
                        loss.update(plain.encode())
                    yield t, covered

            for role, text in read_turns(watched()):
                turns.update(f"{role}\n{text}\n".encode())
                n += 1
            yield c, n, turns.hexdigest(), n_loss, loss.hexdigest(), n_all

    def run(batches):
        arrow = None
        for b in _peeked(batches):
            if arrow is None:
                arrow = b.type
                continue
            yield from _batches(digests(_rows(b.rest)), ["c", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"],
                                [arrow, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()])

    return in_arrow(d, run, schema).withColumnRenamed("c", conv)
