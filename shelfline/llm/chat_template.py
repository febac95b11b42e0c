"""Chat formatting by compiled templates.

A template is text with `{{ expression }}`, `{% if %} {% elif %} {% else %} {% endif %}`, `{% for x in y %}
{% endfor %}`, `{% set x = y %}`, `{% generation %} {% endgeneration %}` and `{# comments #}`; a dash at a
tag's inner edge strips the white space beside it. Expressions have literals, names, members of mappings,
comparisons, `in`, `and`, `or`, `not`, `+`, `~` and filters. There are no calls and no attributes of Python
objects, so a template reaches nothing but its variables. It is parsed into a syntax tree, constants are
folded, and the tree becomes Python closures that yield pieces of text with a mark whether a piece lies
within a generation block.

Rows are sorted by ranges of (conversation, turn), so a conversation with any share of the rows spans several
portions. Each portion is rendered by itself as a stream: the `for` over the messages takes them one by one and
counts on from the portions before it, what precedes the loop is shown by the first portion and what follows it by the last. The
output is cut into parts of about `PART_CHARS` characters, whose places are then summed up over the portions. A
conversation with any number of turns needs the memory of one turn and one part. So a template may pass over
`messages` once on each of its paths, and besides take single ones by a fixed number below `LOOK_AHEAD`
(`messages[0]`, null if there are fewer), which are read ahead and kept. Any other use is a `TemplateError` before a job runs.

Texts are escaped so that no control string can come from a text: a backslash is doubled and each
control string gets a backslash after its first character. Reading back undoes it exactly; its digests are
sequential by nature, so one task streams the parts of a conversation through them.

Defined cases: a null text or role is empty, and so is a missing member. Turns of a conversation go by
turn (null first), then role and text, so ties have one order; repeated rows are turns of their own. Rows
with a null conversation id form one conversation. An empty table gives no conversations. Other columns
are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfline.session import materialize

PART_CHARS = 1 << 16
LOOK_AHEAD = 64
#: Strings that chat models read as control tokens.
CONTROL_STRINGS = ["<|im_start|>", "<|im_end|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"]
DEFAULT_TEMPLATE = """
{%- for message in messages -%}
  <|im_start|>{{ message.role | escape_line }}{{ '\\n' }}
  {%- if message.role == 'assistant' -%}
    {% generation %}{{ message.text | escape }}{% endgeneration %}
  {%- else -%}
    {{ message.text | escape }}
  {%- endif -%}
  <|im_end|>{{ '\\n' }}
{%- endfor -%}
"""

_control = re.compile("|".join(re.escape(c) for c in CONTROL_STRINGS))


def escape(text: str) -> str:
    return _control.sub(lambda m: m[0][0] + "\\" + m[0][1:], text.replace("\\", "\\\\"))


def escape_line(text: str) -> str:
    return escape(text).replace("\n", "\\\n")


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


FILTERS: dict[str, Callable] = {
    "escape": escape, "escape_line": escape_line, "trim": lambda x: x.strip(), "upper": lambda x: x.upper(),
    "lower": lambda x: x.lower(), "length": len, "string": lambda x: _shown(x),
}


class TemplateError(ValueError):
    """A template that does not parse, or that asks for what there is not."""


# Syntax tree -----------------------------------------------------------------------------------

@dataclass
class Const:
    value: object


@dataclass
class Name:
    name: str


@dataclass
class Member:
    of: object
    key: object


@dataclass
class Filter:
    of: object
    name: str


@dataclass
class Operation:
    sign: str
    args: list


@dataclass
class Output:
    value: object


@dataclass
class If:
    test: object
    then: list
    other: list


@dataclass
class For:
    name: str
    over: object
    body: list


@dataclass
class Assign:
    name: str
    value: object


@dataclass
class Generation:
    body: list


_TAG = re.compile(r"\{\{-?(?P<out>.*?)-?\}\}|\{%-?(?P<tag>.*?)-?%\}|\{#.*?#\}", re.S)
_TOKEN = re.compile(r"""\s*(?:(?P<string>'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*")|(?P<number>\d+)|(?P<name>[A-Za-z_]\w*)"""
                    r"""|(?P<sign>==|!=|<=|>=|[<>+~|.\[\]()]))""", re.S)
_ESCAPES = {"n": "\n", "t": "\t", "r": "\r"}
_WORDS = {"and", "or", "not", "in"}
_CONSTANTS = {"true": True, "false": False, "none": None}


class _Expression:
    """Recursive descent over the tokens of one expression."""

    def __init__(self, source: str):
        self.tokens, at, source = [], 0, source.strip()
        while at < len(source):
            found = _TOKEN.match(source, at)
            if not found:
                raise TemplateError(f"can't read {source[at:]!r}")
            self.tokens.append((found.lastgroup, found[found.lastgroup]))
            at = found.end()
        self.at = 0

    def whole(self):
        tree = self.either()
        if self.at < len(self.tokens):
            raise TemplateError(f"{self.tokens[self.at][1]!r} is too much")
        return tree

    def accept(self, *values: str) -> str | None:
        if self.at < len(self.tokens) and self.tokens[self.at][0] in ("sign", "name") and self.tokens[self.at][1] in values:
            self.at += 1
            return self.tokens[self.at - 1][1]
        return None

    def expect(self, value: str) -> None:
        if not self.accept(value):
            raise TemplateError(f"{value!r} is missing")

    def take(self, kind: str) -> str:
        if self.at == len(self.tokens) or self.tokens[self.at][0] != kind:
            raise TemplateError(f"a {kind} is missing")
        self.at += 1
        return self.tokens[self.at - 1][1]

    def either(self):
        tree = self.both()
        while self.accept("or"):
            tree = Operation("or", [tree, self.both()])
        return tree

    def both(self):
        tree = self.negated()
        while self.accept("and"):
            tree = Operation("and", [tree, self.negated()])
        return tree

    def negated(self):
        return Operation("not", [self.negated()]) if self.accept("not") else self.compared()

    def compared(self):
        tree = self.joined()
        while True:
            if sign := self.accept("==", "!=", "<", ">", "<=", ">=", "in"):
                tree = Operation(sign, [tree, self.joined()])
            elif self.accept("not"):
                self.expect("in")
                tree = Operation("not", [Operation("in", [tree, self.joined()])])
            else:
                return tree

    def joined(self):
        tree = self.filtered()
        while sign := self.accept("+", "~"):
            tree = Operation(sign, [tree, self.filtered()])
        return tree

    def filtered(self):
        tree = self.member()
        while self.accept("|"):
            name = self.take("name")
            if name not in FILTERS:
                raise TemplateError(f"no filter {name!r}")
            tree = Filter(tree, name)
        return tree

    def member(self):
        tree = self.single()
        while True:
            if self.accept("."):
                tree = Member(tree, Const(self.take("name")))
            elif self.accept("["):
                tree = Member(tree, self.either())
                self.expect("]")
            else:
                return tree

    def single(self):
        if self.accept("("):
            tree = self.either()
            self.expect(")")
            return tree
        if self.at == len(self.tokens):
            raise TemplateError("an expression is missing")
        kind, value = self.tokens[self.at]
        self.at += 1
        if kind == "string":
            return Const(re.sub(r"\\(.)", lambda m: _ESCAPES.get(m[1], m[1]), value[1:-1], flags=re.S))
        if kind == "number":
            return Const(int(value))
        if kind == "name" and value not in _WORDS:
            return Const(_CONSTANTS[value]) if value in _CONSTANTS else Name(value)
        raise TemplateError(f"{value!r} is no expression")


def parse(source: str) -> list:
    """The syntax tree of a template."""
    pieces, at = [], 0
    strip_next = False
    for found in _TAG.finditer(source):
        raw, text = found[0], source[at:found.start()]
        text = text.lstrip() if strip_next else text
        dashed = raw[2] == "-" and not raw.startswith("{#")
        pieces.append(("text", text.rstrip() if dashed else text))
        strip_next = raw[-3] == "-" and not raw.startswith("{#")
        at = found.end()
        if found["out"] is not None:
            pieces.append(("out", found["out"]))
        elif found["tag"] is not None:
            pieces.append(("tag", found["tag"].strip()))
    pieces.append(("text", source[at:].lstrip() if strip_next else source[at:]))
    stream = iter(pieces)
    body, end = _block(stream, ())
    return body


def _block(stream: Iterator, until: tuple[str, ...]) -> tuple[list, str]:
    body: list = []
    for kind, value in stream:
        if kind == "text":
            if "{%" in value or "{{" in value:
                raise TemplateError("a tag is not closed")
            if value:
                body.append(Output(Const(value)))
            continue
        if kind == "out":
            body.append(Output(_Expression(value).whole()))
            continue
        word, _, rest = value.partition(" ")
        if word in until:
            return body, value
        if word == "if":
            body.append(_conditional(stream, rest))
        elif word == "for":
            found = re.fullmatch(r"([A-Za-z_]\w*)\s+in\s+(.+)", rest.strip(), re.S)
            if not found:
                raise TemplateError(f"can't read {value!r}")
            inner, _ = _block(stream, ("endfor",))
            body.append(For(found[1], _Expression(found[2]).whole(), inner))
        elif word == "set":
            found = re.fullmatch(r"([A-Za-z_]\w*)\s*=(?!=)(.+)", rest.strip(), re.S)
            if not found:
                raise TemplateError(f"can't read {value!r}")
            body.append(Assign(found[1], _Expression(found[2]).whole()))
        elif word == "generation":
            inner, _ = _block(stream, ("endgeneration",))
            body.append(Generation(inner))
        else:
            raise TemplateError(f"no tag {word!r} here")
    if until:
        raise TemplateError(f"{until[-1]} is missing")
    return body, ""


def _conditional(stream: Iterator, test: str) -> If:
    then, end = _block(stream, ("elif", "else", "endif"))
    word, _, rest = end.partition(" ")
    if word == "elif":
        return If(_Expression(test).whole(), then, [_conditional(stream, rest)])
    other = _block(stream, ("endif",))[0] if word == "else" else []
    return If(_Expression(test).whole(), then, other)


# Folding ---------------------------------------------------------------------------------------

def _shown(value: object) -> str:
    return "" if value is None else value if isinstance(value, str) else str(value).lower() if isinstance(value, bool) else str(value)


def _member(of: object, key: object) -> object:
    if isinstance(of, dict):
        return of.get(key)
    if isinstance(of, Messages):
        return of.head[key] if key < len(of.head) else None
    if isinstance(of, (list, tuple, str)) and isinstance(key, int) and not isinstance(key, bool):
        return of[key] if -len(of) <= key < len(of) else None
    return None


_OPERATIONS: dict[str, Callable] = {
    "==": lambda a, b: a == b, "!=": lambda a, b: a != b, "<": lambda a, b: a < b, ">": lambda a, b: a > b,
    "<=": lambda a, b: a <= b, ">=": lambda a, b: a >= b, "in": lambda a, b: a in b, "not": lambda a: not a,
    "+": lambda a, b: a + b, "~": lambda a, b: _shown(a) + _shown(b),
}


def fold(node):
    """A tree of the same meaning with constant parts worked out and neighbouring text joined."""
    if isinstance(node, list):
        out: list = []
        for child in map(fold, node):
            for x in child if isinstance(child, list) else [child]:
                if isinstance(x, Output) and isinstance(x.value, Const):
                    if out and isinstance(out[-1], Output) and isinstance(out[-1].value, Const):
                        x = Output(Const(_shown(out.pop().value.value) + _shown(x.value.value)))
                    else:
                        x = Output(Const(_shown(x.value.value)))
                    if not x.value.value:
                        continue
                out.append(x)
        return out
    if isinstance(node, Member):
        of, key = fold(node.of), fold(node.key)
        return Const(_member(of.value, key.value)) if isinstance(of, Const) and isinstance(key, Const) else Member(of, key)
    if isinstance(node, Filter):
        of = fold(node.of)
        return _constant(Filter(of, node.name)) if isinstance(of, Const) else Filter(of, node.name)
    if isinstance(node, Operation):
        args = [fold(a) for a in node.args]
        if node.sign in ("and", "or"):
            if isinstance(args[0], Const):
                return args[1] if bool(args[0].value) == (node.sign == "and") else args[0]
        elif all(isinstance(a, Const) for a in args):
            return _constant(Operation(node.sign, args))
        return Operation(node.sign, args)
    if isinstance(node, Output):
        return Output(fold(node.value))
    if isinstance(node, If):
        test = fold(node.test)
        if isinstance(test, Const):
            return fold(node.then if test.value else node.other)
        return If(test, fold(node.then), fold(node.other))
    if isinstance(node, For):
        return For(node.name, fold(node.over), fold(node.body))
    if isinstance(node, Assign):
        return Assign(node.name, fold(node.value))
    if isinstance(node, Generation):
        return Generation(fold(node.body))
    return node


def _constant(node):
    """A node of constants as its value; one that fails is left to fail if it is rendered."""
    try:
        return Const(_value(node)({}))
    except (TypeError, ValueError, AttributeError):
        return node


# Closures --------------------------------------------------------------------------------------

Piece = tuple[str, bool]


def _value(node) -> Callable[[dict], object]:
    if isinstance(node, Const):
        return lambda env, v=node.value: v
    if isinstance(node, Name):
        return lambda env, n=node.name: env.get(n)
    if isinstance(node, Member):
        of, key = _value(node.of), _value(node.key)
        return lambda env: _member(of(env), key(env))
    if isinstance(node, Filter):
        of, apply = _value(node.of), FILTERS[node.name]
        text_only = node.name != "length"
        return lambda env: apply(_shown(of(env)) if text_only else of(env))
    args = [_value(a) for a in node.args]
    if node.sign == "and":
        return lambda env: args[0](env) and args[1](env)
    if node.sign == "or":
        return lambda env: args[0](env) or args[1](env)
    act = _OPERATIONS[node.sign]
    return lambda env: act(*[a(env) for a in args])


def _steps(nodes: list, marked: bool) -> Callable[[dict], Iterator[Piece]]:
    steps = [_step(n, marked) for n in nodes]
    if len(steps) == 1:
        return steps[0]

    def run(env):
        for step in steps:
            yield from step(env)

    return run


def _step(node, marked: bool) -> Callable[[dict], Iterator[Piece]]:
    if isinstance(node, Output):
        if isinstance(node.value, Const):
            fixed = ((node.value.value, marked),)
            return lambda env: fixed
        value = _value(node.value)
        return lambda env: ((_shown(value(env)), marked),)
    if isinstance(node, If):
        test, then, other = _value(node.test), _steps(node.then, marked), _steps(node.other, marked)
        return lambda env: then(env) if test(env) else other(env)
    if isinstance(node, Generation):
        return _steps(node.body, True)
    if isinstance(node, Assign):
        value = _value(node.value)

        def assign(env):
            env[node.name] = value(env)
            return ()

        return assign
    over, body = _value(node.over), _steps(node.body, marked)

    def loop(env):
        passed = over(env) or ()
        stream = passed if isinstance(passed, Messages) else Messages(passed)
        stream.place = Messages.WITHIN
        items = iter(stream)
        current = next(items, _END)
        index = stream.offset
        while current is not _END:
            following = next(items, _END)
            # A loop's body has its own variables.
            yield from body(env | {node.name: current, "loop": {
                "index": index + 1, "index0": index, "first": index == 0, "last": following is _END and not stream.more}})
            current, index = following, index + 1
        stream.place = Messages.AFTER

    return loop


_END = object()


@dataclass
class Template:
    """A compiled template; `render` yields (text, whether it is generated)."""
    source: str
    tree: list = field(init=False)

    def __post_init__(self):
        self.tree = fold(parse(self.source))
        self.run = _steps(self.tree, False)

    def render(self, **variables) -> Iterator[Piece]:
        return iter(self.run(dict(variables)))


def stream_reads(node, name: str = "messages", looped: bool = False) -> tuple[int, int]:
    """How often a path of a tree passes over a stream, and how many of its first items it asks for by number.

    Raises `TemplateError` for a use that a stream can't serve.
    """
    if isinstance(node, list):
        reads = [stream_reads(n, name, looped) for n in node]
        return sum(r[0] for r in reads), max((r[1] for r in reads), default=0)
    if isinstance(node, Name) and node.name == name:
        raise TemplateError(f"{name} can only be passed over by one `for`, or be asked for an item by a number")
    if isinstance(node, Member) and isinstance(node.of, Name) and node.of.name == name:
        number = node.key.value if isinstance(node.key, Const) else None
        if type(number) is not int or not 0 <= number < LOOK_AHEAD:
            raise TemplateError(f"an item of {name} goes by a number from 0 to {LOOK_AHEAD - 1}")
        return 0, number + 1
    if isinstance(node, (For, Assign)) and node.name == name:
        raise TemplateError(f"{name} can't be another variable")
    if isinstance(node, For):
        own = isinstance(node.over, Name) and node.over.name == name
        if own and looped:
            raise TemplateError(f"a `for` over {name} can't be in another loop")
        over = (1, 0) if own else stream_reads(node.over, name, looped)
        body = stream_reads(node.body, name, True)
        return over[0] + body[0], max(over[1], body[1])
    if isinstance(node, If):
        test, then, other = (stream_reads(n, name, looped) for n in (node.test, node.then, node.other))
        return test[0] + max(then[0], other[0]), max(test[1], then[1], other[1])
    if isinstance(node, Member):
        return stream_reads([node.of, node.key], name, looped)
    if isinstance(node, Operation):
        return stream_reads(list(node.args), name, looped)
    if isinstance(node, Generation):
        return stream_reads(node.body, name, looped)
    if isinstance(node, Filter):
        return stream_reads(node.of, name, looped)
    if isinstance(node, (Output, Assign)):
        return stream_reads(node.value, name, looped)
    return 0, 0


class Messages:
    """A portion of a conversation's messages, which can be passed over once.

    `offset` messages precede it and `more` says whether others follow. The conversation's first messages are kept, to
    be asked for by number: those given as `head`, else the first `ahead` of the portion. `place` is where the
    rendering is: before, within or after the loop over the messages.
    """
    BEFORE, WITHIN, AFTER = range(3)

    def __init__(self, items: Iterable, ahead: int = 0, head: list | None = None, offset: int = 0, more: bool = False):
        self.items = iter(items)
        self.taken = list(islice(self.items, ahead)) if head is None else []
        self.head = self.taken if head is None else head
        self.offset, self.more, self.place = offset, more, self.BEFORE

    def __iter__(self) -> Iterator:
        return chain(self.taken, self.items)

    def shows(self) -> bool:
        """Whether text from here belongs to this portion: what precedes the loop is the first one's, what follows it the last one's."""
        return self.place == self.WITHIN or (self.offset == 0 if self.place == self.BEFORE else not self.more)


# On Spark --------------------------------------------------------------------------------------

_PARTS = "conv_id {kind}, portion int, part long, start long, text string, loss array<struct<start:long,stop:long>>"
PREFIX_CHARS = 128


def _portions(df: DataFrame, portions: int | None) -> DataFrame:
    """The rows in order, written with the portion of their conversation and their place in it."""
    role, text = F.col("role"), F.col("text")
    short = F.length(role) <= PREFIX_CHARS
    # Bounds are sampled on the driver, so they are made of prefixes; these go as the whole values do.
    ranges = [F.asc("conv_id"), F.asc_nulls_first("turn"), F.substring(role, 1, PREFIX_CHARS).asc(), (~short).asc(),
              F.when(short, F.substring(text, 1, PREFIX_CHARS)).asc()]
    spread = df.repartitionByRange(portions, *ranges) if portions else df.repartitionByRange(*ranges)
    ordered = spread.sortWithinPartitions("conv_id", F.asc_nulls_first("turn"), "role", "text").select("conv_id", "role", "text")
    kind = df.schema["conv_id"].dataType.simpleString()

    def task(batches):
        portion = TaskContext.get().partitionId()
        now, place = _END, 0
        for batch in batches:
            places = []
            for conv in batch.column(0).to_pylist():
                if conv != now:
                    now, place = conv, 0
                places.append(place)
                place += 1
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(batch.num_rows, portion, np.int32)), pa.array(places, pa.int64())],
                names=["conv_id", "role", "text", "portion", "place"])

    return materialize(ordered.mapInArrow(task, f"conv_id {kind}, role string, text string, portion int, place long"), "messages")


def _summed(portions: DataFrame, sums: list[str]) -> DataFrame:
    """(conv_id, portion, more, `sums` over the portions before) of the portions of conversations that have several.

    A task of the ranges holds one such conversation's end and one's start at most, so there are less than two rows a task.
    """
    own = Window.partitionBy("conv_id")
    before = own.orderBy("portion").rowsBetween(Window.unboundedPreceding, -1)
    several = F.min("portion").over(own) < F.max("portion").over(own)
    told = portions.select("conv_id", "portion", several.alias("several"), (F.col("portion") < F.max("portion").over(own)).alias("more"),
                           *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(c) for c in sums])
    return materialize(told.where("several").drop("several"), "portions")


def _with(df: DataFrame, facts: DataFrame, how: str = "left") -> DataFrame:
    """`df` with the facts of its portion; these are few, see `_summed`."""
    known = F.broadcast(facts.withColumnsRenamed({"conv_id": "_conv", "portion": "_portion"}))
    return df.join(known, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("portion") == F.col("_portion")), how).drop("_conv", "_portion")


def format_conversations(df: DataFrame, template: str = DEFAULT_TEMPLATE, conv_id: str = "conv_id", turn: str = "turn",
                         role: str = "role", text: str = "text", part_chars: int = PART_CHARS,
                         portions: int | None = None) -> DataFrame:
    """(conv_id, part, start, text, loss): formatted text in parts; `loss` has the spans to train on, counted
    in code points from the start of the conversation's text.

    `portions` is the number of ranges that rows are sorted in, by default the session's shuffle partitions. Runs jobs when called.
    """
    kind = df.schema[conv_id].dataType.simpleString()
    passes, ahead = stream_reads(Template(template).tree)
    if passes > 1:
        raise TemplateError("a second `for` over messages on one path would find none")
    _Parts(kind)
    given = df.select(F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"),
                      F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
                      F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    rows = _portions(given, portions)
    facts = _summed(rows.groupBy("conv_id", "portion").agg(F.count("*").alias("offset")), ["offset"])
    told = _with(rows, facts).select("conv_id", "portion", F.lit(True).alias("own"), "place", "role", "text", "offset", "more")
    if ahead:
        # The first messages of a conversation of several portions, for each of its portions.
        first = _with(rows, facts, "inner").where(F.col("offset") + F.col("place") < ahead).select(
            F.col("conv_id").alias("_conv"), (F.col("offset") + F.col("place")).alias("place"), "role", "text")
        heads = first.join(facts, F.col("conv_id").eqNullSafe(F.col("_conv"))).select(
            "conv_id", "portion", F.lit(False).alias("own"), "place", "role", "text", "offset", "more")
        told = told.unionByName(heads)
    ordered = told.repartition("conv_id", "portion").sortWithinPartitions("conv_id", "portion", "own", "place").drop("place")

    def task(batches):
        compiled = Template(template)
        rows = _Lookahead((tuple(row[:3]), *row[3:]) for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns)))
        out = _Parts(kind)

        def own(key):
            return ({"role": r, "text": t} for _, r, t, _, _ in rows.run(key))

        while rows.more():
            key, _, _, offset, more = rows.peek()
            single = offset is None
            head = None if single else list(own((*key[:2], False)))
            messages = Messages(own((*key[:2], True)), ahead, head, offset or 0, bool(more))
            held, spans, size, start, part = [], [], 0, 0, 0
            for piece, marked in compiled.render(messages=messages):
                if not piece or not messages.shows():
                    continue
                if held and size + len(piece) > part_chars:
                    yield from out.add(*key[:2], part, start, held, spans)
                    start, part, held, spans, size = start + size, part + 1, [], [], 0
                if marked:
                    spans.append({"start": start + size, "stop": start + size + len(piece)})
                held.append(piece)
                size += len(piece)
            yield from out.add(*key[:2], part, start, held, spans)
            for _ in messages:
                pass
        yield from out.rest()

    parts = materialize(ordered.mapInArrow(task, _PARTS.format(kind=kind)), "formatted")
    sizes = _with(parts, facts.select("conv_id", "portion"), "inner").groupBy("conv_id", "portion").agg(
        F.count("*").alias("parts"), F.sum(F.length("text")).alias("chars"))
    before = {c: F.coalesce(c, F.lit(0)) for c in ("parts", "chars")}
    return _with(parts, _summed(sizes, ["parts", "chars"])).select(
        "conv_id", (F.col("part") + before["parts"]).alias("part"), (F.col("start") + before["chars"]).alias("start"), "text",
        F.transform("loss", lambda x: F.struct((x["start"] + before["chars"]).alias("start"),
                                               (x["stop"] + before["chars"]).alias("stop"))).alias("loss"))


class _Lookahead:
    def __init__(self, items):
        self.items, self.held = iter(items), None

    def more(self) -> bool:
        if self.held is None:
            self.held = next(self.items, None)
        return self.held is not None

    def peek(self):
        return self.held

    def run(self, key) -> Iterator:
        while self.more() and self.held[0] == key:
            row, self.held = self.held, None
            yield row


class _Parts:
    """Collects output rows into batches of bounded size."""

    def __init__(self, kind: str, limit: int = 1 << 21):
        self.rows, self.size, self.limit = [], 0, limit
        self.key = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}.get(kind)
        if self.key is None:
            raise ValueError(f"conversation ids must be whole numbers or strings, not {kind}")

    def add(self, key, portion, part, start, held, spans):
        self.rows.append((key, portion, part, start, "".join(held), spans))
        self.size += sum(map(len, held)) + 64
        return self.rest() if self.size >= self.limit else ()

    def rest(self):
        if self.rows:
            kinds = [self.key, pa.int32(), pa.int64(), pa.int64(), pa.string(),
                     pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))]
            columns = list(zip(*self.rows))
            self.rows, self.size = [], 0
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                             names=["conv_id", "portion", "part", "start", "text", "loss"])


_TURN_END = "<|im_end|>\n"
_TURN = re.compile(r"<\|im_start\|>((?:[^\\\n]|\\.)*)\n(.*?)<\|im_end\|>\n", re.S)


def read_turns(parts) -> Iterator[tuple[str, str]]:
    """(role, text) of the turns in formatted text of the default template, given in parts."""
    held, waiting, tail = "", [], ""
    for part in parts:
        waiting.append(part)
        tail = tail[-len(_TURN_END):] + part
        # Parts without the end of a turn wait, so a long text is scanned once.
        if _TURN_END not in tail:
            continue
        held, waiting, at = held + "".join(waiting), [], 0
        while found := _TURN.match(held, at):
            yield unescape(found[1]), unescape(found[2])
            at = found.end()
        held = held[at:]
    if held or any(waiting):
        raise TemplateError("formatted text does not end with a whole turn")


def read_back(formatted: DataFrame) -> DataFrame:
    """Per conversation, read from formatted parts alone: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256,
    formatted_chars. The turns are hashed as role, line break, text, line break; the loss is all masked text, unescaped."""
    kind = formatted.schema["conv_id"].dataType.simpleString()
    ordered = (formatted.select("conv_id", "part", "start", "text", "loss").repartition("conv_id")
               .sortWithinPartitions("conv_id", "part"))
    schema = (f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
              "formatted_chars long")
    names = [f.split()[0] for f in schema.split(", ")]

    def task(batches):
        rows = _Lookahead(row for batch in batches for row in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3, 4))))
        done = []
        while rows.more():
            key = rows.peek()[0]
            loss, counts = hashlib.sha256(), {"loss": 0, "all": 0}

            def texts():
                for _, start, text, spans in rows.run(key):
                    for span in spans or ():
                        masked = unescape(text[span["start"] - start:span["stop"] - start])
                        loss.update(masked.encode())
                        counts["loss"] += len(masked)
                    counts["all"] += len(text)
                    yield text

            turns, n = hashlib.sha256(), 0
            for role, text in read_turns(texts()):
                turns.update(f"{role}\n{text}\n".encode())
                n += 1
            done.append((key, n, turns.hexdigest(), counts["loss"], loss.hexdigest(), counts["all"]))
            if len(done) == 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], names=names)
                done = []
        if done:
            kinds = [_Parts(kind).key, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done), kinds)], names=names)

    return ordered.mapInArrow(task, schema)
