r"""Chat formatting with compiled templates.

A template is parsed into a syntax tree, its constant parts are folded, and the rest becomes Python
closures. The language has text, `{{ expression }}`, `{# comment #}` and the tags `if`/`elif`/
`else`/`endif`, `for x in list`/`endfor`, `set x = expression`, and `generation`/`endgeneration`, between
which lies what a model is to learn. A `-` inside a tag's brackets strips the white space beside it.
Expressions have literals, names, `a.b` and `a[b]`, `not`, `and`, `or`, comparisons, `in`, `+ - * %`, `~`
(joins as text), `x if y else z` and filters. It is a sandbox: names reach only the given values,
`a.b` looks up keys of mappings only, nothing can be called but the filters listed here, and loops run over
given lists.

`escape` puts a backslash after the first character of every control string in a text and doubles
backslashes, so no control string is left in it, and `unescape` gives the text back.

Conversations are dealt by their id and sorted in their partitions; a task streams them and holds one
conversation. A formatted conversation is one value, so one conversation must fit a task.

Defined results for odd input: null roles and texts are empty; turns are ordered by number (nulls
first), ties by role and text, and repeated turns are kept; rows whose conversation is null are one
conversation; only the four named columns are read; an empty table gives no rows.
"""

from __future__ import annotations

import operator
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import groupby
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_type

CONTROL = ("<|turn|>", "<|text|>", "<|end|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>",
           "<|im_start|>", "<|im_end|>", "<|endoftext|>", "<|startoftext|>")
#: Marks turns and roles; only what an assistant says is learnt.
TEMPLATE = """
{#- every turn: its role, then what it says -#}
{% for m in messages -%}
  {{ '<|turn|>' ~ (m.role | escape) ~ '<|text|>' }}
  {%- if m.role == 'assistant' -%}
    {% generation %}{{ m.text | escape }}{% endgeneration %}
  {%- else -%}
    {{ m.text | escape }}
  {%- endif -%}
  {{ '<|end|>' }}
{%- endfor -%}
"""
_INSIDE = re.compile("|".join(f"{re.escape(c[0])}(?={re.escape(c[1:])})" for c in CONTROL))
_TURN = re.compile(r"<\|turn\|>(.*?)<\|text\|>(.*?)<\|end\|>", re.S)


def escape(text: str) -> str:
    return _INSIDE.sub(r"\g<0>\\", text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


class TemplateError(ValueError):
    pass


# ---- output

@dataclass
class Output:
    """What has been written, and the spans (in code points) written while generating."""
    parts: list[str] = field(default_factory=list)
    size: int = 0
    spans: list[tuple[int, int]] = field(default_factory=list)

    def write(self, text: str) -> None:
        self.parts.append(text)
        self.size += len(text)


# ---- syntax tree: expressions

@dataclass(frozen=True)
class Const:
    value: Any


@dataclass(frozen=True)
class Name:
    name: str


@dataclass(frozen=True)
class Apply:
    """A pure function of its arguments: operators, look-ups and filters."""
    what: str
    args: tuple


@dataclass(frozen=True)
class Choice:
    """`first if test else second`; also `and` and `or`, whose test is their left side."""
    test: Any
    first: Any
    second: Any


# ---- syntax tree: statements

@dataclass(frozen=True)
class Write:
    value: Any


@dataclass(frozen=True)
class Branch:
    test: Any
    yes: tuple
    no: tuple


@dataclass(frozen=True)
class Loop:
    name: str
    over: Any
    body: tuple


@dataclass(frozen=True)
class Assign:
    name: str
    value: Any


@dataclass(frozen=True)
class Generation:
    body: tuple


def _text(value: Any) -> str:
    return "" if value is None else value if isinstance(value, str) else str(value)


def _look_up(holder: Any, key: Any) -> Any:
    if isinstance(holder, dict):
        return holder.get(key)
    if isinstance(holder, (list, tuple, str)) and isinstance(key, int):
        return holder[key] if -len(holder) <= key < len(holder) else None
    raise TemplateError(f"{type(holder).__name__} has no entries that a template may read")


def _product(a: Any, b: Any) -> Any:
    if not (isinstance(a, (int, float)) and isinstance(b, (int, float))):
        raise TemplateError("only numbers can be multiplied")
    return a * b


def _remainder(a: Any, b: Any) -> Any:
    if not (isinstance(a, (int, float)) and isinstance(b, (int, float))):
        raise TemplateError("% takes numbers")
    return a % b


FUNCTIONS: dict[str, Callable] = {
    "look up": _look_up, "~": lambda *args: "".join(map(_text, args)), "not": operator.not_,
    "negative": operator.neg, "+": operator.add, "-": operator.sub, "*": _product, "%": _remainder,
    "==": operator.eq, "!=": operator.ne, "<": operator.lt, "<=": operator.le, ">": operator.gt,
    ">=": operator.ge, "in": lambda a, b: a in b, "not in": lambda a, b: a not in b,
}
FILTERS: dict[str, Callable] = {
    "escape": lambda x: escape(_text(x)), "trim": lambda x: _text(x).strip(), "upper": lambda x: _text(x).upper(),
    "lower": lambda x: _text(x).lower(), "length": len, "default": lambda x, other="": other if x is None else x,
    "join": lambda x, by="": by.join(map(_text, x)), "first": lambda x: x[0] if x else None,
    "last": lambda x: x[-1] if x else None,
}

# ---- parser

_TAGS = re.compile(r"(\{\{-?|\{%-?|\{#-?)(.*?)(-?\}\}|-?%\}|-?#\})", re.S)
_CLOSE = {"{{": "}}", "{%": "%}", "{#": "#}"}
_TOKEN = re.compile(r"""\s*(?:(?P<text>'(?:\\.|[^'\\])*'|"(?:\\.|[^"\\])*")|(?P<number>\d+(?:\.\d+)?)
    |(?P<name>[A-Za-z_]\w*)|(?P<sign>==|!=|<=|>=|[-+*%~|.,()\[\]<>=]))""", re.X | re.S)
_ESCAPES = {"n": "\n", "t": "\t", "r": "\r"}


def _tokens(source: str) -> list[tuple[str, str]]:
    out, at, source = [], 0, source.rstrip()
    while at < len(source):
        found = _TOKEN.match(source, at)
        if not found:
            raise TemplateError(f"can't read {source[at:at + 20]!r}")
        out.append((found.lastgroup, found[found.lastgroup]))
        at = found.end()
    return [*out, ("end", "")]


class _Expression:
    """Precedence climbing over one tag's tokens."""
    LEVELS = (("==", "!=", "<", "<=", ">", ">=", "in", "not in"), ("~",), ("+", "-"), ("*", "%"))

    def __init__(self, source: str):
        self.tokens, self.at = _tokens(source), 0

    def peek(self) -> str:
        return self.tokens[self.at][1] if self.tokens[self.at][0] in ("sign", "name") else ""

    def take(self, wanted: str | None = None) -> tuple[str, str]:
        token = self.tokens[self.at]
        if wanted is not None and token[1] != wanted:
            raise TemplateError(f"expected {wanted!r}, found {token[1]!r}")
        self.at += 1
        return token

    def whole(self) -> Any:
        found = self.choice()
        if self.tokens[self.at][0] != "end":
            raise TemplateError(f"unexpected {self.tokens[self.at][1]!r}")
        return found

    def choice(self) -> Any:
        value = self.either()
        if self.peek() != "if":
            return value
        self.take()
        test, other = self.either(), Const(None)
        if self.peek() == "else":
            self.take()
            other = self.choice()
        return Choice(test, value, other)

    def either(self) -> Any:
        left = self.both()
        while self.peek() == "or":
            self.take()
            left = Choice(left, left, self.both())
        return left

    def both(self) -> Any:
        left = self.negated()
        while self.peek() == "and":
            self.take()
            left = Choice(left, self.negated(), left)
        return left

    def negated(self) -> Any:
        if self.peek() == "not":
            self.take()
            return Apply("not", (self.negated(),))
        return self.binary(0)

    def binary(self, level: int) -> Any:
        if level == len(self.LEVELS):
            return self.unary()
        left = self.binary(level + 1)
        while True:
            sign = self.peek()
            if sign == "not" and self.tokens[self.at + 1][1] == "in":
                sign = "not in"
            if sign not in self.LEVELS[level]:
                return left
            self.at += 2 if sign == "not in" else 1
            left = Apply(sign, (left, self.binary(level + 1)))

    def unary(self) -> Any:
        if self.peek() == "-":
            self.take()
            return Apply("negative", (self.unary(),))
        return self.postfix(self.atom())

    def atom(self) -> Any:
        kind, said = self.take()
        if kind == "text":
            return Const(re.sub(r"\\(.)", lambda m: _ESCAPES.get(m[1], m[1]), said[1:-1], flags=re.S))
        if kind == "number":
            return Const(float(said) if "." in said else int(said))
        if kind == "name":
            known = {"true": True, "false": False, "none": None}
            return Const(known[said.lower()]) if said.lower() in known else Name(said)
        if said == "(":
            inner = self.choice()
            self.take(")")
            return inner
        raise TemplateError(f"unexpected {said!r}")

    def postfix(self, value: Any) -> Any:
        while (sign := self.peek()) in (".", "[", "|"):
            self.take()
            if sign == ".":
                value = Apply("look up", (value, Const(self.take()[1])))
            elif sign == "[":
                value = Apply("look up", (value, self.choice()))
                self.take("]")
            else:
                name, args = self.take()[1], [value]
                if name not in FILTERS:
                    raise TemplateError(f"no filter {name!r}")
                if self.peek() == "(":
                    self.take()
                    while self.peek() != ")":
                        args.append(self.choice())
                        if self.peek() == ",":
                            self.take()
                    self.take(")")
                value = Apply("| " + name, tuple(args))
        return value


class _Statements:
    def __init__(self, template: str):
        self.items: list[tuple[str, str]] = []  # kind, content
        at, strip = 0, False
        for found in _TAGS.finditer(template):
            opened, content, closed = found[1], found[2], found[3]
            if _CLOSE[opened[:2]] != closed.lstrip("-"):
                raise TemplateError(f"{opened} is closed by {closed}")
            text = template[at:found.start()]
            text = text.lstrip() if strip else text
            self.items.append(("text", text.rstrip() if opened.endswith("-") else text))
            if opened[:2] != "{#":
                self.items.append(("write" if opened[:2] == "{{" else "tag", content.strip()))
            at, strip = found.end(), closed.startswith("-")
        self.items.append(("text", template[at:].lstrip() if strip else template[at:]))
        self.items.append(("end", ""))
        self.at = 0

    def body(self, *until: str) -> tuple[tuple, str]:
        """Statements up to a tag that starts with one of `until`; and that tag."""
        out: list[Any] = []
        while True:
            kind, content = self.items[self.at]
            self.at += 1
            if kind == "end":
                if until:
                    raise TemplateError(f"{until[-1]} is missing")
                return tuple(out), ""
            if kind == "text":
                out.append(Write(Const(content)))
            elif kind == "write":
                out.append(Write(_Expression(content).whole()))
            else:
                word, _, rest = content.partition(" ")
                if word in until:
                    return tuple(out), content
                out.append(self.tag(word, rest))

    def tag(self, word: str, rest: str) -> Any:
        if word == "if":
            return self.branch(rest)
        if word == "for":
            name, found, over = rest.partition(" in ")
            if not found or not name.strip().isidentifier():
                raise TemplateError(f"for takes `name in list`, not {rest!r}")
            body, _ = self.body("endfor")
            return Loop(name.strip(), _Expression(over).whole(), body)
        if word == "set":
            name, found, value = rest.partition("=")
            if not found or not name.strip().isidentifier():
                raise TemplateError(f"set takes `name = value`, not {rest!r}")
            return Assign(name.strip(), _Expression(value).whole())
        if word == "generation":
            return Generation(self.body("endgeneration")[0])
        raise TemplateError(f"no tag {word!r}")

    def branch(self, test: str) -> Branch:
        yes, closed = self.body("elif", "else", "endif")
        if closed.startswith("elif"):
            no = (self.branch(closed[4:]),)
        else:
            no = self.body("endif")[0] if closed == "else" else ()
        return Branch(_Expression(test).whole(), yes, no)


# ---- constant folding

def _function(what: str) -> Callable:
    return FILTERS[what[2:]] if what.startswith("| ") else FUNCTIONS[what]


def fold(node: Any) -> Any:
    """The expression with every part that hangs on no name worked out."""
    if isinstance(node, Apply):
        args = tuple(map(fold, node.args))
        if node.what == "~":  # joins are flat, and neighbouring constants one
            flat: list[Any] = []
            for arg in args:
                flat += arg.args if isinstance(arg, Apply) and arg.what == "~" else [arg]
            joined: list[Any] = []
            for const, own in groupby(flat, lambda x: isinstance(x, Const)):
                joined += [Const("".join(_text(x.value) for x in own))] if const else own
            args = tuple(joined)
        if all(isinstance(a, Const) for a in args):
            return Const(_function(node.what)(*(a.value for a in args)))
        return Apply(node.what, args)
    if isinstance(node, Choice):
        test = fold(node.test)
        if isinstance(test, Const):
            return fold(node.first if test.value else node.second)
        return Choice(test, fold(node.first), fold(node.second))
    return node


def fold_body(body: tuple) -> tuple:
    """Statements without dead branches and empty text, with neighbouring texts joined."""
    out: list[Any] = []
    for node in body:
        if isinstance(node, Write):
            value = fold(node.value)
            parts = value.args if isinstance(value, Apply) and value.what == "~" else (value,)
            out += [Write(Const(_text(p.value)) if isinstance(p, Const) else p) for p in parts]
        elif isinstance(node, Branch):
            test, yes, no = fold(node.test), fold_body(node.yes), fold_body(node.no)
            if isinstance(test, Const):
                out += yes if test.value else no
            else:
                out.append(Branch(test, yes, no))
        elif isinstance(node, Loop):
            out.append(Loop(node.name, fold(node.over), fold_body(node.body)))
        elif isinstance(node, Assign):
            out.append(Assign(node.name, fold(node.value)))
        elif inner := fold_body(node.body):
            out.append(Generation(inner))
    joined: list[Any] = []
    for const, own in groupby(out, lambda x: isinstance(x, Write) and isinstance(x.value, Const)):
        if not const:
            joined += own
        elif text := "".join(x.value.value for x in own):
            joined.append(Write(Const(text)))
    return tuple(joined)


# ---- closures

def _value(node: Any) -> Callable[[dict], Any]:
    if isinstance(node, Const):
        return lambda names, value=node.value: value
    if isinstance(node, Name):
        return lambda names, name=node.name: names.get(name)
    if isinstance(node, Choice):
        test, first, second = _value(node.test), _value(node.first), _value(node.second)
        return lambda names: first(names) if test(names) else second(names)
    call, args = _function(node.what), tuple(map(_value, node.args))
    if len(args) == 1:
        only = args[0]
        return lambda names: call(only(names))
    if len(args) == 2:
        left, right = args
        return lambda names: call(left(names), right(names))
    return lambda names: call(*(a(names) for a in args))


def _run(body: tuple) -> Callable[[dict, Output], None]:
    steps = tuple(map(_step, body))
    if len(steps) == 1:
        return steps[0]

    def run(names: dict, out: Output) -> None:
        for step in steps:
            step(names, out)
    return run


def _step(node: Any) -> Callable[[dict, Output], None]:
    if isinstance(node, Write):
        if isinstance(node.value, Const):
            return lambda names, out, text=node.value.value: out.write(text)
        value = _value(node.value)
        return lambda names, out: out.write(_text(value(names)))
    if isinstance(node, Assign):
        value = _value(node.value)
        return lambda names, out, name=node.name: names.__setitem__(name, value(names))
    if isinstance(node, Branch):
        test, yes, no = _value(node.test), _run(node.yes), _run(node.no)
        return lambda names, out: yes(names, out) if test(names) else no(names, out)
    if isinstance(node, Generation):
        inner = _run(node.body)

        def generate(names: dict, out: Output) -> None:
            start = out.size
            inner(names, out)
            if out.size > start:
                out.spans.append((start, out.size))
        return generate
    over, inner, name = _value(node.over), _run(node.body), node.name

    def loop(names: dict, out: Output) -> None:
        rows = over(names)
        if not isinstance(rows, (list, tuple)):
            raise TemplateError("for takes a list")
        own = dict(names)
        for i, row in enumerate(rows):
            own[name] = row
            own["loop"] = {"index": i + 1, "index0": i, "first": i == 0, "last": i == len(rows) - 1,
                           "length": len(rows)}
            inner(own, out)
    return loop


@lru_cache(16)
def compile_template(template: str) -> Callable[[dict], tuple[str, list[tuple[int, int]]]]:
    """A function from names to the rendered text and its generated spans."""
    run = _run(fold_body(_Statements(template).body()[0]))

    def render(names: dict) -> tuple[str, list[tuple[int, int]]]:
        out = Output()
        run(dict(names), out)
        return "".join(out.parts), out.spans
    return render


# ---- Spark

SPANS = pa.list_(pa.struct([("first", pa.int64()), ("past", pa.int64())]))


def formatted(rows: DataFrame, template: str = TEMPLATE, conv_id: str = "conv_id", turn: str = "turn",
              role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, n_turns, formatted, spans): each conversation, and its generated code points."""
    compile_template(template)  # a wrong template fails here
    plain = rows.selectExpr(f"`{conv_id}` AS conv_id", f"`{turn}` AS turn", f"`{role}` AS role", f"`{text}` AS text")
    kind, id_type = plain.schema["conv_id"].dataType, to_arrow_type(plain.schema["conv_id"].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        render = compile_template(template)

        def turns():
            for batch in batches:
                yield from zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text")))

        done, size = [], 0
        for key, own in groupby(turns(), lambda row: row[0]):
            messages = [{"role": r or "", "text": t or ""} for _, r, t in own]
            said, spans = render({"messages": messages})
            done.append((key, len(messages), said, [{"first": a, "past": b} for a, b in spans]))
            size += len(said)
            if size > 1 << 22:
                yield _rows(done, id_type)
                done, size = [], 0
        if done:
            yield _rows(done, id_type)

    return (plain.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
            .mapInArrow(run, f"conv_id {kind.simpleString()}, n_turns long, formatted string, "
                             "spans array<struct<first:bigint,past:bigint>>"))


def _rows(done: list[tuple], id_type: pa.DataType) -> pa.RecordBatch:
    kinds = (id_type, pa.int64(), pa.string(), SPANS)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(zip(*done), kinds)], ["conv_id", "n_turns", "formatted", "spans"])


def read_back(said: str, spans: list[dict]) -> tuple[list[tuple[str, str]], str]:
    """The turns as (role, text), and all text under the mask, from a formatted conversation."""
    turns = [(unescape(m[1]), unescape(m[2])) for m in _TURN.finditer(said)]
    return turns, "".join(unescape(said[s["first"]:s["past"]]) for s in spans)


def read(conversations: DataFrame) -> DataFrame:
    """`formatted`'s rows with `turns` and `learnt`, read back from the output of `TEMPLATE`."""
    names = conversations.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [read_back(*x) for x in zip(batch.column("formatted").to_pylist(),
                                                batch.column("spans").to_pylist())]
            turns = pa.array([[{"role": r, "text": t} for r, t in own] for own, _ in found],
                             pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())])))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, turns, pa.array([x for _, x in found], pa.string())],
                [*names, "turns", "learnt"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in conversations.schema.fields)
    return conversations.mapInArrow(
        run, f"{kinds}, turns array<struct<role:string,text:string>>, learnt string")
