"""Operator 3: chat formatting with a small sandboxed template language.

A template is parsed into a syntax tree, constants are folded, and the tree is
compiled to Python closures that render a conversation and note which
characters lie between ``{% generation %}`` and ``{% endgeneration %}``.

Language: ``{{ expr }}``, ``{% for x in expr %}``, ``{% if expr %}`` with elif and else, ``{% generation %}``,
comments ``{# #}``, and ``-`` beside a mark to trim white space.  Expressions
have strings, integers, names, ``a.b``, ``a["b"]``, ``|filter``, ``~`` and
``+``, comparisons, ``in``, ``and``, ``or``, ``not``.  There are no calls and no
access to Python attributes: ``a.b`` looks up a key of a mapping, so a template can't leave its data.

The filter ``guard`` escapes control strings: a backslash goes before each
control string and each backslash, so texts can't forge a mark and ``unguard``
gives back the text as it was.

Defined cases: null texts and roles are empty; turns are ordered by turn (null first), role
and text; rows without a conv_id are one conversation; repeated rows are turns of their own; other columns are
ignored, whatever their names; an empty table gives an empty table.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Mapping

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]")
TEMPLATE = (
    '{% for m in messages -%}\n'
    '{{ "<s>" ~ "[INST] " }}{{ m.role | guard }}{{ " [/INST]" }}\n'
    '{%- if m.role == "assistant" %}{% generation %}{{ m.text | guard }}{% endgeneration %}'
    '{% else %}{{ m.text | guard }}{% endif %}</s>{% endfor %}')


class TemplateError(ValueError):
    """A template that isn't well formed, or a value it can't use."""


# -- reading ---------------------------------------------------------------------------------------------------

_MARKS = re.compile(r"(\{\{-?|\{%-?|\{#)(.*?)(-?\}\}|-?%\}|#\})", re.S)
_TOKEN = re.compile(r"""\s*(?:(?P<str>"(?:\\.|[^"\\])*"|'(?:\\.|[^'\\])*')|(?P<int>\d+)|(?P<name>[A-Za-z_]\w*)"""
                    r"""|(?P<op>==|!=|<=|>=|[<>|.~+()\[\]]))""", re.S)
_ENDS = {"{{": "}}", "{%": "%}", "{#": "#}"}


def _pieces(source: str) -> list[tuple[str, str]]:
    out, at, trim = [], 0, False
    for m in _MARKS.finditer(source):
        opening, body, closing = m.groups()
        if _ENDS[opening[:2]] != closing[-2:]:
            raise TemplateError(f"mark {opening} is closed by {closing}")
        text = source[at:m.start()]
        text = text.lstrip() if trim else text
        out.append(("text", text.rstrip() if opening.endswith("-") else text))
        if opening != "{#":
            out.append(("out" if opening[:2] == "{{" else "tag", body.strip()))
        at, trim = m.end(), closing.startswith("-")
    out.append(("text", source[at:].lstrip() if trim else source[at:]))
    return [p for p in out if p[1] or p[0] != "text"]


def _tokens(source: str) -> list[tuple[str, str]]:
    out, at = [], 0
    source = source.rstrip()
    while at < len(source):
        m = _TOKEN.match(source, at)
        if not m:
            raise TemplateError(f"can't read {source[at:]!r}")
        out.append((m.lastgroup, m.group(m.lastgroup)))
        at = m.end()
    return out


class _Expression:
    """Recursive descent over the tokens of one expression."""

    def __init__(self, source: str):
        self.tokens, self.at = _tokens(source), 0

    def whole(self):
        node = self.either()
        if self.at < len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at][1]!r}")
        return node

    def next_is(self, *words: str) -> str | None:
        if self.at < len(self.tokens):
            kind, word = self.tokens[self.at]
            if kind in ("op", "name") and word in words:
                self.at += 1
                return word
        return None

    def need(self, kind: str, word: str | None = None) -> str:
        if self.at < len(self.tokens) and self.tokens[self.at][0] == kind and word in (None, self.tokens[self.at][1]):
            self.at += 1
            return self.tokens[self.at - 1][1]
        raise TemplateError(f"expected {word or kind}")

    def either(self):
        node = self.both()
        while self.next_is("or"):
            node = ("or", node, self.both())
        return node

    def both(self):
        node = self.negated()
        while self.next_is("and"):
            node = ("and", node, self.negated())
        return node

    def negated(self):
        return ("not", self.negated()) if self.next_is("not") else self.compared()

    def compared(self):
        node = self.joined()
        while op := self.next_is("==", "!=", "<=", ">=", "<", ">", "in"):
            node = (op, node, self.joined())
        return node

    def joined(self):
        node = self.filtered()
        while op := self.next_is("~", "+"):
            node = (op, node, self.filtered())
        return node

    def filtered(self):
        node = self.reached()
        while self.next_is("|"):
            node = ("filter", self.need("name"), node)
        return node

    def reached(self):
        node = self.atom()
        while op := self.next_is(".", "["):
            if op == ".":
                node = ("item", node, ("const", self.need("name")))
            else:
                node = ("item", node, self.either())
                self.need("op", "]")
        return node

    def atom(self):
        if self.next_is("("):
            node = self.either()
            self.need("op", ")")
            return node
        if self.at >= len(self.tokens):
            raise TemplateError("an expression ends too early")
        kind, word = self.tokens[self.at]
        self.at += 1
        if kind == "str":
            return ("const", re.sub(r"\\(.)", lambda m: {"n": "\n", "t": "\t"}.get(m[1], m[1]), word[1:-1], flags=re.S))
        if kind == "int":
            return ("const", int(word))
        if kind == "name":
            return ("const", {"true": True, "false": False, "none": None}[word]) if word in ("true", "false", "none") else (
                "name", word)
        raise TemplateError(f"unexpected {word!r}")


def parse(source: str) -> list:
    """Syntax tree of a template: a list of statement nodes."""
    pieces, at = _pieces(source), 0

    def body(*ends: str):
        nonlocal at
        nodes = []
        while at < len(pieces):
            kind, text = pieces[at]
            at += 1
            if kind == "text":
                nodes.append(("text", text))
            elif kind == "out":
                nodes.append(("out", _Expression(text).whole()))
            else:
                word, _, rest = text.partition(" ")
                if word in ends:
                    return nodes, word, rest
                nodes.append(statement(word, rest))
        if ends:
            raise TemplateError(f"missing {' or '.join(ends)}")
        return nodes, "", ""

    def statement(word: str, rest: str):
        if word == "for":
            m = re.fullmatch(r"\s*([A-Za-z_]\w*)\s+in\s+(.+)", rest, re.S)
            if not m:
                raise TemplateError(f"can't read for {rest!r}")
            return ("for", m[1], _Expression(m[2]).whole(), body("endfor")[0])
        if word == "if":
            cases, otherwise, test = [], [], _Expression(rest).whole()
            while True:
                nodes, end, rest = body("elif", "else", "endif")
                cases.append((test, nodes))
                if end == "elif":
                    test = _Expression(rest).whole()
                    continue
                if end == "else":
                    otherwise = body("endif")[0]
                return ("if", cases, otherwise)
        if word == "generation":
            return ("generation", body("endgeneration")[0])
        raise TemplateError(f"unknown statement {word!r}")

    return body()[0]


# -- folding ---------------------------------------------------------------------------------------------------

def _apply(op: str, a, b):
    if op == "~":
        return _shown(a) + _shown(b)
    if op == "+":
        if type(a) is type(b) and isinstance(a, (int, str)):
            return a + b
        raise TemplateError("+ needs two strings or two integers")
    if op == "in":
        return a in b if isinstance(b, (str, list, tuple, Mapping)) else False
    return {"==": lambda: a == b, "!=": lambda: a != b, "<": lambda: a < b, ">": lambda: a > b, "<=": lambda: a <= b,
            ">=": lambda: a >= b}[op]()


def _shown(value) -> str:
    return "" if value is None else value if isinstance(value, str) else str(value)


def fold_expression(node, filters: Mapping[str, Callable]):
    kind = node[0]
    if kind in ("const", "name"):
        return node
    if kind == "filter":
        if node[1] not in filters:
            raise TemplateError(f"unknown filter {node[1]!r}")
        inner = fold_expression(node[2], filters)
        return ("const", filters[node[1]](inner[1])) if inner[0] == "const" else ("filter", node[1], inner)
    parts = [fold_expression(n, filters) for n in node[1:]]
    if kind in ("and", "or") and parts[0][0] == "const":
        return parts[1] if bool(parts[0][1]) == (kind == "and") else parts[0]
    if all(p[0] == "const" for p in parts) and kind != "item":
        return ("const", not parts[0][1] if kind == "not" else _apply(kind, parts[0][1], parts[1][1]))
    return (kind, *parts)


def fold(nodes: list, filters: Mapping[str, Callable]) -> list:
    """The tree with constant expressions computed, dead branches cut and neighbouring texts joined."""
    out: list = []

    def add(node) -> None:
        if node[0] == "text" and out and out[-1][0] == "text":
            out[-1] = ("text", out[-1][1] + node[1])
        elif node != ("text", ""):
            out.append(node)

    for node in nodes:
        if node[0] == "out":
            e = fold_expression(node[1], filters)
            add(("text", _shown(e[1])) if e[0] == "const" else ("out", e))
        elif node[0] == "for":
            add(("for", node[1], fold_expression(node[2], filters), fold(node[3], filters)))
        elif node[0] == "generation":
            add(("generation", fold(node[1], filters)))
        elif node[0] == "if":
            cases, otherwise = [], fold(node[2], filters)
            for test, body in node[1]:
                test = fold_expression(test, filters)
                if test[0] != "const":
                    cases.append((test, fold(body, filters)))
                elif test[1]:
                    otherwise = fold(body, filters)
                    break
            for n in [("if", cases, otherwise)] if cases else otherwise:
                add(n)
        else:
            add(node)
    return out


# -- compiling -------------------------------------------------------------------------------------------------

class _Output:
    def __init__(self):
        self.parts, self.size, self.spans = [], 0, []

    def put(self, text: str) -> None:
        self.parts.append(text)
        self.size += len(text)


def _compile_expression(node, filters) -> Callable:
    kind = node[0]
    if kind == "const":
        return lambda env, v=node[1]: v
    if kind == "name":
        return lambda env, n=node[1]: env.get(n)
    if kind == "filter":
        inner, f = _compile_expression(node[2], filters), filters[node[1]]
        return lambda env: f(inner(env))
    a = _compile_expression(node[1], filters)
    if kind == "not":
        return lambda env: not a(env)
    b = _compile_expression(node[2], filters)
    if kind == "and":
        return lambda env: a(env) and b(env)
    if kind == "or":
        return lambda env: a(env) or b(env)
    if kind == "item":
        def item(env):
            of, key = a(env), b(env)
            if isinstance(of, Mapping):
                return of.get(key)
            if isinstance(of, (list, tuple)) and isinstance(key, int):
                return of[key] if -len(of) <= key < len(of) else None
            return None
        return item
    return lambda env: _apply(kind, a(env), b(env))


def _compile_nodes(nodes: list, filters) -> Callable:
    steps = [_compile_node(n, filters) for n in nodes]

    def run(env, out):
        for step in steps:
            step(env, out)
    return run


def _compile_node(node, filters) -> Callable:
    kind = node[0]
    if kind == "text":
        return lambda env, out, t=node[1]: out.put(t)
    if kind == "out":
        value = _compile_expression(node[1], filters)
        return lambda env, out: out.put(_shown(value(env)))
    if kind == "generation":
        inner = _compile_nodes(node[1], filters)

        def generation(env, out):
            start = out.size
            inner(env, out)
            out.spans.append((start, out.size))
        return generation
    if kind == "for":
        name, items, inner = node[1], _compile_expression(node[2], filters), _compile_nodes(node[3], filters)

        def loop(env, out):
            values = items(env)
            if not isinstance(values, (list, tuple)):
                raise TemplateError("for needs a list")
            for k, v in enumerate(values):
                inner({**env, name: v, "loop": {"index0": k, "first": k == 0, "last": k == len(values) - 1}}, out)
        return loop
    cases = [(_compile_expression(t, filters), _compile_nodes(b, filters)) for t, b in node[1]]
    otherwise = _compile_nodes(node[2], filters)

    def choose(env, out):
        for test, inner in cases:
            if test(env):
                return inner(env, out)
        return otherwise(env, out)
    return choose


def guard(text: str, controls=CONTROLS) -> str:
    return re.sub("|".join([r"\\", *map(re.escape, controls)]), lambda m: "\\" + m[0], text)


def unguard(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


def compile_template(source: str = TEMPLATE, controls=CONTROLS) -> Callable[[list], tuple[str, list[tuple[int, int]]]]:
    """A function from a list of messages to the rendered text and the spans of its generated parts."""
    filters = {"guard": lambda v: guard(_shown(v), controls), "trim": lambda v: _shown(v).strip(),
               "upper": lambda v: _shown(v).upper(), "lower": lambda v: _shown(v).lower(),
               "length": lambda v: len(v) if isinstance(v, (str, list, tuple, Mapping)) else 0}
    run = _compile_nodes(fold(parse(source), filters), filters)

    def render(messages: list) -> tuple[str, list[tuple[int, int]]]:
        out = _Output()
        run({"messages": messages}, out)
        return "".join(out.parts), out.spans
    return render


_READ = re.compile(r"\\.|(" + "|".join(map(re.escape, CONTROLS)) + ")", re.S)


def read_turns(text: str) -> list[dict[str, str]]:
    """Roles and texts of a conversation rendered by ``TEMPLATE``, from its marks alone."""
    marks = [(m[1], m.start(), m.end()) for m in _READ.finditer(text) if m[1]]
    turns = []
    for k in range(0, len(marks), 4):
        names = tuple(m[0] for m in marks[k:k + 4])
        if names != ("<s>", "[INST]", "[/INST]", "</s>"):
            raise ValueError(f"marks out of order: {names}")
        role = text[marks[k + 1][2]:marks[k + 2][1]]
        turns.append({"role": unguard(role[1:-1]), "text": unguard(text[marks[k + 2][2]:marks[k + 3][1]])})
    return turns


# -- tables ----------------------------------------------------------------------------------------------------

_SPAN = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
_TURN = T.ArrayType(T.StructType([T.StructField("role", T.StringType()), T.StructField("text", T.StringType())]))



def format_chats(rows: DataFrame, template: str = TEMPLATE, conv_col: str = "conv_id", turn_col: str = "turn",
                 role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv, formatted, loss_spans): each conversation rendered, with the spans (in code points) of its generated parts.

    The turns of one conversation are together in one row, as its rendered text is.
    """
    turn = F.struct(F.col(f"`{turn_col}`").alias("turn"), F.coalesce(F.col(f"`{role_col}`"), F.lit("")).alias("role"),
                    F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    convs = rows.select(F.col(f"`{conv_col}`").alias("_conv"), turn.alias("_turn")).groupBy("_conv").agg(
        F.transform(F.sort_array(F.collect_list("_turn")), lambda t: F.struct(t["role"], t["text"])).alias("_turns"))
    kind = convs.schema["_conv"].dataType
    pair = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        render = compile_template(template)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                done = []
                for turns in part.column(1).to_pylist():
                    text, spans = render([{"role": t["role"], "text": t["text"]} for t in turns])
                    done.append((text, [{"start": a, "end": b} for a, b in spans]))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([d[0] for d in done], pa.string()),
                                                  pa.array([d[1] for d in done], pair)], names=["_conv", "formatted", "loss_spans"])

    named = convs.select("_conv", F.col("_turns").cast(_TURN))
    return named.mapInArrow(run, T.StructType([T.StructField("_conv", kind), T.StructField("formatted", T.StringType()),
                                               T.StructField("loss_spans", _SPAN)])).withColumnRenamed("_conv", conv_col)


def read_chats(formatted: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """(conv, formatted, turns, loss_text), read back from the rendered text and its spans."""
    fields = T.StructType([formatted.schema[conv_col], T.StructField("formatted", T.StringType()),
                           T.StructField("turns", _TURN), T.StructField("loss_text", T.StringType())])
    turn = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts, spans = part.column(1).to_pylist(), part.column(2).to_pylist()
                turns = [read_turns(t) for t in texts]
                loss = ["".join(unguard(t[s["start"]:s["end"]]) for s in ss) for t, ss in zip(texts, spans)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(turns, turn),
                                                  pa.array(loss, pa.string())], names=fields.names)

    return formatted.select(conv_col, "formatted", "loss_spans").mapInArrow(run, fields)
