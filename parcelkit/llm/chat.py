"""Chat formatting with a small compiled template language.

A template is text with ``{{ expression }}`` outputs and ``{% statement %}``
tags: for/endfor, if/elif/else/endif, set, generation/endgeneration. It is
parsed into a syntax tree, constant parts are folded, and the tree becomes
nested Python closures; nothing of a template is ever executed as Python.
Expressions know literals, names, fields of mappings, ``loop`` variables,
+ ~ == != < <= > >= in, and/or/not and a fixed set of filters. Anything else
is a TemplateError when the template is compiled.

Rendering is a stream: loops take their items as they come and text leaves
in pieces, each marked as generated (to be learned) or not, so the longest
conversation needs memory for one message. Control strings inside messages
are escaped reversibly, so a formatted conversation can be read back.
"""

from __future__ import annotations

import hashlib
import operator
import re
from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelkit.llm.common import prepare

OPEN, MIDDLE, CLOSE = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
# Strings that mean something to chat models; none appears unescaped inside a
# message. Fixed values of public chat formats.
CONTROL = (OPEN, MIDDLE, CLOSE, "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|endoftext|>",
           "<|startoftext|>", "<|system|>", "<|user|>", "<|assistant|>", "<|eot_id|>", "<|begin_of_text|>",
           "<|start_header_id|>", "<|end_header_id|>", "<start_of_turn>", "<end_of_turn>", "<bos>", "<eos>")
TEMPLATE = (
    "{% for m in messages %}" + OPEN + "{{ m.role | escape }}" + MIDDLE
    + "{% if m.role == 'assistant' %}{% generation %}{{ m.text | escape }}{% endgeneration %}"
    + "{% else %}{{ m.text | escape }}{% endif %}" + CLOSE + "{% endfor %}")
# Characters of one output part; a part grows beyond by one message at most.
PART = 1 << 20

_CONTROL_AT = re.compile("(?=(?:" + "|".join(map(re.escape, CONTROL)) + "))(.)", re.S)


class TemplateError(ValueError):
    """The template is not in the language."""


def escape(text: str) -> str:
    """Double backslashes, and put one after the first character of every
    control string, so that none is left."""
    return _CONTROL_AT.sub(r"\1\\", text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    """The text that ``escape`` was given."""
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


FILTERS: dict[str, Callable] = {
    "escape": lambda x: escape(_text(x)), "trim": lambda x: _text(x).strip(), "upper": lambda x: _text(x).upper(),
    "lower": lambda x: _text(x).lower(), "length": lambda x: len(x), "string": lambda x: _text(x)}
COMPARE = {"==": operator.eq, "!=": operator.ne, "<": operator.lt, "<=": operator.le, ">": operator.gt,
           ">=": operator.ge, "in": lambda a, b: a in b}


def _text(x) -> str:
    return "" if x is None else "true" if x is True else "false" if x is False else str(x)


# --- parsing: text -> tree of tuples ------------------------------------------------

_TAG = re.compile(r"\{\{(-?)(.*?)(-?)\}\}|\{%(-?)(.*?)(-?)%\}|\{#.*?#\}", re.S)
_TOKEN = re.compile(r"""\s*(?:(\d+)|("(?:[^"\\]|\\.)*"|'(?:[^'\\]|\\.)*')|([A-Za-z_]\w*)|(==|!=|<=|>=|[<>+~|.()\[\]]))""", re.S)
_WORDS = {"and", "or", "not", "in", "true", "false", "none"}


def _tokens(source: str) -> list[tuple[str, str]]:
    out, at = [], 0
    source = source.rstrip()
    while at < len(source):
        m = _TOKEN.match(source, at)
        if not m:
            raise TemplateError(f"unexpected text: {source[at:at + 20]!r}")
        kind = next(k for k, g in zip(("int", "str", "name", "op"), m.groups()) if g is not None)
        value = m.group(m.lastindex)
        out.append(("op" if value in ("and", "or", "not", "in") else kind, value))
        at = m.end()
    return out


class _Expression:
    """Recursive descent over the tokens of one expression."""

    def __init__(self, source: str):
        self.tokens, self.at = _tokens(source), 0

    def whole(self) -> tuple:
        tree = self.either()
        if self.at < len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at][1]!r}")
        return tree

    def take(self, *ops: str) -> str | None:
        if self.at < len(self.tokens) and self.tokens[self.at][0] == "op" and self.tokens[self.at][1] in ops:
            self.at += 1
            return self.tokens[self.at - 1][1]
        return None

    def need(self, kind: str) -> str:
        if self.at >= len(self.tokens) or self.tokens[self.at][0] != kind:
            raise TemplateError(f"{kind} expected")
        self.at += 1
        return self.tokens[self.at - 1][1]

    def either(self) -> tuple:
        left = self.both()
        while self.take("or"):
            left = ("or", left, self.both())
        return left

    def both(self) -> tuple:
        left = self.negation()
        while self.take("and"):
            left = ("and", left, self.negation())
        return left

    def negation(self) -> tuple:
        return ("not", self.negation()) if self.take("not") else self.comparison()

    def comparison(self) -> tuple:
        left = self.sum()
        op = self.take(*COMPARE)
        return ("compare", op, left, self.sum()) if op else left

    def sum(self) -> tuple:
        left = self.filtered()
        while op := self.take("+", "~"):
            left = ("join" if op == "~" else "add", left, self.filtered())
        return left

    def filtered(self) -> tuple:
        tree = self.value()
        while self.take("|"):
            name = self.need("name")
            if name not in FILTERS:
                raise TemplateError(f"unknown filter {name!r}")
            tree = ("filter", name, tree)
        return tree

    def value(self) -> tuple:
        if self.take("("):
            tree = self.either()
            if not self.take(")"):
                raise TemplateError(") expected")
        elif self.at < len(self.tokens) and self.tokens[self.at][0] in ("int", "str"):
            kind, text = self.tokens[self.at]
            self.at += 1
            tree = ("const", int(text) if kind == "int" else
                    re.sub(r"\\(.)", lambda m: {"n": "\n", "t": "\t"}.get(m[1], m[1]), text[1:-1], flags=re.S))
        else:
            name = self.need("name")
            tree = ("const", {"true": True, "false": False, "none": None}[name]) if name in _WORDS else ("name", name)
        while op := self.take(".", "["):
            if op == ".":
                key = ("const", self.need("name"))
            else:
                key = self.either()
                if not self.take("]"):
                    raise TemplateError("] expected")
            tree = ("field", tree, key)
        return tree


def parse(template: str) -> tuple:
    """Syntax tree of a template."""
    parts, at = [], 0
    strip = False
    for m in _TAG.finditer(template):
        text = template[at:m.start()]
        at = m.end()
        text = text.lstrip() if strip else text
        parts.append(("text", text.rstrip() if m[1] or m[4] else text))
        strip = bool(m[3] or m[6])
        if m[2] is not None:
            parts.append(("output", m[2]))
        elif m[5] is not None:
            parts.append(("tag", m[5].strip()))
    tail = template[at:]
    parts.append(("text", tail.lstrip() if strip else tail))
    parts.reverse()
    tree, end = _block(parts, ())
    return tree


def _block(parts: list, ends: tuple) -> tuple[tuple, str]:
    """Nodes up to one of the tags ``ends``, which is returned too."""
    nodes: list = []
    while parts:
        kind, value = parts.pop()
        if kind == "text":
            nodes.append(("text", value))
            continue
        if kind == "output":
            nodes.append(("output", _Expression(value).whole()))
            continue
        word, _, rest = value.partition(" ")
        if word in ends:
            return ("block", nodes), value
        if word == "for":
            m = re.fullmatch(r"([A-Za-z_]\w*)\s+in\s+(.+)", rest.strip(), re.S)
            if not m:
                raise TemplateError(f"bad loop: {value!r}")
            body, _ = _block(parts, ("endfor",))
            nodes.append(("for", m[1], _Expression(m[2]).whole(), body))
        elif word == "if":
            nodes.append(_branches(parts, rest))
        elif word == "set":
            m = re.fullmatch(r"([A-Za-z_]\w*)\s*=(?!=)(.+)", rest.strip(), re.S)
            if not m:
                raise TemplateError(f"bad assignment: {value!r}")
            nodes.append(("set", m[1], _Expression(m[2]).whole()))
        elif word == "generation":
            body, _ = _block(parts, ("endgeneration",))
            nodes.append(("generation", body))
        else:
            raise TemplateError(f"unknown tag {word!r}")
    if ends:
        raise TemplateError(f"{ends[-1]} missing")
    return ("block", nodes), ""


def _branches(parts: list, condition: str) -> tuple:
    body, end = _block(parts, ("elif", "else", "endif"))
    word, _, rest = end.partition(" ")
    if word == "elif":
        other = _branches(parts, rest)
    elif word == "else":
        other, _ = _block(parts, ("endif",))
    else:
        other = ("block", [])
    return ("if", _Expression(condition).whole(), body, other)


# --- folding: tree -> smaller tree --------------------------------------------------

def fold(tree: tuple) -> tuple:
    """The tree with constant expressions evaluated, constant outputs turned
    into text, decided branches chosen and neighbouring texts joined."""
    kind = tree[0]
    if kind == "block":
        nodes: list = []
        for node in map(fold, tree[1]):
            for n in node[1] if node[0] == "block" else [node]:
                if n[0] == "text" and nodes and nodes[-1][0] == "text":
                    nodes[-1] = ("text", nodes[-1][1] + n[1])
                elif n != ("text", ""):
                    nodes.append(n)
        return ("block", nodes)
    if kind == "output":
        inner = fold(tree[1])
        return ("text", _text(inner[1])) if inner[0] == "const" else ("output", inner)
    if kind == "if":
        test = fold(tree[1])
        if test[0] == "const":
            return fold(tree[2] if test[1] else tree[3])
        return ("if", test, fold(tree[2]), fold(tree[3]))
    if kind in ("text", "const", "name"):
        return tree
    parts = tuple(fold(x) if isinstance(x, tuple) else x for x in tree[1:])
    inner = [x for x in parts if isinstance(x, tuple)]
    if kind not in ("for", "set", "generation") and all(x[0] == "const" for x in inner):
        return ("const", _expression((kind, *parts))({}))
    return (kind, *parts)


# --- compiling: tree -> closures ----------------------------------------------------

def _expression(tree: tuple) -> Callable:
    kind = tree[0]
    if kind == "const":
        value = tree[1]
        return lambda env: value
    if kind == "name":
        name = tree[1]

        def look(env):
            try:
                return env[name]
            except KeyError:
                raise TemplateError(f"unknown name {name!r}") from None
        return look
    if kind == "filter":
        apply, inner = FILTERS[tree[1]], _expression(tree[2])
        return lambda env: apply(inner(env))
    if kind == "compare":
        test, a, b = COMPARE[tree[1]], _expression(tree[2]), _expression(tree[3])
        return lambda env: test(a(env), b(env))
    if kind == "not":
        a = _expression(tree[1])
        return lambda env: not a(env)
    a, b = _expression(tree[1]), _expression(tree[2])
    if kind == "and":
        return lambda env: a(env) and b(env)
    if kind == "or":
        return lambda env: a(env) or b(env)
    if kind == "join":
        return lambda env: _text(a(env)) + _text(b(env))
    if kind == "add":
        return lambda env: _add(a(env), b(env))
    return lambda env: _field(a(env), b(env))


def _add(a, b):
    if isinstance(a, str) and isinstance(b, str) or isinstance(a, int) and isinstance(b, int):
        return a + b
    raise TemplateError("+ joins two texts or two numbers")


def _field(of, key):
    """Fields of mappings and items of lists only: no attributes of objects."""
    if isinstance(of, dict):
        return of.get(key)
    if isinstance(of, (list, tuple)) and isinstance(key, int):
        return of[key]
    raise TemplateError(f"no field {key!r}")


def _statement(tree: tuple) -> Callable[[dict, bool], Iterator[tuple[str, bool]]]:
    """A closure (env, generated) that yields (text, generated)."""
    kind = tree[0]
    if kind == "text":
        text = tree[1]

        def run(env, gen):
            yield text, gen
    elif kind == "output":
        value = _expression(tree[1])

        def run(env, gen):
            yield _text(value(env)), gen
    elif kind == "block":
        steps = [_statement(n) for n in tree[1]]

        def run(env, gen):
            for step in steps:
                yield from step(env, gen)
    elif kind == "set":
        name, value = tree[1], _expression(tree[2])

        def run(env, gen):
            env[name] = value(env)
            return iter(())
        return run
    elif kind == "if":
        test, yes, no = _expression(tree[1]), _statement(tree[2]), _statement(tree[3])

        def run(env, gen):
            yield from yes(env, gen) if test(env) else no(env, gen)
    elif kind == "generation":
        body = _statement(tree[1])

        def run(env, gen):
            yield from body(env, True)
    else:
        name, items, body = tree[1], _expression(tree[2]), _statement(tree[3])

        def run(env, gen):
            source = iter(items(env))
            end = object()
            item, i = next(source, end), 0
            while item is not end:
                after = next(source, end)  # one ahead, for loop.last
                scope = dict(env)
                scope[name] = item
                scope["loop"] = {"index0": i, "index": i + 1, "first": i == 0, "last": after is end}
                yield from body(scope, gen)
                item, i = after, i + 1
    return run


def compile_template(template: str) -> Callable[[Iterable[dict]], Iterator[tuple[str, bool]]]:
    """A function from messages to (text, generated) pieces."""
    run = _statement(fold(parse(template)))
    return lambda messages: run({"messages": messages}, False)


# --- Spark: conversations -> formatted parts -> what they say -----------------------

def _groups(batches: Iterator[pd.DataFrame], key: str) -> Iterator[tuple[int | None, Iterator]]:
    """Consecutive rows of equal key, as (key, rows); a group's rows are read
    as they are asked for and may span batches."""
    def rows():
        for pdf in batches:
            yield from pdf.itertuples(index=False)

    from itertools import groupby

    for k, group in groupby(rows(), key=lambda r: None if pd.isna(getattr(r, key)) else int(getattr(r, key))):
        yield k, group


def _format(template: str, part: int):
    def run(batches):
        render = compile_template(template)
        out: list = []
        held = 0
        for key, rows in _groups(batches, "conv_id"):
            messages = ({"role": r.role, "text": r.text, "turn": r.turn} for r in rows)
            n, text, spans, size = 0, [], [], 0
            for piece, gen in render(messages):
                if not piece:
                    continue
                if gen:
                    spans.append([size, size + len(piece)])
                text.append(piece)
                size += len(piece)
                if size >= part:
                    out.append((key, n, "".join(text), spans))
                    n, text, spans, held, size = n + 1, [], [], held + size, 0
                    if held >= part:
                        yield _frame(out)
                        out, held = [], 0
            if text or not n:
                out.append((key, n, "".join(text), spans))
                held += size
            if held >= part:
                yield _frame(out)
                out, held = [], 0
        yield _frame(out)
    return run


def _frame(rows: list) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=["conv_id", "part", "text", "spans"])
    return out.assign(conv_id=out["conv_id"].astype("Int64"))


def format_conversations(rows: DataFrame, template: str = TEMPLATE, part: int = PART) -> DataFrame:
    """(conv_id, part, text, spans): each conversation's formatted text in
    parts of about ``part`` characters, with the character ranges of a part
    that the model is to generate. A conversation's parts follow each other
    in one partition.

    Messages go by turn; equal turns by role and text; null turns first. A
    null role or text is empty; null conv_ids are one conversation; extra
    columns are left out; an empty table gives an empty result.
    """
    prepare(rows.sparkSession)
    compile_template(template)  # a bad template fails here
    clean = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    # One conversation's turns in order is what a template needs; they stream
    # through the task, so a long conversation is not held there.
    ordered = clean.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.mapInPandas(_format(template, part), "conv_id long, part long, text string, spans array<array<long>>")


def _read_back(batches):
    """Digests of formatted conversations, from their text and spans alone."""
    turn = re.compile(re.escape(OPEN) + "(.*?)" + re.escape(MIDDLE) + "(.*?)" + re.escape(CLOSE), re.S)
    out = []
    for key, parts in _groups(batches, "conv_id"):
        turns, loss = hashlib.sha256(), hashlib.sha256()
        n = loss_chars = chars = 0
        open_text, half = "", ""
        for p in parts:
            chars += len(p.text)
            open_text += p.text
            at = 0
            for m in turn.finditer(open_text):
                n, at = n + 1, m.end()
                turns.update(f"{unescape(m[1])}\n{unescape(m[2])}\n".encode("utf-8", "replace"))
            open_text = open_text[at:]
            for a, b in p.spans:
                said = half + p.text[a:b]
                # An escape may be cut between two parts.
                cut = len(said) - len(said.rstrip("\\"))
                half = "\\" if cut % 2 else ""
                said = unescape(said[:len(said) - len(half)])
                loss.update(said.encode("utf-8", "replace"))
                loss_chars += len(said)
        out.append((key, n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars))
        if len(out) >= 10_000:
            yield _digests(out)
            out = []
    yield _digests(out)


def _digests(rows: list) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])
    return out.assign(conv_id=out["conv_id"].astype("Int64"))


def read_back(formatted: DataFrame) -> DataFrame:
    """One row per conversation of ``format_conversations`` with the default
    template: n_turns, turns_sha256 (role, line end, text, line end per
    turn), loss_chars and loss_sha256 (what the spans hold, unescaped) and
    formatted_chars."""
    return formatted.mapInPandas(_read_back, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
                                             "loss_sha256 string, formatted_chars long")
