"""Chat formatting through a small sandboxed template language.

A template is parsed into a syntax tree, constant parts are folded (adjacent
literals, constant expressions, branches of constant conditions), and the rest
becomes Python closures that yield (text, in_generation) chunks. Templates know
text, `{{ expr }}`, `{% for x in expr %}`, `{% if %}`/`{% elif %}`/`{% else %}`,
`{% set x = expr %}` and `{% generation %}` (the loss mask). Expressions have
literals, names, item access by dot or bracket on mappings and lists, `==`,
`!=`, `and`, `or`, `not`, `~`, and the filters listed in FILTERS: no Python
attribute, call or builtin can be reached.

Chunks are made lazily, so a conversation streams through in the order of its
turns and no task holds more than two turns, however long the conversation.
Defined results: null texts and roles count as empty, rows of one conversation
are taken by turn, then role, then text (repeated rows each make a turn), a null
conv_id is a conversation of its own, an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

END = "</turn>"
MARK = "###"
KNOWN_ROLES = ("user", "assistant", "system")
TEMPLATE = (
    "{% for m in messages %}### {{ m.role | label }}:\n"
    "{% if m.role == 'assistant' %}{% generation %}{{ m.text | escape }}{% endgeneration %}"
    "{% else %}{{ m.text | escape }}{% endif %}</turn>\n{% endfor %}"
)


class TemplateError(ValueError):
    pass


def escape(text: str) -> str:
    """Doubles backslashes and puts one before each control string."""
    return text.replace("\\", "\\\\").replace(MARK, "\\" + MARK).replace(END, "\\" + END)


def unescape(text: str) -> str:
    return re.sub(r"\\(\\|" + re.escape(MARK) + "|" + re.escape(END) + ")", r"\1", text)


def label(role: str) -> str:
    """Known roles by name; any other after `=`, with colons and line ends escaped too."""
    if role in KNOWN_ROLES:
        return role.title()
    return "=" + escape(role).replace("\n", "\\n").replace(":", "\\;")


def unlabel(name: str) -> str:
    if not name.startswith("="):
        return name.lower()
    back = {"n": "\n", ";": ":"}
    return re.sub(r"\\(\\|n|;|" + re.escape(MARK) + "|" + re.escape(END) + ")", lambda m: back.get(m[1], m[1]), name[1:])


FILTERS: dict[str, Callable[[str], str]] = {"escape": escape, "label": label, "upper": str.upper, "lower": str.lower, "title": str.title, "trim": str.strip}

_TAG = re.compile(r"(\{%-?.*?-?%\}|\{\{.*?\}\})", re.S)
_TOKEN = re.compile(r"\s*(?:(?P<str>'(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\")|(?P<int>\d+)|(?P<name>[A-Za-z_]\w*)|(?P<op>==|!=|[~|.\[\]()]))")
_ESCAPES = {"n": "\n", "t": "\t"}


def _tokens(source: str) -> list[tuple[str, str]]:
    out, at, source = [], 0, source.strip()
    while at < len(source):
        if not (m := _TOKEN.match(source, at)):
            raise TemplateError(f"cannot read {source[at:]!r}")
        out.append((m.lastgroup, m[m.lastgroup]))
        at = m.end()
    return out


class _Expression:
    """Recursive descent into ('const', v), ('name', n), ('item', a, b), ('op', o, a, b), ('not', a), ('filter', f, a)."""

    def __init__(self, source: str):
        self.left = _tokens(source)
        self.tree = self._or()
        if self.left:
            raise TemplateError(f"unexpected {self.left[0][1]!r}")

    def _next(self, *values: str) -> str | None:
        if self.left and self.left[0][0] != "str" and self.left[0][1] in values:
            return self.left.pop(0)[1]
        return None

    def _binary(self, below: Callable, *ops: str):
        tree = below()
        while op := self._next(*ops):
            tree = ("op", op, tree, below())
        return tree

    def _or(self):
        return self._binary(self._and, "or")

    def _and(self):
        return self._binary(self._not, "and")

    def _not(self):
        return ("not", self._not()) if self._next("not") else self._compare()

    def _compare(self):
        return self._binary(self._concat, "==", "!=")

    def _concat(self):
        return self._binary(self._filtered, "~")

    def _filtered(self):
        tree = self._atom()
        while self._next("|"):
            kind, name = self.left.pop(0) if self.left else ("", "")
            if kind != "name" or name not in FILTERS:
                raise TemplateError(f"no filter {name!r}")
            tree = ("filter", name, tree)
        return tree

    def _atom(self):
        if not self.left:
            raise TemplateError("an expression ends early")
        kind, value = self.left.pop(0)
        if kind == "str":
            tree = ("const", re.sub(r"\\(.)", lambda m: _ESCAPES.get(m[1], m[1]), value[1:-1], flags=re.S))
        elif kind == "int":
            tree = ("const", int(value))
        elif kind == "name":
            tree = ("const", {"true": True, "false": False, "none": None}[value]) if value in ("true", "false", "none") else ("name", value)
        elif value == "(":
            tree = self._or()
            if not self._next(")"):
                raise TemplateError("a bracket stays open")
        else:
            raise TemplateError(f"unexpected {value!r}")
        while op := self._next(".", "["):
            if op == ".":
                kind, value = self.left.pop(0) if self.left else ("", "")
                if kind != "name":
                    raise TemplateError("a name must follow a dot")
                tree = ("item", tree, ("const", value))
            else:
                tree = ("item", tree, self._or())
                if not self._next("]"):
                    raise TemplateError("a bracket stays open")
        return tree


def _text(value) -> str:
    return "" if value is None else value if isinstance(value, str) else str(value).lower() if isinstance(value, bool) else str(value)


def _item(holder, key):
    if isinstance(holder, dict):
        return holder.get(key)
    if isinstance(holder, (list, tuple)) and isinstance(key, int) and -len(holder) <= key < len(holder):
        return holder[key]
    return None


def _compile_expression(tree) -> tuple[bool, object]:
    """(is constant, value or closure of the scope)."""
    kind = tree[0]
    if kind == "const":
        return True, tree[1]
    if kind == "name":
        return False, lambda scope, n=tree[1]: scope.get(n)
    parts = [_compile_expression(x) for x in tree[1:] if isinstance(x, tuple)]
    op = tree[1] if kind in ("op", "filter") else kind
    make = {
        "item": _item, "not": lambda a: not a, "==": lambda a, b: a == b, "!=": lambda a, b: a != b,
        "~": lambda a, b: _text(a) + _text(b), "and": lambda a, b: a and b, "or": lambda a, b: a or b,
    }.get(op) or (lambda a, f=FILTERS[op]: f(_text(a)))
    if all(c for c, _ in parts):
        return True, make(*(v for _, v in parts))
    gets = [(lambda scope, v=v: v) if c else v for c, v in parts]
    if len(gets) == 1:
        return False, lambda scope, a=gets[0]: make(a(scope))
    return False, lambda scope, a=gets[0], b=gets[1]: make(a(scope), b(scope))


class Template:
    """compile once, then stream(context) any number of times."""

    def __init__(self, source: str):
        self.left = [p for p in _TAG.split(source) if p]
        tree, end = self._block(())
        self.nodes = self._fold(tree)
        self.run = self._closures(self.nodes)

    def _block(self, ends: tuple[str, ...]):
        out = []
        while self.left:
            piece = self.left.pop(0)
            if piece.startswith("{{"):
                out.append(("out", _Expression(piece[2:-2]).tree))
            elif piece.startswith("{%"):
                words = piece[2:-2].strip("-").strip()
                head, _, rest = words.partition(" ")
                if head in ends:
                    return out, (head, rest)
                out.append(self._statement(head, rest))
            else:
                out.append(("text", piece))
        if ends:
            raise TemplateError(f"missing {ends[-1]}")
        return out, ("", "")

    def _statement(self, head: str, rest: str):
        if head == "for":
            m = re.fullmatch(r"([A-Za-z_]\w*)\s+in\s+(.+)", rest, re.S)
            if not m:
                raise TemplateError(f"cannot read for {rest!r}")
            body, _ = self._block(("endfor",))
            return "for", m[1], _Expression(m[2]).tree, body
        if head == "generation":
            return "generation", self._block(("endgeneration",))[0]
        if head == "set":
            name, _, value = rest.partition("=")
            return "set", name.strip(), _Expression(value).tree
        if head == "if":
            branches, otherwise = [], []
            test, (end, more) = _Expression(rest).tree, ("", "")
            while True:
                body, (end, more) = self._block(("elif", "else", "endif"))
                branches.append((test, body))
                if end != "elif":
                    break
                test = _Expression(more).tree
            if end == "else":
                otherwise, _ = self._block(("endif",))
            return "if", branches, otherwise
        raise TemplateError(f"unknown statement {head!r}")

    def _fold(self, nodes: list) -> list:
        out: list = []
        for node in nodes:
            kind = node[0]
            if kind == "out":
                constant, value = _compile_expression(node[1])
                node = ("text", _text(value)) if constant else ("out", value)
            elif kind == "set":
                constant, value = _compile_expression(node[2])
                node = ("set", node[1], (lambda scope, v=value: v) if constant else value)
            elif kind == "for":
                constant, value = _compile_expression(node[2])
                node = ("for", node[1], (lambda scope, v=value: v) if constant else value, self._fold(node[3]))
            elif kind == "generation":
                node = ("generation", self._fold(node[1]))
            elif kind == "if":
                kept, otherwise = [], self._fold(node[2])
                for test, body in node[1]:
                    constant, value = _compile_expression(test)
                    if constant and not value:
                        continue
                    if constant:
                        otherwise = self._fold(body)
                        break
                    kept.append((value, self._fold(body)))
                if not kept:
                    for x in otherwise:
                        self._push(out, x)
                    continue
                node = ("if", kept, otherwise)
            self._push(out, node)
        return out

    @staticmethod
    def _push(out: list, node: tuple) -> None:
        if node[0] == "text" and out and out[-1][0] == "text":
            out[-1] = ("text", out[-1][1] + node[1])
        elif node != ("text", ""):
            out.append(node)

    def _closures(self, nodes: list) -> Callable:
        steps = [self._closure(n) for n in nodes]

        def run(scope, masked):
            for step in steps:
                yield from step(scope, masked)

        return run

    def _closure(self, node: tuple) -> Callable:
        kind = node[0]
        if kind == "text":
            return lambda scope, masked, t=node[1]: ((t, masked),)
        if kind == "out":
            return lambda scope, masked, f=node[1]: ((_text(f(scope)), masked),)
        if kind == "set":

            def put(scope, masked, name=node[1], f=node[2]):
                scope[name] = f(scope)
                return ()

            return put
        if kind == "generation":
            inner = self._closures(node[1])
            return lambda scope, masked: inner(scope, True)
        if kind == "if":
            branches, otherwise = [(test, self._closures(body)) for test, body in node[1]], self._closures(node[2])

            def choose(scope, masked):
                for test, body in branches:
                    if test(scope):
                        return body(scope, masked)
                return otherwise(scope, masked)

            return choose
        name, items, body = node[1], node[2], self._closures(node[3])

        def loop(scope, masked):
            inner, missing = dict(scope), object()
            it = iter(items(scope) or ())
            now, index = next(it, missing), 0
            while now is not missing:
                after = next(it, missing)
                inner[name], inner["loop"] = now, {"index0": index, "index": index + 1, "first": index == 0, "last": after is missing}
                yield from body(inner, masked)
                now, index = after, index + 1

        return loop

    def stream(self, **context) -> Iterator[tuple[str, bool]]:
        return self.run(dict(context), False)

    def render(self, **context) -> tuple[str, list[tuple[int, int]]]:
        """The whole text and its loss spans in code points."""
        out, spans, at = [], [], 0
        for text, masked in self.stream(**context):
            if masked and text:
                if spans and spans[-1][1] == at:
                    spans[-1] = (spans[-1][0], at + len(text))
                else:
                    spans.append((at, at + len(text)))
            out.append(text)
            at += len(text)
        return "".join(out), spans


@lru_cache(maxsize=16)
def compiled(source: str) -> Template:
    return Template(source)


_TURN_END = re.compile(r"(?<!\\)(?:\\\\)*" + re.escape(END) + "\n")


class TurnReader:
    """Reads turns back from formatted chunks; holds one turn at a time."""

    def __init__(self):
        self.text, self.masked, self.at = "", [], 0

    def feed(self, text: str, masked: bool) -> Iterator[tuple[str, str, str]]:
        """Yields (role, text, text under the loss mask) of turns that this chunk ends."""
        if masked and text:
            self.masked.append((len(self.text), len(self.text) + len(text)))
        self.text += text
        if masked or END not in text:
            return
        while m := _TURN_END.search(self.text):
            turn, rest = self.text[: m.end() - len(END) - 1], self.text[m.end() :]
            head, _, body = turn.partition(":\n")
            if not head.startswith(MARK + " "):
                raise ValueError("a turn has no marker")
            loss = unescape("".join(self.text[a:b] for a, b in self.masked if b <= m.end()))
            self.masked = [(a - m.end(), b - m.end()) for a, b in self.masked if b > m.end()]
            self.text = rest
            yield unlabel(head[len(MARK) + 1 :]), unescape(body), loss


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, Iterator[dict]]]:
    """(conv_id, lazy turns) of rows sorted by conversation; each must be used up in turn."""
    rows = ((c, {"role": r or "", "text": t or ""}) for b in batches for c, r, t in zip(*(b.column(i).to_pylist() for i in range(3))))
    held = next(rows, None)
    while held is not None:
        conv = held[0]

        def turns():
            nonlocal held
            while held is not None and held[0] == conv:
                yield held[1]
                held = next(rows, None)

        yield conv, (own := turns())
        for _ in own:
            pass


def _in_order(conversations: DataFrame) -> DataFrame:
    rows = conversations.select("conv_id", "turn", "role", "text")
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "role", "text")


def format_conversations(conversations: DataFrame, template: str = TEMPLATE) -> DataFrame:
    """(conv_id, formatted, loss_spans): the text of each conversation and the
    [start, end) code points under its generation markers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for conv, turns in _conversations(batches):
            text, spans = compiled(template).render(messages=turns)
            spans = pa.array([[{"start": a, "end": b} for a, b in spans]], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))
            yield pa.RecordBatch.from_arrays([pa.array([conv], pa.int64()), pa.array([text], pa.string()), spans], ["conv_id", "formatted", "loss_spans"])

    compiled(template)
    return _in_order(conversations).withColumn("conv_id", F.col("conv_id").cast("long")).mapInArrow(run, "conv_id long, formatted string, loss_spans array<struct<start:long,end:long>>")


def format_digests(conversations: DataFrame, template: str = TEMPLATE) -> DataFrame:
    """Formats each conversation, reads its turns back from the chunks made, and
    returns digests of what was read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[list] = [[], [], [], [], [], []]
        for conv, turns in _conversations(batches):
            reader, all_turns, loss = TurnReader(), hashlib.sha256(), hashlib.sha256()
            n = n_loss = chars = 0
            for text, masked in compiled(template).stream(messages=turns):
                chars += len(text)
                for role, said, learned in reader.feed(text, masked):
                    n, n_loss = n + 1, n_loss + len(learned)
                    all_turns.update(f"{role}\n{said}\n".encode())
                    loss.update(learned.encode())
            if reader.text:
                raise ValueError("text is left after the last turn")
            for column, value in zip(out, (conv, n, all_turns.hexdigest(), n_loss, loss.hexdigest(), chars)):
                column.append(value)
            if len(out[0]) >= 1000:
                yield _digest_batch(out)
                out = [[], [], [], [], [], []]
        if out[0]:
            yield _digest_batch(out)

    compiled(template)
    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return _in_order(conversations).withColumn("conv_id", F.col("conv_id").cast("long")).mapInArrow(run, schema)


def _digest_batch(out: list[list]) -> pa.RecordBatch:
    i, s = pa.int64(), pa.string()
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, (i, i, s, i, s, i))], names)
