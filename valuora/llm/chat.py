r"""Chat formatting with a template compiler.

The template language is small and closed: text, ``{{ expression }}``,
``{% for x in messages %}``, ``{% if %}``/``{% elif %}``/``{% else %}`` and
``{% generation %}`` blocks, each closed by its ``end``. Expressions know string
and number literals, ``+``, ``==``, ``!=``, ``and``, ``or``, ``not``,
parentheses, the fields ``role``, ``text`` and ``turn`` of a loop's message,
``loop.first``, ``loop.last`` and ``loop.index``, and the filters of
``FILTERS``. There are no calls, imports, indexing or other names; anything
else is an error when the template is compiled.

A template is cut into tokens, parsed into a syntax tree, constant parts are
folded (literals joined, decided branches dropped, neighbouring texts merged)
and each node becomes a Python closure that yields pieces of output and the
markers of generation blocks. The pieces of a conversation come out as its
turns go in, so a conversation with very many turns needs no more memory than
its longest turn; only a template with several loops keeps all turns.

The filter ``escape`` makes control strings in texts harmless and can be
undone: each ``<``, backslashes, ``|`` gets one more backslash. ``header``
does so for a role, which must not hold line ends either.

Defined results: null roles and texts are empty; turns with one number are
ordered by role, then text, and a null number comes first; repeated rows are
turns of their own; rows with a null conversation id are one conversation with
a null id; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHATML = ("{% for m in messages %}<|im_start|>{{ m.role | header }}\n"
          "{% if m.role == 'assistant' %}{% generation %}{{ m.text | escape }}{% endgeneration %}"
          "{% else %}{{ m.text | escape }}{% endif %}<|im_end|>\n{% endfor %}")
PART = 1 << 16       # characters after which a part of a conversation is given out
FIELDS = ("role", "text", "turn")
LOOP = ("first", "last", "index")


class TemplateError(ValueError):
    """The template is not in the language."""


def escape(text: str) -> str:
    return re.sub(r"<(\\*)\|", r"<\\\1|", text)


def unescape(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def header(role: str) -> str:
    return role.replace("\\", "\\\\").replace("\n", "\\n").replace("|", "\\p")


def unheader(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: {"n": "\n", "p": "|"}.get(m[1], m[1]), role)


FILTERS: dict[str, Callable[[str], str]] = {
    "escape": escape, "header": header, "trim": str.strip, "upper": str.upper, "lower": str.lower}

# --- tokens and syntax tree ----------------------------------------------------------

_TAG = re.compile(r"\{\{(.*?)\}\}|\{%(.*?)%\}", re.S)
_LEX = re.compile(r"""\s*(?:(?P<str>'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*")|(?P<num>\d+)|(?P<name>[A-Za-z_]\w*)|(?P<op>==|!=|[+|().]))""")


def _lex(source: str) -> list[tuple[str, object]]:
    out, at, source = [], 0, source.strip()
    while at < len(source):
        m = _LEX.match(source, at)
        if not m:
            raise TemplateError(f"unexpected {source[at:at + 10]!r}")
        kind = m.lastgroup
        value: object = m[kind]
        if kind == "str":
            value = re.sub(r"\\(.)", lambda x: {"n": "\n", "t": "\t"}.get(x[1], x[1]), m[kind][1:-1])
        elif kind == "num":
            value = int(m[kind])
        out.append((kind, value))
        at = m.end()
    return out


class _Expression:
    """Precedence: or, and, not, == and !=, +, filters, atoms."""

    def __init__(self, source: str, scope: frozenset[str]):
        self.todo, self.scope = _lex(source), scope

    def peek(self) -> tuple[str, object]:
        return self.todo[0] if self.todo else ("end", None)

    def take(self, *values: object) -> object | None:
        if self.todo and self.todo[0][0] in ("op", "name") and self.todo[0][1] in values:
            return self.todo.pop(0)[1]
        return None

    def whole(self) -> tuple:
        tree = self.either()
        if self.todo:
            raise TemplateError(f"unexpected {self.todo[0][1]!r}")
        return tree

    def either(self) -> tuple:
        left = self.both()
        while self.take("or"):
            left = ("or", left, self.both())
        return left

    def both(self) -> tuple:
        left = self.negated()
        while self.take("and"):
            left = ("and", left, self.negated())
        return left

    def negated(self) -> tuple:
        return ("not", self.negated()) if self.take("not") else self.compared()

    def compared(self) -> tuple:
        left = self.added()
        while op := self.take("==", "!="):
            left = (op, left, self.added())
        return left

    def added(self) -> tuple:
        left = self.filtered()
        while self.take("+"):
            left = ("+", left, self.filtered())
        return left

    def filtered(self) -> tuple:
        tree = self.atom()
        while self.take("|"):
            kind, name = self.peek()
            if kind != "name" or name not in FILTERS:
                raise TemplateError(f"unknown filter {name!r}")
            self.todo.pop(0)
            tree = ("filter", name, tree)
        return tree

    def atom(self) -> tuple:
        if self.take("("):
            tree = self.either()
            if not self.take(")"):
                raise TemplateError("missing )")
            return tree
        kind, value = self.peek()
        if kind in ("str", "num"):
            self.todo.pop(0)
            return ("const", value)
        if kind == "name" and (value in self.scope or value == "loop" and self.scope):
            self.todo.pop(0)
            allowed = LOOP if value == "loop" else FIELDS
            if not self.take(".") or self.peek()[1] not in allowed or self.peek()[0] != "name":
                raise TemplateError(f"{value} has the fields {', '.join(allowed)}")
            return ("field", value, self.todo.pop(0)[1])
        raise TemplateError(f"unknown name {value!r}")


def parse(template: str) -> list[tuple]:
    """The syntax tree: ``text``, ``out``, ``for``, ``if`` and ``generation`` nodes."""
    pieces: list[tuple[str, str]] = []
    at = 0
    for m in _TAG.finditer(template):
        pieces.append(("text", template[at:m.start()]))
        pieces.append(("out", m[1]) if m[1] is not None else ("tag", m[2].strip()))
        at = m.end()
    pieces.append(("text", template[at:]))
    pieces.reverse()
    tree, end = _block(pieces, frozenset(), (), False)
    if end is not None:
        raise TemplateError(f"unexpected {end!r}")
    return tree


def _block(pieces, scope, ends, generating) -> tuple[list[tuple], str | None]:
    out: list[tuple] = []
    while pieces:
        kind, source = pieces.pop()
        if kind == "text":
            out.append(("text", source))
            continue
        if kind == "out":
            out.append(("out", _Expression(source, scope).whole()))
            continue
        word, _, rest = source.partition(" ")
        if word in ends:
            return out, source
        if word == "for":
            m = re.fullmatch(r"([A-Za-z_]\w*)\s+in\s+messages", rest.strip())
            if not m or m[1] == "loop":
                raise TemplateError(f"a loop is 'for x in messages', not {source!r}")
            body, end = _block(pieces, scope | {m[1]}, ("endfor",), generating)
            out.append(("for", m[1], body))
        elif word == "if":
            arms, other, end = [], [], "if " + rest
            while end and end.split()[0] in ("if", "elif"):
                test = _Expression(end.partition(" ")[2], scope).whole()
                body, end = _block(pieces, scope, ("elif", "else", "endif"), generating)
                arms.append((test, body))
            if end == "else":
                other, end = _block(pieces, scope, ("endif",), generating)
            out.append(("if", arms, other))
        elif word == "generation":
            if generating:
                raise TemplateError("generation blocks do not nest")
            body, end = _block(pieces, scope, ("endgeneration",), True)
            out.append(("generation", body))
        else:
            raise TemplateError(f"unknown tag {source!r}")
        if end is None:
            raise TemplateError(f"{word} is not closed")
    return out, None


# --- constant folding --------------------------------------------------------------------

def _as_text(value: object) -> str:
    return "" if value is None else str(value)


_BINARY = {"+": lambda a, b: a + b if isinstance(a, int) and isinstance(b, int) else _as_text(a) + _as_text(b),
           "==": lambda a, b: a == b, "!=": lambda a, b: a != b}


def fold_expression(tree: tuple) -> tuple:
    kind = tree[0]
    if kind in ("const", "field"):
        return tree
    if kind == "filter":
        inner = fold_expression(tree[2])
        return ("const", FILTERS[tree[1]](_as_text(inner[1]))) if inner[0] == "const" else ("filter", tree[1], inner)
    if kind == "not":
        inner = fold_expression(tree[1])
        return ("const", not inner[1]) if inner[0] == "const" else ("not", inner)
    left, right = fold_expression(tree[1]), fold_expression(tree[2])
    if kind in ("and", "or"):
        if left[0] == "const":
            return right if bool(left[1]) == (kind == "and") else left
    elif left[0] == right[0] == "const":
        return ("const", _BINARY[kind](left[1], right[1]))
    return (kind, left, right)


def fold(nodes: list[tuple]) -> list[tuple]:
    out: list[tuple] = []
    for node in nodes:
        kind = node[0]
        if kind == "out":
            tree = fold_expression(node[1])
            made = [("text", _as_text(tree[1]))] if tree[0] == "const" else [("out", tree)]
        elif kind == "for":
            made = [("for", node[1], fold(node[2]))]
        elif kind == "generation":
            made = [("generation", fold(node[1]))]
        elif kind == "if":
            arms, other = [], fold(node[2])
            for test, body in node[1]:
                test, body = fold_expression(test), fold(body)
                if test[0] != "const":
                    arms.append((test, body))
                elif test[1]:
                    other = body
                    break
            made = [("if", arms, other)] if arms else other
        else:
            made = [node]
        for part in made:
            if part[0] == "text" and out and out[-1][0] == "text":
                out[-1] = ("text", out[-1][1] + part[1])
            elif part != ("text", ""):
                out.append(part)
    return out


# --- closures ------------------------------------------------------------------------------

BEGIN, END, TURN = object(), object(), object()  # generation markers; a place to give out a part


def _value(tree: tuple) -> Callable[[dict], object]:
    kind = tree[0]
    if kind == "const":
        return lambda env, v=tree[1]: v
    if kind == "field":
        return lambda env, a=tree[1], b=tree[2]: env[a][b]
    if kind == "filter":
        return lambda env, f=FILTERS[tree[1]], x=_value(tree[2]): f(_as_text(x(env)))
    if kind == "not":
        return lambda env, x=_value(tree[1]): not x(env)
    a, b = _value(tree[1]), _value(tree[2])
    if kind == "and":
        return lambda env: a(env) and b(env)
    if kind == "or":
        return lambda env: a(env) or b(env)
    return lambda env, f=_BINARY[kind]: f(a(env), b(env))


def _closure(nodes: list[tuple], depth: int = 0) -> Callable[[dict], Iterator]:
    steps = []
    for node in nodes:
        kind = node[0]
        if kind == "text":
            steps.append(lambda env, t=node[1]: iter((t,)))
        elif kind == "out":
            steps.append(lambda env, x=_value(node[1]): iter((_as_text(x(env)),)))
        elif kind == "if":
            steps.append(_branch([(_value(t), _closure(b, depth)) for t, b in node[1]], _closure(node[2], depth)))
        elif kind == "generation":
            steps.append(_marked(_closure(node[1], depth)))
        else:
            steps.append(_loop(node[1], _closure(node[2], depth + 1), depth == 0))

    def run(env: dict) -> Iterator:
        for step in steps:
            yield from step(env)
    return run


def _branch(arms, other):
    def run(env):
        return next((body for test, body in arms if test(env)), other)(env)
    return run


def _marked(body):
    def run(env):
        yield BEGIN
        yield from body(env)
        yield END
    return run


def _loop(name, body, outer):
    def run(env):
        index, messages = 0, iter(env["messages"])
        message = next(messages, None)
        while message is not None:
            after = next(messages, None)
            yield from body({**env, name: message, "loop": {"first": not index, "last": after is None, "index": index}})
            if outer:
                yield TURN
            index, message = index + 1, after
    return run


def _loops(nodes: list[tuple]) -> int:
    total = 0
    for n in nodes:
        if n[0] == "for":
            total += 1 + _loops(n[2])
        elif n[0] == "generation":
            total += _loops(n[1])
        elif n[0] == "if":
            total += sum(_loops(b) for _, b in n[1]) + _loops(n[2])
    return total


def compile_template(template: str) -> Callable[[Iterable[dict]], Iterator]:
    """A function from messages (``role``, ``text``, ``turn``) to pieces and markers."""
    tree = fold(parse(template))
    run, once = _closure(tree), _loops(tree) <= 1
    return lambda messages: run({"messages": messages if once else list(messages)})


def render(template: str, messages: Iterable[dict]) -> tuple[str, list[tuple[int, int]]]:
    """(formatted text, spans under the loss mask) of one conversation."""
    text, spans = "", []
    for part, found in _parts(compile_template(template)(messages)):
        spans += [(a + len(text), b + len(text)) for a, b in found]
        text += part
    return text, spans


def _parts(pieces: Iterator) -> Iterator[tuple[str, list[tuple[int, int]]]]:
    """Parts (text, loss spans in it) of about ``PART`` characters, cut between turns."""
    made, size, start, spans = [], 0, None, []
    for p in pieces:
        if p is BEGIN:
            start = size
        elif p is END:
            spans.append((start, size))
            start = None
        elif p is TURN:
            if size >= PART and start is None:
                yield "".join(made), spans
                made, size, spans = [], 0, []
        else:
            made.append(p)
            size += len(p)
    yield "".join(made), spans


# --- Spark ---------------------------------------------------------------------------------

def _rows(batches, names):
    for b in batches:
        yield from zip(*(b.column(n).to_pylist() for n in names), strict=True)


def _runs(rows: Iterator[tuple]) -> Iterator[tuple[object, Iterator[tuple]]]:
    """Neighbouring rows of one key, each as an iterator to be used up before the next."""
    row = next(rows, None)
    while row is not None:
        key, more = row[0], [row]

        def same(key=key, more=more):
            while more:
                r = more.pop()
                yield r
                after = next(rows, None)
                if after is not None and after[0] == key:
                    more.append(after)
                else:
                    ahead.append(after)

        ahead: list = []
        run = same()
        yield key, run
        for _ in run:  # what the user left over
            pass
        row = ahead[0] if ahead else None


_FORMATTED = pa.schema([("conv_id", pa.int64()), ("part", pa.int64()), ("text", pa.string()),
                        ("loss", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))])
_READ = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                   ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])


def _batches(rows: Iterator[dict], schema: pa.Schema, weight: Callable[[dict], int]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for r in rows:
        held.append(r)
        size += weight(r)
        if size >= 1 << 22 or len(held) >= 10_000:
            yield pa.RecordBatch.from_pylist(held, schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def _format(template: str):
    def run(batches):
        formatted = compile_template(template)

        def rows():
            for conv, turns in _runs(_rows(batches, ["conv_id", "turn", "role", "text"])):
                messages = ({"turn": t, "role": r or "", "text": x or ""} for _, t, r, x in turns)
                for i, (text, loss) in enumerate(_parts(formatted(messages))):
                    yield {"conv_id": conv, "part": i, "text": text, "loss": [{"start": a, "end": b} for a, b in loss]}
        yield from _batches(rows(), _FORMATTED, lambda r: len(r["text"]))
    return run


def format_conversations(turns: DataFrame, template: str = CHATML) -> DataFrame:
    """Rows ``(conv_id, part, text, loss)`` of ``turns(conv_id, turn, role, text)``.

    The parts of a conversation, in order, are its formatted text; ``loss``
    holds the spans of a part under the loss mask. A conversation's turns are
    brought together by its id and read in order, a turn at a time.
    """
    compile_template(template)
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                        F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    return (rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
            .mapInArrow(_format(template), "conv_id long, part long, text string, loss array<struct<start:long,end:long>>"))


_TURN = re.compile(r"<\|im_start\|>([^\n]*)\n(.*?)<\|im_end\|>\n", re.S)


def read_turns(text: str) -> tuple[list[tuple[str, str]], str]:
    """((role, text) of the whole turns of formatted text, what is left)."""
    out, at = [], 0
    while m := _TURN.match(text, at):
        out.append((unheader(m[1]), unescape(m[2])))
        at = m.end()
    return out, text[at:]


def _read(batches):
    def rows():
        for conv, parts in _runs(_rows(batches, ["conv_id", "part", "text", "loss"])):
            turns_hash, loss_hash = hashlib.sha256(), hashlib.sha256()
            n, loss_chars, chars, rest = 0, 0, 0, ""
            for _, _, text, loss in parts:
                chars += len(text)
                for span in loss:
                    own = unescape(text[span["start"]:span["end"]])
                    loss_chars += len(own)
                    loss_hash.update(own.encode())
                found, rest = read_turns(rest + text)
                for role, said in found:
                    n += 1
                    turns_hash.update(f"{role}\n{said}\n".encode())
            if rest:
                raise ValueError("formatted text that is no turn")
            yield {"conv_id": conv, "n_turns": n, "turns_sha256": turns_hash.hexdigest(), "loss_chars": loss_chars,
                   "loss_sha256": loss_hash.hexdigest(), "formatted_chars": chars}
    yield from _batches(rows(), _READ, lambda r: 200)


def read_back(formatted: DataFrame) -> DataFrame:
    """What the output of :func:`format_conversations` (default template) says, per conversation.

    Takes the formatted rows as they come out, a conversation's parts in order.
    """
    return formatted.mapInArrow(_read, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
                                       "loss_sha256 string, formatted_chars long")
