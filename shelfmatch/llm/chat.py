"""Chat records of any known layout as canonical turns, and a template that can be read back.

The nested field paths of a record, hashed, are its schema fingerprint; a table of declarative
mappings says for each fingerprint where turns are. The template marks turns with control strings.
The same strings inside a text are escaped by a backslash after their first character, and so are
strings that look escaped, so that reading back undoes exactly that.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

START, END = "<|im_start|>", "<|im_end|>"
# fixed values: control strings of common templates; a text must not contain any of them
CONTROL = [START, END, "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"]
_PLAIN = re.compile("|".join(rf"{re.escape(c[0])}\\*{re.escape(c[1:])}" for c in CONTROL))
_ESCAPED = re.compile("|".join(rf"{re.escape(c[0])}\\+{re.escape(c[1:])}" for c in CONTROL))
_TURN = re.compile(rf"{re.escape(START)}([^\n]*)\n(.*?){re.escape(END)}\n", re.DOTALL)
_HALF = re.compile("[\ud800-\udfff]")
DEEPEST = 16  # levels of a record that its fingerprint looks into
TURNS = T.ArrayType(
    T.StructType([T.StructField("role", T.StringType()), T.StructField("text", T.StringType())])
)


@dataclass(frozen=True)
class Layout:
    """Turns are either fields, each of a fixed role, or the items of a list."""

    name: str
    fields: tuple[tuple[str, str], ...] = ()  # role, field
    items: str = ""  # field that holds a list
    role: str = ""  # and in each item its role
    text: str = ""  # and text
    roles: tuple[tuple[str, str], ...] = ()  # names of roles and what they mean
    optional: tuple[str, ...] = ()  # paths that may be missing


LAYOUTS = (
    Layout("prompt", (("system", "system"), ("user", "prompt"), ("assistant", "response")), optional=("system",)),
    Layout("completion", (("user", "prompt"), ("assistant", "completion"))),
    Layout("question", (("user", "question"), ("assistant", "answer"))),
    Layout(
        "instruction",
        (("system", "instruction"), ("user", "input"), ("assistant", "output")),
    ),
    Layout("instruction_only", (("user", "instruction"), ("assistant", "output"))),
    Layout("messages", items="messages", role="role", text="content"),
    Layout(
        "conversations",
        items="conversations",
        role="from",
        text="value",
        roles=(("human", "user"), ("gpt", "assistant")),
    ),
)


def field_paths(record, at: str = "", depth: int = 0) -> set[str]:
    """Paths of all leaves; items of lists share one path. A null leaf counts, its path is there.

    What lies DEEPEST levels down or deeper is one leaf, whatever it holds.
    """
    below = depth + 1
    if depth == DEEPEST:
        return {f"{at}..."}
    if isinstance(record, dict) and record:
        return set().union(*(field_paths(v, f"{at}.{k}" if at else k, below) for k, v in record.items()))
    if isinstance(record, list):
        return set().union({f"{at}[]"} if not record else set(), *(field_paths(v, f"{at}[]", below) for v in record))
    return {at}


def fingerprint(paths: set[str]) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode("utf-8", "surrogatepass")).hexdigest()[:16]


def known_layouts(layouts: tuple[Layout, ...] = LAYOUTS) -> dict[str, Layout]:
    """Every fingerprint that a layout can have, with and without its optional paths."""
    known = {}
    for x in layouts:
        if x.items:
            known[fingerprint({f"{x.items}[]"})] = x
            paths = {f"{x.items}[].{x.role}", f"{x.items}[].{x.text}"}
        else:
            paths = {f for _, f in x.fields}
        for n in range(len(x.optional) + 1):
            for gone in combinations(x.optional, n):
                known[fingerprint(paths - set(gone))] = x
    return known


def turns_of(record, known: dict[str, Layout]) -> tuple[str | None, list[tuple[str, str]]]:
    """Name of the layout and the turns; no name and no turns if the fingerprint is unknown."""
    layout = known.get(fingerprint(field_paths(record)))
    if layout is None:
        return None, []
    if layout.items:
        roles = dict(layout.roles)
        found = [(m.get(layout.role), m.get(layout.text)) for m in record[layout.items]]
        found = [(_text(r), _text(t)) for r, t in found]
        return layout.name, [(roles.get(r, r), t) for r, t in found]
    return layout.name, [(r, _text(record[f])) for r, f in layout.fields if f in record]


def _text(value) -> str:
    """Null is empty; what is no text is written as JSON; halves of surrogate pairs are replaced."""
    if isinstance(value, str):
        return _HALF.sub("\ufffd", value)
    return "" if value is None else json.dumps(value)


def escape(text: str) -> str:
    return _PLAIN.sub(lambda m: f"{m[0][0]}\\{m[0][1:]}", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: m[0][0] + m[0][2:], text)


def format_turns(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted text, and the spans of assistant texts, on which the loss is taken."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        name = escape(role.replace("\\", "\\\\").replace("\n", "\\n"))
        head, body = f"{START}{name}\n", escape(text)
        if role == "assistant":
            spans.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, f"{END}\n"]
        at += len(head) + len(body) + len(END) + 1
    return "".join(parts), spans


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted text."""
    return [
        (re.sub(r"\\(\\|n)", lambda m: "\n" if m[1] == "n" else "\\", unescape(r)), unescape(t))
        for r, t in _TURN.findall(formatted)
    ]


def read_loss(formatted: str, spans: list[tuple[int, int]]) -> str:
    """What the loss mask covers, unescaped."""
    return "".join(unescape(formatted[a:b]) for a, b in spans)


def canonical(df: DataFrame, record: str = "record", layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """The columns of ``df`` and a struct ``chat`` of layout and turns, from a JSON column.

    Null, text that is no JSON or nested too deeply to be read, and records of unknown layout have a
    null layout and no turns. Null texts and roles count as empty, other values are written as JSON,
    and halves of surrogate pairs, which no text can hold, become U+FFFD. Repeated rows stay, an
    empty table stays empty, a column named ``chat`` is replaced.
    """
    known = known_layouts(layouts)

    def read(text: str | None):
        try:
            value = json.loads(text) if text else None
        except (ValueError, RecursionError):
            value = None
        return turns_of(value, known)

    out = T.StructType([T.StructField("layout", T.StringType()), T.StructField("turns", TURNS)])
    return _mapped(df, record, "chat", out, read)


def formatted(df: DataFrame, turns: str = "turns") -> DataFrame:
    """The columns of ``df`` and a struct ``formatted`` of text and loss spans (code points).

    Null or no turns give an empty text and no spans, null roles and texts count as empty. Repeated
    rows stay, an empty table stays empty, a column named ``formatted`` is replaced.
    """
    span = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
    out = T.StructType(
        [T.StructField("text", T.StringType()), T.StructField("loss", T.ArrayType(span))]
    )

    def work(value):
        return format_turns([(x["role"] or "", x["text"] or "") for x in value or []])

    return _mapped(df, turns, "formatted", out, work)


def read_back(df: DataFrame, formatted: str = "formatted") -> DataFrame:
    """The columns of ``df`` and a struct ``back`` of the turns and the text under the loss mask.

    A null struct or text has no turns and an empty loss text. Repeated rows stay, an empty table
    stays empty, a column named ``back`` is replaced.
    """
    out = T.StructType([T.StructField("turns", TURNS), T.StructField("loss_text", T.StringType())])

    def work(value):
        if not value or value["text"] is None:
            return [], ""
        spans = [(s["start"], s["end"]) for s in value["loss"] or []]
        return read_turns(value["text"]), read_loss(value["text"], spans)

    return _mapped(df, formatted, "back", out, work)


def _mapped(df: DataFrame, source: str, target: str, out: T.StructType, work) -> DataFrame:
    from pyspark.sql.pandas.types import to_arrow_type

    kept = [c for c in df.columns if c != target]
    rows = df.select(F.struct(F.lit(0).alias("_"), *kept).alias("_row"), F.col(source).alias("_value"))
    kinds = [T.StructField("_", T.IntegerType(), False)] + [f for f in df.schema if f.name in kept]
    schema = T.StructType([T.StructField("_row", T.StructType(kinds)), T.StructField(target, out)])
    kind = to_arrow_type(out)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_record(work(v.as_py()), out) for v in batch[1]]
            yield pa.record_batch([batch[0], pa.array(found, kind)], names=["_row", target])

    made = rows.mapInArrow(each, schema)
    return made.select(*[F.col("_row")[c].alias(c) for c in kept], target)


def _record(value, kind):
    """Tuples as the dictionaries that Arrow wants for structs."""
    if isinstance(kind, T.StructType) and value is not None:
        return {f.name: _record(v, f.dataType) for f, v in zip(kind, value)}
    if isinstance(kind, T.ArrayType) and value is not None:
        return [_record(v, kind.elementType) for v in value]
    return value
