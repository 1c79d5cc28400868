"""Chat formatting with a compiled template (operator 5)."""

from __future__ import annotations

import json
import re
import tempfile
from array import array
from collections.abc import Iterator, Sequence
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.template import BEGIN, END, STEP, compile_template, reads_once

#: Turns between control strings; only what the assistant says is marked as generated.
CHATML = (
    "{% for message in messages %}"
    "<|im_start|>{{ message.role | escape_line }}\n"
    "{% if message.role == 'assistant' %}"
    "{% generation %}{{ message.text | escape }}{% endgeneration %}"
    "{% else %}{{ message.text | escape }}{% endif %}"
    "<|im_end|>\n"
    "{% endfor %}"
)
#: A conversation's text is cut after the turn that reaches this many code points.
PIECE_CHARS = 1 << 18
#: Bytes of a conversation that a template reads more than once and that stay in memory.
SPOOL_BYTES = 1 << 24

_OPENING = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<\\(\\*)\|")
_TURN = re.compile(r"<\|im_start\|>(.*?)\n(.*?)<\|im_end\|>\n", re.S)

SCHEMA = "conv_id long, piece long, text string, generated array<struct<start:long,end:long>>"


def escape(text: str | None) -> str:
    """No `<|` is left: each gets a backslash between its characters, one more if there are some."""
    return _OPENING.sub(r"<\\\1|", text or "")


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def escape_line(text: str | None) -> str:
    """As `escape`, and on one line."""
    return escape((text or "").replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_line(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(text))


FILTERS = {"escape": escape, "escape_line": escape_line}


def _messages(batches) -> Iterator[tuple[int | None, dict]]:
    for batch in batches:
        columns = (batch.column(name).to_pylist() for name in ("conv_id", "role", "text"))
        for conv_id, role, text in zip(*columns, strict=True):
            yield conv_id, {"role": role or "", "text": text or ""}


def _conversations(batches) -> Iterator[tuple[int | None, Iterator[dict]]]:
    """Runs of rows with one id. A run must be used up before the next one is taken."""
    rows = _messages(batches)
    ahead = next(rows, None)

    def run(conv_id):
        nonlocal ahead
        while ahead is not None and ahead[0] == conv_id:
            message = ahead[1]
            ahead = next(rows, None)
            yield message

    while ahead is not None:
        conv_id = ahead[0]
        turns = run(conv_id)
        yield conv_id, turns
        for _ in turns:  # a template may leave messages out
            pass


class Turns(Sequence):
    """A conversation for templates that read it twice or out of order. It goes to a file of the
    task once it is large; the task makes it and ends with it, so no other task needs the file."""

    def __init__(self, messages: Iterator[dict]):
        self._file = tempfile.SpooledTemporaryFile(SPOOL_BYTES)
        self._at = array("q")
        for message in messages:
            self._at.append(self._file.tell())
            self._file.write(json.dumps(message).encode() + b"\n")

    def __len__(self) -> int:
        return len(self._at)

    def __getitem__(self, index: int) -> dict:
        self._file.seek(self._at[index])
        return json.loads(self._file.readline())

    def close(self) -> None:
        self._file.close()


def _pieces(render, messages) -> Iterator[tuple[str, list[dict]]]:
    parts: list[str] = []
    spans: list[dict] = []
    at, begun = 0, None
    for part in render(messages=messages):
        if part is BEGIN:
            begun = at
        elif part is END:
            spans.append({"start": begun, "end": at})
            begun = None
        elif part is not STEP:
            parts.append(part)
            at += len(part)
        elif at >= PIECE_CHARS:
            yield "".join(parts), spans
            parts, spans, at = [], [], 0
    if parts or spans:
        yield "".join(parts), spans


def _format(batches, template: str):
    render, once = compile_template(template, FILTERS), reads_once(template, "messages", FILTERS)
    schema = pa.schema([
        ("conv_id", pa.int64()), ("piece", pa.int64()), ("text", pa.string()),
        ("generated", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
    ])
    rows: list[dict] = []
    chars = 0
    for conv_id, messages in _conversations(batches):
        turns = messages if once else Turns(messages)
        for number, (text, spans) in enumerate(_pieces(render, turns)):
            rows.append({"conv_id": conv_id, "piece": number, "text": text, "generated": spans})
            chars += len(text)
            if chars >= 8 * PIECE_CHARS or len(rows) >= 4096:
                yield pa.RecordBatch.from_pylist(rows, schema)
                rows, chars = [], 0
        turns.close()
    if rows:
        yield pa.RecordBatch.from_pylist(rows, schema)


def format_conversations(conversations: DataFrame, template: str = CHATML) -> DataFrame:
    """Render conversations (conv_id, turn, role, text) with a template over `messages`.

    Returns the text of each conversation in pieces that end between turns, numbered from 0, with
    the ranges of code points that the template marks as generated. The pieces of a conversation
    are consecutive rows of one partition, in order.

    Rows are put in the order of turn, then role and text; a null turn comes first. Null roles and
    texts are empty. Repeated rows are turns like others. Rows without a conv_id form one
    conversation without an id. Other columns are ignored; an empty table gives no rows.

    Only one conversation's order needs its rows in one task. They are sorted on disk if need be
    and streamed through the compiled template, so a conversation of any length takes the memory of
    one piece. A template that looks at the first or last message, at their number, or at all of them
    twice is given them from a file of the task; that takes eight bytes of memory for each message.
    """
    order = ["conv_id", "turn", "role", "text"]
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), *order[1:])
    return (
        rows.repartition("conv_id")
        .sortWithinPartitions(*order)
        .select("conv_id", "role", "text")
        .mapInArrow(partial(_format, template=template), SCHEMA)
    )


def read_turns(text: str) -> list[tuple[str, str]]:
    """Role and text of each turn in a piece that `CHATML` has written."""
    return [(unescape_line(m[1]), unescape(m[2])) for m in _TURN.finditer(text)]
