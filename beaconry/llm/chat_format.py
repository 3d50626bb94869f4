"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it as context, and only its text trainable. Turns that no
assistant turn follows make one last example without trainable text, so that nothing of a conversation is missing from the
output. Roles and texts are escaped, so the marks of the template can't be forged and reading back is exact.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beaconry.llm.common import prepare

OPEN, MIDDLE, CLOSE = "### ", ": ", "</turn>\n"
TARGET = "assistant"
_CONTROL = re.compile(r"\\|###|</turn>")
_CONTROL_OR_MIDDLE = re.compile(r"\\|###|</turn>|: ")
_ESCAPED = re.compile(r"\\(\\|###|</turn>|: )")
_TURN = re.compile(r"### ((?:\\\\|\\###|\\</turn>|\\: |[^\\])*?): ((?:\\\\|\\###|\\</turn>|\\: |[^\\])*?)</turn>\n", re.S)


def escape(text: str, role: bool = False) -> str:
    return (_CONTROL_OR_MIDDLE if role else _CONTROL).sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: m[1], text)


def parse(formatted: str) -> list[tuple[str, str]]:
    """Roles and texts of a formatted example."""
    return [(unescape(m[1]), unescape(m[2])) for m in _TURN.finditer(formatted)]


def _examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by conversation -> examples; a task holds one context and one batch."""
    names = ["conv_id", "example", "formatted", "loss_start", "loss_end"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
    out: list[tuple] = []
    conv, context, count, open_turns, begun, held = None, "", 0, False, False, 0

    def batch() -> pa.RecordBatch:
        rows = out.copy()
        out.clear()
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=names)

    for part in batches:
        for conv_id, role, text in zip(*(part.column(c).to_pylist() for c in ("conv_id", "role", "text")), strict=True):
            if not begun or conv_id != conv:
                if open_turns:
                    out.append((conv, count, context, None, None))
                conv, context, count, open_turns, begun = conv_id, "", 0, False, True
            head = f"{OPEN}{escape(role or '', role=True)}{MIDDLE}"
            body = escape(text or "")
            start = len(context) + len(head)
            context = f"{context}{head}{body}{CLOSE}"
            open_turns = role != TARGET
            if not open_turns:
                out.append((conv, count, context, start, start + len(body)))
                count += 1
                held += len(context)
                if held > 4 << 20:
                    yield batch()
                    held = 0
        if out:
            yield batch()
            held = 0
    if open_turns:
        out.append((conv, count, context, None, None))
        yield batch()


def prefix_examples(turns: DataFrame) -> DataFrame:
    """Rows (conv_id, example, formatted, loss_start, loss_end): the trainable characters of ``formatted`` are [loss_start, loss_end).

    Turns are taken by turn, then role and text, nulls first. Null roles and texts count as empty; rows without conversation id
    make one conversation; repeated rows are turns; other columns are ignored; an empty table gives no rows. The examples of a conversation come
    next to each other and in order within their partition. The output of a conversation grows with the square of its turns: that is the format.
    """
    prepare(turns.sparkSession)
    key = [F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text"]
    return (turns.select(*key).repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
            .mapInArrow(_examples, "conv_id long, example long, formatted string, loss_start long, loss_end long"))


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    columns = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_examples"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
    conv, state, begun = None, None, False

    def close() -> tuple:
        # the last example has every turn of the conversation
        turns, whole = parse(state["last"]), hashlib.sha256()
        for role, text in turns:
            whole.update(f"{role}\n{text}\n".encode())
        return conv, len(turns), whole.hexdigest(), state["loss"], state["digest"].hexdigest(), state["chars"], state["n"]

    for part in batches:
        rows = []
        for conv_id, formatted, start, end in zip(*(part.column(c).to_pylist() for c in ("conv_id", "formatted", "loss_start", "loss_end")), strict=True):
            if not begun or conv_id != conv:
                if begun:
                    rows.append(close())
                conv, begun, state = conv_id, True, {"loss": 0, "digest": hashlib.sha256(), "chars": 0, "n": 0, "last": ""}
            state["last"] = formatted
            state["chars"] += len(formatted)
            state["n"] += 1
            if start is not None:
                text = unescape(formatted[start:end])
                state["loss"] += len(text)
                state["digest"].update(text.encode())
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=columns)
    if begun:
        row = close()
        yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types, strict=True)], names=columns)


def read_back(examples: DataFrame) -> DataFrame:
    """Per conversation what its examples say; rows have to lie as ``prefix_examples`` gives them."""
    return examples.mapInArrow(_read, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_examples long")
