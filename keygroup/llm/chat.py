"""Conversations as training text, with the spans that the loss counts."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame

from keygroup.llm.common import batches, picked
from keygroup.llm.templates import FILTERS, compile_template

# Turns are "### role:\ntext</turn>\n". Characters that begin a control string get a
# backslash inside texts and roles, as does the backslash, so nothing in them can be
# taken for a mark, and everything can be read back.
TEMPLATE = (
    "{% for message in messages %}"
    "### {{ message.role | escape_role }}:\n"
    "{% if message.role == 'assistant' %}"
    "{% generation %}{{ message.text | escape }}{% endgeneration %}"
    "{% else %}{{ message.text | escape }}{% endif %}"
    "</turn>\n"
    "{% endfor %}"
)
_TURN = re.compile(r"### ((?:[^\\#<:]|\\.)*):\n((?:[^\\#<]|\\.)*)</turn>\n", re.DOTALL)
PART_CHARS = 1_000_000


def escape(text: str) -> str:
    return re.sub(r"[\\#<]", r"\\\g<0>", text)


def escape_role(text: str) -> str:
    return re.sub(r"[\\#<:]", r"\\\g<0>", text)


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)


CHAT_FILTERS = {**FILTERS, "escape": escape, "escape_role": escape_role}


def _rows(stream: Iterable[pa.RecordBatch]) -> Iterator[dict]:
    for whole in stream:
        for at in range(0, whole.num_rows, 512):
            yield from whole.slice(at, 512).to_pylist()


def format_conversations(
    df: DataFrame,
    template: str = TEMPLATE,
    filters: dict[str, Callable[[str], str]] | None = None,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    part_chars: int = PART_CHARS,
) -> DataFrame:
    """Render every conversation, a row per part: ``conv_id, part, formatted, loss``.

    ``loss`` lists the spans ``start, stop`` (code points within the part) that lie in
    generation blocks. Parts of a conversation follow each other without a gap and are
    numbered from 0; a part ends behind the chunk that takes it to ``part_chars``, so
    that a conversation of any length passes through one task in bounded memory, and
    only a single text has to fit. The parts of a conversation lie in one partition, in
    order.

    Turns come by turn, role and text, nulls first; repeated rows are repeated turns.
    Null roles and texts are empty; null conversations form one conversation, and null
    turns come first. An empty table has no parts. Other columns are left out.
    """
    rows = picked(df, conv_id=conversation, turn=turn, role=role, text=text)
    key = rows.schema["conv_id"].dataType.simpleString()
    schema = f"conv_id {key}, part int, formatted string, loss array<struct<start:int,stop:int>>"
    known = CHAT_FILTERS if filters is None else filters
    compile_template(template, known)  # a faulty template fails here

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        render = compile_template(template, known)
        spans = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))
        arrow = None

        def parts(conv_id, messages) -> Iterator[tuple]:
            part, held, size, loss = 0, [], 0, []
            for chunk, masked in render({"messages": messages}):
                if masked and chunk:
                    if loss and loss[-1]["stop"] == size:
                        loss[-1]["stop"] += len(chunk)
                    else:
                        loss.append({"start": size, "stop": size + len(chunk)})
                held.append(chunk)
                size += len(chunk)
                if size >= part_chars:
                    yield conv_id, part, "".join(held), loss
                    part, held, size, loss = part + 1, [], 0, []
            if size or not part:
                yield conv_id, part, "".join(held), loss

        def peeked() -> Iterator[pa.RecordBatch]:
            nonlocal arrow
            for one in stream:
                arrow = one.schema.field("conv_id").type
                yield one

        def all_parts() -> Iterator[tuple]:
            for conv_id, group in groupby(_rows(peeked()), key=lambda r: r["conv_id"]):
                messages = ({"role": r["role"] or "", "text": r["text"] or ""} for r in group)
                yield from parts(conv_id, messages)

        first = next(made := all_parts(), None)
        if first is None:
            return
        out = pa.schema([("conv_id", arrow), ("part", pa.int32()), ("formatted", pa.string()), ("loss", spans)])

        def chained() -> Iterator[tuple]:
            yield first
            yield from made

        yield from batches(out, chained(), 128)

    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartition(n, "conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.mapInArrow(run, schema)


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of the turns and of the loss text, read from parts in their order.

    The parts must lie as ``format_conversations`` leaves them. A text that does not
    consist of turns raises an error.
    """
    key = formatted.schema["conv_id"].dataType.simpleString()
    schema = (
        f"conv_id {key}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string,"
        " formatted_chars bigint"
    )
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = None

        def peeked() -> Iterator[pa.RecordBatch]:
            nonlocal arrow
            for one in stream:
                arrow = one.schema.field("conv_id").type
                yield one

        def digests() -> Iterator[tuple]:
            for conv_id, parts in groupby(_rows(peeked()), key=lambda r: r["conv_id"]):
                turns, loss = hashlib.sha256(), hashlib.sha256()
                n_turns = loss_chars = chars = 0
                rest = ""
                for part in parts:
                    text = part["formatted"]
                    chars += len(text)
                    for span in part["loss"]:
                        counted = unescape(text[span["start"] : span["stop"]])
                        loss_chars += len(counted)
                        loss.update(counted.encode())
                    rest += text
                    at = 0
                    while found := _TURN.match(rest, at):
                        turns.update(f"{unescape(found[1])}\n{unescape(found[2])}\n".encode())
                        n_turns += 1
                        at = found.end()
                    rest = rest[at:]
                if rest:
                    raise ValueError(f"conversation {conv_id} cannot be read back")
                yield conv_id, n_turns, turns.hexdigest(), loss_chars, loss.hexdigest(), chars

        first = next(made := digests(), None)
        if first is None:
            return
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        out = pa.schema(list(zip(names, [arrow, *kinds])))

        def chained() -> Iterator[tuple]:
            yield first
            yield from made

        yield from batches(out, chained())

    return formatted.mapInArrow(run, schema)
