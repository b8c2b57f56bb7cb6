"""Conversations formatted with a compiled chat template, with a loss mask, and read back.

The rows of a conversation meet in one task, sorted by turn by Spark (which spills), and stream
through the template: memory holds a part of a conversation, never all of it.  Control strings in
texts are escaped by one more backslash between ``<`` and ``|``; roles are percent-encoded.

Defined results: a null text or role is empty; rows of a turn that tie go by role, then text; repeated
rows are turns of their own; null conv_ids form one conversation; null turns come first; a very long text
is one turn, which a task holds whole; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .templates import compile_template

TEMPLATE = (
    "{% for m in messages %}<|im_start|>{{ m.role | header }}\n"
    "{% if m.role == 'assistant' %}{% generation %}{{ m.text | escape }}{% endgeneration %}"
    "{% else %}{{ m.text | escape }}{% endif %}<|im_end|>\n{% endfor %}"
)
#: Code points after which a part of a formatted conversation is passed on.
PART_CHARS = 100_000

PARTS = T.StructType(
    [
        T.StructField("conv_id", T.LongType()),
        T.StructField("part", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("loss_spans", T.ArrayType(T.LongType())),
    ]
)
DIGEST = T.StructType(
    [
        T.StructField("conv_id", T.LongType()),
        T.StructField("n_turns", T.LongType()),
        T.StructField("turns_sha256", T.StringType()),
        T.StructField("loss_chars", T.LongType()),
        T.StructField("loss_sha256", T.StringType()),
        T.StructField("formatted_chars", T.LongType()),
    ]
)


def escape(text: str) -> str:
    return re.sub(r"<(\\*)\|", r"<\1\\|", text)


def unescape(text: str) -> str:
    return re.sub(r"<(\\*)\\\|", r"<\1|", text)


def header(role: str) -> str:
    return re.sub(r"[%<\n]", lambda m: f"%{ord(m[0]):02X}", role)


def unheader(role: str) -> str:
    return re.sub(r"%(25|3C|0A)", lambda m: chr(int(m[1], 16)), role)


FILTERS: dict[str, Callable[[str], str]] = {"escape": escape, "header": header, "trim": str.strip, "upper": str.upper, "lower": str.lower}


def _by_conversation(conversations: DataFrame) -> DataFrame:
    rows = conversations.select(
        F.col("conv_id").cast("long"),
        F.col("turn").cast("long"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")


def format_conversations(conversations: DataFrame, template: str = TEMPLATE) -> DataFrame:
    """``conv_id, part, text, loss_spans``: formatted conversations in parts, in order within a task.

    ``loss_spans`` are half-open code point intervals (start, end, start, end, ...) in the whole
    formatted conversation.  Use ``formatted_texts`` for one row each.
    """
    compile_template(template, FILTERS)  # a wrong template fails here and not in a task

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        render = compile_template(template, FILTERS)
        rows = (r for b in batches for r in zip(*(b.column(i).to_pylist() for i in (0, 2, 3))))
        schema = pa.schema([("conv_id", pa.int64()), ("part", pa.int64()), ("text", pa.string()), ("loss_spans", pa.list_(pa.int64()))])
        out: list[dict] = []
        held = 0
        for conv_id, group in groupby(rows, key=lambda r: r[0]):
            part, at, texts, size, spans = 0, 0, [], 0, []
            for text, generated in render({"messages": ({"role": r, "text": t} for _, r, t in group)}):
                if generated and text:
                    if spans and spans[-1] == at:
                        spans[-1] += len(text)
                    else:
                        spans += [at, at + len(text)]
                texts.append(text)
                at += len(text)
                size += len(text)
                if size >= PART_CHARS:
                    out.append({"conv_id": conv_id, "part": part, "text": "".join(texts), "loss_spans": spans})
                    held, part, texts, size, spans = held + size, part + 1, [], 0, []
                    if held >= 50 * PART_CHARS:
                        yield pa.RecordBatch.from_pylist(out, schema=schema)
                        out, held = [], 0
            out.append({"conv_id": conv_id, "part": part, "text": "".join(texts), "loss_spans": spans})
            held += size + 100
            if held >= 50 * PART_CHARS:
                yield pa.RecordBatch.from_pylist(out, schema=schema)
                out, held = [], 0
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    return _by_conversation(conversations).mapInArrow(run, PARTS)


def formatted_texts(conversations: DataFrame, template: str = TEMPLATE) -> DataFrame:
    """One row per conversation: the whole ``text`` and its ``loss_spans``."""
    parts = F.array_sort(F.collect_list(F.struct("part", "text", "loss_spans")))  # of one conversation
    return (
        format_conversations(conversations, template)
        .groupBy("conv_id")
        .agg(parts.alias("p"))
        .select(
            "conv_id",
            F.array_join(F.transform("p", lambda x: x["text"]), "").alias("text"),
            F.flatten(F.transform("p", lambda x: x["loss_spans"])).alias("loss_spans"),
        )
    )


class _Reader:
    """Reads a formatted conversation back, part by part, into digests."""

    def __init__(self) -> None:
        self.rest, self.turns, self.chars, self.loss_chars, self.under, self.under_end = "", 0, 0, 0, "", 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def part(self, text: str, spans: list[int]) -> None:
        for s, e in zip(spans[::2], spans[1::2]):
            if s != self.under_end:  # another text: escapes do not reach from one into the next
                self._loss()
            self.under += text[s - self.chars : e - self.chars]
            self.under_end = e
        self.chars += len(text)
        turns = (self.rest + text).split("<|im_end|>\n")
        self.rest = turns.pop()
        for t in turns:
            head, _, body = t.removeprefix("<|im_start|>").partition("\n")
            self.all.update(f"{unheader(head)}\n{unescape(body)}\n".encode())
            self.turns += 1
        if not self.rest:  # no escape is cut here
            self._loss()

    def _loss(self) -> None:
        plain = unescape(self.under)
        self.loss_chars += len(plain)
        self.loss.update(plain.encode())
        self.under = ""

    def result(self) -> tuple:
        self._loss()
        return self.turns, self.all.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


def read_back(parts: DataFrame) -> DataFrame:
    """Digests of formatted conversations, whose parts follow each other within a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for b in batches for r in zip(*(b.column(i).to_pylist() for i in (0, 2, 3))))
        schema = pa.schema([(f.name, pa.string() if isinstance(f.dataType, T.StringType) else pa.int64()) for f in DIGEST])
        out = []
        for conv_id, group in groupby(rows, key=lambda r: r[0]):
            reader = _Reader()
            for _, text, spans in group:
                reader.part(text, spans)
            out.append(dict(zip(DIGEST.names, (conv_id, *reader.result()))))
            if len(out) >= 5000:
                yield pa.RecordBatch.from_pylist(out, schema=schema)
                out = []
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    return parts.mapInArrow(run, DIGEST)
