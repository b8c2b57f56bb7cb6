"""Line dedup on content-defined chunks.

A rolling hash over the hashes of the last ``WINDOW`` lines chooses boundaries: windows whose hash is no greater
than those of both neighbours, and of the others each with a chance of its bytes in ``TARGET``, so that boundaries
stand no more than about ``TARGET`` bytes apart whatever the lines are like.  A chunk is a boundary's window with the lines around it up to the
boundaries next to it.  It finds itself again when lines were put in or taken out before it.  A window that
occurs anywhere else is kept where it occurs first, by (doc_id, place), and removed elsewhere once its bytes were
compared with those of the first; from there the match grows line by line to both sides as far as the bytes of the
chunk agree.  A line of over ``LONG_WORDS`` words is a passage by itself: it counts as a chunk of its own, too.

Defined results: lines end at ``\\n`` alone; a null text stays null and an empty text empty; a text
whose every chunk goes becomes empty; a very long text is read whole, by one task; null doc_ids come
first; repeated rows (same doc_id, same text) are one occurrence and are treated alike; other single lines and
windows of white space alone always stay; an empty table gives no rows.  Other columns pass through
unchanged; the three counts replace input columns of their names, and with ``counts=False`` there are none.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import arrow_rows, materialise

#: Lines under the rolling hash, bytes between boundaries, about, and most lines of a chunk to either side.
WINDOW, TARGET, MOST = 2, 64, 64
#: Words of a line beyond which it is a chunk of its own.
LONG_WORDS = 50
#: Keys of texts with first occurrences are broadcast up to so many bytes, of so many each, so that other texts
#: are not shuffled; beyond, they are.
BROADCAST_BYTES, KEY_BYTES = 32_000_000, 16
COUNTS = ("n_lines", "n_removed_lines", "n_removed_chunks")
_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15  # odd; any such multiplier does

CHUNKS = T.StructType(
    [
        T.StructField("uid", T.LongType()),
        T.StructField("doc_id", T.LongType()),
        T.StructField("chunk", T.IntegerType()),
        T.StructField("high", T.LongType()),
        T.StructField("low", T.LongType()),
    ]
)


def boundaries(lines: list[bytes], target: int = TARGET) -> list[int]:
    """First lines of the windows that the rolling hash chooses."""
    from xxhash import xxh64_intdigest

    last, rolling, hashes = [0] * WINDOW, 0, []
    drop = pow(_BASE, WINDOW, 1 << 64)
    for k, line in enumerate(lines):
        h = xxh64_intdigest(line)
        rolling = (rolling * _BASE + h - last[k % WINDOW] * drop) & _MASK
        last[k % WINDOW] = h
        if k + 1 >= WINDOW:
            hashes.append(rolling >> 32)
    found, before, size = [], _MASK, sum(map(len, lines[: WINDOW - 1])) + WINDOW - 1
    for k, (h, after) in enumerate(zip(hashes, [*hashes[1:], _MASK])):
        size += len(lines[k + WINDOW - 1])
        if h * target < size << 32 or before >= h <= after:
            found.append(k)
        size -= len(lines[k])
        before = h
    return found


class Unit(NamedTuple):
    """What may be removed: its number in the text, its lines, and those of the chunk around it."""

    number: int
    begin: int
    whole: bytes
    before: list[bytes]
    after: list[bytes]


def units(lines: list[bytes], target: int = TARGET) -> Iterator[Unit]:
    """Windows of the chunks of a text, and its long lines."""
    found = boundaries(lines, target)
    for low, begin, high in zip([-1, *found], found, [*found[1:], len(lines)]):
        whole = b"\n".join(lines[begin : begin + WINDOW])
        if whole.strip():
            yield Unit(2 * begin, begin, whole, lines[max(low + 1, begin - MOST) : begin], lines[begin + WINDOW : min(high + WINDOW - 1, begin + WINDOW + MOST)])
    for k, line in enumerate(lines):
        if len(line) > 2 * LONG_WORDS and len(line.split()) > LONG_WORDS:
            yield Unit(2 * k + 1, k, line, [], [])


def matched(lines: list[bytes], begin: int, first: Unit) -> range:
    """The lines that a window's match with its first occurrence covers, grown to both sides."""
    low, high = begin, begin + first.whole.count(b"\n") + 1
    for line in reversed(first.before):
        if not low or lines[low - 1] != line:
            break
        low -= 1
    for line in first.after:
        if high == len(lines) or lines[high] != line:
            break
        high += 1
    return range(low, high)


def _with_uid(docs: DataFrame) -> DataFrame:
    return docs.withColumn("__line_dedup_uid", F.xxhash64(F.col("doc_id").cast("long"), "text"))


def chunk_table(docs: DataFrame, target: int = TARGET) -> DataFrame:
    """A row for every chunk, with a 128-bit hash of its bytes."""

    def make():
        from xxhash import xxh3_128_intdigest

        def work(batch: pa.RecordBatch) -> dict[str, list]:
            out: dict[str, list] = {f: [] for f in CHUNKS.names}
            for uid, doc_id, text in zip(*(batch.column(i).to_pylist() for i in range(2)), batch.column(2)):
                for unit in units((text.as_py() or b"").split(b"\n"), target):
                    h = xxh3_128_intdigest(unit.whole)
                    high, low = h >> 64, h & _MASK
                    out["uid"].append(uid)
                    out["doc_id"].append(doc_id)
                    out["chunk"].append(unit.number)
                    out["high"].append(high - (1 << 64) if high >> 63 else high)
                    out["low"].append(low - (1 << 64) if low >> 63 else low)
            return out

        return work

    texts = _with_uid(docs).select("__line_dedup_uid", F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("text"))
    return arrow_rows(texts, make, CHUNKS)


def _first_texts(docs: DataFrame, first: DataFrame, target: int) -> DataFrame:
    """``high, low, first`` of first occurrences: the bytes of the window, and of the chunk's other lines."""
    lines = T.ArrayType(T.BinaryType())
    unit = T.StructType([T.StructField("bytes", T.BinaryType()), T.StructField("before", lines), T.StructField("after", lines)])
    schema = T.StructType([*CHUNKS.fields[3:], T.StructField("first", unit)])

    def make():
        def work(batch: pa.RecordBatch) -> dict[str, list]:
            out: dict[str, list] = {"high": [], "low": [], "first": []}
            for text, wanted in zip(batch.column(0), batch.column(1).to_pylist()):
                found = {u.number: u for u in units((text.as_py() or b"").split(b"\n"), target)}
                for w in wanted:
                    if (u := found.get(w["chunk"])) is not None:
                        out["high"].append(w["high"])
                        out["low"].append(w["low"])
                        out["first"].append({"bytes": u.whole, "before": u.before, "after": u.after})
            return out

        return work

    wanted = first.groupBy("uid").agg(F.collect_list(F.struct("chunk", "high", "low")).alias("wanted"))  # of one text
    wanted = materialise(wanted, "wanted")
    texts = _with_uid(docs).select("__line_dedup_uid", "text")
    if wanted.count() * KEY_BYTES <= BROADCAST_BYTES:
        texts = texts.join(F.broadcast(wanted.select("uid")), F.col("__line_dedup_uid") == F.col("uid"), "left_semi")
    # equal rows have equal texts; one of them is enough
    texts = texts.join(wanted, F.col("__line_dedup_uid") == F.col("uid"))
    rows = texts.select(F.col("text").cast("binary").alias("text"), "wanted")
    return arrow_rows(rows, make, schema).groupBy("high", "low").agg(F.min("first").alias("first"))


def _runs(lines: set[int]) -> int:
    return sum(k - 1 not in lines for k in lines)


def deduplicate(docs: DataFrame, *, target: int = TARGET, counts: bool = True) -> DataFrame:
    """``docs`` with repeated chunks taken out of ``text``, and ``n_lines, n_removed_lines, n_removed_chunks``.

    Chunks that overlap or touch are removed as one, and ``n_removed_chunks`` counts those.
    """
    chunks = materialise(chunk_table(docs, target), "chunks")
    place = F.struct("doc_id", "uid", "chunk")
    first = (
        chunks.groupBy("high", "low")
        .agg(F.min(place).alias("first"), F.max(place).alias("last"))
        .where(F.col("first") != F.col("last"))
        .select("high", "low", F.col("first.uid").alias("uid"), F.col("first.chunk").alias("chunk"))
    )
    first = materialise(first, "firsts")
    known = first.select("high", "low", F.col("uid").alias("_u"), F.col("chunk").alias("_c")).join(_first_texts(docs, first, target), ["high", "low"])
    known = materialise(known, "repeated")
    # one join of two plain exchanges, which Spark may split where a chunk is very frequent; equal rows
    # have the same marks, so a set of them is no larger than the chunks of one text
    marks = (
        chunks.join(known, ["high", "low"])
        .where((F.col("uid") != F.col("_u")) | (F.col("chunk") != F.col("_c")))
        .groupBy(F.col("uid").alias("__line_dedup_key"))
        .agg(F.collect_set(F.struct("chunk", F.col("first.bytes"), F.col("first.before"), F.col("first.after"))).alias("__line_dedup_marks"))
    )
    # columns go through the task by number, so that no name of theirs can clash
    names = [c for c in docs.columns if c != "text" and not (counts and c in COUNTS)]
    joined = _with_uid(docs).join(marks, F.col("__line_dedup_uid") == F.col("__line_dedup_key"), "left")
    joined = joined.select(*(F.col(f"`{c}`").alias(f"_{i}") for i, c in enumerate(names)), F.col("text").cast("binary").alias("_text"), "__line_dedup_marks")
    added = [T.StructField("_text", T.BinaryType()), *(T.StructField(f"_{c}", T.LongType()) for c in COUNTS)]
    schema = T.StructType([*(T.StructField(f"_{i}", docs.schema[c].dataType) for i, c in enumerate(names)), *added])

    def make():
        def work(batch: pa.RecordBatch) -> dict[str, object]:
            out: dict[str, object] = {f"_{i}": batch.column(i) for i in range(len(names))}
            texts, total, gone, runs = [], [], [], []
            for text, marks_here in zip(batch.column(len(names)), batch.column(len(names) + 1)):
                text, there = text.as_py(), marks_here.as_py()
                total.append(text.count(b"\n") + 1 if text else 0)
                dropped: set[int] = set()
                if text and there:
                    lines = text.split(b"\n")
                    known = {m["chunk"]: Unit(m["chunk"], 0, m["bytes"], m["before"], m["after"]) for m in there}
                    for unit in units(lines, target):
                        if (first := known.get(unit.number)) is not None and first.whole == unit.whole:
                            dropped.update(matched(lines, unit.begin, first))
                    text = b"\n".join(x for k, x in enumerate(lines) if k not in dropped)
                gone.append(len(dropped))
                runs.append(_runs(dropped))
                texts.append(text)
            return out | {"_text": texts} | dict(zip((f"_{c}" for c in COUNTS), (total, gone, runs)))

        return work

    done = arrow_rows(joined, make, schema)
    place_of = {c: f"_{i}" for i, c in enumerate(names)} | {"text": "_text"}
    kept = [F.col(place_of[c]).cast("string").alias(c) if c == "text" else F.col(place_of[c]).alias(c) for c in docs.columns if c in place_of]
    return done.select(*kept, *(F.col(f"_{c}").alias(c) for c in COUNTS if counts))
