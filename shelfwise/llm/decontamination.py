"""Benchmark decontamination with a distributed positional inverted index.

The index is sharded by document, as search engines shard theirs: each task turns its documents
into segments, and a segment is one stored row with its terms, the ends of their posting lists and
the lists themselves (ascending word positions; documents stand apart by a gap, so that no phrase
crosses from one to the next).  All terms are stored, and an index serves any benchmark.  A segment is a row of several MB, so it has a row group
of its own and travels alone: neither the writer, nor the reader, nor the way to Python holds more than one or two
of a task at once, however large the table is.  Test items become
windows, which meet the index in blocks of about ``WINDOWS_A_BLOCK``.  In a segment, a window starts from the
posting list of its rarest term there, and the offset-adjusted lists of its other terms are
intersected, rarest first, for about ``PAIRS_AT_ONCE`` starts at a time.  What is left are exact phrases.
Proximity matches need all terms of a window within a given distance of its rarest one, in any order.

Defined results: null or empty text has no words and no hits; a very long text is one segment; an item
without words has no window, and the words of an item without id count as hit while no id is listed; copies
of an item match together; repeated rows and doc_ids are judged row by row; empty tables give no rows, or
rows without hits; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import arrow_rows, materialise

WINDOW = 10
#: Words of a segment (a document is never split, so a very long one makes a longer segment).
SEGMENT_WORDS = 1_000_000
#: Windows of a block that meets all segments, about, and candidate starts that a segment holds at once.
WINDOWS_A_BLOCK, PAIRS_AT_ONCE = 400_000, 2_000_000
#: Documents and segments that go to Python at once.  Without limits a writer looks at its size after 100 segments
#: for the first time, and a reader and a batch hold all segments of a task.
DOCS_AT_ONCE, SEGMENTS_AT_ONCE = 2_000, 1
SEGMENT_FILES = {"parquet.block.row.count.limit": "1"}
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"

#: A-Z become a-z; ASCII that is no letter or digit becomes a space; other bytes stay.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)

WINDOWS = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("words", T.ArrayType(T.BinaryType()))])


def _segments(doc: T.DataType) -> T.StructType:
    return T.StructType(
        [
            T.StructField("segment", T.StringType()),
            T.StructField("docs", T.ArrayType(doc)),
            T.StructField("n_words", T.ArrayType(T.LongType())),
            T.StructField("terms", T.ArrayType(T.BinaryType())),
            T.StructField("ends", T.ArrayType(T.IntegerType())),
            T.StructField("postings", T.BinaryType()),
        ]
    )


def _hits(doc: T.DataType) -> T.StructType:
    return T.StructType(
        [
            T.StructField("segment", T.StringType()),
            T.StructField("row", T.IntegerType()),
            T.StructField("doc", doc),
            T.StructField("n_words", T.LongType()),
            *(T.StructField(c, T.ArrayType(T.LongType())) for c in ("hit_spans", "items", "near_items")),
        ]
    )


def words_of(text: bytes) -> list[bytes]:
    return text.translate(WORD_BYTES).split()


def benchmark_windows(benchmark: DataFrame, width: int = WINDOW) -> DataFrame:
    """``(item_id, words)``: every window of ``width`` words; a shorter item is one window."""
    def make():
        def work(batch: pa.RecordBatch) -> dict[str, list]:
            ids, out = [], []
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                w = words_of(text or b"")
                for i in range(max(1, len(w) - width + 1) if w else 0):
                    ids.append(item)
                    out.append(w[i : i + width])
            return {"item_id": ids, "words": out}

        return work

    return arrow_rows(
        benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("binary").alias("text")),
        make,
        WINDOWS,
    )


def build_index(docs: DataFrame, ids: tuple[str, ...] = ("doc_id",), *, gap: int = WINDOW, segment_words: int = SEGMENT_WORDS) -> DataFrame:
    """Segments of the positional index of the texts of ``docs``; ``ids`` are kept for every document."""

    def make():
        from pyspark import TaskContext

        task, made = TaskContext.get().partitionId(), 0

        def segment(rows: list, counts: list, term: list, terms: list) -> dict[str, list]:
            nonlocal made
            starts = np.cumsum(np.array([0, *counts], dtype=np.int64) + gap) - gap
            term = np.concatenate(term)
            at = np.arange(len(term)) + np.repeat(starts[:-1] - np.cumsum([0, *counts[:-1]]), counts)
            order = np.argsort(term, kind="stable")
            made += 1
            return {
                "segment": [f"{task}-{made}"],
                "docs": [rows],
                "n_words": [counts],
                "terms": [terms],
                "ends": [np.cumsum(np.bincount(term, minlength=len(terms))).astype(np.int32)],
                "postings": [at[order].astype("<i4").tobytes()],
            }

        def work(batch: pa.RecordBatch) -> Iterator[dict[str, list]]:
            rows, counts, term, total = [], [], [], 0
            number: dict[bytes, int] = {}
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                w = words_of(text.as_py() or b"")
                rows.append(doc)
                counts.append(len(w))
                try:
                    term.append(np.fromiter(map(number.__getitem__, w), dtype=np.int32, count=len(w)))
                except KeyError:
                    term.append(np.fromiter((number.setdefault(x, len(number)) for x in w), dtype=np.int32, count=len(w)))
                total += len(w)
                if total >= segment_words:
                    yield segment(rows, counts, term, list(number))
                    rows, counts, term, total, number = [], [], [], 0, {}
            if rows:
                yield segment(rows, counts, term, list(number))

        return work

    texts = docs.select(F.struct(*ids).alias("doc"), F.col("text").cast("binary").alias("text"))
    schema = _segments(texts.schema["doc"].dataType)
    return arrow_rows(texts, make, schema)


@contextmanager
def _at_once(spark: SparkSession, rows: int) -> Iterator[None]:
    """What is run inside hands at most ``rows`` rows to Python at once."""
    before = spark.conf.get(BATCH_ROWS)
    spark.conf.set(BATCH_ROWS, min(rows, int(before)) if int(before) > 0 else rows)
    try:
        yield
    finally:
        spark.conf.set(BATCH_ROWS, before)


def store_index(docs: DataFrame, ids: tuple[str, ...] = ("doc_id",), **options) -> DataFrame:
    """The index of ``build_index``, written with a row group for each segment."""
    with _at_once(docs.sparkSession, DOCS_AT_ONCE):
        return materialise(build_index(docs, ids, **options), "index", **SEGMENT_FILES)


class _Queries:
    """Distinct windows as term numbers, padded with -1, and the ids of their items (none for items without id)."""

    def __init__(self, windows: list[tuple[list[int], list[bytes]]]):
        self.items = [sorted(items) for items, _ in windows]
        self.number = {t: i for i, t in enumerate(dict.fromkeys(t for _, w in windows for t in w))}
        self.width = max((len(w) for _, w in windows), default=1)
        self.terms = np.full((len(windows), self.width), -1, dtype=np.int64)
        for k, (_, w) in enumerate(windows):
            self.terms[k, : len(w)] = [self.number[t] for t in w]
        self.length = (self.terms >= 0).sum(axis=1)


def _matches(q: _Queries, terms: list[bytes], ends: np.ndarray, postings: np.ndarray, slop: int | None):
    """(window, position) of phrases, and of proximity matches if ``slop`` is given."""
    nothing = np.zeros(0, np.int64)
    starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
    local = np.fromiter((q.number.get(t, -1) for t in terms), dtype=np.int64, count=len(terms))
    row = np.full(len(q.number) + 1, -1, dtype=np.int64)  # of a query term in this segment; the last is the padding
    row[local[local >= 0]] = np.flatnonzero(local >= 0)
    rows = row[q.terms]  # padding reads the last entry
    inside = q.terms >= 0
    whole = np.flatnonzero(((rows >= 0) | ~inside).all(axis=1) & (q.length > 0))
    if not len(whole):
        return (nothing, nothing), (nothing, nothing)
    count = (ends - starts).astype(np.int64)
    often = np.where(inside[whole], count[rows[whole]], np.iinfo(np.int64).max)
    by_rarity = np.argsort(often, axis=1, kind="stable")
    anchor = rows[whole, by_rarity[:, 0]]
    span = int(postings.max()) + 2 * q.width + 2 + (slop or 0)
    used = np.unique(rows[whole][inside[whole]])  # ascending: lists in order, positions in order
    key = np.concatenate([t * span + postings[starts[t] : ends[t]].astype(np.int64) for t in used])

    def has(term_row: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        found = np.searchsorted(key, term_row * span + np.maximum(low, 0), side="left")
        return (found < len(key)) & (key[np.minimum(found, len(key) - 1)] <= term_row * span + high) & (high >= 0)

    exact, near = [], []
    block = np.cumsum(count[anchor]) // PAIRS_AT_ONCE
    cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), len(whole)]
    for first, end in zip(cuts, cuts[1:]):
        n = count[anchor[first:end]]
        window = np.repeat(np.arange(first, end), n)
        at = postings[np.repeat(starts[anchor[first:end]] - (np.cumsum(n) - n), n) + np.arange(n.sum())].astype(np.int64)
        w, p = window, at - by_rarity[window, 0]  # p: where the window would start
        near_w, near_p = window, at
        for k in range(1, q.width):
            other = by_rarity[w, k]
            real = inside[whole[w], other]
            keep = ~real | has(np.where(real, rows[whole[w], other], 0), p + other, p + other)
            w, p = w[keep], p[keep]
            if slop is not None:
                other = by_rarity[near_w, k]
                real = inside[whole[near_w], other]
                keep = ~real | has(np.where(real, rows[whole[near_w], other], 0), near_p - slop, near_p + slop)
                near_w, near_p = near_w[keep], near_p[keep]
        exact.append((whole[w], p))
        if slop is not None:
            near.append((whole[near_w], near_p))
    return tuple(tuple(np.concatenate([nothing, *(x[i] for x in found)]) for i in (0, 1)) for found in (exact, near))


def _union(spans: list[tuple[int, int]]) -> list[int]:
    """Half-open intervals, sorted, as start, end, start, end, ... of their union."""
    out: list[int] = []
    for s, e in spans:
        if out and s <= out[-1]:
            out[-1] = max(out[-1], e)
        else:
            out += [s, e]
    return out


def _probe(index: DataFrame, queries, gap: int, slop: int | None) -> DataFrame:
    schema = _hits(index.schema["docs"].dataType.elementType)

    def make():
        q = queries.value

        def work(batch: pa.RecordBatch) -> dict[str, list]:
            out: dict[str, list] = {f: [] for f in schema.names}
            for at in range(batch.num_rows):  # a segment at a time
                terms, ends, postings = (batch.column(c)[at] for c in ("terms", "ends", "postings"))
                r = {c: batch.column(c)[at].as_py() for c in ("segment", "docs", "n_words")}
                counts = np.array(r["n_words"], dtype=np.int64)
                starts = np.cumsum(counts + gap) - counts - gap
                ends = ends.values.to_numpy(zero_copy_only=False).astype(np.int64)
                (w, p), (nw, np_) = _matches(q, terms.as_py(), ends, np.frombuffer(postings.as_buffer(), "<i4"), slop)
                order = np.argsort(p, kind="stable")
                w, p = w[order], p[order]
                doc = np.searchsorted(starts, p, side="right") - 1
                near_doc = np.searchsorted(starts, np_, side="right") - 1
                cuts = np.searchsorted(doc, np.arange(len(counts) + 1))
                order = np.argsort(near_doc, kind="stable")
                nw, near_cuts = nw[order], np.searchsorted(near_doc[order], np.arange(len(counts) + 1))
                for k, doc_row in enumerate(r["docs"]):
                    a, b = cuts[k], cuts[k + 1]
                    out["segment"].append(r["segment"])
                    out["row"].append(k)
                    out["doc"].append(doc_row)
                    out["n_words"].append(r["n_words"][k])
                    out["hit_spans"].append(_union(list(zip((p[a:b] - starts[k]).tolist(), (p[a:b] - starts[k] + q.length[w[a:b]]).tolist()))))
                    out["items"].append(sorted({i for x in set(w[a:b].tolist()) for i in q.items[x]}))
                    out["near_items"].append(sorted({i for x in set(nw[near_cuts[k] : near_cuts[k + 1]].tolist()) for i in q.items[x]}))
            return out

        return work

    return arrow_rows(index, make, schema)


def _merged(parts: DataFrame) -> DataFrame:
    """One row for each document row, from one of each block of windows."""
    columns = ("hit_spans", "items", "near_items")
    grouped = parts.groupBy("segment", "row").agg(F.first("doc").alias("doc"), F.first("n_words").alias("n_words"), *(F.collect_list(c).alias(c) for c in columns))

    def make():
        def work(batch: pa.RecordBatch) -> dict[str, object]:
            out: dict[str, object] = {c: batch.column(i) for i, c in enumerate(("segment", "row", "doc", "n_words"))}
            spans, *items = (batch.column(i).to_pylist() for i in (4, 5, 6))
            out["hit_spans"] = [_union(sorted((x[i], x[i + 1]) for x in every for i in range(0, len(x), 2))) for every in spans]
            return out | {c: [sorted({i for x in every for i in x}) for every in found] for c, found in zip(columns[1:], items)}

        return work

    return arrow_rows(grouped, make, _hits(parts.schema["doc"].dataType))


def find_matches(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    ids: tuple[str, ...] = ("doc_id",),
    width: int = WINDOW,
    slop: int | None = None,
    windows_a_block: int = WINDOWS_A_BLOCK,
) -> DataFrame:
    """Per document row its ``ids`` in the struct ``doc``, ``hit_spans`` (word intervals start, end, start,
    end, ...) and ``items`` of exact phrases, and ``near_items`` whose terms all lie within ``slop`` words of
    the rarest."""
    spark, gap = docs.sparkSession, width + (slop or 0)
    windows = materialise(benchmark_windows(benchmark, width), "windows")
    index = store_index(docs, ids, gap=gap)
    blocks = max(1, -(-windows.count() // windows_a_block))
    parts = []
    for k in range(blocks):  # by the words, so that a long or repeated item is spread over the blocks
        mine = windows.where(F.pmod(F.xxhash64("words"), F.lit(blocks)) == k).groupBy("words").agg(F.collect_set("item_id").alias("items"))
        queries = _Queries([(r["items"], [bytes(w) for w in r["words"]]) for r in mine.toLocalIterator()])
        with _at_once(spark, SEGMENTS_AT_ONCE):
            parts.append(materialise(_probe(index, spark.sparkContext.broadcast(queries), gap, slop), "hits"))
    return parts[0] if blocks == 1 else _merged(reduce(DataFrame.unionByName, parts))


def contamination(docs: DataFrame, benchmark: DataFrame, *, ids: tuple[str, ...] = ("doc_id",), **options) -> DataFrame:
    """The digest per document: counts of hit words and items, and whether any word is hit."""
    n_hit = F.aggregate(
        F.sequence(F.lit(0), F.size("hit_spans") - 2, F.lit(2)),
        F.lit(0).cast("long"),
        lambda a, i: a + F.get(F.col("hit_spans"), i + 1) - F.get(F.col("hit_spans"), i),
    )
    names = F.array_join(F.array_sort(F.transform("items", lambda x: x.cast("string"))), ",")
    return (
        find_matches(docs, benchmark, ids=ids, **options)
        .withColumn("n_hit", F.when(F.size("hit_spans") > 0, n_hit).otherwise(F.lit(0)).cast("long"))
        .select(
            "doc.*",
            "n_words",
            "n_hit",
            F.size("items").cast("long").alias("n_items"),
            F.sha2(names.cast("binary"), 256).alias("items_sha256"),
            (F.col("n_hit") > 0).alias("contaminated"),
            F.size("near_items").cast("long").alias("n_near_items"),
        )
    )
