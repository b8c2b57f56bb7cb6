"""Document fingerprints from prefix polynomial hashes.

A text's prefix array holds, for every i, the hash of its first i code points: a polynomial in a fixed base modulo
2^31 - 1, in two bases.  The hash of any span follows from two of its entries, so spans of any texts are compared
in constant time, and the longest common extension of two positions is found by binary search over its length.

A fingerprint is the number of code points, the hash of the whole text, and a sketch: the ``SKETCH`` least values
that the hashes of its spans of ``SPAN`` code points take after mixing.  Two sketches tell which share of their
spans two texts have in common (``likeness``).  The spans of an edited text, a text's beginning and another's
beginning, are those of both and a few over the seam, so it is not hashed anew.

Defined results: a null text is empty; a text shorter than ``SPAN`` has one span, itself, and an empty one none; two
empty texts are alike, an empty and another are not; repeated spans count once; equal doc_ids are in the order of
a hash of their texts, null ones last; equal rows are each other's next; the next of a lone document is itself; a
very long text is read whole, its arrays take 8 bytes for each code point; an empty table gives no row.  Other columns
of the input are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import arrow_rows, give_back, materialise, worker_memo

#: Code points of a span, and span hashes of a sketch.
SPAN, SKETCH = 12, 64
PRIME = (1 << 31) - 1
#: Any two bases below the prime do; all fingerprints that are compared must share them.
BASES = (911_382_323, 1_972_663_141)
#: Code points whose powers are at hand; longer texts go on block by block.
BLOCK = 1 << 14


def _reduced(x: np.ndarray) -> np.ndarray:
    """x modulo 2^31 - 1, for x below 2^62."""
    x = (x & PRIME) + (x >> np.uint64(31))
    x = (x & PRIME) + (x >> np.uint64(31))
    return np.where(x == PRIME, np.uint64(0), x)


class Powers:
    """Powers of a base and of its inverse, up to a block."""

    def __init__(self, base: int):
        self.base = base
        self.up, self.down = self._table(base), self._table(pow(base, -1, PRIME))

    @staticmethod
    def _table(base: int) -> np.ndarray:
        out = np.ones(BLOCK + 1, dtype=np.uint64)
        n = 1
        while n <= BLOCK:  # doubling: the powers from n on are those before, times base^n
            more = min(n, BLOCK + 1 - n)
            out[n : n + more] = _reduced(out[:more] * np.uint64(pow(base, n, PRIME)))
            n += more
        return out

    def prefixes(self, codes: np.ndarray) -> np.ndarray:
        """Hashes of the first 0, 1, ... code points."""
        out = np.zeros(len(codes) + 1, dtype=np.uint32)
        before = np.uint64(0)
        for low in range(0, len(codes), BLOCK):
            c = codes[low : low + BLOCK]
            n = len(c)
            # sum of c[k] * base^(t-1-k) over k < t, as base^(t-1) times a running sum over inverse powers
            inner = _reduced(np.cumsum(_reduced(c * self.down[:n])))
            whole = _reduced(_reduced(inner * self.up[:n]) + _reduced(before * self.up[1 : n + 1]))
            out[low + 1 : low + n + 1] = whole
            before = whole[-1]
        return out


class Prefixes:
    """The prefix arrays of one text."""

    def __init__(self, text: str):
        powers = worker_memo(("powers",), lambda: [Powers(b) for b in BASES])
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64) + np.uint64(1)
        self.n = len(codes)
        self.arrays = [p.prefixes(codes) for p in powers]

    def span(self, i: int, n: int) -> int:
        """The hash of n code points from the i-th on."""
        out = 0
        for base, h in zip(BASES, self.arrays):
            out = (out << 31) | (int(h[i + n]) - int(h[i]) * pow(base, n, PRIME)) % PRIME
        return out

    def spans(self, n: int, low: int = 0, high: int | None = None) -> np.ndarray:
        """The hashes of all spans of n code points that begin at low and later, and end at high or before."""
        high = self.n if high is None else high
        if high - low < n:
            return np.zeros(0, dtype=np.uint64)
        out = np.zeros(high - low - n + 1, dtype=np.uint64)
        for base, h in zip(BASES, self.arrays):
            taken = _reduced(h[low : high - n + 1].astype(np.uint64) * np.uint64(pow(base, n, PRIME)))
            out = (out << np.uint64(31)) | _reduced(h[low + n : high + 1].astype(np.uint64) + np.uint64(PRIME) - taken)
        return out

    def equal(self, i: int, other: Prefixes, j: int, n: int) -> bool:
        return i + n <= self.n and j + n <= other.n and self.span(i, n) == other.span(j, n)

    def common_extension(self, i: int, other: Prefixes, j: int) -> int:
        """How many code points from i on equal those of the other text from j on."""
        low, high = 0, max(0, min(self.n - i, other.n - j))
        while low < high:
            middle = (low + high + 1) // 2
            low, high = (middle, high) if self.equal(i, other, j, middle) else (low, middle - 1)
        return low


def _mixed(spans: np.ndarray) -> np.ndarray:
    """Span hashes in an order that has nothing to do with their texts."""
    x = spans * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return x >> np.uint64(32)


def _least(*values: np.ndarray) -> np.ndarray:
    """The ``SKETCH`` least distinct values of all."""
    total = sum(map(len, values))
    bound = (1 << 32) * 4 * SKETCH // max(total, 1)
    if bound < 1 << 32:  # repeated spans may leave too few below the bound
        few = np.unique(np.concatenate([v[v < bound] for v in values]))
        if len(few) >= SKETCH:
            return few[:SKETCH]
    return np.unique(np.concatenate(values))[:SKETCH]


class Fingerprinted:
    """A text with its prefix arrays, mixed span hashes and fingerprint."""

    def __init__(self, text: str):
        self.text, self.prefixes = text, Prefixes(text)
        n = self.prefixes.n
        self.values = _mixed(self.prefixes.spans(min(SPAN, n)) if n else np.zeros(0, dtype=np.uint64))
        self.fingerprint = fingerprint_text(n, self.prefixes.span(0, n), _least(self.values))


def fingerprint_text(n: int, whole: int, sketch: np.ndarray) -> str:
    return f"{n:x}-{whole:016x}-" + "".join(f"{v:08x}" for v in sketch.tolist())


def edited(doc: Fingerprinted, following: Fingerprinted) -> tuple[str, str, int]:
    """The edited text, its fingerprint, and how many code points it begins with that the text does, too."""
    n = doc.prefixes.n
    cut = n - n // 3
    more = min(n // 3, following.prefixes.n)
    text = doc.text[:cut] + following.text[:more]
    if cut + more < SPAN:  # one span at most
        new = Fingerprinted(text)
        return text, new.fingerprint, doc.prefixes.common_extension(0, new.prefixes, 0)
    first = max(0, cut - SPAN + 1)
    seam = Prefixes(doc.text[first:cut] + following.text[: min(more, SPAN - 1)])
    sketch = _least(doc.values[:first] if n >= SPAN else doc.values[:0], _mixed(seam.spans(SPAN)), following.values[: max(0, more - SPAN + 1)])
    whole = 0
    for base, h, g in zip(BASES, doc.prefixes.arrays, following.prefixes.arrays):
        whole = (whole << 31) | (int(h[cut]) * pow(base, more, PRIME) + int(g[more])) % PRIME
    same = cut + min(doc.prefixes.common_extension(cut, following.prefixes, 0), more)
    return text, fingerprint_text(cut + more, whole, sketch), same


def likeness(a: str, b: str) -> float:
    """The share of their spans that two texts have in common (twice those in both, by those of either), from
    their fingerprints: exact for texts of few spans, else from the least values of both together."""
    (size_a, whole_a, sketch_a), (size_b, whole_b, sketch_b) = (x.split("-") for x in (a, b))
    if (size_a, whole_a) == (size_b, whole_b):
        return 1.0
    x, y = ({s[k : k + 8] for k in range(0, len(s), 8)} for s in (sketch_a, sketch_b))
    if not x or not y:
        return 0.0
    full = [len(s) == SKETCH for s in (x, y)]
    least = sorted(x | y)
    if any(full):
        # beyond its last value a full sketch says nothing
        top = min(max(s) for s, f in zip((x, y), full) if f)
        least = [v for v in least if v <= top]
    both = sum(v in x and v in y for v in least)
    return 2 * both / (len(least) + both)


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, n_chars, fingerprint`` of every document."""
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("n_chars", T.LongType()), T.StructField("fingerprint", T.StringType())])

    def make():
        def work(batch: pa.RecordBatch) -> dict[str, list]:
            found = [Fingerprinted(t.as_py() or "") for t in batch.column(1)]
            return {"doc_id": batch.column(0), "n_chars": [x.prefixes.n for x in found], "fingerprint": [x.fingerprint for x in found]}

        return work

    return arrow_rows(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").alias("text")), make, schema)


def span_equality(pairs: DataFrame) -> DataFrame:
    """``pairs`` of texts (``text_a, start_a, text_b, start_b, length``) with ``equal``, and ``extension``: the
    longest equal run from both starts.  A span that leaves its text is not equal; nulls give null."""
    kept = pairs.columns
    schema = T.StructType([*pairs.schema.fields, T.StructField("equal", T.BooleanType()), T.StructField("extension", T.LongType())])
    needed = [kept.index(c) for c in ("text_a", "start_a", "text_b", "start_b", "length")]

    def make():
        def work(batch: pa.RecordBatch) -> dict[str, object]:
            out: dict[str, object] = {c: batch.column(i) for i, c in enumerate(kept)}
            equal, extension, at, texts = [], [], (), ()
            for a, i, b, j, n in zip(*(batch.column(k).to_pylist() for k in needed)):
                if None in (a, i, b, j, n):
                    equal.append(None)
                    extension.append(None)
                    continue
                if (a, b) != at:  # neighbouring questions about the same texts share their arrays
                    at, texts = (a, b), (Prefixes(a), Prefixes(b))
                inside = min(i, j, n) >= 0
                equal.append(inside and texts[0].equal(i, texts[1], j, n))
                extension.append(texts[0].common_extension(i, texts[1], j) if min(i, j) >= 0 else 0)
            return out | {"equal": equal, "extension": extension}

        return work

    return arrow_rows(pairs, make, schema)


RESULT = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("n_chars", T.LongType()),
        T.StructField("edited_sha256", T.StringType()),
        T.StructField("fingerprint", T.StringType()),
        T.StructField("edited_fingerprint", T.StringType()),
        T.StructField("near_edited", T.DoubleType()),
        T.StructField("near_next", T.DoubleType()),
        T.StructField("common_prefix", T.LongType()),
    ]
)


def _result(doc_id: int | None, doc: Fingerprinted, following: Fingerprinted) -> tuple:
    text, fingerprint, same = edited(doc, following)
    sha = hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()
    return doc_id, doc.prefixes.n, sha, doc.fingerprint, fingerprint, likeness(doc.fingerprint, fingerprint), likeness(doc.fingerprint, following.fingerprint), same


def compare_with_next(docs: DataFrame) -> DataFrame:
    """Every text against itself after an edit, and against the next document, by descending doc_id.

    One exchange sorts the table by range; neighbours then meet in a stream over each range.  The last document of
    a range and the first of the next one, two rows a range, meet in a join.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    edge = [T.StructField("part", T.LongType()), T.StructField("first", T.BooleanType()), T.StructField("text", T.StringType())]
    schema = T.StructType([*RESULT, *edge])
    target = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, part = None, None
        for batch in batches:
            out: list[tuple] = []
            parts, doc_ids = (batch.column(c).to_pylist() for c in (0, 1))
            for part, doc_id, text in zip(parts, doc_ids, batch.column(2)):
                here = Fingerprinted(text.as_py())
                if last is None:
                    out.append((None,) * len(RESULT) + (part, True, here.text))
                else:
                    out.append(_result(*last, here) + (None, None, None))
                last = (doc_id, here)
            yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*out), target)], schema=target)
            del batch, out
            give_back()
        if last is not None:
            row = (last[0], *(None,) * (len(RESULT) - 1), part, False, last[1].text)
            yield pa.RecordBatch.from_arrays([pa.array([v], type=f.type) for v, f in zip(row, target)], schema=target)

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    order = [F.desc_nulls_last("doc_id"), F.asc("_hash"), F.asc("_tie")]
    # equal rows are told apart by a number, so that they may lie in several ranges
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("_hash"), F.monotonically_increasing_id().alias("_tie"))
    ranged = keyed.repartitionByRange(*order).sortWithinPartitions(*order).select(F.spark_partition_id().cast("long").alias("part"), "doc_id", "text")
    found = materialise(ranged.mapInArrow(run, schema), "neighbours", compression="zstd")
    edges = found.where("part is not null")
    firsts = edges.where("first").select("part", F.col("text").alias("next_text"))
    # numbers of ranges that have rows: one for each task
    parts = [r["part"] for r in firsts.select("part").orderBy("part").collect()]
    following = docs.sparkSession.createDataFrame(list(zip(parts, [*parts[1:], *parts[:1]])), "part long, next_part long")
    lasts = edges.where("not first").select("part", "doc_id", F.col("text").alias("last_text")).join(following, "part")
    met = lasts.join(firsts.withColumnRenamed("part", "next_part"), "next_part").select("doc_id", "last_text", "next_text")

    def make():
        def work(batch: pa.RecordBatch) -> dict[str, list]:
            rows = [_result(i, Fingerprinted(a), Fingerprinted(b)) for i, a, b in zip(*(batch.column(c).to_pylist() for c in range(3)))]
            return dict(zip(RESULT.names, map(list, zip(*rows)))) if rows else {c: [] for c in RESULT.names}

        return work

    return found.where("part is null").select(*RESULT.names).unionByName(arrow_rows(met, make, RESULT))
