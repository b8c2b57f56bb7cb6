"""Cross-tokenizer alignment: two tokenizers' tokens of one text, grouped where both end at the same byte.

The byte offsets at which tokens end are two sorted lists.  Merging them visits every link once: each distinct
end lies in one token of A and one of B, and an end of both closes a group.  A document's merge is a path from
(0, 0) to (tokens of A, tokens of B); diagonals at equal distances cut it into pieces of equal work, and a binary
search along each diagonal finds where the path crosses it, so that pieces are merged without each other.  A
document of one piece is merged where its tokens are made; the pieces of longer ones are dealt out over tasks,
and the groups that stay open at their ends are stitched.

Counts of linked id pairs add up over the corpus before any row is shuffled.  Documents meet the most frequent
``HEAD_PAIRS`` pairs inside their task; their other pairs, rare by then, are joined as rows.

Defined results: a null or empty text, or one whose joined tokens of either side are not its bytes, has no
tokens: zeros and an empty ``groups_sha256``.  Repeated rows count and come out each for itself; a null doc_id is
kept; an empty table gives no row; a very long text is tokenised by one task; ties for the highest count of a B id
are all best.  Other columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
import json
import os
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import arrow_rows, give_back, materialise, worker_memo

#: Steps of the merge, tokens of both sides, in a piece; pairs that tasks hold; bytes of texts tokenised at once.
STEPS, HEAD_PAIRS, BYTES_AT_ONCE = 1 << 16, 1 << 17, 2_000_000
#: Runs that long without ASCII white space, or of it alone, go to the tokenizer that is linear in them.
LONG_RUN = r"\S{1000}|\s{1000}"
# fixed value: how byte-level tokenizers of this kind cut a text
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
OPEN = ("head_a", "head_b", "body", "tail_a", "tail_b")
TOKENS = ("ids_a", "ends_a", "ids_b", "ends_b")

_fields = lambda kind, *names: [T.StructField(n, kind) for n in names]
PARTS = T.StructType(
    [
        *_fields(T.LongType(), "row", "doc_id", "piece", "pieces", "n_a", "n_b", "n_groups", "n_links"),
        *_fields(T.StringType(), "groups_sha256", *OPEN),
        *_fields(T.BooleanType(), "cut"),
        *_fields(T.BinaryType(), "codes", "times", *TOKENS),
        *_fields(T.LongType(), "next_a", "next_b"),
    ]
)


class TokenTable:
    """Bytes and lengths of the tokens of one vocabulary."""

    def __init__(self, tokens: list[bytes]):
        self.size = np.array([len(t) for t in tokens], dtype=np.int64)
        self.begin = np.cumsum(self.size) - self.size
        self.flat = np.frombuffer(b"".join(tokens), dtype=np.uint8)

    def joined(self, ids: np.ndarray) -> np.ndarray:
        size = self.size[ids]
        at = np.repeat(self.begin[ids] - (np.cumsum(size) - size), size)
        at += np.arange(len(at))
        return self.flat[at]


def _byte_alphabet() -> dict[str, int]:
    """Characters in which byte-level vocabularies write bytes: printable ones as they are, others from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(rest)}


class GroupTexts:
    """Every id as text, before a comma and before what ends its side of a group."""

    def __init__(self, n_a: int, n_b: int):
        self.n_a, self.n_b = n_a, n_b
        self.texts = [f"{i}{c}" for n, c in ((n_a, ","), (n_a, "|"), (n_b, ","), (n_b, ";")) for i in range(n)]

    def numbers(self, a: np.ndarray, b: np.ndarray, cut_a: np.ndarray, cut_b: np.ndarray) -> np.ndarray:
        """Closed groups in order, A's ids of a group before B's, as numbers in ``texts``."""
        size_a, size_b = np.diff(cut_a, prepend=-1), np.diff(cut_b, prepend=-1)
        last_a, last_b = np.zeros(len(a), dtype=bool), np.zeros(len(b), dtype=bool)
        last_a[cut_a], last_b[cut_b] = True, True
        out = np.empty(len(a) + len(b), dtype=np.int64)
        out[np.arange(len(a)) + np.repeat(np.append(0, cut_b + 1)[:-1], size_a)] = a + last_a * self.n_a
        out[np.arange(len(b)) + np.repeat(cut_a + 1, size_b)] = 2 * self.n_a + b + last_b * self.n_b
        return out

    def text(self, numbers: np.ndarray) -> str:
        return "".join(map(self.texts.__getitem__, numbers.tolist()))[:-1]


class TokenizerPair:
    """A: a byte-level BPE file; B: a sentence-piece model with byte fallback."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks run side by side already
        self.whole = Tokenizer.from_file(a_path)
        self.whole.encode_special_tokens = True
        parts, alphabet = json.loads(self.whole.to_str()), _byte_alphabet()
        vocabulary, merges = parts["model"]["vocab"], parts["model"]["merges"]
        tokens = [b""] * (max(self.whole.get_vocab().values()) + 1)
        for text, i in vocabulary.items():
            tokens[i] = bytes(alphabet[c] for c in text)
        self.a = TokenTable(tokens)
        merged = ["".join(m) if isinstance(m, (list, tuple)) else m.replace(" ", "") for m in merges]
        order = [vocabulary[m] for m in merged]
        cut = parts["pre_tokenizer"]
        plain = not parts["normalizer"] and cut["type"] == "ByteLevel" and cut["use_regex"] and not cut["add_prefix_space"]
        # ids in the order of merges are ranks, and ranks alone give the same tokens
        self.ranked = None
        if plain and order == sorted(order):
            self.ranked = tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks={t: i for i, t in enumerate(tokens) if t}, special_tokens={})
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=b_path)
        n = self.pieces.get_piece_size()
        kind = lambda i: self.pieces.is_control(i) or self.pieces.is_unknown(i)
        names = [self.pieces.id_to_piece(i) for i in range(n)]
        self.b = TokenTable([b"" if kind(i) else bytes([int(p[3:5], 16)]) if self.pieces.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(names)])
        self.texts = GroupTexts(len(tokens), n)

    def _encode_a(self, text: str, long: bool) -> np.ndarray:
        if long or self.ranked is None:
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, dtype=np.int64)
        return np.asarray(self.ranked.encode_to_numpy(text), dtype=np.int64)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of both sides of all texts in a row, and how many each text has of either: none if the tokens of a
        side are not the bytes of a space and the text."""
        spaced = pc.binary_join_element_wise("", texts, " ")
        long = pc.match_substring_regex(spaced, LONG_RUN).to_numpy(zero_copy_only=False)
        strings = spaced.to_pylist()
        a = [_NONE, *(self._encode_a(t, x) for t, x in zip(strings, long))]
        b = self.pieces.encode([t[1:] for t in strings], num_threads=1)
        n_a, n_b = np.array([len(x) for x in a[1:]], dtype=np.int64), np.array([len(x) for x in b], dtype=np.int64)
        a, b = np.concatenate(a), np.fromiter(chain.from_iterable(b), dtype=np.int64, count=int(n_b.sum()))
        n_bytes = pc.binary_length(spaced).to_numpy(zero_copy_only=False).astype(np.int64)
        right = (_sums(self.a.size[a], n_a) == n_bytes) & (_sums(self.b.size[b], n_b) == n_bytes)
        a, b, n_a, n_b = _keep(a, b, n_a, n_b, right)
        raw = np.frombuffer("".join(t for t, r in zip(strings, right) if r).encode(), dtype=np.uint8)
        wrong = (self.a.joined(a) != raw) | (self.b.joined(b) != raw)
        if wrong.any():
            a, b, n_a, n_b = _keep(a, b, n_a, n_b, _sums(wrong, np.where(right, n_bytes, 0)) == 0)
        return a, b, n_a, n_b


_NONE = np.zeros(0, dtype=np.int64)


def _sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs of so many values."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    ends = np.cumsum(counts)
    return total[ends] - total[ends - counts]


def _keep(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, which: np.ndarray) -> tuple:
    return a[np.repeat(which, n_a)], b[np.repeat(which, n_b)], n_a * which, n_b * which


def diagonal_cuts(ends_a: np.ndarray, ends_b: np.ndarray, pieces: int) -> tuple[np.ndarray, np.ndarray]:
    """Where the merge path of two sorted lists crosses the diagonals that cut it into equal pieces: how many of
    either list lie before each cut.  An end of both lists goes to one piece whole."""
    n_a, n_b = len(ends_a), len(ends_b)
    diagonal = np.arange(pieces + 1) * (n_a + n_b) // pieces
    low, high = np.maximum(0, diagonal - n_b), np.minimum(diagonal, n_a)
    while (open_ := low < high).any():
        middle = (low + high) // 2
        here = np.minimum(middle, n_a - 1)
        first = open_ & (ends_a[here] <= ends_b[np.clip(diagonal - 1 - middle, 0, n_b - 1)])
        low, high = np.where(first, middle + 1, low), np.where(open_ & ~first, middle, high)
    i, j = low, diagonal - low
    if n_a and n_b:
        j = j + ((i > 0) & (j < n_b) & (ends_a[np.maximum(i - 1, 0)] == ends_b[np.minimum(j, n_b - 1)]))
    return i, j


def merge_ends(a: np.ndarray, ends_a: np.ndarray, b: np.ndarray, ends_b: np.ndarray, next_a: int, next_b: int):
    """Links and group ends of one piece: which B token each A token's end lies in (the one after the piece if
    none of it), which A token each B end lies in, whether it ends there, too."""
    in_b, in_a = np.searchsorted(ends_b, ends_a), np.searchsorted(ends_a, ends_b)
    both = np.concatenate([ends_a, [-1]])[in_a] == ends_b
    left = np.concatenate([a, np.append(a, next_a)[in_a[~both]]])
    right = np.concatenate([np.append(b, next_b)[in_b], b[~both]])
    return left, right, in_a[both], np.flatnonzero(both), both


def _codes(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return (left << 32) | right


def _ids(ids: np.ndarray) -> str:
    return ",".join(map(str, ids.tolist()))


def merge_piece(texts: GroupTexts, row: dict) -> dict:
    """A piece of a long document: counts, links, closed groups, and what stays open at both ends."""
    a, ends_a, b, ends_b = (np.frombuffer(row[c], dtype="<u4").astype(np.int64) for c in TOKENS)
    left, right, cut_a, cut_b, _ = merge_ends(a, ends_a, b, ends_b, row["next_a"], row["next_b"])
    codes, times = np.unique(_codes(left, right), return_counts=True)
    out = {c: row[c] for c in ("row", "doc_id", "piece", "pieces")}
    out |= {"n_a": len(a), "n_b": len(b), "n_groups": len(cut_a), "n_links": len(left), "cut": len(cut_a) > 0}
    out |= {"codes": codes.astype("<i8").tobytes(), "times": times.astype("<u4").tobytes()}
    first_a, first_b, last_a, last_b = (cut_a[0] + 1, cut_b[0] + 1, cut_a[-1] + 1, cut_b[-1] + 1) if len(cut_a) else (0, 0, 0, 0)
    inner = (cut_a[1:] - first_a, cut_b[1:] - first_b)
    body = texts.text(texts.numbers(a[first_a:last_a], b[first_b:last_b], *inner)) if len(inner[0]) else ""
    return out | {"head_a": _ids(a[:first_a]), "head_b": _ids(b[:first_b]), "body": body, "tail_a": _ids(a[last_a:]), "tail_b": _ids(b[last_b:])}


def stitch(parts: list[dict]) -> str:
    """Hash of a document's groups from its pieces: what one leaves open goes on in the next."""
    digest, begun, open_a, open_b = hashlib.sha256(), False, [], []
    for p in sorted(parts, key=lambda p: p["piece"]):
        if p["cut"]:
            group = ",".join(x for x in (*open_a, p["head_a"]) if x) + "|" + ",".join(x for x in (*open_b, p["head_b"]) if x)
            digest.update(((";" if begun else "") + group + (";" + p["body"] if p["body"] else "")).encode())
            begun, open_a, open_b = True, [p["tail_a"]], [p["tail_b"]]
        else:
            open_a.append(p["tail_a"])
            open_b.append(p["tail_b"])
    return digest.hexdigest()


def _short(pair: TokenizerPair, out: dict[str, list], rows: list, doc_ids: list, a, b, n_a, n_b) -> None:
    """Documents of one piece each, merged side by side: the end of a document is one of both sides."""
    ends_a, ends_b = np.cumsum(pair.a.size[a]), np.cumsum(pair.b.size[b])
    left, right, cut_a, cut_b, both = merge_ends(a, ends_a, b, ends_b, 0, 0)
    doc = np.arange(len(n_a))
    of_a, of_b = np.repeat(doc, n_a), np.repeat(doc, n_b)
    of_link = np.concatenate([of_a, of_b[~both]])
    order = np.lexsort((_codes(left, right), of_link))
    codes, of_link = _codes(left, right)[order], of_link[order]
    new = np.ones(len(codes), dtype=bool)
    new[1:] = (codes[1:] != codes[:-1]) | (of_link[1:] != of_link[:-1])
    at = np.flatnonzero(new)
    times, codes, of_pair = np.diff(at, append=len(codes)).astype("<u4"), codes[at].astype("<i8"), of_link[at]
    links, groups = np.bincount(of_link, minlength=len(doc)), np.bincount(of_a[cut_a], minlength=len(doc))
    pair_ends = np.cumsum(np.bincount(of_pair, minlength=len(doc)))
    numbers, ends = pair.texts.numbers(a, b, cut_a, cut_b), np.cumsum(n_a + n_b)
    for k in range(len(doc)):
        p, q = int(pair_ends[k - 1]) if k else 0, int(pair_ends[k])
        text = pair.texts.text(numbers[int(ends[k]) - int(n_a[k] + n_b[k]) : int(ends[k])])
        _add(
            out,
            row=rows[k], doc_id=doc_ids[k], piece=0, pieces=1, n_a=int(n_a[k]), n_b=int(n_b[k]), n_groups=int(groups[k]), n_links=int(links[k]),
            groups_sha256=hashlib.sha256(text.encode()).hexdigest() if n_a[k] else "", codes=codes[p:q].tobytes(), times=times[p:q].tobytes(),
        )


def _long(pair: TokenizerPair, out: dict[str, list], row: int, doc_id: int | None, a, b, steps: int) -> None:
    """The pieces of one document, to be merged elsewhere."""
    ends_a, ends_b = np.cumsum(pair.a.size[a]), np.cumsum(pair.b.size[b])
    pieces = -(-(len(a) + len(b)) // steps)
    i, j = diagonal_cuts(ends_a, ends_b, pieces)
    for k in range(pieces):
        x, y = slice(i[k], i[k + 1]), slice(j[k], j[k + 1])
        base = min([*ends_a[x][:1], *ends_b[y][:1]], default=0)
        own = {"ids_a": a[x], "ends_a": ends_a[x] - base, "ids_b": b[y], "ends_b": ends_b[y] - base}
        _add(
            out,
            row=row, doc_id=doc_id, piece=k, pieces=pieces, next_a=int(a[i[k + 1]]) if i[k + 1] < len(a) else 0, next_b=int(b[j[k + 1]]) if j[k + 1] < len(b) else 0,
            **{c: v.astype("<u4").tobytes() for c, v in own.items()},
        )


def _add(out: dict[str, list], **values: object) -> None:
    for c in PARTS.names:
        out[c].append(values.get(c))


def merged_parts(docs: DataFrame, a_path: str, b_path: str, steps: int = STEPS) -> DataFrame:
    """Both tokenisations of every text, merged: a row a document, or for longer ones a row a piece."""

    def tokens_of():
        pair = worker_memo(("pair", a_path, b_path), lambda: TokenizerPair(a_path, b_path))

        def work(batch: pa.RecordBatch) -> dict[str, list]:
            out: dict[str, list] = {c: [] for c in PARTS.names}
            texts = pc.fill_null(batch.column(2), "")
            size = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False), dtype=np.int64)
            cuts = np.flatnonzero(np.diff(size // BYTES_AT_ONCE)) + 1  # texts of about so many bytes at once
            for low, high in zip([0, *cuts], [*cuts, len(texts)]):
                some = texts.slice(low, high - low)
                rows, doc_ids = (batch.column(c).slice(low, high - low).to_pylist() for c in (0, 1))
                a, b, n_a, n_b = pair.encode(some)
                empty = pc.equal(pc.binary_length(some), 0).to_numpy(zero_copy_only=False)
                a, b, n_a, n_b = _keep(a, b, n_a, n_b, ~empty)
                long = n_a + n_b > steps
                for k in np.flatnonzero(long):
                    at_a, at_b = int(n_a[:k].sum()), int(n_b[:k].sum())
                    _long(pair, out, rows[k], doc_ids[k], a[at_a : at_a + n_a[k]], b[at_b : at_b + n_b[k]], steps)
                rest = np.flatnonzero(~long)
                a, b, n_a, n_b = _keep(a, b, n_a, n_b, ~long)
                _short(pair, out, [rows[k] for k in rest], [doc_ids[k] for k in rest], a, b, n_a[rest], n_b[rest])
                give_back()
            return out

        return work

    def pieces_of():
        pair = worker_memo(("pair", a_path, b_path), lambda: TokenizerPair(a_path, b_path))

        def work(batch: pa.RecordBatch) -> dict[str, list]:
            out: dict[str, list] = {c: [] for c in PARTS.names}
            for row in batch.to_pylist():
                _add(out, **merge_piece(pair.texts, row))
            return out

        return work

    texts = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    first = materialise(arrow_rows(texts, tokens_of, PARTS), "tokens", compression="zstd")
    spread = first.where("pieces > 1").repartition("row", "piece")
    second = materialise(arrow_rows(spread, pieces_of, PARTS), "merged-pieces", compression="zstd")
    keep = [c for c in PARTS.names if c not in (*TOKENS, "next_a", "next_b")]
    return first.where("pieces = 1").select(*keep).unionByName(second.select(*keep))


def pair_counts(parts: DataFrame) -> DataFrame:
    """``code, n, best``: every pair of ids (A's in the upper 32 bits), how many links of the corpus hold it,
    and whether no pair of its B id has more."""
    schema = T.StructType(_fields(T.LongType(), "code", "n"))

    def make():
        def work(batch: pa.RecordBatch) -> dict[str, np.ndarray]:
            codes, times = _flat(batch.column(0), "<i8"), _flat(batch.column(1), "<u4")
            found, at = np.unique(codes, return_inverse=True)
            return {"code": found, "n": np.bincount(at, weights=times, minlength=len(found)).astype(np.int64)}

        return work

    counts = arrow_rows(parts.select("codes", "times"), make, schema).groupBy("code").agg(F.sum("n").alias("n"))
    counts = materialise(counts.withColumn("b", F.col("code").bitwiseAND(0xFFFFFFFF)), "pair-counts")
    best = counts.groupBy("b").agg(F.max("n").alias("most"))
    return counts.join(best, "b").select("code", "n", (F.col("n") == F.col("most")).alias("best"))


def _flat(column: pa.Array, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(x for x in column.to_pylist() if x), dtype=kind).astype(np.int64)


def _scored(parts: DataFrame, pairs: DataFrame, head_pairs: int) -> DataFrame:
    """``n_best`` and ``count_sum`` of each part over the most frequent pairs, and its other pairs as lists."""
    head = pairs.orderBy(F.desc("n"), "code").limit(head_pairs).toArrow()  # at most head_pairs rows of 17 bytes
    codes = head["code"].to_numpy()
    order = np.argsort(codes)
    held = parts.sparkSession.sparkContext.broadcast((codes[order], head["n"].to_numpy()[order], head["best"].to_numpy()[order]))
    kept = [c for c in parts.columns if c not in ("codes", "times")]
    schema = T.StructType(
        [*(parts.schema[c] for c in kept), *_fields(T.LongType(), "n_best", "count_sum"), *_fields(T.ArrayType(T.LongType()), "rest_codes", "rest_times")]
    )

    def make():
        known, count, best = held.value
        last = max(0, len(known) - 1)

        def work(batch: pa.RecordBatch) -> dict[str, object]:
            out: dict[str, object] = {c: batch.column(i) for i, c in enumerate(kept)}
            n_best, total, rest_codes, rest_times = [], [], [], []
            for c, t in zip(*(batch.column(len(kept) + i).to_pylist() for i in range(2))):
                c, t = np.frombuffer(c or b"", dtype="<i8"), np.frombuffer(t or b"", dtype="<u4").astype(np.int64)
                at = np.minimum(np.searchsorted(known, c), last)
                there = known[at] == c if len(known) else np.zeros(len(c), dtype=bool)
                n, b = (count[at], best[at]) if len(known) else (c, there)
                n_best.append(int((t * b)[there].sum()))
                total.append(int((t * n)[there].sum()))
                rest_codes.append(c[~there])
                rest_times.append(t[~there])
            return out | {"n_best": n_best, "count_sum": total, "rest_codes": rest_codes, "rest_times": rest_times}

        return work

    return arrow_rows(parts.select(*kept, "codes", "times"), make, schema)


def align(docs: DataFrame, a_path: str, b_path: str, *, steps: int = STEPS, head_pairs: int = HEAD_PAIRS) -> DataFrame:
    """One row a document: tokens of both sides, groups, links, how good these are over the corpus."""
    parts = merged_parts(docs, a_path, b_path, steps)
    pairs = materialise(pair_counts(parts), "pairs")
    scored = materialise(_scored(parts, pairs, head_pairs), "scored", compression="zstd")
    rest = scored.where(F.size("rest_codes") > 0).select("row", F.explode(F.arrays_zip("rest_codes", "rest_times")).alias("r"))
    rest = rest.select("row", F.col("r.rest_codes").alias("code"), F.col("r.rest_times").alias("t")).join(pairs, "code")
    rest = rest.groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("t")).otherwise(0)).alias("_best"), F.sum(F.col("t") * F.col("n")).alias("_sum"))

    sums = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")
    stitched = T.StructType([*_fields(T.LongType(), "row", "doc_id", *sums), *_fields(T.StringType(), "groups_sha256")])

    def make():
        def work(batch: pa.RecordBatch) -> dict[str, list]:
            out = {c: batch.column(i) for i, c in enumerate(stitched.names[:-1])}
            return out | {"groups_sha256": [stitch(p) for p in batch.column(len(out)).to_pylist()]}

        return work

    # the pieces of one document, which was one row before
    grouped = scored.where("pieces > 1").groupBy("row").agg(F.first("doc_id").alias("doc_id"), *(F.sum(c).alias(c) for c in sums), F.collect_list(F.struct("piece", "cut", *OPEN)).alias("parts"))
    whole = scored.where("pieces = 1").select(*stitched.names).unionByName(arrow_rows(grouped, make, stitched))
    more = lambda c: F.coalesce(F.col(c), F.lit(0))
    return whole.join(rest, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", (F.col("n_best") + more("_best")).alias("n_best"), (F.col("count_sum") + more("_sum")).alias("count_sum"), "groups_sha256"
    )
