"""Sequence packing: shortest-pack-first over the length histogram.

Documents become token ids plus a closing id; those longer than a sequence are cut into full
pieces and a rest.  Only the histogram of piece lengths, at most ``max_tokens`` numbers, goes
to the driver.  There lengths are placed longest first, each time into the packs with most room,
as counts of packing patterns and never as single documents.  Each pattern slot then owns a range
of ranks among the pieces of its length, and a join on (length, rank) gives every piece its
sequence and offset.

Defined results: a null text is empty, so its document is the closing id alone; a null doc_id
is kept as null; repeated rows are packed each for itself; an empty table gives no row; other
columns of the input are ignored.
"""

from __future__ import annotations

import heapq
import os
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import arrow_rows, give_back, materialise, ranked, worker_memo

MAX_TOKENS = 4096
#: Words of these characters alone are cut here as the tokenizer cuts them; all others go through the whole
#: tokenizer. Each of these letters is one code point in any normal form and has one in lower case.
_LETTERS = "a-zA-ZÀ-ÖØ-öø-į"
_PLAIN = f"^[!-~{_LETTERS}]+$"
# fixed value: the tokenizer's own pattern, over these characters
_PIECE = f"('(?:s|t|re|ve|m|ll|d)|[{_LETTERS}]+|[0-9]|[^{_LETTERS}0-9]+)"
#: Byte-level alphabets write bytes that do not print as characters from 256 on; the space parts pieces here.
BYTE_CHARS = {b: chr(256 + k) for k, b in enumerate(b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or b >= 174)) if b != 32}
#: A special string begins so; it is matched before anything is lower-cased.
SPECIAL = "<|"
#: Bytes of texts, about, whose distinct words are encoded at once; words of a row given to the tokenizer, and rows
#: of a call, whose tokens it holds as objects.
BYTES_AT_ONCE, WORDS_A_ROW, ROWS_A_CALL = 4_000_000, 200, 50

PIECES = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
        T.StructField("doc_tokens", T.LongType()),
    ]
)


class WordEncoder:
    """Ids of texts by a byte-level tokenizer in lower case that drops white space.

    Such a tokenizer never joins across white space, so the ids of a text are those of its words in
    a row.  Arrow numbers the words of many texts, each distinct one is encoded once, and NumPy puts the
    ids of the texts together.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks run side by side already; its threads would each keep memory
        self.tokenizer = Tokenizer.from_file(path)
        # the same model for pieces that are cut and written in byte characters already
        self.bare = Tokenizer.from_file(path)
        self.bare.normalizer = normalizers.Sequence([])
        self.bare.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        vocabulary = self.tokenizer.get_vocab()
        self.closes = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.closes[[i for t, i in vocabulary.items() if t.endswith(self.tokenizer.model.end_of_word_suffix)]] = True

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts (strings without nulls) in a row, and where each text ends among them."""
        lists = pc.ascii_split_whitespace(texts)
        counts, words = np.diff(np.asarray(lists.offsets)), lists.flatten()
        del lists
        # words with a special string keep their case
        words = pc.if_else(pc.match_substring(words, SPECIAL), words, pc.ascii_lower(words)).dictionary_encode()
        flat, begin, size = self._encode_words(words.dictionary)
        words = np.asarray(words.indices)
        size, begin = size[words], begin[words]
        ends = np.cumsum(size)
        at = np.repeat(begin - (ends - size), size)
        at += np.arange(len(at))
        return flat[at], np.concatenate([[0], ends])[np.cumsum(counts)]

    def _encode_words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of distinct words, and where those of each begin and how many they are."""
        plain = pc.and_not(pc.match_substring_regex(words, _PLAIN), pc.match_substring(words, SPECIAL))
        ascii_ = pc.string_is_ascii(words)
        flat, begin, size, total = [np.zeros(0, dtype="<u4")], np.zeros(len(words), np.int64), np.zeros(len(words), np.int64), 0
        for which, encode in ((pc.and_(plain, ascii_), self._plain), (pc.and_not(plain, ascii_), self._plain), (pc.invert(plain), self._other)):
            which = np.flatnonzero(which.to_numpy(zero_copy_only=False))
            ids, ends = encode(words.take(pa.array(which)))
            size[which] = np.diff(ends, prepend=0)
            begin[which] = total + ends - size[which]
            flat.append(ids)
            total += len(ids)
        return np.concatenate(flat), begin, size

    def _plain(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Every piece ends with the one id of it that closes a word."""
        words = pc.utf8_lower(words)
        pieces = pc.count_substring_regex(words, _PIECE).to_numpy(zero_copy_only=False)
        words = pc.replace_substring_regex(words, _PIECE, "\\1 ").cast(pa.large_binary())
        text, offsets = words.buffers()[2], np.frombuffer(words.buffers()[1], dtype=np.int64)[: len(words) + 1]
        cuts = [*offsets[:-1:WORDS_A_ROW].tolist(), int(offsets[-1])] if len(words) else [0]
        rows = [text[a:b].to_pybytes().decode("latin-1") for a, b in zip(cuts, cuts[1:])]
        rows = [r if r.isascii() else r.translate(BYTE_CHARS) for r in rows]
        ids = [np.zeros(0, dtype="<u4")]
        for i in range(0, len(rows), ROWS_A_CALL):
            ids += [np.array(e.ids, dtype="<u4") for e in self.bare.encode_batch_fast(rows[i : i + ROWS_A_CALL], add_special_tokens=False)]
        ids = np.concatenate(ids)
        ends = np.concatenate([[0], np.flatnonzero(self.closes[ids]) + 1])
        if len(ends) != pieces.sum() + 1 or ends[-1] != len(ids):
            raise ValueError("the tokenizer does not close every piece with one id")
        return ids, ends[np.cumsum(pieces)]

    def _other(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        found = [np.array(e.ids, dtype="<u4") for e in self.tokenizer.encode_batch_fast(words.to_pylist(), add_special_tokens=False)]
        return np.concatenate([np.zeros(0, dtype="<u4"), *found]), np.cumsum([len(x) for x in found], dtype=np.int64)


def tokenize_pieces(
    docs: DataFrame, tokenizer_path: str, *, max_tokens: int = MAX_TOKENS, closing_id: int = 2, with_ids: bool = False
) -> DataFrame:
    """One row per piece of at most ``max_tokens`` ids; ``with_ids`` adds the ids themselves."""
    schema = T.StructType([*PIECES.fields, *([T.StructField("ids", T.ArrayType(T.IntegerType()))] if with_ids else [])])
    close = np.array([closing_id], dtype="<u4").tobytes()

    def make():
        encoder = worker_memo(("tokenizer", tokenizer_path), lambda: WordEncoder(tokenizer_path))

        def work(batch: pa.RecordBatch) -> dict[str, list]:
            out: dict[str, list] = {f: [] for f in schema.names}
            texts = pc.fill_null(batch.column(1), "")
            size = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False), dtype=np.int64)
            cuts = np.flatnonzero(np.diff(size // BYTES_AT_ONCE)) + 1  # texts of about so many bytes at once
            for low, high in zip([0, *cuts], [*cuts, len(texts)]):
                ids, ends = encoder.encode(texts.slice(low, high - low))
                raw, begin = memoryview(ids.tobytes()), 0
                for doc_id, end in zip(batch.column(0).slice(low, high - low).to_pylist(), ends.tolist()):
                    mine, n = b"".join((raw[4 * begin : 4 * end], close)), end - begin + 1
                    begin = end
                    for start in range(0, n, max_tokens):
                        piece = mine[4 * start : 4 * (start + max_tokens)]
                        out["doc_id"].append(doc_id)
                        out["start"].append(start)
                        out["length"].append(len(piece) // 4)
                        out["ids_crc32"].append(zlib.crc32(piece))
                        out["doc_tokens"].append(n)
                        if with_ids:
                            out["ids"].append(np.frombuffer(piece, dtype="<i4"))
                del ids, raw
                give_back()
            return out

        return work

    return arrow_rows(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").alias("text")), make, schema)


def packing_patterns(histogram: dict[int, int], max_tokens: int = MAX_TOKENS) -> list[tuple[int, list[tuple[int, int]]]]:
    """Patterns ``(packs, [(length, copies), ...])`` that hold every length of the histogram.

    Lengths go longest first into the packs with most room.  If no pack has room, new ones are
    opened and filled with copies of this length, as packing one piece after the other would do.
    """
    room: dict[int, list[tuple[int, tuple]]] = {max_tokens: []}
    heap: list[int] = []

    def put(free: int, packs: int, slots: tuple) -> None:
        if free not in room or not room[free]:
            room.setdefault(free, [])
            heapq.heappush(heap, -free)
        room[free].append((packs, slots))

    for length in sorted((k for k, n in histogram.items() if n), reverse=True):
        left = histogram[length]
        while left:
            while heap and not room[-heap[0]]:
                heapq.heappop(heap)
            free = -heap[0] if heap else 0
            if free >= length:
                packs, slots = room[free].pop()
                if not room[free]:
                    heapq.heappop(heap)
                used = min(packs, left)
                if packs > used:
                    put(free, packs - used, slots)
                if slots[-1][0] == length:
                    slots, copies = slots[:-1], slots[-1][1] + 1
                else:
                    copies = 1
                put(free - length, used, (*slots, (length, copies)))
                left -= used
            else:
                each = max_tokens // length
                if left >= each:
                    packs, copies = left // each, each
                else:
                    packs, copies = 1, left
                put(max_tokens - copies * length, packs, ((length, copies),))
                left -= packs * copies
    return [(packs, list(slots)) for free in sorted(room) for packs, slots in room[free]]


def pack(pieces: DataFrame, *, max_tokens: int = MAX_TOKENS, salts: int | None = None) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces; ``pieces`` is read more than once."""
    spark = pieces.sparkSession
    histogram = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    salts = salts or max(8, min(4096, sum(histogram.values()) // 20_000))
    first, taken, slots_out = 0, dict.fromkeys(histogram, 0), []
    for packs, slots in packing_patterns(histogram, max_tokens):
        offset = 0
        for length, copies in slots:
            low = taken[length]
            taken[length] = low + packs * copies
            slots_out.append((int(length), low, taken[length], first, offset, int(copies)))
            offset += length * copies
        first += packs
    # at most a few slots for each of max_tokens lengths, whatever the number of documents
    slots = spark.createDataFrame(slots_out, "length long, low long, high long, first long, base long, copies long")
    order = [F.col("doc_id"), F.col("start"), F.col("ids_crc32")]
    inside = F.col("rank") - F.col("low")
    return (
        ranked(pieces, "length", order, salts)
        .join(F.broadcast(slots), "length")
        .where((F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high")))
        .withColumn("sequence_id", F.col("first") + F.floor(inside / F.col("copies")))
        .withColumn("offset", F.col("base") + F.pmod(inside, F.col("copies")) * F.col("length"))
        .drop("rank", "low", "high", "first", "base", "copies")
    )


def pack_documents(docs: DataFrame, tokenizer_path: str, *, max_tokens: int = MAX_TOKENS, closing_id: int = 2) -> DataFrame:
    """Tokenise once, keep the small piece table in the shared folder, and place every piece."""
    pieces = materialise(tokenize_pieces(docs, tokenizer_path, max_tokens=max_tokens, closing_id=closing_id), "pieces")
    return pack(pieces, max_tokens=max_tokens).select(*PIECES.names, "sequence_id", "offset")


def packed_sequences(
    docs: DataFrame, tokenizer_path: str, *, max_tokens: int = MAX_TOKENS, closing_id: int = 2, pad_id: int = 0
) -> DataFrame:
    """The training sequences themselves: ``sequence_id``, ``ids`` and ``doc_ids`` of each.

    A sequence is filled up to ``max_tokens`` with ``pad_id`` unless its length is a power of two.
    """
    pieces = materialise(tokenize_pieces(docs, tokenizer_path, max_tokens=max_tokens, closing_id=closing_id, with_ids=True), "piece-ids")
    packed = pack(pieces, max_tokens=max_tokens)
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids", "doc_id")))  # at most max_tokens parts
    ids = F.flatten(F.transform(F.col("parts"), lambda p: p["ids"]))
    used = F.size("ids")
    pad = F.when(F.bit_count(used) == 1, F.lit(0)).otherwise(F.lit(max_tokens) - used)
    return (
        packed.groupBy("sequence_id")
        .agg(parts.alias("parts"))
        .select("sequence_id", ids.alias("ids"), F.transform("parts", lambda p: p["doc_id"]).alias("doc_ids"))
        .withColumn("n_tokens", used)
        .withColumn("ids", F.concat("ids", F.array_repeat(F.lit(pad_id), pad)))
    )
