"""Language of words and texts by a linear-chain conditional random field.

Every word has prefix, suffix, character n-gram and lexicon features; a label is a language, and
learned transitions say how likely a text changes it from one word to the next.  Forward-backward
gives each word its posterior, so code-switched text gets a label for each run of words; a text's
language is the one with most posterior mass over all its words, and that share is its score.

Training: at most ``SAMPLE_PER_LANGUAGE`` labelled texts of every language, chosen by hash and of at most
``SAMPLE_CHARS`` characters together (and one text more), go to the driver, spliced into sequences that
change language; a few hundred kilobytes of weights a language come back.  Languages, words and characters
of words have no cap.  Prediction runs over all words of all texts.

Defined results: a null text or one without a letter is ``und`` with score 0, and so is every text if
no label was learned (none given, or an empty table, which gives no rows); a very long text, or a word
without end, is read whole by one task; a null doc_id counts as empty text in the held-out rule; ties go
to the first language by name; repeated rows are judged each for itself; other columns are ignored
(``with_row`` hands them on in a struct, where no name can clash).
"""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import arrow_rows, materialise, worker_memo

SAMPLE_PER_LANGUAGE, SAMPLE_CHARS = 150, 2_000_000
#: Labels whose counts are broadcast; more of them are joined by a shuffle.
LABELS_BROADCAST = 10_000
FEATURES = 1 << 16
#: Training sequences a language, words of each, mean words before a change of language, and gradient steps.
SEQUENCES, SEQUENCE_WORDS, RUN_WORDS, STEPS = 400, 60, 12, 60
#: Numbers (words times languages) that a worker remembers, and that forward-backward holds at once.
MEMO_CELLS, GROUP_CELLS = 1_000_000, 1_200_000
_WORD = re.compile(r"[^\W\d_]+")


def held_out(doc_id: Column | None = None) -> Column:
    """Documents that are never learned from."""
    key = F.coalesce((F.col("doc_id") if doc_id is None else doc_id).cast("string"), F.lit(""))
    return F.pmod(F.crc32(key.cast("binary")), F.lit(4)) == 2


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def _hashed(kind: int, *chars: np.ndarray) -> np.ndarray:
    h = np.full(len(chars[0]), kind * 0x9E3779B97F4A7C15 % (1 << 64), dtype=np.uint64)
    for x in chars:
        h = (h ^ x) * np.uint64(0x100000001B3)
        h ^= h >> np.uint64(29)
    return ((h >> np.uint64(7)) % np.uint64(FEATURES)).astype(np.int64)


def word_features(words: list[str], lexicon: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed affixes, n-grams and lexicon entries: feature numbers word by word, and how many each has.

    A word of n characters has n - 1 bigrams, n - 2 trigrams, up to three prefixes and as many suffixes.
    """
    c = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    n = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    entry = np.fromiter((lexicon.get(w, -1) for w in words), dtype=np.int64, count=len(words))
    two, three, affixes = np.maximum(n - 1, 0), np.maximum(n - 2, 0), np.minimum(n, 3)
    sizes = two + three + 2 * affixes + (entry >= 0)
    slot = np.cumsum(sizes) - sizes  # where the features of each word begin
    first = np.cumsum(n) - n  # where its characters begin
    out = np.empty(int(sizes.sum()), dtype=np.int64)

    def put(kind: int, word: np.ndarray, at: np.ndarray, *chars: np.ndarray) -> None:
        out[slot[word] + at] = _hashed(kind, *chars)

    owner = np.repeat(np.arange(len(n)), n)
    place = np.arange(len(c)) - first[owner]
    for kind, width, before in ((1, 2, 0 * n), (2, 3, two)):
        at = np.flatnonzero(place + width <= n[owner])
        put(kind, owner[at], before[owner[at]] + place[at], *(c[at + k] for k in range(width)))
    for k in (1, 2, 3):
        word = np.flatnonzero(n >= k)
        base = (two + three)[word] + k - 1
        put(2 + k, word, base, *(c[first[word] + i] for i in range(k)))
        put(5 + k, word, base + affixes[word], *(c[first[word] + n[word] - 1 - i] for i in range(k)))
    word = np.flatnonzero(entry >= 0)
    put(9, word, sizes[word] - 1, entry[word].astype(np.uint64))
    return out, sizes


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray  # FEATURES x languages
    moves: np.ndarray  # languages x languages, log
    begin: np.ndarray  # log
    lexicon: dict[str, int]


def _emissions(words: list[str], lexicon: dict[str, int], weights: np.ndarray) -> np.ndarray:
    """Summed weights of the features of each word, language by language."""
    flat, sizes = word_features(words, lexicon)
    begin = np.cumsum(sizes) - sizes
    return np.stack([np.add.reduceat(w[flat], begin) for w in np.ascontiguousarray(weights.T)], axis=1)


def forward_backward(emit: np.ndarray, lengths: np.ndarray, moves: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Posteriors of sequences that lie one after another in ``emit`` (log), their packed order, and
    the summed posteriors of neighbouring labels.  All sequences move on together, word by word."""
    order = np.argsort(-lengths, kind="stable")
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])[order]
    sizes = lengths[order]
    steps = int(sizes[0]) if len(sizes) else 0
    active = np.searchsorted(-sizes, -np.arange(steps), side="left")  # sequences longer than t
    at = np.concatenate([[0], np.cumsum(active)])
    index = np.empty(at[-1], dtype=np.int64)
    for t in range(steps):
        index[at[t] : at[t + 1]] = starts[: active[t]] + t
    e = np.exp(emit[index] - emit[index].max(axis=1, keepdims=True))
    a, trans = np.empty_like(e), np.exp(moves)
    for t in range(steps):
        s = slice(at[t], at[t + 1])
        now = (a[at[t - 1] : at[t - 1] + active[t]] @ trans if t else np.exp(begin)) * e[s]
        now /= now.sum(axis=1, keepdims=True)
        a[s] = now
    b = np.ones_like(e)
    both = np.zeros_like(trans)
    for t in range(steps - 2, -1, -1):
        n = active[t + 1]
        ahead = e[at[t + 1] : at[t + 2]] * b[at[t + 1] : at[t + 2]]
        back = ahead @ trans.T
        scale = back.sum(axis=1, keepdims=True)
        b[at[t] : at[t] + n] = back / scale
        here = a[at[t] : at[t] + n]
        both += (here / np.maximum((here * back).sum(axis=1, keepdims=True), 1e-300)).T @ ahead * trans
    post = a * b
    post /= post.sum(axis=1, keepdims=True)
    return post, index, both


def _spliced(texts: list[tuple[list[int], int]], sequences: int, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers and labels of ``sequences`` sequences, half of them changing language."""
    words, labels = [], []
    for k in range(sequences):
        left = SEQUENCE_WORDS
        while left:
            ids, label = texts[int(rng.integers(len(texts)))]
            n = min(left, len(ids), left if k % 2 else 1 + int(rng.geometric(1 / RUN_WORDS)))
            s = int(rng.integers(len(ids) - n + 1))
            words += ids[s : s + n]
            labels += [label] * n
            left -= n
    return np.array(words), np.array(labels)


def train(rows: list[tuple[str, str]], seed: int = 7) -> Model:
    """Fit a model to bounded ``(text, language)`` rows, by gradient ascent on the likelihood."""
    languages = sorted({lang for _, lang in rows})
    number: dict[str, int] = {}
    texts, counts = [], np.zeros((0, len(languages)))
    pairs = []
    for text, lang in rows:
        ids = [number.setdefault(w, len(number)) for w in words_of(text)]
        if ids:
            texts.append((ids, languages.index(lang)))
            pairs.append(np.array(ids) * len(languages) + texts[-1][1])
    k = len(languages)
    if not texts:
        return Model([], np.zeros((FEATURES, 0)), np.zeros((0, 0)), np.zeros(0), {})
    counts = np.bincount(np.concatenate(pairs), minlength=len(number) * k).reshape(-1, k)
    # lexicon: frequent words that nearly always stand in one language
    sure = (counts.sum(axis=1) >= 20) & (counts.max(axis=1) >= 0.9 * counts.sum(axis=1))
    lexicon = {w: int(counts[i].argmax()) for w, i in number.items() if sure[i]}
    rng = np.random.default_rng(seed)
    texts.sort(key=lambda t: (t[1], len(t[0])))
    sequences = SEQUENCES * max(k, 4)
    words, labels = _spliced(texts, sequences, rng)
    used, inverse = np.unique(words, return_inverse=True)
    names = list(number)
    flat, sizes = word_features([names[i] for i in used], lexicon)
    owner = np.repeat(np.arange(len(used)), sizes)
    cuts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    lengths = np.full(sequences, SEQUENCE_WORDS)
    truth = np.bincount(inverse * k + labels, minlength=len(used) * k).reshape(-1, k).astype(float)
    inner = np.ones(len(labels), dtype=bool)
    inner[SEQUENCE_WORDS - 1 :: SEQUENCE_WORDS] = False
    moved = np.bincount(labels[inner] * k + labels[np.flatnonzero(inner) + 1], minlength=k * k).reshape(k, k).astype(float)
    weights, moves, begin = np.zeros((FEATURES, k)), np.zeros((k, k)), np.zeros(k)
    speed = [np.zeros_like(weights), np.zeros_like(moves)]
    for _ in range(STEPS):
        emit = np.stack([np.add.reduceat(w[flat], cuts) for w in np.ascontiguousarray(weights.T)], axis=1)[inverse]
        post, index, both = forward_backward(emit, lengths, moves, begin)
        expected = np.stack([np.bincount(inverse[index], post[:, j], len(used)) for j in range(k)], axis=1)
        gap = (truth - expected)[owner]
        grad_w = np.stack([np.bincount(flat, gap[:, j], FEATURES) for j in range(k)], axis=1) - 1e-1 * weights
        grad_m = moved - both
        for x, g, v in zip((weights, moves), (grad_w, grad_m), speed):
            v += g * g  # Adagrad
            x += 0.3 * g / np.sqrt(v + 1e-8)
    return Model(languages, weights.astype(np.float32), moves, begin, lexicon)


def training_sample(docs: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE, chars: int = SAMPLE_CHARS) -> list[tuple[str, str]]:
    """A bounded sample of labelled rows that are not held out, alike at every table size.

    Equal texts of a language are one, so copies do not crowd others out.
    """
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out()).select(F.col("lang").cast("string"), F.col("text").cast("string"))
    counts = materialise(known.groupBy("lang").agg(F.count("*").alias("_rows")), "labels")
    if counts.count() <= LABELS_BROADCAST:  # a row for each label
        counts = F.broadcast(counts)
    unit = F.xxhash64("text")  # uniform over all 64 bits
    share = F.lit(1.3 * per_language * 2.0**64) / F.col("_rows") - F.lit(2.0**63)
    some = known.join(counts, "lang").where(unit < share).groupBy("lang", unit.alias("_unit")).agg(F.min("text").alias("text"))
    order = W.partitionBy("lang").orderBy("_unit")
    some = some.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= per_language)
    before = F.sum(F.length("text")).over(order.rowsBetween(W.unboundedPreceding, -1))
    rows = some.withColumn("_before", F.coalesce(before, F.lit(0))).where(F.col("_before") < chars).select("text", "lang", "_rank")
    return [(r["text"], r["lang"]) for r in sorted(rows.collect(), key=lambda r: (r["lang"], r["_rank"]))]


def predict(docs: DataFrame, model: Model, *, with_runs: bool = False, with_row: bool = False) -> DataFrame:
    """``doc_id, lang_pred, score`` and, if asked for, ``runs``, (first word, words, language), and the input ``row``."""
    fields = [T.StructField("doc_id", T.LongType()), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    run = T.StructType([T.StructField("start", T.LongType()), T.StructField("words", T.LongType()), T.StructField("lang", T.StringType())])
    row = F.struct(*(f"`{c}`" for c in docs.columns)).alias("row")
    texts = docs.select(F.col("doc_id").cast("long"), row if with_row else F.col("text").cast("string"))
    schema = T.StructType([*fields, *([T.StructField("runs", T.ArrayType(run))] if with_runs else []), *(texts.schema[1:] if with_row else [])])
    shared = docs.sparkSession.sparkContext.broadcast((uuid.uuid4().hex, model))  # FEATURES numbers a language

    def make():
        name, m = shared.value
        k = len(m.languages)
        memo = worker_memo(("emissions", name), lambda: [{}, np.zeros((0, k), dtype=np.float32)])
        number: dict[str, int] = memo[0]

        def learn(words: set[str]) -> None:
            table = memo[1]
            new = []
            for w in sorted(words):
                if any(map(str.isalpha, w)):
                    number[w] = len(table) + len(new)
                    new.append(w)
                else:  # superscripts and the like count as word characters but are no letters
                    number[w] = -1
            if new:
                memo[1] = np.concatenate([table, _emissions(new, m.lexicon, m.weights)])

        def work(batch: pa.RecordBatch) -> dict[str, object]:
            n = batch.num_rows
            best, score, runs = ["und"] * n, np.zeros(n), [[] for _ in range(n)]
            ids: list[np.ndarray] = []
            column = batch.column(1)
            for text in column.field("text") if with_row else column:
                w = words_of(text.as_py() or "") if k else []
                try:
                    got = np.fromiter(map(number.__getitem__, w), dtype=np.int32, count=len(w))
                except KeyError:
                    learn({x for x in w if x not in number})
                    got = np.fromiter(map(number.__getitem__, w), dtype=np.int32, count=len(w))
                ids.append(got[got >= 0])
            sizes = np.array([len(x) for x in ids], dtype=np.int64)
            order = [i for i in np.argsort(-sizes, kind="stable") if sizes[i]]
            begin = 0
            while begin < len(order):
                end, total = begin, 0
                while end < len(order) and (end == begin or (total + sizes[order[end]]) * k <= GROUP_CELLS):
                    total += sizes[order[end]]
                    end += 1
                part = order[begin:end]
                lengths = sizes[part]
                post, index, _ = forward_backward(memo[1][np.concatenate([ids[i] for i in part])], lengths, m.moves, m.begin)
                owner = np.repeat(np.arange(len(part)), lengths)[index]
                mass = np.stack([np.bincount(owner, post[:, j], len(part)) for j in range(k)], axis=1) / lengths[:, None]
                for i, top, x in zip(part, mass.argmax(axis=1), mass):
                    best[i], score[i] = m.languages[top], min(1.0, float(x[top]))
                if with_runs:
                    label = np.empty(len(index), dtype=np.int64)
                    label[index] = post.argmax(axis=1)
                    for i, s, e in zip(part, np.cumsum(lengths) - lengths, np.cumsum(lengths)):
                        cut = np.concatenate([[0], np.flatnonzero(np.diff(label[s:e])) + 1, [e - s]])
                        runs[i] = [{"start": int(a), "words": int(b - a), "lang": m.languages[label[s + a]]} for a, b in zip(cut, cut[1:])]
                begin = end
            if len(number) * k > MEMO_CELLS:
                number.clear()
                memo[1] = memo[1][:0].copy()
            return {"doc_id": batch.column(0), "lang_pred": best, "score": score, "runs": runs} | ({"row": column} if with_row else {})

        return work

    return arrow_rows(texts, make, schema)


def identify(docs: DataFrame, **options) -> DataFrame:
    """Train on the labelled, not held-out documents and predict every document."""
    return predict(docs, train(training_sample(docs)), **options).withColumn("held_out", held_out())
