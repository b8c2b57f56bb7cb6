"""Operator 11 against the plain definition: tokens by both libraries, every pair of byte ranges."""

import collections
import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfwise.llm import alignment
from shelfwise.llm.queries import pair_paths


@pytest.fixture(scope="module")
def tokenizers():
    import sentencepiece
    from tokenizers import Tokenizer

    a_path, b_path = pair_paths()
    a = Tokenizer.from_file(a_path)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=b_path)


def bytes_a(a, i, alphabet={}):
    if not alphabet:
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        alphabet |= {chr(b): b for b in printable}
        alphabet |= {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in printable)}
    return bytes(alphabet[c] for c in a.id_to_token(i))


def brute(texts, a, b):
    docs, links_of = [], collections.Counter()
    for t in texts:
        empty = (0, 0, 0, [], "")
        if not t:
            docs.append(empty)
            continue
        ia, ib = a.encode(" " + t, add_special_tokens=False).ids, b.encode(t)
        ba = [bytes_a(a, i) for i in ia]
        bb = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ib]
        if not b"".join(ba) == b"".join(bb) == (" " + t).encode():
            docs.append(empty)
            continue
        ea, eb = np.cumsum([len(x) for x in ba]).tolist(), np.cumsum([len(x) for x in bb]).tolist()
        both, groups, links = sorted(set(ea) & set(eb)), [], []
        for low, high in zip([0, *both], both):
            ga = [k for k in range(len(ia)) if low < ea[k] <= high]
            gb = [k for k in range(len(ib)) if low < eb[k] <= high]
            groups.append(",".join(str(ia[k]) for k in ga) + "|" + ",".join(str(ib[k]) for k in gb))
            links += [(ia[x], ib[y]) for x in ga for y in gb if max(ea[x] - len(ba[x]), eb[y] - len(bb[y])) < min(ea[x], eb[y])]
        links_of.update(links)
        docs.append((len(ia), len(ib), len(both), links, ";".join(groups)))
    best = {}
    for (x, y), n in links_of.items():
        best[y] = max(best.get(y, 0), n)
    out = []
    for n_a, n_b, n_groups, links, text in docs:
        n_best = sum(links_of[p] == best[p[1]] for p in links)
        out.append((n_a, n_b, n_groups, len(links), n_best, sum(links_of[p] for p in links), hashlib.sha256(text.encode()).hexdigest() if text else ""))
    return out


def some_texts():
    rng = random.Random(11)
    words = "the of and stone rivière Ünder überall señor don't 1234 3.5 naïve 汉字 нет <|endoftext|> <s> </s> <unk> \t \n\n  ﬁ x▁y".split(" ")
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(1, 40))) for _ in range(60)]
    return texts + [None, "", " ", "\n", "a", "▁", "\x00", "x" * 3000, " " * 2500, "é" * 700, texts[0], texts[0], "tail    ", "😀😀 é"]


def rows_of(df):
    return [(r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in df.collect()]


@pytest.mark.parametrize("steps, head", [(alignment.STEPS, alignment.HEAD_PAIRS), (7, 3), (2, 0)])
def test_alignment_against_brute_force(spark, tokenizers, steps, head):
    texts = some_texts()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumns({"row": F.lit(1), "piece": F.lit("x"), "n_a": F.lit(5)})
    got = sorted(rows_of(alignment.align(docs, *pair_paths(), steps=steps, head_pairs=head)))
    assert got == [(i, *w) for i, w in enumerate(brute(texts, *tokenizers))]


def test_repeated_rows_null_ids_and_empty_tables(spark, tokenizers):
    rows = [(None, "stone river"), (None, "stone river"), (3, "stone"), (3, None)]
    got = rows_of(alignment.align(spark.createDataFrame(rows, "doc_id long, text string"), *pair_paths()))
    want = [(i, *w) for (i, _), w in zip(rows, brute([t for _, t in rows], *tokenizers))]
    assert collections.Counter(got) == collections.Counter(want)
    assert not rows_of(alignment.align(spark.createDataFrame([], "doc_id long, text string"), *pair_paths()))


def test_diagonal_cuts_are_equal_and_keep_common_ends_whole():
    rng = np.random.default_rng(3)
    for _ in range(200):
        a, b = (np.unique(rng.integers(1, 60, rng.integers(1, 30))) for _ in range(2))
        pieces = int(rng.integers(1, 9))
        i, j = alignment.diagonal_cuts(a, b, pieces)
        assert (i[0], j[0], i[-1], j[-1]) == (0, 0, len(a), len(b))
        steps = np.diff(i) + np.diff(j)
        assert steps.sum() == len(a) + len(b) and steps.max() - (len(a) + len(b)) / pieces <= 2
        for k in range(1, pieces):
            before = max([*a[: i[k]][-1:], *b[: j[k]][-1:]], default=0)
            assert before < min([*a[i[k] :][:1], *b[j[k] :][:1]], default=1e9)
