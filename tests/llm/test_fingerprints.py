"""Operator 13 against strings compared as strings."""

import collections
import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfwise.llm import fingerprints as P


def text_of(rng, n, alphabet="ab c\n"):
    return "".join(rng.choice(alphabet) for _ in range(n))


@pytest.mark.parametrize("alphabet", ["ab", "aé😀\x00 "])
def test_span_equality_and_extensions(alphabet, monkeypatch):
    monkeypatch.setattr(P, "BLOCK", 32)  # prefixes go on over blocks
    monkeypatch.setattr("shelfwise.llm.common._worker_memo", {})
    rng = random.Random(4)
    for _ in range(60):
        a = text_of(rng, rng.randint(0, 200), alphabet)
        b = a[rng.randint(0, len(a)) :] + text_of(rng, rng.randint(0, 50), alphabet)
        x, y = P.Prefixes(a), P.Prefixes(b)
        for _ in range(30):
            i, j = rng.randint(0, len(a)), rng.randint(0, len(b))
            n = rng.randint(0, 12)
            inside = i + n <= len(a) and j + n <= len(b)
            assert x.equal(i, y, j, n) == (inside and a[i : i + n] == b[j : j + n])
            want = 0
            while i + want < len(a) and j + want < len(b) and a[i + want] == b[j + want]:
                want += 1
            assert x.common_extension(i, y, j) == want
        spans = x.spans(5)
        assert [int(v) for v in spans] == [x.span(k, 5) for k in range(max(0, len(a) - 4))]


def brute_likeness(a, b):
    sets = [{t[k : k + min(P.SPAN, len(t))] for k in range(len(t) - min(P.SPAN, len(t)) + 1)} if t else set() for t in (a, b)]
    if a == b:
        return 1.0
    return 2 * len(sets[0] & sets[1]) / (len(sets[0]) + len(sets[1])) if any(sets) else 1.0


def some_texts():
    rng = random.Random(8)
    words = "stone river window under seven often little garden morning".split()
    texts = [" ".join(rng.choice(words) + str(rng.randint(0, 99)) for _ in range(rng.randint(1, 300))) for _ in range(60)]
    return [*texts, "", None, "a", "ab", "abc", "é" * 500, texts[3], texts[3], "x" * 11, "y" * 13, "😀 long " * 40_000, text_of(rng, 70_000)]


def following(rows):
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    return zip(order, [*order[1:], *order[:1]])


def test_query_against_strings(spark):
    rows = list(enumerate(some_texts()))
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"part": F.lit("x"), "n_chars": F.lit(1), "fingerprint": F.lit(2)})
    got = {r.doc_id: r for r in P.compare_with_next(docs.repartition(7)).collect()}
    assert len(got) == len(rows)
    by_text = collections.defaultdict(set)
    for (i, text), (_, after) in following(rows):
        text, after, r = text or "", after or "", got[i]
        k = len(text) // 3
        new = text[: len(text) - k] + after[:k]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(new.encode()).hexdigest())
        assert r.edited_fingerprint == P.Fingerprinted(new).fingerprint
        assert new[: r.common_prefix] == text[: r.common_prefix] and (r.common_prefix in (len(text), len(new)) or new[r.common_prefix] != text[r.common_prefix])
        for near, other in ((r.near_edited, new), (r.near_next, after)):
            assert 0 <= near <= 1 and abs(near - brute_likeness(text, other)) < (0.25 if len(text) > 60 else 1e-9)
        by_text[text].add(r.fingerprint)
    assert all(len(f) == 1 for f in by_text.values()) and len(set.union(*by_text.values())) == len(by_text)


def test_equal_ids_null_ids_lone_and_no_documents(spark):
    rows = [(5, "stone river window")] * 3 + [(None, "garden"), (None, None)]
    got = P.compare_with_next(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert collections.Counter(r.doc_id for r in got) == {5: 3, None: 2}
    assert sorted(r.near_next for r in got if r.doc_id == 5)[1:] == [1.0, 1.0]
    (lone,) = P.compare_with_next(spark.createDataFrame([(1, "abcdef")], "doc_id long, text string")).collect()
    assert lone.edited_sha256 == hashlib.sha256(b"abcdab").hexdigest() and lone.near_next == 1.0
    assert P.compare_with_next(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_span_equality_over_rows(spark):
    rows = [("stone river", 6, "a river", 2, 5), ("stone", 0, "store", 0, 4), ("stone", 3, "stone", 3, 9), (None, 0, "a", 0, 1), ("ab", -1, "ab", 0, 1)]
    done = P.span_equality(spark.createDataFrame(rows, "text_a string, start_a long, text_b string, start_b long, length long")).collect()
    assert [(r.equal, r.extension) for r in done] == [(True, 5), (False, 3), (False, 2), (None, None), (False, 0)]
    docs = spark.createDataFrame([(1, "stone"), (2, None)], "doc_id long, text string")
    assert {r.doc_id: r.fingerprint for r in P.fingerprints(docs).collect()} == {1: P.Fingerprinted("stone").fingerprint, 2: P.Fingerprinted("").fingerprint}


def test_sketch_of_repeated_spans_is_whole():
    values = np.repeat(np.arange(70, dtype=np.uint64) * np.uint64(1 << 25), 10_000)
    assert P._least(values).tolist() == [k << 25 for k in range(P.SKETCH)]
