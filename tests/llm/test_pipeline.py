"""The pipeline on the smallest tables, and registration."""

import random
import zlib

import pytest

import __spark_entry__
import corpus_pipeline
from test_operators import chunk_lines_gone, matches_by_hand, without
from tokenizers import Tokenizer

from shelfwise.llm import language_id, line_dedup, near_texts
from shelfwise.llm.queries import tokenizer_path

SMALL = "/root/testdata/sf0.001"


def test_registered():
    names = __spark_entry__.queries()
    assert {f"op{n}" for n in range(1, 11)} <= {k.split("_")[0] for k in names} and "pipeline" in names


def test_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    extra = docs.limit(1).selectExpr("900001L as doc_id", "'123 ...' as text", "lang", "source", "n_chars")
    docs = docs.unionByName(extra).unionByName(docs.where("doc_id = 1"))
    columns, seen = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = stage(spark, docs, SMALL).persist()
        seen.append(docs.count())
        if name != "pack":
            assert docs.columns == columns
        if name == "language":
            assert docs.where("doc_id = 900001").count() == 0 and seen[-1] == before.count() - 1
    assert seen[0] == seen[1] > seen[2] > seen[3]
    assert set(docs.columns) == {"doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"}


def groups_by_hand(texts):
    """The least row number of the group of each text: five-word Jaccard of 0.8 or more, or equal sets."""
    sets = [{tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if (w := (t or "").lower().split()) else set() for t in texts]
    groups = list(range(len(texts)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a == b or 5 * len(a & b) >= 4 * len(a | b):
                groups = [min(groups[i], groups[j]) if g in (groups[i], groups[j]) else g for g in groups]
    return groups


def test_run_against_brute_force(spark, tmp_path):
    """All five stages in a row over a small corpus with copies, repeats, leaks, nulls and clashing columns."""
    rng = random.Random(11)
    stems = {"en": "the and ing tion was her".split(), "de": "der und ung keit sch zu".split()}
    word = lambda k: rng.choice(stems[k]) + rng.choice(stems[k]) + rng.choice(stems[k])
    line = lambda k: " ".join(word(k) for _ in range(12))
    shared, item = [line("en"), line("en")], " ".join(word("en") for _ in range(14))
    rows = []
    for i in range(60):
        k = "en" if i % 2 else "de"
        body = [line(k) for _ in range(rng.randint(1, 4))]
        if i % 6 == 1:
            body[1:1] = shared
        if i % 10 == 3:
            body.append(f"so {item} end")
        rows.append((i, "\n".join(body), k))
    long = " ".join(word("en") for _ in range(60))
    rows += [(60, rows[5][1], "en"), (61, long, "en"), (62, long.replace(long.split()[-1], "other"), "en"), (63, None, "en"), (64, "", None), (65, "123 ..", None), (66, "a\nb", "en"), (None, rows[7][1], "en"), (9, rows[9][1], "en")]
    half = (" ".join(word(k) for _ in range(40)) for k in ("en", "de"))
    rows.append((67, "\n".join(half), None))  # as much of one language as of the other
    bench = [(1, item), (2, None), (None, " ")]
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    columns = "doc_id long, text string, lang string, source string, n_chars int, row string, score double, fp int, n_lines int, `a.b` int"
    table = spark.createDataFrame([(*r, "s", 0, "r", 1.5, 3, 4, 5) for r in rows], columns)
    table.write.parquet(f"{tmp_path}/documents.parquet")
    # language: the operator's own labels, which are tested apart; what they decide is done by hand
    model = language_id.train(language_id.training_sample(table))
    found = {(r.doc_id, r.row.text): r for r in language_id.predict(table, model, with_row=True).collect()}
    learned = [f.score for f in found.values() if f.lang_pred == f.row.lang and zlib.crc32(("" if f.doc_id is None else str(f.doc_id)).encode()) % 4 != 2]
    left = [r for r in rows if found[r[0], r[1]].lang_pred != "und" and found[r[0], r[1]].score >= min(learned)]
    assert {r[0] for r in rows} - {r[0] for r in left} == {63, 64, 65, 67}
    order = lambda r: (r[0] is not None, r[0])
    gone = chunk_lines_gone([(r[0], r[1]) for r in sorted(set(left), key=order)], line_dedup.TARGET)
    left = [(r[0], without(r[1], gone[r[0], r[1]]), r[2]) for r in left]
    assert sum(map(len, gone.values())) > 10
    left = sorted(set(left), key=lambda r: (r[0] is None, r[0]))
    groups = groups_by_hand([r[1] for r in left])
    left = [r for i, r in enumerate(left) if groups[i] == i]
    left = [r for r in left if not matches_by_hand(r[1], [(i, t) for i, t in bench if t])[1]]
    tok = Tokenizer.from_file(tokenizer_path())
    want = sorted(((r[0], len(tok.encode(r[1] or "", add_special_tokens=False).ids) + 1) for r in left), key=repr)
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted(((r.doc_id, r.doc_tokens) for r in got), key=repr) == want and 20 < len(want) < 60
    docs = table
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == table.columns
    assert {(r.row, r.score, r.fp, r.n_lines, r["a.b"]) for r in docs.collect()} == {("r", 1.5, 3, 4, 5)}
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, table.limit(0), str(tmp_path)).count() == 0


@pytest.mark.parametrize("rounds", [0, 2])
def test_near_copies_against_brute_force(spark, monkeypatch, rounds):
    """Every group of Jaccard 0.8 or more on five words has one document left, by leaders and by what is apart."""
    monkeypatch.setattr(near_texts, "ROUNDS", rounds)
    monkeypatch.setattr(near_texts, "PAIRS_A_COPY", 2)
    monkeypatch.setattr(near_texts, "FIRST_PAIRS", 1)
    rng = random.Random(3)
    word = lambda: f"w{rng.randrange(5000)}"
    rows = []
    for size in (6, 30, 60, 300):
        for _ in range(6):
            base = [word() for _ in range(size)]
            for changed in (0, 0, 1, 1, 2, 3, 6):
                copy = list(base)
                for at in rng.sample(range(size), changed):
                    copy[at] = word()
                rows.append((len(rows), " ".join(copy)))
    rows += [(None, rows[0][1].upper()), (900, None), (901, " "), (902, "one two"), (903, "One  two")]
    groups = groups_by_hand([t for _, t in rows])
    want = {min((r[0] for r, g in zip(rows, groups) if g == x and r[0] is not None)) for x in set(groups)}
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = [r.doc_id for r in corpus_pipeline.near_copies(spark, docs, SMALL).collect()]
    assert sorted(got) == sorted(want)
    assert corpus_pipeline.near_copies(spark, docs.limit(0), SMALL).count() == 0
