"""Every operator on nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfwise.llm import chat, decontamination, embedding_dedup, language_id, licenses, line_dedup, packing, pii, simhash, templates, url_filter
from shelfwise.llm.components import connected_components
from shelfwise.llm.queries import tokenizer_path

DOCS = "doc_id long, text string, lang string, source string, n_chars long, uid string, chunk int, segment string, rank int"
WORDS = "the of and stone river window under seven often little garden morning people silver never".split()


def docs_of(spark, texts, langs=None):
    rows = [(i, t, (langs or {}).get(i, "en"), "s", 0, "u", 1, "g", 2) for i, t in texts]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    prose = lambda n: " ".join(rng.choice(WORDS) for _ in range(n))
    out = [(i, prose(rng.randint(1, 60)) + ".\n" + prose(8)) for i in range(40)]
    out += [(40, None), (41, ""), (42, " \n\t "), (43, out[3][1]), (44, out[3][1].upper()), (45, prose(30000)), (None, out[5][1]), (None, None), (7, out[7][1]), (46, "ΑΒΓ <|endoftext|> ñ+1 (212) 555-0100\x0b²")]
    return out


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def fingerprint(text):
    import xxhash

    w = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    h = [xxhash.xxh64_intdigest(" ".join(w[k : k + 3]).encode(), 42) for k in range(max(1, len(w) - 2) if w else 0)]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in h) > len(h))


def test_simhash_against_brute_force(spark, texts):
    rows = simhash.near_duplicates(docs_of(spark, texts)).collect()
    assert len(rows) == len(texts)
    want = collections.Counter((i, f"{fingerprint(t):016x}") for i, t in texts)
    assert collections.Counter((r.doc_id, r.fingerprint) for r in rows) == want
    fps = {fingerprint(t) for _, t in texts}
    parent = {f: f for f in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in fps:
        for b in fps:
            if (a ^ b).bit_count() <= 2:
                parent[find(a)] = find(b)
    group = collections.defaultdict(list)
    for i, t in texts:
        group[find(fingerprint(t))].append(i)
    least = {f"{fingerprint(t):016x}": min((i for i in group[find(fingerprint(t))] if i is not None), default=None) for _, t in texts}
    assert all(r.component_id == least[r.fingerprint] for r in rows)
    assert simhash.near_duplicates(docs_of(spark, [])).count() == 0


@pytest.mark.parametrize(("crowd", "max_bits"), [(10, 2), (400, 2), (400, 1), (10, 3)])
def test_simhash_links_in_small_and_large_buckets(spark, crowd, max_bits):
    """Chains of changed bits, and a crowd of them, against all pairs."""
    rng = random.Random(crowd)
    fps = {rng.getrandbits(64) for _ in range(300)}
    base = rng.getrandbits(64)
    for _ in range(crowd):
        fps.add(base ^ sum(1 << rng.choice(range(0, 9)) for _ in range(rng.randint(0, 5))) & (1 << 64) - 1)
    for f in list(fps)[:40]:
        fps.add(f ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)))
    fps = sorted(fps)
    nodes = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp long")
    links = simhash.near_links(nodes, max_bits)
    assert all(((r.a ^ r.b) & (1 << 64) - 1).bit_count() <= max_bits for r in links.collect())
    got = {r.node: r.component for r in connected_components(links).collect()}
    parent = {f: f for f in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in fps:
        for b in fps:
            if (a ^ b).bit_count() <= max_bits:
                parent[find(a)] = find(b)
    signed = lambda f: f - (1 << 64) if f >> 63 else f
    groups = collections.defaultdict(set)
    for f in fps:
        groups[find(f)].add(signed(f))
    assert {frozenset(v) for v in groups.values() if len(v) > 1} == {frozenset(k for k, c in got.items() if c == x) for x in set(got.values())}


def test_simhash_plan_is_a_pigeonhole():
    rng = np.random.default_rng(1)
    for total in (10, 10**5, 10**10):
        bits = rng.random((500, 64)) < rng.random(64)
        counts = (bits.T.astype(float) @ bits) / 500 * total
        plan = simhash.plan_partitions(total, counts)
        assert sum(t + 1 for _, t in plan) == simhash.MAX_BITS + 1
        assert len({b for part, _ in plan for b in part}) == sum(len(part) for part, _ in plan)


def test_packing_round_trip(spark, texts):
    from tokenizers import Tokenizer

    docs = docs_of(spark, texts)
    rows = packing.pack_documents(docs, tokenizer_path()).collect()
    tok = Tokenizer.from_file(tokenizer_path())
    want = collections.Counter()
    for i, t in texts:
        ids = np.array([*tok.encode(t or "", add_special_tokens=False).ids, 2], dtype="<u4")
        for s in range(0, len(ids), 4096):
            want[i, s, len(ids[s : s + 4096]), zlib.crc32(ids[s : s + 4096].tobytes()), len(ids)] += 1
    assert collections.Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in rows) == want
    packs = collections.defaultdict(list)
    for r in rows:
        packs[r.sequence_id].append((r.offset, r.length))
    for parts in packs.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096
    whole = packing.packed_sequences(docs, tokenizer_path()).collect()
    assert all(len(r.ids) == 4096 or len(r.ids) & (len(r.ids) - 1) == 0 for r in whole)
    assert packing.pack_documents(docs_of(spark, []), tokenizer_path()).count() == 0


def test_packing_patterns_hold_every_length():
    rng = random.Random(3)
    for histogram in ({}, {4096: 3}, {1: 10_000}, {100: 1000, 7: 3}, {rng.randint(1, 4096): rng.randint(1, 500) for _ in range(300)}):
        got = collections.Counter()
        for packs, slots in packing.packing_patterns(histogram):
            assert sum(length * n for length, n in slots) <= 4096
            for length, n in slots:
                got[length] += packs * n
        assert dict(got) == histogram
    prose = collections.Counter(min(4096, max(2, int(rng.lognormvariate(6, 1.2)))) for _ in range(20_000))
    packs = sum(p for p, _ in packing.packing_patterns(prose))
    assert sum(k * n for k, n in prose.items()) / 4096 / packs > 0.97


def test_word_encoder_equals_tokenizer():
    """Ids of words put together are those of the tokenizer on the whole text, special strings included."""
    import pyarrow as pa
    from tokenizers import Tokenizer

    tok, enc = Tokenizer.from_file(tokenizer_path()), packing.WordEncoder(tokenizer_path())
    rng = random.Random(9)
    pool = ["Été", "ÀÈß", "ñandú,", "\u00e9t\u00e9.", "Straße", "Ĳssel", "Đa", "ªº", "Don't", "it's,", "a.b!", "!!", "x1y22", "é", "É́", "ﬁ", "<|endoftext|>", "<|ENDOFTEXT|>", "日本", "don't!.", "'s", " ", "ΣΑΣ", "--,", "A,", "🙂."]
    pool += ["<|EndOfText|>", "a<|startoftext|>B", "<|", "<<|a|>", "The", "Hello", "</w>", "w</w>x", "''ll", "'S'T", "a\u00a0B", "x\x85Y", "\x1cA", "\x00", "İstanbul", "²³", "µg", "Ⅷ", "_a_B", "éÉ1é'd"]
    char = lambda: chr(rng.choice([rng.randrange(32, 127), rng.randrange(32, 0x180), rng.randrange(32, 0x3000)]))
    word = lambda: rng.choice(pool) if rng.random() < 0.7 else "".join(char() for _ in range(rng.randint(1, 6)))
    for _ in range(250):
        texts = [rng.choice([" ", "\n", "\t ", "", "  "]).join(word() for _ in range(rng.randint(0, 9))) + rng.choice(["", " "]) for _ in range(4)]
        ids, ends = enc.encode(pa.array(texts, pa.string()))
        assert [x.tolist() for x in np.split(ids, ends)[:-1]] == [tok.encode(t, add_special_tokens=False).ids for t in texts], texts
    for t in ("The <| sign", "Hello World <|x", "A, <|endoftext|>", "<|EndOfText|> Hi"):
        assert enc.encode(pa.array([t]))[0].tolist() == tok.encode(t, add_special_tokens=False).ids


def matches_by_hand(text, items, width=10):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    w, hit, found = word.findall(lower(text)), set(), set()
    for item, t in items:
        v = word.findall(lower(t))
        for i in range(max(1, len(v) - width + 1) if v else 0):
            win = v[i : i + width]
            for p in range(len(w) - len(win) + 1):
                if w[p : p + len(win)] == win:
                    hit |= set(range(p, p + len(win)))
                    found.add(item)
    return len(w), len(hit), sorted(found)


@pytest.mark.parametrize(("block", "pairs"), [(10_000, 10**6), (4, 10**6), (10_000, 1)])
def test_decontamination_against_brute_force(spark, texts, block, pairs, monkeypatch):
    monkeypatch.setattr(decontamination, "PAIRS_AT_ONCE", pairs)
    rng = random.Random(1)
    items = [(1, " ".join(rng.choice(WORDS) for _ in range(14))), (2, "Stone, river"), (3, None), (4, "  "), (5, "Stone river!"), (6, "NEVER")]
    long = [(100, f"x {items[0][1]} y"), (101, items[0][1][:-20]), (102, "stone-river stone river")]
    docs = docs_of(spark, texts[:44] + texts[46:] + long)
    bench = spark.createDataFrame([(*x, "e") for x in items], "item_id long, text string, doc_id string")
    rows = decontamination.contamination(docs, bench, slop=5, windows_a_block=block).collect()
    want = collections.Counter()
    for i, t in texts[:44] + texts[46:] + long:
        n, h, found = matches_by_hand(t, items)
        want[i, n, h, len(found), hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest(), h > 0] += 1
    assert collections.Counter((r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in rows) == want
    assert all(r.n_near_items >= r.n_items for r in rows)
    assert decontamination.contamination(docs, bench.where("false")).where("contaminated").count() == 0
    assert decontamination.contamination(docs_of(spark, []), bench).count() == 0


def test_segments_are_stored_and_probed_one_at_a_time(spark, monkeypatch):
    import pyarrow.parquet as pq

    docs = docs_of(spark, [(i, f"a b {i}") for i in range(300)]).coalesce(1)
    index, before = decontamination.store_index(docs, segment_words=9), spark.conf.get(decontamination.BATCH_ROWS)
    files = [pq.ParquetFile(f.removeprefix("file://")).metadata for f in index.inputFiles()]
    assert [m.row_group(i).num_rows for m in files for i in range(m.num_row_groups)] == [1] * 100
    rows_at_once = []
    probe = decontamination._probe
    monkeypatch.setattr(decontamination, "_probe", lambda *a: rows_at_once.append(spark.conf.get(decontamination.BATCH_ROWS)) or probe(*a))
    bench = spark.createDataFrame([(1, "a b 7")], "item_id long, text string")
    assert [r.doc_id for r in decontamination.contamination(docs, bench).where("contaminated").collect()] == [7]
    assert rows_at_once == ["1"] and spark.conf.get(decontamination.BATCH_ROWS) == before


def test_decontamination_of_items_without_id(spark):
    docs = docs_of(spark, [(1, "a b c d"), (2, "c d"), (3, "e")])
    bench = spark.createDataFrame([(None, "a b"), (7, "a b"), (8, "b c"), (None, "c d")], "item_id long, text string")
    got = {r.doc_id: (r.n_hit, r.n_items, r.contaminated) for r in decontamination.contamination(docs, bench).collect()}
    assert got == {1: (4, 2, True), 2: (2, 0, True), 3: (0, 0, False)}


def test_language_id(spark):
    rng = random.Random(2)
    stems = {"en": "the and ing tion was her".split(), "de": "der und ung keit sch zu".split(), "es": "los que ción mente rr ñ".split()}
    word = lambda k: rng.choice(stems[k]) + rng.choice(stems[k])
    rows, langs = [], {}
    for i in range(240):
        k = list(stems)[i % 3]
        rows.append((i, " ".join(word(k) for _ in range(rng.randint(3, 80)))))
        langs[i] = k
    rows += [(300, None), (301, ""), (302, "1 2 ²_"), (None, rows[0][1]), (303, " ".join(word("en") for _ in range(9000)))]
    langs |= {300: None, 301: "en", 302: None, None: None, 303: None}
    docs = docs_of(spark, rows, langs)
    got = language_id.identify(docs, with_runs=True).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert all(by[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i in range(240))
    right = [by[i].lang_pred == langs[i] for i in range(240) if by[i].held_out]
    assert sum(right) / len(right) > 0.95
    assert [by[i].lang_pred for i in (300, 301, 302)] == ["und"] * 3 and by[303].lang_pred == "en"
    assert all(0 <= r.score <= 1 for r in got) and by[None].held_out is False
    mixed = docs_of(spark, [(1, " ".join([*(word("en") for _ in range(30)), *(word("de") for _ in range(30))]))])
    runs = language_id.predict(mixed, language_id.train(language_id.training_sample(docs)), with_runs=True).first().runs
    assert [r.lang for r in runs][0] == "en" and [r.lang for r in runs][-1] == "de"
    bare = language_id.identify(docs_of(spark, rows[:3], {i: None for i, _ in rows}))
    assert {r.lang_pred for r in bare.collect()} == {"und"}
    assert language_id.identify(docs_of(spark, [])).count() == 0


def test_language_sample_is_ranked_in_each_language(spark):
    """Copies, null ids and very frequent languages push nobody out; the sample is bounded in rows and characters."""
    rows = [(None, f"text {i % 40} a", "aa") for i in range(400)] + [(4, f"word {i} b", "bb") for i in range(30)] + [(8, "c " * 5000 + str(i), "cc") for i in range(5)] + [(9, "x", None), (10, None, "dd")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = collections.Counter(lang for _, lang in language_id.training_sample(docs, per_language=20, chars=25_000))
    assert 10 < got["bb"] <= 20 and 0 < got["aa"] <= 20 and got["cc"] == 3 and set(got) == {"aa", "bb", "cc"}


def test_every_language_and_every_character_counts(monkeypatch):
    monkeypatch.setattr(language_id, "SEQUENCES", 2)
    monkeypatch.setattr(language_id, "STEPS", 5)
    names = [f"l{i:02d}" for i in range(70)]
    rows = [(" ".join(f"{a}{b}{n[1:]}" .translate(str.maketrans("0123456789", "abcdefghij")) for b in "xyz"), n) for n in names for a in "uvw"]
    model = language_id.train(rows)
    assert model.languages == names
    word = "a" * 100
    flat, sizes = language_id.word_features([word, word + "b", "c", word[:-1] + "b"], {"c": 1})
    assert sizes.tolist() == [99 + 98 + 6, 100 + 99 + 6, 0 + 0 + 2 + 1, 99 + 98 + 6]
    parts = np.split(flat, np.cumsum(sizes)[:-1])
    assert set(parts[0]) != set(parts[1]) and set(parts[1]) == set(parts[3])
    assert (flat >= 0).all() and (flat < language_id.FEATURES).all()


def test_forward_backward_against_enumeration():
    import itertools

    rng = np.random.default_rng(0)
    emit, moves, begin = rng.normal(size=(7, 2)), rng.normal(size=(2, 2)), rng.normal(size=2)
    post, index, _ = language_id.forward_backward(emit, np.array([3, 4]), moves, begin)
    for start, n in ((0, 3), (3, 4)):
        mass = np.zeros((n, 2))
        for path in itertools.product(range(2), repeat=n):
            s = begin[path[0]] + sum(emit[start + t, k] for t, k in enumerate(path)) + sum(moves[a, b] for a, b in zip(path, path[1:]))
            for t, k in enumerate(path):
                mass[t, k] += np.exp(s)
        want = mass / mass.sum(axis=1, keepdims=True)
        got = np.array([post[np.flatnonzero(index == start + t)[0]] for t in range(n)])
        assert np.allclose(got, want)


def pii_by_hand(text):
    luhn = lambda s: sum(d if k % 2 == 0 else d * 2 - 9 * (d > 4) for k, d in enumerate(map(int, reversed(s)))) % 10 == 0
    digits = lambda s: re.sub("[^0-9]", "", s)
    kinds = (
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(p) <= 255 for p in s.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda s: 12 <= len(digits(s)) <= 19 and luhn(digits(s))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 9 <= len(digits(s)) <= 15),
    )
    spans = [(m.start(), k, name, m.end()) for k, (name, p, ok) in enumerate(kinds) for m in re.finditer(p, text) if ok(m[0])]
    return ",".join(f"{name}:{s}:{e}" for s, _, name, e in sorted(spans))


def test_pii_base_spans_against_patterns(spark, texts):
    rng = random.Random(4)
    pool = ["a@b.co", "x.y@z", "a@b.c-d_e@f.gh", "@", "1.2.3.4.5", "300.1.1.1", "0001.2.3.4", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (212) 555-0100", "+12", "é", "12", ".", " ", "x", "token = \"24be64439e3e49cf46b2d7c90f3602a3\"", "Mr. Paul Martin", "paul (at) mail (dot) com"]
    rows = texts + [(200 + i, "".join(rng.choice(pool) + rng.choice(["", " ", ","]) for _ in range(12))) for i in range(150)] + [(999, "a" * 50_000 + "@" + "1" * 50_000)]
    got = pii.find_pii(docs_of(spark, rows)).collect()
    want = collections.Counter((i, hashlib.sha256(pii_by_hand(t or "").encode()).hexdigest()) for i, t in rows)
    assert collections.Counter((r.doc_id, r.base_sha256) for r in got) == want
    by = {r.doc_id: r for r in got}
    for i, t in rows[-150:]:
        base = [x for x in pii_by_hand(t).split(",") if x]
        assert set(base) <= set(by[i].spans.split(",")) and by[i].n_email == sum(x.startswith("email") for x in base)
    assert sum(r.n_added for r in got) > 0
    assert pii.find_pii(docs_of(spark, [])).count() == 0
    assert pii.find_pii(docs_of(spark, [(1, None)])).first().spans == ""


def lines_gone(rows, units):
    """Per distinct row, in order, the lines of units that occurred before."""
    seen, gone = set(), {}
    for row in rows:
        lines, gone[row] = (row[1] or "").split("\n"), set()
        for begin, end in units(lines):
            part = tuple(lines[begin:end])
            if "".join(part).strip():
                gone[row] |= set(range(begin, end)) if part in seen else set()
                seen.add(part)
    return gone


def without(text, gone):
    return None if text is None else "\n".join(x for k, x in enumerate(text.split("\n")) if k not in gone)


def chunk_lines_gone(rows, target):
    """The same for content-defined chunks: windows that occurred before, grown as far as the chunks agree."""
    first, gone = {}, {}
    for row in rows:
        lines, gone[row] = (row[1] or "").encode().split(b"\n"), set()
        begins = line_dedup.boundaries(lines, target)
        windows = [(b, b + 2, begins[k - 1] + 1 if k else 0, begins[k + 1] + 1 if k + 1 < len(begins) else len(lines)) for k, b in enumerate(begins)]
        windows += [(k, k + 1, k, k + 1) for k, x in enumerate(lines) if len(x.split()) > 50]
        for low, high, before, after in windows:
            whole = b"\n".join(lines[low:high])
            if not whole.strip():
                continue
            if whole not in first:
                first[whole] = (lines[max(before, low - line_dedup.MOST) : low], lines[high : min(after, high + line_dedup.MOST)])
                continue
            x, y = low, high
            for line in reversed(first[whole][0]):
                if not x or lines[x - 1] != line:
                    break
                x -= 1
            for line in first[whole][1]:
                if y == len(lines) or lines[y] != line:
                    break
                y += 1
            gone[row] |= set(range(x, y))
    return gone


@pytest.mark.parametrize("target", [1, line_dedup.TARGET, 1000])
def test_line_dedup_against_brute_force(spark, target):
    rng = random.Random(6)
    line = lambda n=5: " ".join(rng.choice(WORDS) for _ in range(n))
    passage, long = [line() for _ in range(12)], line(51)
    rows = []
    for i in range(60):
        own = [line() for _ in range(rng.randint(0, 9))] + ([long] if i % 7 == 1 else [])
        at = rng.randint(0, len(own))
        rows.append((i, "\n".join(own[:at] + (passage if i % 3 == 0 else []) + own[at:])))
    rows += [(60, None), (61, ""), (62, "\n\n\n\n"), (63, rows[3][1]), (None, rows[6][1]), (5, rows[5][1]), (64, f"{line(50)}\nx"), (64, " ".join(long.split()[:50]))]
    table = docs_of(spark, rows).selectExpr("*", "77 as n_lines", "'t' as _text", "3 as _runs", "4 as `a.b`", "5 as high")

    gone = chunk_lines_gone(sorted(dict.fromkeys(rows), key=lambda r: (r[0] is not None, r[0])), target)
    want = collections.Counter((i, without(t, gone[i, t]), len(gone[i, t])) for i, t in rows)
    got = line_dedup.deduplicate(table, target=target)
    found = got.collect()
    assert collections.Counter((r.doc_id, r.text, r.n_removed_lines) for r in found) == want
    assert got.columns == [c for c in table.columns if c != "n_lines"] + ["n_lines", "n_removed_lines", "n_removed_chunks"]
    assert all((r.uid, r.chunk, r._text, r._runs, r["a.b"], r.high) == ("u", 1, "t", 3, 4, 5) for r in found)
    plain = line_dedup.deduplicate(table, target=target, counts=False)
    assert plain.columns == table.columns and {r.n_lines for r in plain.collect()} == {77}
    assert sum(r.n_removed_lines for r in found) > 100 and all(long in r.text for r in found if r.doc_id == 1)
    assert line_dedup.deduplicate(docs_of(spark, [])).count() == 0


def test_repeated_line_runs_are_all_found(spark):
    """Passages of 2 to 5 lines between different neighbours, and long lines alone, go wherever they are not first."""
    rng = random.Random(8)
    line = lambda n=30: " ".join(f"{rng.choice(WORDS)}{rng.randrange(10**6)}" for _ in range(n))
    passages = [[line() for _ in range(n)] for n in (2, 2, 3, 3, 4, 5)] + [[line(51)]]
    rows = []
    for i in range(40):
        parts = [[line() for _ in range(rng.randint(1, 3))] for _ in range(3)]
        rows.append((i, "\n".join(parts[0] + passages[i % 7] + parts[1] + passages[(i + 3) % 7] + parts[2])))
    rows += [(50, None), (51, ""), (52, "\n\n\n"), (53, "x\n\n\ny"), (54, "same\nsame\nsame"), (55, "\n".join(passages[0][::-1]))]
    gone = lines_gone(rows, lambda lines: [(k, k + 2) for k in range(len(lines) - 1)] + [(k, k + 1) for k, x in enumerate(lines) if len(x.split()) > 50])
    got = line_dedup.deduplicate(docs_of(spark, rows)).collect()
    assert {(r.doc_id, r.text, r.n_removed_lines) for r in got} == {(i, without(t, gone[i, t]), len(gone[i, t])) for i, t in rows}
    by = {r[0]: gone[r] for r in rows}
    assert all(r.n_removed_chunks == sum(k - 1 not in by[r.doc_id] for k in by[r.doc_id]) for r in got)
    left = collections.Counter(x for r in got if r.doc_id < 50 for x in r.text.split("\n"))
    assert all(left[x] == 1 for p in passages for x in p)


def test_many_equal_rows_cost_no_more_than_others(spark):
    """Equal rows are one occurrence; their marks do not grow with their number."""
    text = "\n".join(f"line {k} of the text, which is long enough" for k in range(12))
    rows = spark.range(20_000).selectExpr("7L as doc_id", "if(id % 2 = 0, 'a\nb', NULL) as other").withColumn("text", F.lit(text))
    rows = rows.unionByName(spark.createDataFrame([(9, None, text), (1, None, "line 3 of the text, which is long enough\nline 4 of the text, which is long enough")], "doc_id long, other string, text string"))
    got = line_dedup.deduplicate(rows).groupBy("doc_id", "text", "n_removed_lines").count().collect()
    short = without(text, {3, 4})
    assert {tuple(r) for r in got} == {(7, short, 2, 20_000), (9, "", 12, 1), (1, "line 3 of the text, which is long enough\nline 4 of the text, which is long enough", 0, 1)}


def test_line_chunks_find_themselves_again():
    rng = random.Random(1)
    lines = [str(rng.random()).encode() for _ in range(200)]
    a = [u.whole for u in line_dedup.units(lines, 400)]
    b = [u.whole for u in line_dedup.units([b"new", *lines], 400)]
    assert len(set(a) & set(b)) > 0.95 * len(a) and len(a) < 120
    assert len(line_dedup.boundaries([b"same"] * 50, 10**9)) == 49  # lines without a difference are boundaries all


def test_recall_of_line_runs_between_foreign_neighbours():
    """Runs of short and long lines: nothing goes that is no repeated run, and at least nine lines in ten go."""
    rng = random.Random(9)
    line = lambda: " ".join(f"{rng.choice(WORDS)}{rng.randrange(10**4)}" for _ in range(rng.randint(3, 40)))
    runs = {n: [[line() for _ in range(n)] for _ in range(60)] for n in (2, 3, 4, 5, 9)}
    rows, of = [], {}
    for again in range(2):
        for n, some in runs.items():
            for run in some:
                of[len(rows)] = n
                rows.append((len(rows), "\n".join([line() for _ in range(rng.randint(1, 4))] + run + [line() for _ in range(rng.randint(1, 4))])))
    gone = chunk_lines_gone(rows, line_dedup.TARGET)
    every = lines_gone(rows, lambda lines: [(k, k + 2) for k in range(len(lines) - 1)])
    assert all(gone[r] - {k for k, x in enumerate(r[1].split("\n")) if len(x.split()) > 50} <= every[r] for r in rows)
    for n in runs:
        found, whole = (sum(len(g[r]) for r in rows if of[r[0]] == n) for g in (gone, every))
        assert whole == 60 * n and found >= 0.9 * whole


@pytest.mark.parametrize(("tile", "band"), [(2048, 16384), (8, 16), (8, 8)])
def test_embeddings_against_brute_force(spark, monkeypatch, tile, band):
    monkeypatch.setattr(embedding_dedup, "TILE", tile)
    monkeypatch.setattr(embedding_dedup, "BAND", band)
    rng = np.random.default_rng(3)
    base = rng.normal(size=(40, 16))
    x = np.concatenate([base, base[:10] + 0.08 * rng.normal(size=(10, 16)), np.repeat(base[:1], 30, axis=0) + 0.02 * rng.normal(size=(30, 16)), base[:3], base[3:5] * 7]).astype(np.float32)
    rows = [(i, [float(v) for v in r], 0) for i, r in enumerate(x)]
    rows += [(500, None, 0), (501, [], 0), (502, [0.0] * 16, 0), (503, [float("nan")] * 16, 0), (504, [None, 1.0], 0), (505, [1.0, float("inf")], 0), (506, [1.0], 1), (None, rows[0][1], 0), (0, rows[0][1], 1)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").selectExpr("*", "1 as node", "2 as v", "3 as tile")
    good = [(i, np.array(v + [0.0] * (16 - len(v)))) for i, v, _ in rows if v and all(c is not None and np.isfinite(c) for c in v) and any(v)]
    u = np.array([v / np.linalg.norm(v) for _, v in good])
    link = u @ u.T >= 0.9
    comp = np.arange(len(good))
    for _ in range(len(good)):
        comp = np.array([comp[link[k]].min() for k in range(len(good))])
    least = {c: min((i for k, (i, _) in enumerate(good) if comp[k] == c and i is not None), default=None) for c in set(comp)}
    want = collections.Counter((i, int(link[k].sum()) - 1, least[comp[k]]) for k, (i, _) in enumerate(good))
    want.update((i, 0, i) for i in range(500, 506))
    got = embedding_dedup.near_duplicates(table).collect()
    assert collections.Counter((r.vec_id, r.n_links, r.component_id) for r in got) == want
    assert all(r.kept == (r.vec_id is not None and r.vec_id == r.component_id) for r in got)
    assert embedding_dedup.near_duplicates(table.where("false")).count() == 0
    assert embedding_dedup.near_duplicates(table.where("vec_id = 500")).first().n_links == 0


def test_embedding_bounds_lose_nothing():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, 40)) * np.linspace(3, 0.1, 40)
    x = np.concatenate([x, x[:50] + 0.2 * rng.normal(size=(50, 40))])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    axes = np.linalg.eigh(x.T @ x)[1][:, ::-1]
    r, c = embedding_dedup.links_between(x, x, x @ axes, x @ axes, 0.8, True)
    want = {(i, j) for i, j in zip(*np.nonzero(np.triu(x @ x.T >= 0.8, 1)))}
    assert set(zip(r.tolist(), c.tolist())) == {(int(i), int(j)) for i, j in want}


def test_connected_components_on_long_chains(spark):
    edges = [(i, i + 1) for i in range(100)] + [(1000, k) for k in range(1001, 1100)] + [(5, 5), (2000, 2000)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(101)} | {i: 1000 for i in range(1000, 1100)}


def units_by_hand(scanner, templates, text):
    """Every run of words against every template; of overlapping runs the best, ties to the longest, first, first template."""
    words = [(w, n) for n, line in enumerate(text.lower().split("\n")) for w in re.findall(r"\w+", line)]
    grams = [(a[0], b[0]) for a, b in zip(words, words[1:])]
    found = []
    for k, (_, t) in enumerate(templates):
        want = collections.Counter(licenses.bigrams(t))
        for a in range(len(grams)):
            best = None
            for b in range(a + 1, len(grams) + 1):
                have = sum((collections.Counter(grams[a:b]) & want).values())
                dice = 2 * have / (b - a + want.total())
                # a unit begins and ends with bigrams of its template
                if dice >= 0.8 - 1e-12 and grams[a] in want and grams[b - 1] in want and (best is None or dice > best[0]):
                    best = (dice, a, b, k)
            found += [best] if best else []
    taken = []
    for dice, a, b, k in sorted(found, key=lambda x: (-x[0], x[1] - x[2], x[1], x[3])):
        if all(b < c or d < a for _, c, d, _ in taken):
            taken.append((dice, a, b, k))
    return [(templates[k][0], words[a][1], words[b][1], dice) for dice, a, b, k in sorted(taken, key=lambda x: x[1])]


def test_license_units_against_brute_force():
    rng = random.Random(12)
    templates = [("A", "you may copy and use this work freely if you keep this note"), ("B", "you may copy and use this work freely"), ("C", "no rights"), ("D", "the the the work of the work"), ("E", "one")]
    scanner = licenses.Scanner(templates)
    pool = "you may copy and use this work freely if keep note no rights the of x y".split()
    hits = 0
    for _ in range(150):
        parts = [" ".join(rng.choice(pool) for _ in range(rng.randint(0, 5)))]
        for _ in range(rng.randint(0, 3)):
            t = rng.choice(templates)[1].split()
            for _ in range(rng.randint(0, 2)):
                t[rng.randrange(len(t))] = rng.choice(pool)
            parts += [" ".join(t), rng.choice(["\n", " ", ", and "]), " ".join(rng.choice(pool) for _ in range(rng.randint(0, 4)))]
        text = rng.choice([" ", "\n"]).join(parts)
        got, want = scanner.scan(text), units_by_hand(scanner, templates, text)
        assert [x[:3] for x in got] == [x[:3] for x in want] and all(abs(x[3] - y[3]) < 1e-9 for x, y in zip(got, want)), text
        hits += len(got)
    assert hits > 100
    assert scanner.scan("") == scanner.scan("one") == scanner.scan("\n\n x \n") == []


def test_license_scan_is_linear_in_a_long_text():
    import time

    scanner, took = licenses.Scanner(), []
    for n in (5_000, 20_000):
        began = time.process_time()
        assert scanner.scan("use of the Software is\n" * n) == []
        took.append(time.process_time() - began)
    assert took[1] < 8 * took[0] + 0.5


def test_licenses(spark, texts):
    mit = next(t for n, t in licenses.TEMPLATES if n == "MIT" and len(t) > 200)
    rows = texts[:6] + [(70, "x\nReleased under the MIT License.\ny"), (71, mit), (72, mit.replace("Software", "Program", 2)), (73, "All rights reserved"), (74, None), (75, "licence"), (76, "This work is licensed under the GNU General Public License, version 3.")]
    rows += [(77, "The tool is released under the MIT License. All rights reserved."), (78, texts[45][1] + "\n" + mit + "\n" + texts[45][1]), (79, "")]
    table = docs_of(spark, rows).selectExpr("*", "1 as matches", "2 as license")
    found = {r.doc_id: r.matches for r in licenses.scan_licenses(table).collect()}
    got = {i: sorted({m.license for m in x}) for i, x in found.items()}
    assert got[70] == got[71] == got[72] == ["MIT"] and got[73] == ["proprietary"] and got[76] == ["GPL-3.0"]
    assert got[77] == ["MIT", "proprietary"] and found[70][0].first_line == found[70][0].last_line == 1
    assert got[78] == ["MIT"] and found[78][0].dice == 1.0
    assert got[74] == got[75] == got[79] == [] and not any(got[i] for i in range(6))
    assert licenses.scan_licenses(docs_of(spark, [])).count() == 0


def test_confusable_licenses_are_told_apart():
    scanner = licenses.Scanner()
    for name, text in licenses.TEMPLATES:
        assert [m[0] for m in scanner.scan(f"Some words before. {text} And some after.")] == [name]
    names = {name for name, text in licenses.TEMPLATES if len(text) > 200}
    assert {"AGPL-3.0", "BSD-2-Clause", "BSD-3-Clause", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0"} <= names


def test_span_checks_are_not_quadratic():
    import time

    took = []
    for n in (2_000, 16_000):
        began = time.process_time()
        taken = pii._Taken([(20 * k, 20 * k + 10) for k in range(n)])
        assert not any(taken.overlaps(20 * k + 10, 20 * k + 20) for k in range(n)) and all(taken.overlaps(20 * k + 9, 20 * k + 20) for k in range(n))
        took.append(time.process_time() - began)
    assert took[1] < 30 * took[0] + 0.5


def test_url_filter(spark, monkeypatch):
    from datetime import datetime as D

    day = lambda n: D(2024, 1, n)
    entries = spark.createDataFrame([("host:a.x", day(2), 1, True), ("host:a.x", day(5), 2, False), ("host:a.x", day(5), 3, True), ("site:b.x", day(3), 4, True), ("site:b.x", day(4), 5, False), (None, day(1), 6, True), ("host:c.x", None, 7, True), ("", day(1), 8, True)], "key string, ts timestamp, entry_id long, listed boolean")
    caps = [("http://a.x/1", day(1)), ("http://a.x/1", day(2)), ("https://u@A.X:80/", day(4)), ("http://a.x", day(6)), ("http://shop.eu.b.x/p", day(3)), ("http://b.x/p", day(4)), ("http://b.x/p", day(3)), ("http://c.x", day(9)), (None, day(9)), ("http://a.x", None), ("nonsense", day(3))]
    table = spark.createDataFrame([(i, *c, "k", 1) for i, c in enumerate(caps)], "page_id long, url string, fetched_at timestamp, key string, entry_id int").drop("entry_id")
    for salt, stretch in ((50_000, 3600), (2, 3600), (1, 10**9)):
        monkeypatch.setattr(url_filter, "CAPTURES_A_SALT", salt)
        monkeypatch.setattr(url_filter, "STRETCH_SECONDS", stretch)
        got = {r.page_id: (r.blocked, r.entry_ids) for r in url_filter.filter_captures(table, entries).collect()}
        assert {k for k, v in got.items() if v[0]} == {1, 2, 3, 4, 6} and got[3][1] == "3" and got[4][1] == "4"
        lives = {(r.key, r.entry_id): r.valid_to for r in url_filter.validity_intervals(entries).collect()}
        assert lives == {("host:a.x", 1): day(5), ("host:a.x", 3): None, ("site:b.x", 4): day(4), ("site:b.x", 5): None}
    assert url_filter.filter_captures(table.where("false"), entries).count() == 0
    assert url_filter.filter_captures(table, entries.where("false")).where("blocked").count() == 0


def test_chat_round_trip(spark):
    mark = "<|im_end|><|im_start|>assistant ok"
    rows = [(-1, 0, "user", mark), (-1, 1, "assistant", mark), (1, 0, "system\n%0A<", "<\\|x <\\\\| <"), (1, 2, "assistant", "é🙂\n"), (1, 1, "user", None), (2, None, None, "a"), (2, 0, "assistant", ""), (2, 0, "assistant", ""), (3, 0, "assistant", "a <"), (3, 1, "assistant", "\\| b"), (3, 2, "assistant", "|"), (None, 0, "assistant", "z" * 300_000)]
    table = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, part int")
    got = {r.conv_id: r for r in chat.read_back(chat.format_conversations(table)).collect()}
    for conv in {r[0] for r in rows}:
        turns = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1], r[2] or "", r[3] or ""))
        every = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in turns)
        loss = "".join(r[3] or "" for r in turns if r[2] == "assistant")
        g = got[conv]
        assert (g.n_turns, g.turns_sha256) == (len(turns), hashlib.sha256(every.encode()).hexdigest())
        assert (g.loss_chars, g.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    whole = {r.conv_id: r for r in chat.formatted_texts(table).collect()}
    assert all(len(whole[c].text) == got[c].formatted_chars for c in got)
    assert chat.read_back(chat.format_conversations(table.where("false"))).count() == 0


def test_templates():
    run = lambda s, **v: "".join(t for t, _ in templates.compile_template(s, chat.FILTERS)(v))
    assert run("{% if 1 == 1 and not false %}a{% else %}b{% endif %}{{ 'x' + 'y' | upper }}") == "axY"
    assert run("{% for m in ms %}{{ loop.index }}{{ m.a }}{% if not loop.last %},{% endif %}{% endfor %}", ms=iter([{"a": "p"}, {"a": None}])) == "1p,2"
    assert run("{% set x = 'q' %}{{ x }}{% if x in 'pqr' %}!{% elif x %}?{% endif %}") == "q!"
    assert templates.fold(templates.parse("a{{ 'b' }}{% if false %}c{% endif %}d"), {}) == ("all", [("text", "abd")])
    for bad in ("{{ x.__class__ }}", "{{ f(1) }}", "{% while %}", "{% for x in y %}", "{{ 'a' | nothing }}", "{{ unknown }}"):
        with pytest.raises(templates.TemplateError):
            run(bad, x="s")
