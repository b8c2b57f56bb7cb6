"""Personal data by weak supervision.

Candidate spans come from exact rules (email, ip, card, phone) and from looser ones (spelled-out
emails, phones without a country code, names after a title, secrets after a key word).  Labelers of
three families vote on every candidate, yes, no or nothing: patterns and checks of the span itself,
gazetteers, and the words around it.  Expectation-maximisation over the counts of vote patterns, at
most a few thousand numbers, estimates how reliable each labeler is; its posteriors train the final
span classifier, a logistic regression over shape and context features, on a bounded sample
(``SAMPLE_SPANS``, by hash).  Exact-rule spans always stay; others are added if the classifier says so.
``n_*`` and ``base_sha256`` of the digest are of exact-rule spans, ``spans`` has all.

Defined results: a null text is empty; an empty one has no spans; a very long one is read whole, by one task; repeated rows are judged each for
itself; an empty table gives no rows; without candidates nothing is learned and nothing added; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from bisect import bisect_left
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import arrow_rows, materialise

#: Kinds in the order of the contract, then those that only the method finds.
KINDS = ("email", "ip", "card", "phone", "name", "secret")
SAMPLE_SPANS, FEATURES, EM_ROUNDS, STEPS = 20_000, 1 << 12, 50, 200
CONTEXT = 32

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+$")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a run of digits that was begun before cannot match either, so tries start at its first digit only
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_LOOSE_EMAIL = re.compile(r"[A-Za-z0-9_%+-]{1,64} ?[\[(] ?at ?[\])] ?[A-Za-z0-9-]{1,63} ?[\[(] ?dot ?[\])] ?[A-Za-z]{2,12}")
_LOOSE_PHONE = re.compile(r"(?<![0-9A-Za-z+.-])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])")
_SECRET = re.compile(r"[=:]\s?\"?([A-Za-z0-9+/_-]{16,})")
# fixed values: titles, given names, context words and top-level domains of the labelers
TITLES = ("Mr.", "Mrs.", "Ms.", "Dr.", "Herr ", "Frau ", "Mme ", "Monsieur ", "Señor ", "Señora ")
_NAME = re.compile(r"(?:Mr\.|Mrs\.|Ms\.|Dr\.|Herr|Frau|Mme|Monsieur|Señor|Señora) ?([A-ZÀ-Ý][a-zà-ÿ]{1,20}(?: [A-ZÀ-Ý][a-zà-ÿ]{1,20})?)")
GIVEN_NAMES = frozenset(
    "alice anna antonio ben carlos carmen claire david elena emma felix hans jean john jose juan julia karl laura lea "
    "louis lucas luis manuel maria marie mark martin mary max michael paul peter pierre sara sofia thomas".split()
)
DOMAINS = frozenset("com org net edu gov info io de fr es uk eu ch at be it nl".split())
KIND_WORDS = {
    "email": frozenset("mail email e-mail contact contacto kontakt courriel correo write from to".split()),
    "ip": frozenset("ip host server address addr from by serveur servidor".split()),
    "card": frozenset("card visa mastercard credit karte carte tarjeta pay payment".split()),
    "phone": frozenset("call phone tel telephone telefon téléphone teléfono mobile fax".split()),
    "name": frozenset("dear name hello sehr cher querido signed by".split()),
    "secret": frozenset("token secret password passwd key api_key apikey auth bearer".split()),
}
AGAINST_WORDS = frozenset("version v page pages isbn issn chapter section figure table id no nr art".split())

SPAN = T.StructType(
    [
        T.StructField("kind", T.IntegerType()),
        T.StructField("start", T.IntegerType()),
        T.StructField("end", T.IntegerType()),
        T.StructField("base", T.BooleanType()),
        T.StructField("votes", T.StringType()),
        T.StructField("features", T.ArrayType(T.IntegerType())),
    ]
)
CANDIDATES = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("spans", T.ArrayType(SPAN))])


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(d * 2 - 9 * (d > 4) for d in map(int, digits[-2::-2]))
    return total % 10 == 0


def _emails(text: str) -> list[tuple[int, int]]:
    """Leftmost, non-overlapping; found from each @, so that long runs of letters cost nothing."""
    out, last, at = [], 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > last and _LOCAL.match(text[begin - 1]):
            begin -= 1
        domain = _DOMAIN.match(text, at + 1) if begin < at else None
        if domain:
            out.append((begin, domain.end()))
            last = domain.end()
        at = text.find("@", max(at + 1, last))
    return out


def base_spans(text: str) -> list[tuple[int, int, int, bool]]:
    """``(kind, start, end, holds)`` of every match of the exact patterns; ``holds``: its check too."""
    out = [(0, s, e, True) for s, e in _emails(text)]
    digit = _DIGIT.search(text)
    if digit:
        first = digit.start()
        out += [(1, *m.span(), all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))) for m in _IP.finditer(text, first)]
        for m in _CARD.finditer(text, first):
            digits = m[0].replace(" ", "").replace("-", "")
            if len(digits) > 7:
                out.append((2, *m.span(), 12 <= len(digits) <= 19 and luhn(digits)))
        if "+" in text:
            for m in _PHONE.finditer(text, max(0, first - 1)):
                out.append((3, *m.span(), 9 <= sum(c.isdigit() for c in m[0]) <= 15))
    return out


def _loose(text: str) -> list[tuple[int, int, int]]:
    out = []
    if "dot" in text:
        out += [(0, *m.span()) for m in _LOOSE_EMAIL.finditer(text)]
    digit = _DIGIT.search(text)
    if digit:
        out += [(3, *m.span()) for m in _LOOSE_PHONE.finditer(text, max(0, digit.start() - 1))]
    if any(t in text for t in TITLES):
        out += [(4, *m.span(1)) for m in _NAME.finditer(text)]
    if "=" in text or ":" in text:
        out += [(5, *m.span(1)) for m in _SECRET.finditer(text)]
    return out


class _Taken:
    """Spans that others must not overlap, asked in logarithmic time."""

    def __init__(self, spans: list[tuple[int, int]]):
        self.starts = sorted(s for s, _ in spans)
        self.ends = list(accumulate((e for _, e in sorted(spans)), max))  # the furthest of those so far

    def overlaps(self, start: int, end: int) -> bool:
        before = bisect_left(self.starts, end)
        return before > 0 and self.ends[before - 1] > start


def _shape(span: str) -> str:
    return re.sub(r"(.)\1+", r"\1+", re.sub(r"[^\W\d_]", "a", re.sub(r"[0-9]", "0", span[:60])))


def votes_on(kind: int, span: str, left: str, right: str, holds: bool | None) -> str:
    """One sign per labeler: ``+`` yes, ``-`` no, ``.`` nothing."""
    name = KINDS[kind]
    before = re.findall(r"[\w-]+", left.lower())[-4:]
    digits = sum(c.isdigit() for c in span)
    mixed = digits and digits < len(span)
    pattern = "." if holds is None else "+" if holds else "-"
    if name == "email":
        form, known = ("+" if "." in span else "."), ("+" if span.rpartition(".")[2].strip("-").lower() in DOMAINS or "dot" in span else "-")
    elif name == "ip":
        form, known = ("-" if right[:1] == "." and right[1:2].isdigit() else "+"), ("-" if span.startswith(("0.", "127.", "255.")) else ".")
    elif name == "card":
        form, known = ("+" if digits in (15, 16) else "-"), ("+" if span[0] in "3456" else "-")
    elif name == "phone":
        form, known = ("+" if re.search(r"[ ().-]", span) else "."), ("+" if span[0] in "+(" else ".")
    elif name == "name":
        form, known = ("+" if " " in span else "."), ("+" if span.split()[0].lower() in GIVEN_NAMES else ".")
    else:
        form, known = ("+" if mixed and len(set(span)) >= 10 else "-"), ("+" if re.fullmatch(r"[0-9a-f]{32,}|[A-Za-z0-9+/_-]{40,}", span) else ".")
    context = "+" if KIND_WORDS[name] & set(before) else "."
    against = "-" if before and before[-1] in AGAINST_WORDS else "."
    glued = "-" if left[-1:].isalnum() and span[:1].isalnum() or right[:1].isalnum() and span[-1:].isalnum() else "."
    return pattern + form + known + context + against + glued


def span_features(kind: int, span: str, left: str, right: str) -> list[int]:
    name, words = KINDS[kind], re.findall(r"[\w-]+", left.lower())[-2:]
    raw = [name, f"{name} shape {_shape(span)}", f"{name} length {min(len(span) // 4, 12)}", f"{name} left {left[-1:]!r}", f"{name} right {right[:1]!r}"]
    raw += [f"{name} word {w}" for w in words] + [f"{name} kinds {len(set(span)) // 4}"]
    return sorted({zlib.crc32(x.encode()) % FEATURES for x in raw})


def candidates(docs: DataFrame) -> DataFrame:
    """Per document row all candidate spans, with votes and features."""

    def make():
        def work(batch: pa.RecordBatch) -> dict[str, object]:
            spans = []
            for text in batch.column(1):
                text, here = text.as_py() or "", []
                exact = base_spans(text)
                kept = _Taken([(s, e) for _, s, e, holds in exact if holds])
                for kind, s, e, holds in exact + [(*x, None) for x in _loose(text)]:
                    if not holds and kept.overlaps(s, e):
                        continue
                    left, right = text[max(0, s - CONTEXT) : s], text[e : e + 2]
                    here.append((kind, s, e, bool(holds), votes_on(kind, text[s:e], left, right, holds), span_features(kind, text[s:e], left, right)))
                spans.append([dict(zip(SPAN.names, x)) for x in sorted(here, key=lambda x: (x[1], x[0]))])
            return {"doc_id": batch.column(0), "spans": spans}

        return work

    return arrow_rows(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), make, CANDIDATES)


def reliabilities(patterns: list[tuple[int, str, int]]) -> dict[tuple[int, str], float]:
    """EM over ``(kind, votes, count)``: the posterior of every pattern."""
    if not patterns:
        return {}
    kind = np.array([p[0] for p in patterns])
    vote = np.array([[{"+": 1, "-": -1, ".": 0}[c] for c in p[1]] for p in patterns])
    n = np.array([p[2] for p in patterns], dtype=float)
    post = 1 / (1 + np.exp(-1.5 * vote.sum(axis=1)))  # a majority vote to begin with
    for _ in range(EM_ROUNDS):
        prior = np.array([(1 + (n * post)[kind == k].sum()) / (2 + n[kind == k].sum()) for k in range(len(KINDS))])
        odds = np.log(prior / (1 - prior))[kind]
        for j in range(vote.shape[1]):
            v = vote[:, j]
            yes = {s: (1 + (n * post)[v == s].sum()) for s in (1, 0, -1)}
            no = {s: (1 + (n * (1 - post))[v == s].sum()) for s in (1, 0, -1)}
            ratio = {s: np.log(yes[s] / sum(yes.values())) - np.log(no[s] / sum(no.values())) for s in yes}
            odds = odds + np.array([ratio[s] for s in v.tolist()]) * (v != 0)
        post = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
    return {(p[0], p[1]): float(x) for p, x in zip(patterns, post)}


def train_classifier(rows: list[tuple[list[int], float]]) -> np.ndarray:
    """Logistic regression on soft labels; the last weight is the intercept."""
    w = np.zeros(FEATURES + 1)
    if not rows:
        return w
    flat = np.concatenate([np.array([*f, FEATURES]) for f, _ in rows])
    owner = np.repeat(np.arange(len(rows)), [len(f) + 1 for f, _ in rows])
    y, v = np.array([p for _, p in rows]), np.zeros_like(w)
    for _ in range(STEPS):
        p = 1 / (1 + np.exp(-np.clip(np.bincount(owner, w[flat], len(rows)), -30, 30)))
        g = np.bincount(flat, (y - p)[owner], len(w)) - 1e-2 * w
        v += g * g
        w += 0.3 * g / np.sqrt(v + 1e-8)
    return w


RESULT = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        *(T.StructField(f"n_{k}", T.LongType()) for k in KINDS[:4]),
        T.StructField("base_sha256", T.StringType()),
        T.StructField("spans", T.StringType()),
        T.StructField("n_added", T.LongType()),
    ]
)


def find_pii(docs: DataFrame) -> DataFrame:
    """The digest of every document row; candidates are kept once in the shared folder."""
    found = materialise(candidates(docs), "spans")
    each = found.select("doc_id", F.explode("spans").alias("s")).select("doc_id", "s.*")
    counts = each.groupBy("kind", "votes").count().collect()  # bounded: kinds times 3 ** labelers
    posterior = reliabilities(sorted((r["kind"], r["votes"], r["count"]) for r in counts))
    sample = each.select("kind", "votes", "features", F.xxhash64("doc_id", "start", "kind").alias("u"))
    rows = sorted((r["u"], r["features"], posterior[r["kind"], r["votes"]]) for r in sample.orderBy("u").limit(SAMPLE_SPANS).collect())
    weights = docs.sparkSession.sparkContext.broadcast(train_classifier([(f, p) for _, f, p in rows]))

    def make():
        w = weights.value

        def work(batch: pa.RecordBatch) -> dict[str, list]:
            out: dict[str, list] = {f: [] for f in RESULT.names}
            for doc_id, spans in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                base, every, n, last = [], [], [0] * len(KINDS), -1
                taken = _Taken([(s["start"], s["end"]) for s in spans if s["base"]])
                for s in spans:
                    text = f"{KINDS[s['kind']]}:{s['start']}:{s['end']}"
                    if s["base"]:
                        base.append(text)
                        every.append(text)
                        n[s["kind"]] += 1
                    elif w[s["features"]].sum() + w[FEATURES] > 0 and s["start"] >= last and not taken.overlaps(s["start"], s["end"]):
                        every.append(text)
                        last = s["end"]
                out["doc_id"].append(doc_id)
                for k in range(4):
                    out[f"n_{KINDS[k]}"].append(n[k])
                out["base_sha256"].append(hashlib.sha256(",".join(base).encode()).hexdigest())
                out["spans"].append(",".join(every))
                out["n_added"].append(len(every) - len(base))
            return out

        return work

    return arrow_rows(found, make, RESULT)
