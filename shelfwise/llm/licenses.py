"""Licence scan: Dice coefficient over word bigrams, with size bounds.

Text is normalised to lower-case words.  A unit is a run of words, wherever it stands in a line or across
lines.  A unit with a bigrams and a template with b bigrams share at most min(a, b), so Dice 2 * shared / (a + b)
can reach the threshold t only if t / (2 - t) * b <= a <= (2 - t) / t * b, and then they share at least
t / (2 - t) * b.  A template with fewer of its bigrams in a text is never compared; where there are enough, a
window of the largest size slides over them with its shared count, and only starts whose window shares enough
are extended.  Bigrams count with repeats.  The work is linear in the length of a text.

Defined results: null or empty text and texts of one word match nothing; a very long text is read whole, by one
task; ties between templates go to the first one; of overlapping units the best one is kept, of equal ones the
longest, then the first; repeated rows are judged each for itself; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left, insort
from collections import Counter
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import arrow_rows
from .license_texts import TEMPLATES

THRESHOLD = 0.8
_WORD = re.compile(r"\w+")

MATCH = T.StructType(
    [
        T.StructField("license", T.StringType()),
        T.StructField("first_line", T.LongType()),
        T.StructField("last_line", T.LongType()),
        T.StructField("dice", T.DoubleType()),
    ]
)
RESULT = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("matches", T.ArrayType(MATCH))])


def bigrams(text: str) -> list[tuple[str, str]]:
    w = _WORD.findall(text.lower())
    return list(zip(w, w[1:]))


class Scanner:
    """Templates as bigram counts, and which of them have a bigram."""

    def __init__(self, templates=TEMPLATES, threshold: float = THRESHOLD):
        self.names = [name for name, _ in templates]
        self.counts = [Counter(bigrams(text)) for _, text in templates]
        self.sizes = [sum(c.values()) for c in self.counts]
        self.threshold = threshold
        self.low = [max(1, math.ceil(threshold / (2 - threshold) * n - 1e-9)) for n in self.sizes]
        self.high = [math.floor((2 - threshold) / threshold * n + 1e-9) for n in self.sizes]
        self.word = {w: i for i, w in enumerate(dict.fromkeys(w for c in self.counts for b in c for w in b))}
        code = lambda b: self.word[b[0]] * len(self.word) + self.word[b[1]]
        self.codes = np.array(sorted({code(b) for c in self.counts for b in c}), dtype=np.int64)
        place = {int(x): i for i, x in enumerate(self.codes)}
        #: how often each template has each bigram
        self.often = np.zeros((len(self.codes), len(self.names)), dtype=np.int64)
        for k, c in enumerate(self.counts):
            for b, n in c.items():
                self.often[place[code(b)], k] = n

    def _units(self, k: int, at: list[int], gram: list[int]) -> list[tuple[float, int, int, int]]:
        """For each start the best unit of template ``k``; ``at`` are the places of its bigrams in the text."""
        often, size, low, high, t = self.often[:, k].tolist(), self.sizes[k], self.low[k], self.high[k], self.threshold
        found, seen, shared, end = [], Counter(), 0, 0
        for i, start in enumerate(at):
            while end < len(at) and at[end] < start + high:
                seen[gram[end]] += 1
                shared += seen[gram[end]] <= often[gram[end]]
                end += 1
            if shared >= low:  # as many as the smallest unit must share
                own, have, best = Counter(), 0, None
                for j in range(i, end):
                    own[gram[j]] += 1
                    have += own[gram[j]] <= often[gram[j]]
                    n = at[j] - start + 1
                    if n >= low and 2 * have >= t * (n + size) - 1e-12:
                        dice = 2 * have / (n + size)
                        if best is None or dice > best[0]:
                            best = (dice, start, at[j] + 1, k)
                if best:
                    found.append(best)
            shared -= seen[gram[i]] <= often[gram[i]]
            seen[gram[i]] -= 1
        return found

    def scan(self, text: str) -> list[tuple[str, int, int, float]]:
        """``(licence, first line, last line, dice)`` of the units of a text."""
        every = [_WORD.findall(line) for line in text.lower().split("\n")]
        ids = np.fromiter((i for w in every for i in map(self.word.get, w, repeat(-1))), dtype=np.int64)
        if len(ids) < 2 or not len(self.codes):
            return []
        code = np.where((ids[:-1] >= 0) & (ids[1:] >= 0), ids[:-1] * len(self.word) + ids[1:], -1)
        gram = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
        at = np.flatnonzero(self.codes[gram] == code)
        gram = gram[at]
        has = self.often[gram] > 0
        found: list[tuple[float, int, int, int]] = []
        for k in np.flatnonzero(has.sum(axis=0) >= self.low):
            mine = has[:, k]
            found += self._units(int(k), at[mine].tolist(), gram[mine].tolist())
        taken: list[tuple[int, int, float, int]] = []  # apart from each other, by place
        for dice, a, b, k in sorted(found, key=lambda x: (-x[0], x[1] - x[2], x[1], x[3])):
            i = bisect_left(taken, (a,))
            if (i == 0 or taken[i - 1][1] < a) and (i == len(taken) or b < taken[i][0]):  # words, which neighbours would share
                insort(taken, (a, b, dice, k))
        line = np.repeat(np.arange(len(every)), [len(w) for w in every])
        return [(self.names[k], int(line[a]), int(line[b]), dice) for a, b, dice, k in taken]


def scan_licenses(docs: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, matches``: the licences in every text, with their lines and Dice coefficients."""

    def make():
        scanner = Scanner(templates, threshold)

        def work(batch: pa.RecordBatch) -> dict[str, object]:
            found = [scanner.scan(t.as_py() or "") for t in batch.column(1)]
            return {"doc_id": batch.column(0), "matches": [[dict(zip(MATCH.names, m)) for m in x] for x in found]}

        return work

    return arrow_rows(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), make, RESULT)
