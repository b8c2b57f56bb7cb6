"""Operator 12 against a search over all edits, and its damage against the plain rule."""

import collections
import hashlib
import heapq
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from shelfwise.llm import conversation_repair as R

SCHEMA = "conv_id long, turn long, role string, text string"
SPACE = " \t\n\x0b\x0c\r"
GRAMMAR = re.compile("(s?(ua)+)?")


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        show = [" " if x is None else str(x) for x in (conv, turn)]
        role, text = " " if role is None else role, " " if text is None else text
        k = zlib.crc32(":".join(show).encode()) % 20
        if k:
            text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
            out += [(conv, turn, "user" if k == 4 else role, text)] * (2 if k == 3 else 1)
    return out


def brute(rows):
    """Dijkstra over (rows done, role written last), keys (cost, audit); the text follows along."""
    digest = lambda r: hashlib.sha256(f"{len(r[2])}:{r[2]}{r[3]}".encode()).hexdigest()
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], digest(r)))
    faults, seen = [], set()
    for _, _, role, text in rows:
        body = text.strip(SPACE)
        faults.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    turns = [t for _, t, _, _ in rows if t is not None]
    initials = [r[2][:1] for r in rows]
    heap, done = [(0, "", 0, "0", ())], set()
    while heap:
        cost, audit, k, last, lines = heapq.heappop(heap)
        if (k, last) in done:
            continue
        done.add((k, last))
        if k == len(rows) and last in R.ENDS:
            break
        for q, name in R.NAMES.items():
            if q in R.AFTER[last]:
                heapq.heappush(heap, (cost + 3, audit + "I", k, q, (*lines, f"{name}:")))
        if k < len(rows):
            heapq.heappush(heap, (cost + 4, audit + "D", k + 1, last, lines))
            if faults[k] not in ("blank", "duplicate"):
                stays = 3 * (faults[k] == "truncated")
                for q in R.AFTER[last]:
                    if q == initials[k]:
                        heapq.heappush(heap, (cost + stays, audit + "K", k + 1, q, (*lines, f"{rows[k][2]}:{rows[k][3]}")))
                    elif q in R.NAMES:
                        heapq.heappush(heap, (cost + stays + 3, audit + "R", k + 1, q, (*lines, f"{R.NAMES[q]}:{rows[k][3]}")))
    assert GRAMMAR.fullmatch("".join(x[:1] for x in lines))
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    return (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def wanted(rows):
    groups = collections.defaultdict(list)
    for r in damaged(rows):
        groups[r[0]].append(r)
    return sorted(((c, *brute(groups[c])) for c in {r[0] for r in rows}), key=str)


def got(df):
    names = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    return sorted((tuple(r[c] for c in names) for r in df.collect()), key=str)


def some_rows():
    rng = random.Random(12)
    texts = ["Stone river.", "Seven windows!", "Is it so?", "cut off", " \n", "", "Ends here. \t", "Ümlaut\u0085", "a .", "x.\u0085", None]
    roles = ["user", "assistant", "system", "tool", "unknown", "", None, "sys"]
    rows = []
    for conv in range(150):
        for turn in range(rng.randint(1, 9)):
            role = rng.choice(roles) if rng.random() < 0.4 else ("assistant" if turn % 2 else "user")
            rows.append((conv, None if rng.random() < 0.05 else turn * rng.choice([1, 1, 2]), role, rng.choice(texts)))
    rows += [(None, t, "user", f"Null {t}.") for t in (0, 1, None)] + [(900, None, "user", "So.")] * 3
    return rows


@pytest.mark.parametrize("block, fan", [(64, 16), (2, 2), (1, 3)])
def test_repair_against_search(spark, monkeypatch, block, fan):
    monkeypatch.setattr(R, "BLOCK", block)
    monkeypatch.setattr(R, "FAN", fan)
    rows = some_rows()
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"conv": F.lit("x"), "at": F.lit(1), "kind": F.lit(0), "digest": F.lit("y")})
    assert got(R.damage_and_repair(df)) == wanted(rows)


def test_all_short_role_strings(spark):
    """Every conversation of up to four rows over five kinds of rows, undamaged."""
    kinds = [("system", "S."), ("user", "U."), ("assistant", "A."), ("user", "cut"), ("tool", "")]
    rows, conv = [], 0
    level = [()]
    for _ in range(4):
        level = [(*x, k) for x in level for k in range(5)]
        for x in level:
            rows += [(conv, t, kinds[k][0], f"{kinds[k][1][:1]}{t}{kinds[k][1][1:]}" if kinds[k][1] else "") for t, k in enumerate(x)]
            conv += 1
    groups = collections.defaultdict(list)
    for r in rows:
        groups[r[0]].append(r)
    want = sorted(((c, *brute(g)) for c, g in groups.items()), key=str)
    assert got(R.repair(spark.createDataFrame(rows, SCHEMA))) == want


def test_long_conversation_empty_table_and_dropped_rows(spark):
    rng = random.Random(1)
    rows = [(1, t, rng.choice(["user", "assistant"]), f"Turn {rng.randint(0, 400)}{rng.choice('.!?x')}") for t in range(700)]
    lone = next(c for c in range(5, 500) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    rows.append((lone, 0, "user", "Gone."))
    found = got(R.damage_and_repair(spark.createDataFrame(rows, SCHEMA)))
    assert found == wanted(rows)
    assert (lone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest()) in found
    assert got(R.damage_and_repair(spark.createDataFrame([], SCHEMA))) == []
