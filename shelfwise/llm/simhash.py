"""SimHash near-duplicates by the generalised pigeonhole principle.

64-bit fingerprints link if they differ in at most ``max_bits`` bits.  The bits are grouped by
correlation into m partitions with thresholds t_1..t_m, each -1 (not probed) or more, whose
(t_i + 1) sum to max_bits + 1: a linked pair then agrees up to t_i bits in at least one probed
partition.  Widths and thresholds come from a dynamic program over estimated probes and
candidates, from one- and two-bit counts over all distinct fingerprints.  Equal fingerprints are
one node from the start.

The nodes of a bucket are verified by the cheaper of two exact ways, which find the same groups.  Candidate
pairs cost half the bucket's nodes for each node.  Where near copies crowd, that would grow with the square,
and the second level of the plan takes over: one partition of all bits with threshold ``max_bits``, probed
from both sides with half of the changed bits each, which costs a fixed number of probes a node.  Two
fingerprints are within r + q bits if and only if one's r-bit probes meet the other's q-bit probes; all
that meet in a probe are linked to the least of it.

Defined results: null or empty text, or white space alone, has fingerprint zero; a very long text is
read whole, by one task; a null doc_id gets its group's component; a group of null doc_ids alone has a
null component; repeated rows share a group; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import arrow_rows, materialise
from .components import connected_components

SHINGLE = 3
MAX_BITS = 2
SEED = 42
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))

FINGERPRINTS = T.StructType([T.StructField(c, T.LongType()) for c in ("doc_id", "fp")])


def fold(hashes: list[int], counts: list[int]) -> np.ndarray:
    """A fingerprint of each run of hashes: a bit is set if it is in over half of them."""
    n = np.array(counts, dtype=np.int64)
    out = np.zeros((len(n), 64), dtype=np.uint8)
    full = np.flatnonzero(n)
    if len(full):
        bits = np.unpackbits(np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        starts = np.concatenate([[0], np.cumsum(n[full])[:-1]])
        ones = np.add.reduceat(bits, starts, axis=0, dtype=np.int32)
        out[full] = 2 * ones > n[full, None]
    return np.packbits(out, axis=1, bitorder="little").view("<i8").ravel()


def fingerprints(docs: DataFrame, *, shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """``(doc_id, fp)`` of whole texts: words between ASCII white space, A-Z in lower case."""

    def make():
        from xxhash import xxh64_intdigest

        def work(batch: pa.RecordBatch) -> dict[str, object]:
            fps, hashes, counts = [], [], []
            for text in batch.column(1):
                w = (text.as_py() or b"").translate(LOWER).split()
                if len(w) > shingle:
                    got = [xxh64_intdigest(s, seed) for s in map(b" ".join, zip(*(w[i:] for i in range(shingle))))]
                else:
                    got = [xxh64_intdigest(b" ".join(w), seed)] if w else []
                hashes += got
                counts.append(len(got))
                if len(hashes) > 100_000:
                    fps.append(fold(hashes, counts))
                    hashes, counts = [], []
            fps.append(fold(hashes, counts))
            return {"doc_id": batch.column(0), "fp": np.concatenate(fps)}

        return work

    return arrow_rows(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("text")), make, FINGERPRINTS)


def bit_counts(nodes: DataFrame) -> tuple[int, np.ndarray]:
    """How many nodes there are, and in how many of them bits i and j are both set, over all nodes."""
    schema = T.StructType([T.StructField(c, T.LongType()) for c in ("i", "j", "n", "rows")])

    def make():
        i, j = (x.ravel() for x in np.indices((64, 64)))

        def work(batch: pa.RecordBatch) -> dict[str, object]:
            bits = np.unpackbits(batch.column(0).to_numpy().view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
            return {"i": i, "j": j, "n": (bits.T @ bits).astype(np.int64).ravel(), "rows": np.full(4096, len(bits))}

        return work

    counts, total = np.zeros((64, 64)), 0
    for r in arrow_rows(nodes.select("fp"), make, schema).groupBy("i", "j").agg(F.sum("n"), F.sum("rows")).collect():
        counts[r[0], r[1]], total = r[2], r[3]
    return total, counts


def _within(agree: np.ndarray, effective: float, most: int) -> np.ndarray:
    """Estimated chance that two nodes differ in at most 0..most bits of a partition."""
    spread = np.zeros(most + 1)
    spread[0] = 1.0
    for a in agree ** (effective / len(agree)):
        spread[1:], spread[0] = spread[1:] * a + spread[:-1] * (1 - a), spread[0] * a
    return np.cumsum(spread)


def plan_partitions(total: int, counts: np.ndarray, max_bits: int = MAX_BITS) -> list[tuple[list[int], int]]:
    """``(bits, threshold)`` of each probed partition, at the least estimated cost."""
    p = counts.diagonal() / max(total, 1)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-9))
    corr = np.abs((counts / max(total, 1) - np.outer(p, p)) / np.outer(spread, spread))
    np.fill_diagonal(corr, 1.0)
    agree = p**2 + (1 - p) ** 2
    best: tuple[float, list] = (np.inf, [])
    for m in range(1, max_bits + 3):
        left, parts = set(range(64)), []
        for k in range(m):
            width = round(64 * (k + 1) / m) - round(64 * k / m)
            part = [max(sorted(left), key=lambda b: corr[b, sorted(left)].sum())]
            left.discard(part[0])
            while len(part) < width:  # the bit that goes best with those already here
                b = max(sorted(left), key=lambda b: corr[b, part].sum())
                part.append(b)
                left.discard(b)
            parts.append(sorted(part))
        cost = []
        for part in parts:
            own = corr[np.ix_(part, part)]
            effective = len(part) ** 2 / (own**2).sum()
            chance = _within(agree[part], effective, max_bits)
            probes = np.cumsum([float(comb(len(part), t)) for t in range(max_bits + 1)])
            cost.append([0.0, *(probes + total * chance)])  # of thresholds -1, 0, 1, ...
        # least[s]: the cheapest way for the partitions so far to have (t + 1) sum to s
        least: list[tuple[float, list[int]]] = [(0.0, [])] + [(np.inf, [])] * (max_bits + 1)
        for c in cost:
            least = [
                min((least[s - t][0] + c[t], [*least[s - t][1], t - 1]) for t in range(min(s, max_bits + 1) + 1))
                for s in range(max_bits + 2)
            ]
        if least[-1][0] < best[0]:
            best = (least[-1][0], [(part, t) for part, t in zip(parts, least[-1][1]) if t >= 0])
    return best[1]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _keys(part: list[int], flips: int):
    """The key of a partition, and its neighbours up to ``flips`` changed bits, as an array column."""
    key = F.col("fp").bitwiseAND(F.lit(_signed(sum(1 << b for b in part))))
    changes = [0]
    for _ in range(flips):
        changes = sorted({c ^ (1 << b) for c in changes for b in part} | set(changes))
    return F.array(*(key.bitwiseXOR(F.lit(_signed(c))) for c in changes))


def _probes(bits: int) -> list[int]:
    """Changes of up to so many of all 64 bits."""
    return [_signed(sum(1 << b for b in c)) for k in range(bits + 1) for c in combinations(range(64), k)]


def near_links(nodes: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Links ``(a, b)``, each within ``max_bits``, that keep every group within ``max_bits`` together."""
    plan = plan_partitions(*bit_counts(nodes), max_bits)

    def probes(flips: bool) -> DataFrame:
        each = [
            nodes.select("fp", F.lit(k).alias("part"), F.explode(_keys(part, t if flips else 0)).alias("key"))
            for k, (part, t) in enumerate(plan)
        ]
        return reduce(DataFrame.unionByName, each)

    wide = any(t for _, t in plan)
    sizes = probes(wide).groupBy("part", "key").agg(F.count("*").alias("size")).where("size > 1")
    asked = materialise(probes(wide).join(sizes, ["part", "key"]), "buckets")
    stored = asked if not wide else probes(False).join(sizes, ["part", "key"])
    less, more = _probes(max_bits // 2), _probes(max_bits - max_bits // 2)
    crowded = F.col("size") > 2 * len(more)  # half of the nodes as pairs cost more than the probes
    x = asked.where(~crowded).select("part", "key", F.col("fp").alias("a"))
    y = stored.where(~crowded).select("part", "key", F.col("fp").alias("b"))
    apart = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    pairs = x.join(y, ["part", "key"]).where((F.col("a") < F.col("b")) & (apart <= max_bits)).select("a", "b")

    def around(changes: list[int]) -> DataFrame:
        return crowd.select("fp", F.explode(F.array(*(F.col("fp").bitwiseXOR(F.lit(c)) for c in changes))).alias("mid"))

    crowd = materialise(asked.where(crowded).select("fp").distinct(), "crowd")
    least = around(less).groupBy("mid").agg(F.min("fp").alias("b"))
    stars = around(more).join(least, "mid").where(F.col("fp") != F.col("b")).select(F.col("fp").alias("a"), "b")
    return pairs.unionByName(stars).distinct()


def near_duplicates(docs: DataFrame, *, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every row of ``docs``."""
    fps = materialise(fingerprints(docs, shingle=shingle), "fingerprints")
    nodes = materialise(fps.groupBy("fp").agg(F.min("doc_id").alias("least_doc")), "nodes")
    member = connected_components(near_links(nodes, max_bits)).withColumnRenamed("node", "fp")
    grouped = nodes.join(member, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    least = grouped.groupBy("component").agg(F.min("least_doc").alias("component_id"))
    named = grouped.join(least, "component").select("fp", "component_id")
    fingerprint = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return fps.join(named, "fp").select("doc_id", fingerprint, "component_id")
