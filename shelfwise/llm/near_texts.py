"""Near copies of texts: every pair whose sets of word shingles have a Jaccard of ``SIMILAR`` or more.

Operator 1 goes first: fingerprints of the texts' shingle sets link within ``MAX_BITS`` bits, and links are
verified on the shingles themselves.  A bit distance cannot bound a Jaccard, though: at 0.8 about ten of 64
bits differ, where partitions of the bits are too narrow to leave few candidates.  So the rest comes from a
prefix filter, which loses no pair.  Shingles have one order everywhere, frequent ones last.  Two sets of
Jaccard t or more share a shingle among the first n - ceil(t * n) + 1 of each, so texts that share
none are never compared.  Which shingles count as frequent is counted over all texts, batch by batch: the
order only decides how many candidates there are, never which pairs are found.  Texts with equal sets are
one node from the start, and a bucket is the nodes that have one shingle in their prefixes.

Buckets are emptied in rounds.  In each, the nodes of a bucket meet one leader, and buckets whose nodes are
all connected are done: near copies, which gather in buckets, cost a pair a node.  Nodes that are
still apart then meet inside their bucket and size class; a few candidates of each are verified first, and of
the others those that are not connected by then.  In both, a pair is a candidate only if its sizes,
what follows the shingle in both sets and the sets' parity maps allow the similarity: two maps differ in
no more bits than the sets in shingles, so this loses none.  Candidates are verified on the bytes of their shingles.

Defined results: words stand between ASCII white space, A-Z count as lower case; a text of fewer
words than a shingle is one shingle; texts without a word (null, empty, white space) are one group; a very
long text is read whole, by one task; of a group the row with the least doc_id stays (nulls last), and of
rows that are equal in doc_id and text one; other columns pass through; an empty table gives no rows.
"""

from __future__ import annotations

from functools import lru_cache, reduce
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ROW_KEY, arrow_rows, materialise, row_key
from .components import connected_components
from .simhash import LOWER, MAX_BITS, fold
from .simhash import near_links as fingerprint_links

#: Words of a shingle, and the least Jaccard as a fraction.
SHINGLE, SIMILAR = 5, (4, 5)
#: Texts of a batch that make a shingle frequent, and shingles that are put last (the most frequent ones).
FREQUENT, PUT_LAST = 4, 100_000
#: Rounds of leaders, candidates of a node that are verified before its others, 64-bit words of a parity map, and
#: pairs that bring one copy of a node's text with them.
ROUNDS, FIRST_PAIRS, MAP_WORDS, PAIRS_A_COPY = 1, 8, 4, 256
#: Nodes of candidates are broadcast up to so many bytes, so that other texts are not shuffled.
BROADCAST_BYTES, NODE_BYTES = 32_000_000, 40

PREFIXES = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("row_key", ROW_KEY, False),
        T.StructField("node", T.LongType()),
        T.StructField("key", T.BinaryType()),
        T.StructField("n", T.LongType()),
        T.StructField("fp", T.LongType()),
        T.StructField("map", T.ArrayType(T.LongType())),
        T.StructField("prefix", T.ArrayType(T.LongType())),
    ]
)
LINKS = T.StructType([T.StructField(c, T.LongType()) for c in ("a", "b")])


def shingles(text: bytes | None, size: int = SHINGLE) -> list[bytes]:
    w = (text or b"").translate(LOWER).split()
    return list(map(b" ".join, zip(*(w[i:] for i in range(size))))) if len(w) > size else [b" ".join(w)] if w else []


def _hashes(text: bytes | None, size: int) -> np.ndarray:
    from xxhash import xxh64_intdigest

    return np.unique(np.array([xxh64_intdigest(s) for s in shingles(text, size)], dtype=np.uint64))


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long"), row_key().alias("row_key"), F.col("text").cast("binary").alias("text"))


def frequent(docs: DataFrame, shingle: int = SHINGLE) -> np.ndarray:
    """Hashes of shingles that many texts of some batch have, by their number over all texts, sorted."""

    def make():
        def work(batch: pa.RecordBatch) -> dict[str, object] | None:
            found = [_hashes(t.as_py(), shingle) for t in batch.column(0).unique()]
            if not found:
                return None
            token, n = np.unique(np.concatenate(found), return_counts=True)
            return {"token": token[n >= FREQUENT].view(np.int64), "n": n[n >= FREQUENT]}

        return work

    tokens = arrow_rows(_texts(docs).select("text"), make, T.StructType([T.StructField(c, T.LongType()) for c in ("token", "n")]))
    many = tokens.groupBy("token").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "token").limit(PUT_LAST)
    return np.sort(np.array([r.token for r in many.collect()], dtype=np.int64).view(np.uint64))


def prefixes(docs: DataFrame, last: np.ndarray, *, shingle: int = SHINGLE, similar: tuple[int, int] = SIMILAR) -> DataFrame:
    """For every row the 128-bit key, size, fingerprint and parity map of its set of shingles and the set's prefix,
    in which ``last`` come last; ``node`` is half of the key."""

    def make():
        from xxhash import xxh3_128_digest

        def work(batch: pa.RecordBatch) -> dict[str, object]:
            keys, sizes, maps, firsts, fps = [], [], [], [], [np.zeros(0, dtype=np.int64)]
            for text in batch.column(2):
                own = _hashes(text.as_py(), shingle)
                n = len(own)
                keys.append(xxh3_128_digest(own.tobytes()))
                sizes.append(n)
                fps.append(fold(own, [n]))
                odd = np.bincount((own % np.uint64(64 * MAP_WORDS)).astype(np.int64), minlength=64 * MAP_WORDS) % 2
                maps.append(np.packbits(odd.astype(np.uint8)).view(np.int64))
                most = n + (-similar[0] * n) // similar[1] + 1 if n else 0  # n - ceil(t * n) + 1
                late = last[np.searchsorted(last[:-1], own)] == own if len(last) else np.zeros(n, dtype=bool)
                firsts.append(np.concatenate([own[~late], own[late]])[:most].view(np.int64))
            lengths = np.cumsum([0, *map(len, firsts)])
            prefix = pa.ListArray.from_arrays(pa.array(lengths, pa.int32()), pa.array(np.concatenate(firsts) if firsts else [], pa.int64()))
            node = np.frombuffer(b"".join(keys), dtype="<i8")[::2]
            return {"doc_id": batch.column(0), "row_key": batch.column(1), "node": node, "key": keys, "n": sizes, "fp": np.concatenate(fps), "map": maps, "prefix": prefix}

        return work

    return arrow_rows(_texts(docs), make, PREFIXES)


def verified(pairs: DataFrame, texts: DataFrame, *, shingle: int = SHINGLE, similar: tuple[int, int] = SIMILAR) -> DataFrame:
    """Those of ``pairs (a, b)`` that are similar; ``texts (node, text)`` has a row for each node.

    The text of ``b`` goes to its pair, and that of ``a`` once to each group of its pairs, so a node with very
    many pairs is no burden for one task.
    """

    def make():
        of = lru_cache(16)(lambda text: frozenset(shingles(text, shingle)))

        def work(batch: pa.RecordBatch) -> dict[str, object]:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = of(x.as_py()), of(y.as_py())
                both = len(x & y)
                keep.append(both * similar[1] >= similar[0] * (len(x) + len(y) - both))
            return {c: batch.column(i).filter(pa.array(keep, pa.bool_())) for i, c in enumerate("ab")}

        return work

    groups = pairs.groupBy("a").agg(F.ceil(F.count("*") / PAIRS_A_COPY).alias("groups"))
    pairs = pairs.join(groups, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.col("groups")).alias("group"))
    x, y = (texts.select(F.col("node").alias(c), F.col("text").alias(f"text_{c}")) for c in "ab")
    heads = pairs.select("a", "group").distinct().join(x, "a")
    both = pairs.join(y, "b").join(heads, ["a", "group"])
    return arrow_rows(both.select("a", "b", "text_a", "text_b"), make, LINKS)


def near_links(docs: DataFrame, rows: DataFrame, *, shingle: int = SHINGLE, similar: tuple[int, int] = SIMILAR) -> DataFrame:
    """Links ``(a, b)`` between nodes of ``rows`` that keep every group of similar texts together."""
    t, how = similar[0] / similar[1], {"shingle": shingle, "similar": similar}
    # operator 1: nodes with near fingerprints, and one link from each to another node of the same fingerprint
    marks = materialise(rows.select("fp", "node").distinct(), "marks")
    heads = materialise(marks.groupBy("fp").agg(F.min("node").alias("head")), "heads")
    near_heads = fingerprint_links(heads, MAX_BITS)
    ends = (heads.select(F.col("fp").alias(c), F.col("head").alias(f"node_{c}")) for c in "ab")
    near_heads = near_heads.join(next(ends), "a").join(next(ends), "b").select(F.col("node_a").alias("a"), F.col("node_b").alias("b"))
    same = marks.join(heads, "fp").where(F.col("node") != F.col("head")).select(F.col("head").alias("a"), F.col("node").alias("b"))
    sketched = materialise(near_heads.unionByName(same).distinct(), "sketched")
    some = (F.any_value(c).alias(c) for c in ("n", "map", "prefix"))
    nodes = materialise(rows.groupBy("node").agg(F.min("row_key").alias("row_key"), *some), "nodes")
    size_class = F.floor(F.log("n") / max(-log(t), 0.001))  # sizes of similar sets are of one class or two adjoining ones
    facts = nodes.select("node", "n", size_class.alias("class"), "map")
    tokens = nodes.select(F.posexplode("prefix").alias("pos", "token"), "node")
    shared = materialise(tokens.groupBy("token").agg(F.count("*").alias("size")).where("size > 1").select("token"), "shared")
    members = tokens.join(shared, "token").join(facts, "node")

    def checked(pairs: DataFrame) -> DataFrame:
        """Similar ones of candidate pairs."""
        wanted = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct().join(nodes.select("node", "row_key"), "node")
        wanted = materialise(wanted, "wanted")
        if wanted.count() * NODE_BYTES <= BROADCAST_BYTES:
            wanted = F.broadcast(wanted)
        texts = _texts(docs).select("row_key", "text").join(wanted, "row_key")
        return verified(pairs, texts.dropDuplicates(["node"]).select("node", "text"), **how)

    def alike(x: str, y: str) -> Column:
        """What the facts of two nodes of one bucket allow.

        The first shingle that two similar sets share is followed by the rest of what they share.
        """
        (x_n, y_n), (x_pos, y_pos), (x_map, y_map) = ((F.col(f"{x}.{c}"), F.col(f"{y}.{c}")) for c in ("n", "pos", "map"))
        fits = F.least(x_n, y_n) >= t * F.greatest(x_n, y_n) - 1e-6
        follows = F.least(x_n - x_pos, y_n - y_pos) >= t / (1 + t) * (x_n + y_n) - 1e-6
        differ = reduce(Column.__add__, (F.bit_count(x_map[i].bitwiseXOR(y_map[i])) for i in range(MAP_WORDS)))
        return fits & follows & (differ <= (1 - t) / (1 + t) * (x_n + y_n) + 1e-6)

    def apart(k: int) -> DataFrame:
        """Members of the buckets whose nodes are not all connected yet, with their component and a leader."""
        joined = members.join(connected_components(links), "node", "left").withColumn("component", F.coalesce("component", "node"))
        leader = F.min_by(F.struct("node", "n", "pos", "map", "component"), F.xxhash64("node", F.lit(k))).alias("leader")
        ends = joined.groupBy("token").agg(F.min("component").alias("low"), F.max("component").alias("high"), leader)
        return materialise(joined.join(ends.where("low < high").select("token", "leader"), "token"), "apart")

    def still_apart(pairs: DataFrame) -> DataFrame:
        of = connected_components(links)
        ends = (of.select(F.col("node").alias(c), F.col("component").alias(f"of_{c}")) for c in "ab")
        joined = pairs.join(next(ends), "a", "left").join(next(ends), "b", "left")
        return joined.where(F.coalesce("of_a", "a") != F.coalesce("of_b", "b")).select("a", "b")

    links = materialise(checked(sketched), "similar")
    for k in range(ROUNDS):
        met = apart(k)
        members = met.drop("component", "leader")
        stars = met.withColumn("own", F.struct("node", "n", "pos", "map", "component")).where(F.col("own.component") != F.col("leader.component"))
        stars = stars.where(alike("own", "leader")).select(F.col("leader.node").alias("a"), F.col("own.node").alias("b"))
        stars = materialise(stars.distinct(), "pairs")
        if stars.isEmpty():
            break
        links = materialise(links.unionByName(checked(stars)), "similar")
    met = apart(ROUNDS).select("token", "class", F.struct("node", "n", "pos", "map", "component").alias("x"))
    y = met.withColumnRenamed("x", "y")
    x = met.select("token", F.explode(F.array("class", F.col("class") + 1)).alias("class"), F.col("class").alias("own"), "x")
    once = (F.col("own") < F.col("class")) | (F.col("x.node") < F.col("y.node"))
    pairs = x.join(y, ["token", "class"]).where((F.col("x.component") != F.col("y.component")) & once & alike("x", "y"))
    pairs = materialise(pairs.select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct(), "pairs")
    order = Window.partitionBy("a").orderBy(F.xxhash64("b"), "b")
    firsts = materialise(pairs.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= FIRST_PAIRS).select("a", "b"), "firsts")
    links = materialise(links.unionByName(checked(firsts)), "similar")
    others = materialise(still_apart(pairs.join(firsts, ["a", "b"], "left_anti")), "others")
    return links if others.isEmpty() else materialise(links.unionByName(checked(others)), "similar")


def keep_one_each(docs: DataFrame, *, shingle: int = SHINGLE, similar: tuple[int, int] = SIMILAR) -> DataFrame:
    """One row of ``docs`` for each group of similar texts: the one with the least doc_id (nulls last), unchanged."""
    rows = materialise(prefixes(docs, frequent(docs, shingle), shingle=shingle, similar=similar), "prefixes")
    member = connected_components(near_links(docs, rows, shingle=shingle, similar=similar))
    keyed = rows.select("doc_id", "row_key", "node", "key")
    grouped = keyed.join(member, "node", "left").withColumn("component", F.coalesce("component", "node"))
    order = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row_key"))
    keep = grouped.groupBy("component").agg(order.alias("first")).select(F.col("first.row_key").alias("__near_key"))
    # sets of different keys that share a node by chance were not compared: one row of each stays
    mixed = keyed.groupBy("node").agg(F.min("key").alias("one"), F.max("key").alias("other")).where("one <> other").select("node")
    strays = keyed.join(mixed, "node", "left_semi").groupBy("key").agg(order.alias("first")).select(F.col("first.row_key").alias("__near_key"))
    keep = keep.unionByName(strays).distinct()
    kept = docs.withColumn("__near_row", row_key()).join(keep, F.col("__near_row") == F.col("__near_key"), "left_semi")
    return kept.dropDuplicates(["__near_row"]).drop("__near_row")
