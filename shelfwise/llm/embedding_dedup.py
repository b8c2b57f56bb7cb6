"""Embedding near-duplicates: tiled comparison in PCA order with suffix-norm bounds.

Unit vectors are turned into the eigenbasis of their second moments, which a small sum over all
vectors gives.  They are cut into tiles along the first axis, and runs of tiles into bands.  A task compares
two bands, so that a tile is shuffled once for each band and not for each tile.  Two tiles meet only if
their boxes along the leading axes come close enough.  Within a pair of tiles, the dot product over the
leading axes plus the product of the norms of what is left bounds the cosine, and one matrix product gives
that bound for all pairs; for what stays above the threshold the dot product is accumulated over further
axes, and, in the end, compared exactly in double precision.  Equal vectors are one node with a weight.  A
pair of bands returns a row per linked vector (its links and a label), never a row per link.

Defined results: null, empty or zero vectors and those with null or non-finite components link with
nothing; shorter vectors count as filled up with zeros; repeated rows are vectors of their own; a
null vec_id takes part and has its component's id; a cosine equal to the threshold links; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import arrow_rows, materialise
from .components import connected_components

THRESHOLD = 0.9
#: Vectors of a tile, about; and bins along the first axis (the driver holds a count of each).
TILE, BINS = 2048, 4096
#: Vectors of a band, about, and bytes of it in double precision.
BAND, BAND_BYTES = 16_384, 64_000_000
#: Axes that a step of the accumulation adds.
STEP = 16
#: Leading axes whose box a tile keeps.
BOX = 4
#: Allowance for rounding in bounds; pairs within it are compared exactly.
SLACK = 1e-9


def unit_rows(flat: np.ndarray, sizes: np.ndarray, width: int) -> np.ndarray:
    """Rows of length one in double precision, filled up with zeros to ``width``."""
    x = np.zeros((len(sizes), width))
    x[np.arange(width)[None, :] < sizes[:, None]] = flat
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _units(column: pa.Array, width: int) -> np.ndarray:
    sizes = np.asarray(column.value_lengths())
    return unit_rows(np.asarray(column.flatten(), dtype=np.float64), sizes, width)


def principal_axes(nodes: DataFrame, width: int) -> np.ndarray:
    """Eigenvectors of the second moments of all unit vectors, largest first."""
    schema = T.StructType([T.StructField("i", T.IntegerType()), T.StructField("row", T.ArrayType(T.DoubleType()))])

    def make():
        def work(batch: pa.RecordBatch) -> dict[str, list]:
            x = _units(batch.column(0), width)
            return {"i": np.arange(width, dtype=np.int32), "row": list(x.T @ x)}

        return work

    sums = (
        arrow_rows(nodes.select("v"), make, schema)
        .select("i", F.posexplode("row").alias("j", "x"))
        .groupBy("i", "j")
        .agg(F.sum("x").alias("x"))
        .groupBy("i")
        .agg(F.transform(F.array_sort(F.collect_list(F.struct("j", "x"))), lambda e: e["x"]).alias("row"))
    )
    moments = np.zeros((width, width))
    for r in sums.collect():  # width rows
        moments[r["i"]] = r["row"]
    return np.linalg.eigh((moments + moments.T) / 2)[1][:, ::-1]


def _raw(column: pa.Array, width: int) -> np.ndarray:
    """Components as they are given, filled up with zeros."""
    flat, sizes = np.asarray(column.flatten()), np.asarray(column.value_lengths())
    x = np.zeros((len(sizes), width), dtype=flat.dtype)
    x[np.arange(width)[None, :] < sizes[:, None]] = flat
    return x


def _tiles(nodes: DataFrame, axes: np.ndarray, width: int) -> DataFrame:
    """Packed tiles ``(tile, band, low, high, node, weight, raw)``; ``raw`` keeps the given precision."""
    first = axes[:, 0]

    def make_bins():
        def work(batch: pa.RecordBatch) -> dict[str, object]:
            at = ((_units(batch.column(2), width) @ first + 1) * (BINS / 2)).astype(np.int64)
            return {"node": batch.column(0), "weight": batch.column(1), "v": batch.column(2), "bin": np.clip(at, 0, BINS - 1)}

        return work

    schema = T.StructType([*(nodes.schema[c] for c in ("node", "weight", "v")), T.StructField("bin", T.LongType())])
    binned = materialise(arrow_rows(nodes.select("node", "weight", "v"), make_bins, schema), "binned")
    counts = {r["bin"]: r["count"] for r in binned.groupBy("bin").count().collect()}
    size, number, plan = 0, -1, []  # bins with the number of their first tile and of their tiles
    for b in sorted(counts):
        if counts[b] > TILE:  # a full bin has tiles of its own
            plan.append((b, number + 1, math.ceil(counts[b] / TILE)))
            number += plan[-1][2]
            size = TILE
        else:
            if number < 0 or size + counts[b] > TILE:
                number, size = number + 1, 0
            size += counts[b]
            plan.append((b, number, 1))
    runs = nodes.sparkSession.createDataFrame(plan, "bin long, begin long, tiles long")  # BINS rows at most
    numbered = binned.join(F.broadcast(runs), "bin").select(
        (F.col("begin") + F.pmod(F.xxhash64("node"), F.col("tiles"))).alias("tile"), "node", "weight", "v"
    )
    tiles_a_band = max(1, min(BAND, BAND_BYTES // (8 * width)) // TILE)
    packed = T.StructType(
        [
            T.StructField("tile", T.LongType()),
            T.StructField("band", T.LongType()),
            T.StructField("low", T.ArrayType(T.DoubleType())),
            T.StructField("high", T.ArrayType(T.DoubleType())),
            T.StructField("node", T.BinaryType()),
            T.StructField("weight", T.BinaryType()),
            T.StructField("raw", T.BinaryType()),
        ]
    )
    lead = axes[:, :BOX]

    def pack(table: pa.Table) -> pa.Table:
        from pyspark.sql.pandas.types import to_arrow_schema

        table = table.combine_chunks()
        v = table.column("v").chunk(0)
        y = _units(v, width) @ lead
        tile = table.column("tile")[0].as_py()
        row = {
            "tile": tile,
            "band": tile // tiles_a_band,
            "low": (y.min(axis=0) - SLACK).tolist(),
            "high": (y.max(axis=0) + SLACK).tolist(),
            "node": table.column("node").to_numpy().astype(np.int64).tobytes(),
            "weight": table.column("weight").to_numpy().astype(np.int64).tobytes(),
            "raw": _raw(v, width).tobytes(),
        }
        return pa.Table.from_pylist([row], schema=to_arrow_schema(packed))

    return materialise(numbered.groupBy("tile").applyInArrow(pack, packed), "tiles")


def _tile_pairs(tiles: DataFrame, threshold: float) -> DataFrame:
    """``(band_i, band_j, i, j)``, i <= j, of tiles whose boxes are near enough for one link."""
    reach = math.sqrt(max(0.0, 2 - 2 * threshold)) + SLACK
    step = max(reach, 1e-3)
    box = tiles.select("tile", "band", "low", "high")
    cell = lambda c: F.floor(c / step)
    here = box.select(F.col("tile").alias("i"), F.col("band").alias("band_i"), F.col("low").alias("a"), F.col("high").alias("b"), F.explode(F.sequence(cell(F.col("low")[0]), cell(F.col("high")[0]))).alias("cell"))
    near = box.select(F.col("tile").alias("j"), F.col("band").alias("band_j"), F.col("low").alias("c"), F.col("high").alias("d"), F.explode(F.sequence(cell(F.col("low")[0] - reach), cell(F.col("high")[0] + reach))).alias("cell"))
    gaps = F.zip_with(
        F.zip_with("a", "b", lambda lo, hi: F.struct(lo.alias("lo"), hi.alias("hi"))),
        F.zip_with("c", "d", lambda lo, hi: F.struct(lo.alias("lo"), hi.alias("hi"))),
        lambda x, y: F.greatest(F.lit(0.0), x["lo"] - y["hi"], y["lo"] - x["hi"]),
    )
    square = F.aggregate(gaps, F.lit(0.0), lambda s, g: s + g * g)
    return here.join(near, "cell").where((F.col("i") <= F.col("j")) & (square <= reach * reach)).select("band_i", "band_j", "i", "j").distinct()


def links_between(x: np.ndarray, y: np.ndarray, a: np.ndarray, b: np.ndarray, threshold: float, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of all pairs with cosine >= threshold; of one tile with itself each pair once.

    ``a`` and ``b`` are the unit rows ``x`` and ``y`` along the axes.
    """
    width = a.shape[1]
    lead = next((k for k in range(8, width, 8) if (a[:, :k] ** 2).sum() >= 0.5 * len(a)), width)
    rest = lambda z, k: np.sqrt(np.maximum(0.0, (z[:, k:] ** 2).sum(axis=1)))
    bound = np.column_stack([a[:, :lead], rest(a, lead)]) @ np.column_stack([b[:, :lead], rest(b, lead)]).T
    if same:
        bound[np.tril_indices(len(a))] = -2
    r, c = np.nonzero(bound >= threshold - SLACK)
    dot = bound[r, c] - rest(a, lead)[r] * rest(b, lead)[c]  # over the axes so far
    del bound
    for k in range(lead, width, STEP):
        if not len(r):
            break
        end = min(k + STEP, width)
        left_a, left_b = rest(a, end), rest(b, end)
        keep = np.zeros(len(r), dtype=bool)
        for s in range(0, len(r), 100_000):
            p, q = r[s : s + 100_000], c[s : s + 100_000]
            dot[s : s + 100_000] += np.einsum("ij,ij->i", a[p, k:end], b[q, k:end])
            keep[s : s + 100_000] = dot[s : s + 100_000] + left_a[p] * left_b[q] >= threshold - SLACK
        r, c, dot = r[keep], c[keep], dot[keep]
    keep = np.zeros(len(r), dtype=bool)
    for s in range(0, len(r), 100_000):
        p, q = r[s : s + 100_000], c[s : s + 100_000]
        keep[s : s + 100_000] = np.einsum("ij,ij->i", x[p], y[q]) >= threshold
    return r[keep], c[keep]


def _labels(n: int, r: np.ndarray, c: np.ndarray) -> np.ndarray:
    """The least number that is reachable from each of n nodes over links (r, c)."""
    label = np.arange(n)
    while True:
        least = np.minimum(label[r], label[c])
        new = label.copy()
        np.minimum.at(new, r, least)
        np.minimum.at(new, c, least)
        new = new[new]
        if (new == label).all():
            return label
        label = new


FOUND = T.StructType([T.StructField(c, T.LongType()) for c in ("node", "links", "label")])


def find_links(nodes: DataFrame, width: int, threshold: float = THRESHOLD) -> DataFrame:
    """``(node, links, label)`` per pair of bands: weight of linked nodes, and a node linked in some way."""
    from pyspark.sql.pandas.types import to_arrow_schema

    axes = principal_axes(nodes, width)
    tiles = _tiles(nodes, axes, width)
    pairs = _tile_pairs(tiles, threshold).groupBy("band_i", "band_j").agg(F.collect_list(F.struct("i", "j")).alias("pairs"))  # of two bands
    bands = pairs.select(F.col("band_i").alias("x"), F.col("band_j").alias("y"), F.explode(F.array_distinct(F.array("band_i", "band_j"))).alias("band"))
    kind = np.float32 if isinstance(nodes.schema["v"].dataType.elementType, T.FloatType) else np.float64
    target = to_arrow_schema(FOUND)

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        """The tiles of two bands, and which of them meet."""
        at, parts, total = {}, [], 0
        for t in left.to_pylist():
            x = unit_rows(np.frombuffer(t["raw"], dtype=kind).astype(np.float64), np.full(len(t["node"]) // 8, width), width)
            at[t["tile"]] = (total, x, x @ axes)
            parts.append((np.frombuffer(t["node"], dtype=np.int64), np.frombuffer(t["weight"], dtype=np.int64)))
            total += len(x)
        if not parts or not right.num_rows:
            return target.empty_table()
        node, weight = (np.concatenate(z) for z in zip(*parts))
        links, ends = np.zeros(total, dtype=np.int64), [np.zeros((0, 2), dtype=np.int64)]
        for pair in right.column("pairs").to_pylist()[0]:
            (s, x, a), (e, y, b) = at[pair["i"]], at[pair["j"]]
            r, c = links_between(x, y, a, b, threshold, pair["i"] == pair["j"])
            r, c = r + s, c + e
            np.add.at(links, r, weight[c])
            np.add.at(links, c, weight[r])
            used, number = np.unique(np.concatenate([r, c]), return_inverse=True)
            label = _labels(len(used), number[: len(r)], number[len(r) :])
            ends.append(np.column_stack([used, used[label]]))
        ends = np.concatenate(ends)
        linked = np.flatnonzero(links)
        label = node[_labels(total, ends[:, 0], ends[:, 1])]
        return pa.Table.from_arrays([pa.array(z[linked]) for z in (node, links, label)], schema=target)

    rows = bands.join(tiles.select("band", "tile", "node", "weight", "raw"), "band")
    return rows.groupBy("x", "y").cogroup(pairs.groupBy("band_i", "band_j")).applyInArrow(compare, FOUND)


def near_duplicates(embeddings: DataFrame, *, threshold: float = THRESHOLD) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``embeddings (vec_id, embedding)``."""
    good = F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf")))) & F.exists("embedding", lambda x: x != 0)
    rows = embeddings.select(F.col("vec_id").cast("long"), F.when(F.coalesce(good, F.lit(False)), F.col("embedding")).alias("v"))
    nodes = (
        rows.where(F.col("v").isNotNull())
        .groupBy("v")
        .agg(F.count("*").alias("weight"), F.min("vec_id").alias("least"))
        .withColumn("node", F.monotonically_increasing_id())
    )
    nodes = materialise(nodes, "nodes")
    width = nodes.agg(F.max(F.size("v"))).first()[0]
    alone = rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    if width is not None:
        found = materialise(find_links(nodes, width, threshold), "found")
        member = connected_components(found.select(F.col("node").alias("a"), F.col("label").alias("b")))
        whole = (
            nodes.join(found.groupBy("node").agg(F.sum("links").alias("links")), "node", "left")
            .join(member, "node", "left")
            .withColumn("component", F.coalesce("component", "node"))
        )
        least = whole.groupBy("component").agg(F.min("least").alias("component_id"))
        named = whole.join(least, "component").select(
            "v", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).cast("long").alias("n_links"), "component_id"
        )
        alone = rows.where(F.col("v").isNotNull()).join(named, "v").select(*alone.columns).unionByName(
            rows.where(F.col("v").isNull()).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
        )
    return alone.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
