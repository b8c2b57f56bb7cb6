"""Figures of scopes and price slices from a few passes over products, none of which repeats a product.

Products of one category with the same keywords are a kind.  A slice is a range of prices, so the sorted prices of a
group hold those of all its slices: ranks of a slice are places in the order of the whole group.  Sums need no price,
and distinct values keep a bit for each slice they are in.  Scopes, slices and keywords come in when rows are
counts of kinds and no longer products.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import slug
from ..sources.tables import materialise
from . import aggregates as A

SCOPE = ["scope_slug", "scope_category"]
RANGES = ["range_key", "range_label", "range_low", "range_high"]
KIND = "_kind"
#: Rows of a small table that goes to every task, and slices of a scope.
FEW, PARTS = 200_000, 5
#: Places of prices beside the slices: 0 or less, and none.
NO_SLICE, NO_PRICE = 0, -1
#: What a figure is of: all priced rows of a group, the slice of scope ``all``, or that of the scope of the category.
#: Or all rows, priced or not.
WHOLE, OF_ALL, OF_OWN, ANY = "whole", "of_all", "of_own", "any"
COUNTED = {"seller": "seller_count", "brand": "brand_count"}


def small(rows: DataFrame, tag: str) -> DataFrame:
    """Written, and sent to every task if it has few rows."""
    rows = materialise(rows, tag)
    return F.broadcast(rows) if rows.count() <= FEW else rows


def in_scopes(products: DataFrame) -> DataFrame:
    """Each product in scope ``all`` and in the scope of its category."""
    own = F.struct(slug(F.col("source_category")).alias("scope_slug"), F.col("source_category").alias("scope_category"))
    every = F.struct(F.lit("all").alias("scope_slug"), F.lit("").alias("scope_category"))
    return products.withColumn("_scope", F.explode(F.array(every, own))).select("*", "_scope.*").drop("_scope")


def with_kinds(products: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Products with their kind, and ``(_kind, source_category, keywords)``."""
    if KIND not in products.columns:
        products = products.withColumn(KIND, F.xxhash64("source_category", "keywords"))
    kinds = small(products.select(KIND, "source_category", "keywords").distinct(), "kinds")
    if kinds.groupBy(KIND).count().where("count > 1").isEmpty():
        return products, kinds
    kinds = small(kinds.withColumn(KIND, F.monotonically_increasing_id()), "kinds")  # two of them had one hash
    named = kinds.select(KIND, F.col("source_category").alias("_c"), F.col("keywords").alias("_k"))
    same = F.col("source_category").eqNullSafe(F.col("_c")) & F.col("keywords").eqNullSafe(F.col("_k"))
    return products.drop(KIND).join(named, same).drop("_c", "_k"), kinds


@dataclass
class Cube:
    """Counts of kinds.  ``sums``: by slices and band; ``prices``: by price; ``values``: sellers and brands with a bit
    for each slice; ``words``: pairs of category and keyword, ``links``: those of each kind."""

    products: DataFrame
    kinds: DataFrame
    edges: DataFrame
    slices: DataFrame
    sums: DataFrame
    prices: DataFrame
    values: DataFrame
    words: DataFrame
    links: DataFrame
    _made: dict[str, DataFrame] = field(default_factory=dict)

    def once(self, name: str, make) -> DataFrame:
        if name not in self._made:
            self._made[name] = materialise(make(), name)
        return self._made[name]


def placed(rows: DataFrame, edges: DataFrame) -> DataFrame:
    """Rows with the slices of their price in scope ``all`` and in the scope of their category: one more than the
    edges below it."""
    price = F.col("price_krw")

    def of(name: str) -> Column:
        above = sum((F.when(price > F.col(f"{name}_{i}"), 1).otherwise(0) for i in range(PARTS)), F.lit(1))
        return F.when(price.isNull(), NO_PRICE).when(price <= 0, NO_SLICE).otherwise(above)

    at = [c for c in edges.columns if c.startswith("_edge_")]
    known = rows.join(edges, F.col("source_category").eqNullSafe(F.col("_category"))) if "_category" in edges.columns else rows.join(edges, F.lit(True))
    names = [n for n in (OF_ALL, OF_OWN) if f"_edge_{n}_0" in at]
    return known.withColumns({n: of(f"_edge_{n}") for n in names}).drop("_category", *at)


def _edges(slices: DataFrame, categories: DataFrame) -> DataFrame:
    """``_category`` and the upper ends of the slices of both its scopes."""
    cut = materialise(slices.where("slice > 0").groupBy(*SCOPE).agg(F.array_sort(F.collect_list("range_high")).alias("_e")), "cut")  # at most PARTS
    every = cut.where("scope_slug = 'all' and scope_category = ''").select(F.col("_e").alias("_all"))
    own = cut.where("scope_slug <> 'all' or scope_category <> ''").select(F.col("scope_category").alias("_category"), F.col("_e").alias("_own"))
    ends = lambda c, n: [F.get(F.col(c), F.lit(i)).alias(f"_edge_{n}_{i}") for i in range(PARTS)]
    named = categories.withColumnRenamed("source_category", "_category").join(own, "_category", "left").join(every, F.lit(True), "left")
    return small(named.select("_category", *ends("_all", OF_ALL), *ends("_own", OF_OWN)), "edges")


def price_cube(products: DataFrame, sliced: bool = True) -> Cube:
    """The counts of which scopes, slices, benchmarks, bands and ranks are made; without slices if nothing asks for them."""
    products, kinds = with_kinds(products)
    categories = materialise(kinds.select("source_category").distinct(), "categories")
    every = in_scopes(categories).select(*SCOPE).distinct()
    slices = every.select(*SCOPE, F.lit(0).alias("slice"), F.lit(-(1 << 63)).alias("range_low"), F.lit((1 << 63) - 1).alias("range_high"), F.lit("").alias("range_key"), F.lit("").alias("range_label"))
    if sliced:
        bounds = products.where("price_krw > 0").groupBy("source_category").agg(F.min("price_krw").alias("lo"), F.max("price_krw").alias("hi"))
        ends = materialise(bounds.select("source_category", F.explode(F.array("lo", "hi")).alias("price_krw")), "ends")
        slices = A.price_slices(in_scopes(ends), SCOPE, PARTS).unionByName(slices)
    slices = small(slices, "slices")
    edges = _edges(slices, categories)
    at = [OF_ALL, OF_OWN]
    rows = placed(products, edges)
    sums = materialise(A.summed_cells(rows, [KIND, *at]), "sums")
    prices = materialise(products.where("price_krw is not null").groupBy(KIND, "price_krw").agg(F.count("*").alias("_n")), "prices")
    bit = lambda c: F.bit_or(F.when(F.col(c) >= 0, F.expr(f"shiftleft(1L, {c})")).otherwise(0)).alias(c)
    each = [rows.select(KIND, F.lit(c).alias("what"), F.col(c).cast("string").alias("value"), *at) for c in COUNTED]
    values = each[0].unionByName(each[1]).where("value <> ''").groupBy(KIND, "what", "value").agg(*(bit(c) for c in at))
    values = materialise(values, "values")
    told = materialise(kinds.select(KIND, "source_category", F.explode("keywords").alias("keyword")), "told")
    keys = materialise(told.select("keyword").distinct().withColumn("_key", F.monotonically_increasing_id()), "keys")
    words = small(told.select("source_category", "keyword").distinct().join(keys, "keyword").withColumn("_word", F.monotonically_increasing_id()), "words")
    same = words.select("_word", "_key", F.col("keyword").alias("_k"), F.col("source_category").alias("_c"))
    links = told.join(same, F.col("keyword").eqNullSafe(F.col("_k")) & F.col("source_category").eqNullSafe(F.col("_c"))).select(KIND, "_word", "_key")
    return Cube(products, kinds, edges, slices, sums, prices, values, words, small(links, "links"))


def by_words(rows: DataFrame, cube: Cube) -> DataFrame:
    """Rows of kinds with the category and keyword of each of their words."""
    return rows.join(cube.links, KIND).join(cube.words.drop("_key"), "_word")


def by_category(rows: DataFrame, cube: Cube) -> DataFrame:
    return rows.join(cube.kinds.select(KIND, "source_category"), KIND)


def _ranks(cells: DataFrame, sums: DataFrame, group: str, spans: list[str]) -> DataFrame:
    """``group, span, slice`` and the quartiles: values at index ``round(p * (n - 1))`` of the sorted prices of a span.

    Spans follow each other in the order of prices, so one running count over the prices of a group serves them all.
    """
    of_group = W.partitionBy(group)
    pieces = sums.where(F.col(OF_ALL) >= 0).groupBy(group, *spans).agg(F.sum("cell_count").alias("_size"))
    before = lambda s: F.coalesce(F.sum("_size").over(of_group.orderBy(s).rangeBetween(W.unboundedPreceding, -1)), F.lit(0))
    begin = {WHOLE: F.lit(0)} | {s: before(s) for s in spans}
    size = {WHOLE: F.sum("_size").over(of_group)} | {s: F.sum("_size").over(W.partitionBy(group, s)) for s in spans}
    wanted = {(s, name): f"_at_{s}_{name}" for s in (WHOLE, *spans) for name in A.QUARTILES}
    index = lambda s, p: begin[s] + F.floor(F.lit(p) * (size[s] - 1) + 0.5)
    pieces = small(pieces.select(group, *spans, *(index(s, A.QUARTILES[name]).alias(c) for (s, name), c in wanted.items())), "wanted")
    up_to = cells.withColumn("_cum", F.sum("_n").over(of_group.orderBy("price_krw")))
    hit = lambda c: (F.col(c) < F.col("_cum")) & (F.col(c) >= F.col("_cum") - F.col("_n"))
    anywhere = F.lit(False)
    for c in wanted.values():
        anywhere = anywhere | hit(c)
    found = up_to.join(pieces, [group, *spans]).where(anywhere)
    each = [F.struct(F.lit(s).alias("span"), (F.lit(0) if s == WHOLE else F.col(s)).alias("slice"), *(F.when(hit(wanted[s, n]), F.col("price_krw")).alias(n) for n in A.QUARTILES)) for s in (WHOLE, *spans)]
    rows = found.select(group, F.explode(F.array(*each)).alias("_f")).select(group, "_f.*").where(f"span = '{WHOLE}' or slice > 0")
    return rows.groupBy(group, "span", "slice").agg(*(F.max(n).alias(n) for n in A.QUARTILES))


def _distinct(values: DataFrame, group: list[str], spans: list[str]) -> DataFrame:
    """``group, span, slice`` and how many sellers and brands it has; span ``any`` is of rows without a price too."""
    by_value = values.groupBy(*group, "what", "value").agg(*(F.bit_or(s).alias(s) for s in spans))
    inside = lambda s, bits: F.count_if(F.col(s).bitwiseAND(F.lit(bits).cast("long")) != 0)
    every = {(ANY, 0): F.count("*"), (WHOLE, 0): F.count_if(F.col(spans[0]) != 0)} | {(s, k): inside(s, 1 << k) for s in spans for k in range(1, PARTS + 1)}
    counted = by_value.groupBy(*group, "what").agg(*(c.alias(f"_{s}_{k}") for (s, k), c in every.items()))
    each = F.array(*(F.struct(F.lit(s).alias("span"), F.lit(k).alias("slice"), F.col(f"_{s}_{k}").alias("n")) for s, k in every))
    rows = counted.select(*group, "what", F.explode(each).alias("_f")).select(*group, "what", "_f.*").where("n > 0")
    return rows.groupBy(*group, "span", "slice").agg(*(F.coalesce(F.max(F.when(F.col("what") == c, F.col("n"))), F.lit(0)).alias(n) for c, n in COUNTED.items()))


def category_ranks(cube: Cube) -> DataFrame:
    cells = by_category(cube.prices, cube).groupBy("source_category", "price_krw").agg(F.sum("_n").alias("_n"))
    return cube.once("category-ranks", lambda: _ranks(placed(cells, cube.edges), by_category(cube.sums, cube), "source_category", [OF_ALL, OF_OWN]))


def all_ranks(cube: Cube) -> DataFrame:
    cells = cube.prices.groupBy("price_krw").agg(F.sum("_n").alias("_n")).withColumn("_one", F.lit(1))
    return cube.once("all-ranks", lambda: _ranks(placed(cells, _edges_of_all(cube)), cube.sums.withColumn("_one", F.lit(1)), "_one", [OF_ALL]).drop("_one"))


def _edges_of_all(cube: Cube) -> DataFrame:
    return F.broadcast(cube.edges.select(*(c for c in cube.edges.columns if OF_ALL in c)).distinct())  # one row


def _word_cells(cube: Cube) -> DataFrame:
    return cube.once("word-prices", lambda: cube.prices.join(cube.links, KIND).groupBy("_word", "price_krw").agg(F.sum("_n").alias("_n")))


def word_ranks(cube: Cube) -> DataFrame:
    """Of pairs of category and keyword."""

    def make() -> DataFrame:
        named = cube.words.select("_word", "source_category")
        return _ranks(placed(_word_cells(cube).join(named, "_word"), cube.edges).drop("source_category"), cube.sums.join(cube.links, KIND), "_word", [OF_ALL, OF_OWN]).join(cube.words, "_word").drop("_word", "_key")

    return cube.once("word-ranks", make)


def keyword_ranks(cube: Cube) -> DataFrame:
    def make() -> DataFrame:
        cells = _word_cells(cube).join(cube.words.select("_word", "_key"), "_word").groupBy("_key", "price_krw").agg(F.sum("_n").alias("_n"))
        names = cube.words.select("_key", "keyword").distinct()
        return _ranks(placed(cells, _edges_of_all(cube)), cube.sums.join(cube.links, KIND), "_key", [OF_ALL]).join(names, "_key").drop("_key")

    return cube.once("keyword-ranks", make)


def category_values(cube: Cube) -> DataFrame:
    return cube.once("category-values", lambda: _distinct(by_category(cube.values, cube), ["source_category"], [OF_ALL, OF_OWN]))


def word_values(cube: Cube) -> DataFrame:
    make = lambda: _distinct(cube.values.join(cube.links, KIND), ["_word"], [OF_ALL, OF_OWN]).join(cube.words, "_word").drop("_word", "_key")
    return cube.once("word-values", make)


def keyword_values(cube: Cube) -> DataFrame:
    names = cube.words.select("_key", "keyword").distinct()
    return cube.once("keyword-values", lambda: _distinct(cube.values.join(cube.links, KIND), ["_key"], [OF_ALL]).join(names, "_key").drop("_key"))


def in_all(rows: DataFrame, *spans: str) -> DataFrame:
    """Figures of spans as those of scope ``all``."""
    return rows.where(F.col("span").isin(*spans)).withColumns({"scope_slug": F.lit("all"), "scope_category": F.lit("")}).drop("span")


def in_own(rows: DataFrame, *spans: str) -> DataFrame:
    """Figures of spans as those of the scopes of their categories."""
    own = rows.where(F.col("span").isin(*spans) & F.col("source_category").isNotNull())
    return own.withColumns({"scope_slug": slug(F.col("source_category")), "scope_category": F.col("source_category")}).drop("span")


def in_ranges(of_all: DataFrame, of_own: DataFrame, cube: Cube, without: tuple[str, ...] = ()) -> DataFrame:
    """Figures of spans as those of the slices of scopes, whole scopes being slice 0."""
    rows = in_all(of_all, WHOLE, OF_ALL).drop(*without).unionByName(in_own(of_own, WHOLE, OF_OWN).drop(*without))
    return rows.join(cube.slices, [*SCOPE, "slice"])


def sums_in_ranges(cube: Cube, words: bool) -> DataFrame:
    """Sums of the slices of scopes: by category, or by category and keyword."""
    rows = (by_words if words else by_category)(cube.sums.where(F.col(OF_ALL) >= 0), cube)
    return each_range(rows, cube)


def each_range(rows: DataFrame, cube: Cube) -> DataFrame:
    """Rows in every scope and slice that they are part of."""
    at = lambda own, k: F.struct((slug(F.col("source_category")) if own else F.lit("all")).alias("scope_slug"), (F.col("source_category") if own else F.lit("")).alias("scope_category"), k.alias("slice"))
    inside = lambda own, c: F.when(F.col(c) > 0, at(own, F.col(c)))
    every = F.array(at(False, F.lit(0)), at(True, F.lit(0)), inside(False, OF_ALL), inside(True, OF_OWN))
    rows = rows.withColumn("_at", F.explode(F.array_compact(every))).select("*", "_at.*").drop("_at")
    return rows.join(cube.slices, [*SCOPE, "slice"])
