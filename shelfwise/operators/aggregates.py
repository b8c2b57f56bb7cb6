"""Grouped statistics of products: benchmarks, percentiles, bands, slices and summaries.

Every aggregate is partial before its shuffle.  Percentiles come from a histogram by price, so a
group that holds every row (scope ``all``) costs one task its distinct prices and not its rows.

All of them take products or ``cells``, a pre-aggregate that can be grouped on in any way: a plan that asks for many
groupings of the same products makes the cells once.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import scores as S
from ..functions.text import range_key, range_label
from ..sources.tables import materialise

LOW_PRICE = 10_000
QUARTILES = {"p25_price_krw": 0.25, "median_price_krw": 0.5, "p75_price_krw": 0.75}
#: Label, least and most price of the bands (no most: open).
BANDS = (("<=10k", 0, 10000), ("10k-30k", 10001, 30000), ("30k-50k", 30001, 50000), ("50k-100k", 50001, 100000), ("100k+", 100001, None))
#: Characters at the beginning of a code that tell which rows are certainly beyond a list, few values first.
CODE_BEGINS, SEARCH_ROWS = (1, 3), 160
CATEGORY_LIMIT, KEYWORD_LIMIT, PAIR_LIMIT, PAIRS_A_CATEGORY = 40, 240, 800, 40


MEASURES = ("cell_count", "review_count", "order_count", "discounted_count", "first_collected_at", "collected_at")


def cells(products: DataFrame, dims: list[str]) -> DataFrame:
    """Counts, sums and bounds by ``dims``, price, seller and brand."""
    return as_cells(products).groupBy(*dims, "price_krw", "seller", "brand").agg(
        *(F.sum(c).alias(c) for c in MEASURES[:4]), F.min("first_collected_at").alias("first_collected_at"), F.max("collected_at").alias("collected_at")
    )


def as_cells(rows: DataFrame) -> DataFrame:
    """Products as cells of one product each; cells as they are."""
    if "cell_count" in rows.columns:
        return rows
    return rows.withColumns(
        {
            "cell_count": F.lit(1).cast("long"),
            "discounted_count": F.coalesce((F.col("original_price_krw") > F.col("price_krw")).cast("long"), F.lit(0)),
            "first_collected_at": F.nullif(F.col("collected_at"), F.lit("")),
        }
    )


@dataclass
class Known:
    """What was counted before for the same keys: distinct values and ranks."""

    distinct: DataFrame
    ranks: DataFrame


def band_label(bands=BANDS) -> Column:
    """The label of the band of a price; null outside of all."""
    band = None
    for label, low, high in bands:
        inside = (F.col("price_krw") >= low) & (F.lit(True) if high is None else F.col("price_krw") <= high)
        band = F.when(inside, label) if band is None else band.when(inside, label)
    return band


def summed_cells(products: DataFrame, dims: list[str]) -> DataFrame:
    """All that is added up by ``dims`` and price band, with no price: ``basic_stats`` of it are those of the products."""
    return as_cells(products).groupBy(*dims, band_label().alias("label")).agg(
        *(F.sum(c).alias(c) for c in MEASURES[:4]),
        F.sum(_low()).alias("low_price_count"),
        F.min("price_krw").alias("min_price_krw"),
        F.max("price_krw").alias("max_price_krw"),
        F.min("first_collected_at").alias("first_collected_at"),
        F.max("collected_at").alias("collected_at"),
    )


def _low() -> Column:
    return F.when(F.col("price_krw") <= LOW_PRICE, F.col("cell_count")).otherwise(0)


def _bounds(rows: DataFrame) -> list[Column]:
    """Products of low price, least and most price."""
    summed = "low_price_count" in rows.columns
    low, least, most = (F.col("low_price_count"), "min_price_krw", "max_price_krw") if summed else (_low(), "price_krw", "price_krw")
    return [F.sum(low).alias("low_price_count"), F.min(least).alias("min_price_krw"), F.max(most).alias("max_price_krw")]


def nearest_rank(df: DataFrame, keys: list[str], value: str, ranks: dict[str, float]) -> DataFrame:
    """``keys`` and the values at index ``round(p * (n - 1))`` of each group's sorted values."""
    n = F.sum("cell_count") if "cell_count" in df.columns else F.count("*")
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(n.alias("_n"))
    group = W.partitionBy(*keys)
    running = counts.withColumn("_cum", F.sum("_n").over(group.orderBy(value))).withColumn("_all", F.sum("_n").over(group))
    index = lambda p: F.floor(F.lit(p) * (F.col("_all") - 1) + 0.5)
    return running.groupBy(*keys).agg(*(F.min(F.when(F.col("_cum") > index(p), F.col(value))).alias(name) for name, p in ranks.items()))


def basic_stats(rows: DataFrame) -> list[Column]:
    """Counts, sums and bounds that every benchmark has, beside distinct values."""
    low, least, most = _bounds(rows)
    return [
        F.sum("cell_count").alias("product_count"),
        F.sum("review_count").alias("review_sum"),
        F.sum("order_count").alias("order_sum"),
        least,
        most,
        F.sum("discounted_count").alias("discounted_count"),
        low,
        F.max("collected_at").alias("latest_collected_at"),
    ]


def distinct_counts(rows: DataFrame, keys: list[str], columns: dict[str, str]) -> DataFrame:
    """How many values, empty ones aside, each of ``columns`` has in a group.

    The values of a row become rows (column, value) that partial aggregates thin out before the
    shuffle, so a group that holds every row sends its distinct values once a task and not its rows.
    """
    pairs = F.explode(F.array(*(F.struct(F.lit(name).alias("_what"), F.col(c).cast("string").alias("_value")) for c, name in columns.items())))
    values = rows.select(*keys, pairs.alias("_p")).select(*keys, "_p.*").where("_value <> ''").distinct()
    counted = values.groupBy(*keys, "_what").agg(F.count("*").alias("_n"))
    return counted.groupBy(*keys).agg(*(F.coalesce(F.max(F.when(F.col("_what") == name, F.col("_n"))), F.lit(0)).alias(name) for name in columns.values()))


def benchmarks(products: DataFrame, keys: list[str], distinct: dict[str, str] | None = None, known: Known | None = None) -> DataFrame:
    """Statistics, quartiles, and the scores that all benchmarks share, by ``keys``."""
    columns = {"seller": "seller_count", "brand": "brand_count"} | (distinct or {})
    products = as_cells(products)
    n = F.col("product_count")
    if known:  # others are counted among few sums
        more = {name: F.count_distinct(F.nullif(F.col(c).cast("string"), F.lit(""))) for c, name in (distinct or {}).items()}
        stats = products.groupBy(*keys).agg(*basic_stats(products), *(c.alias(name) for name, c in more.items()))
        counted, ranks = stats.join(known.distinct, keys, "left"), known.ranks
        counted = counted.select(*(c for c in counted.columns if c not in more), *more)
    else:
        stats = products.groupBy(*keys).agg(*basic_stats(products))
        counted, ranks = stats.join(distinct_counts(products, keys, columns), keys, "left"), nearest_rank(products, keys, "price_krw", QUARTILES)
    return (
        counted.fillna(0, list(columns.values()))
        .join(ranks, keys)
        .withColumn("iqr_price_krw", F.col("p75_price_krw") - F.col("p25_price_krw"))
        .withColumn("discounted_percent", S.percent(F.col("discounted_count"), n))
        .withColumn("low_price_percent", S.percent(F.col("low_price_count"), n))
        .withColumn("demand_score", S.demand(n, F.col("review_sum"), F.col("order_sum")))
        .withColumn("competition_score", S.competition(n, F.col("seller_count"), F.col("brand_count")))
    )


def _top(df: DataFrame, within: list[str], order: list[Column], limit: int | None, rank: str = "rank") -> DataFrame:
    w = (W.partitionBy(*within) if within else W.partitionBy(F.lit(0))).orderBy(*order)
    ranked = df.withColumn(rank, F.row_number().over(w))
    return ranked.where(F.col(rank) <= limit) if limit else ranked


def category_benchmarks(products: DataFrame, scope: list[str] | None = None, by: list[str] | None = None, limit: int | None = CATEGORY_LIMIT, known: Known | None = None) -> DataFrame:
    """Benchmarks of each category, ranked by low-price, discounted and product counts."""
    scope, by = scope or [], by or ["source_category"]
    if "cell_count" not in products.columns:
        # three groupings follow: products are made once, without what none of them reads
        products = materialise(as_cells(products).select(*dict.fromkeys([*scope, *by, "price_krw", "seller", "brand", *MEASURES])), "benchmark-rows")
    out = benchmarks(products, [*scope, *by], known=known)
    opportunity = S.category_opportunity(F.col("demand_score"), F.col("competition_score"), F.col("low_price_percent"), F.col("discounted_percent"))
    out = out.withColumn("opportunity_score", opportunity).withColumn(
        "interpretation", S.category_text(F.col("opportunity_score"), F.col("competition_score"), F.col("iqr_price_krw"), F.col("median_price_krw"))
    )
    order = [F.desc("low_price_count"), F.desc("discounted_count"), F.desc("product_count"), *(F.asc(c) for c in by)]
    return _top(out, scope, order, limit)


def _by_keyword(rows: DataFrame) -> DataFrame:
    return rows if "keyword" in rows.columns else rows.withColumn("keyword", F.explode("keywords"))


def keyword_benchmarks(products: DataFrame, scope: list[str] | None = None, limit: int | None = KEYWORD_LIMIT, known: Known | None = None) -> DataFrame:
    """Benchmarks of each keyword of ``keywords``, ranked by reaction."""
    scope = scope or []
    out = benchmarks(_by_keyword(products), [*scope, "keyword"], {"source_category": "category_count"}, known)
    dem, comp, cats = F.col("demand_score"), F.col("competition_score"), F.col("category_count")
    out = (
        out.withColumn("saturation_score", S.keyword_saturation(dem, comp, cats))
        .withColumn("opportunity_score", S.keyword_opportunity(dem, comp, cats))
        .withColumn("interpretation", S.keyword_text(F.col("opportunity_score"), F.col("saturation_score")))
    )
    order = [F.desc(S.reaction(F.col("review_sum"), F.col("order_sum"))), F.desc("product_count"), F.asc("keyword")]
    return _top(out, scope, order, limit)


def category_keywords(products: DataFrame, scope: list[str] | None = None, each: int = PAIRS_A_CATEGORY, limit: int = PAIR_LIMIT, known: Known | None = None) -> DataFrame:
    """Benchmarks of category and keyword pairs: the best of every category, up to ``limit`` in all."""
    scope = scope or []
    out = benchmarks(_by_keyword(products), [*scope, "source_category", "keyword"], known=known)
    dem, comp = F.col("demand_score"), F.col("competition_score")
    out = (
        out.withColumn("cluster_label", S.price_cluster(F.col("median_price_krw")))
        .withColumn("price_gap_score", S.price_gap(F.col("iqr_price_krw"), F.col("median_price_krw"), comp, dem))
        .withColumn("opportunity_score", S.pair_opportunity(dem, F.col("price_gap_score"), comp))
        .withColumn("interpretation", S.pair_text(F.col("opportunity_score"), comp, F.col("price_gap_score")))
    )
    order = [F.desc(S.reaction(F.col("review_sum"), F.col("order_sum"))), F.desc("product_count"), F.asc("keyword")]
    best = _top(out, [*scope, "source_category"], order, each, "category_rank")
    # what is left is at most ``each`` rows a category
    return _top(best, scope, [F.asc("source_category"), F.asc("category_rank")], limit)


def scope_summary(products: DataFrame, scope: list[str], ranks: DataFrame | None = None) -> DataFrame:
    """Counts, shares, price bounds and first and last collection time of each scope."""
    n, products = F.col("product_count"), as_cells(products)
    stats = products.groupBy(*scope).agg(
        F.sum("cell_count").alias("product_count"),
        F.count_distinct("source_category").alias("category_count"),
        F.sum("discounted_count").alias("discounted_count"),
        *_bounds(products),
        F.min("first_collected_at").alias("first_collected_at"),
        F.max("collected_at").alias("latest_collected_at"),
    )
    return (
        stats.join(nearest_rank(products, scope, "price_krw", {"median_price_krw": 0.5}) if ranks is None else ranks, scope)
        .withColumn("discounted_percent", S.percent(F.col("discounted_count"), n))
        .withColumn("low_price_percent", S.percent(F.col("low_price_count"), n))
    )


def price_bands(products: DataFrame, scope: list[str], bands=BANDS) -> DataFrame:
    """Every band of every scope with its share of products and of reactions; empty bands stay."""
    band = F.col("label") if "low_price_count" in products.columns else band_label(bands)  # summed by the same bands
    counted = as_cells(products).groupBy(*scope, band.alias("label")).agg(F.sum("cell_count").alias("c"), F.sum("review_count").alias("r"), F.sum("order_count").alias("o"))
    # one row a scope: totals, and a map from band to its counts
    totals = counted.groupBy(*scope).agg(
        F.sum("c").alias("all_products"),
        F.sum(S.reaction(F.col("r"), F.col("o"))).alias("all_reaction"),
        F.map_from_entries(F.collect_list(F.when(F.col("label").isNotNull(), F.struct("label", F.struct("c", "r", "o"))))).alias("m"),
    )
    every = F.array(*(F.struct(F.lit(i).alias("band"), F.lit(label).alias("label"), F.lit(low).cast("long").alias("min_price_krw"), F.lit(high).cast("long").alias("max_price_krw")) for i, (label, low, high) in enumerate(bands)))
    out = totals.select(*scope, "all_products", "all_reaction", "m", F.explode(every).alias("b"))
    got = F.try_element_at(F.col("m"), F.col("b.label"))
    out = out.select(
        *scope,
        "all_products",
        "all_reaction",
        "b.*",
        F.coalesce(got["c"], F.lit(0)).cast("long").alias("product_count"),
        F.coalesce(got["r"], F.lit(0)).cast("long").alias("review_sum"),
        F.coalesce(got["o"], F.lit(0)).cast("long").alias("order_sum"),
    )
    return (
        out.withColumn("product_percent", S.percent(F.col("product_count"), F.col("all_products")))
        .withColumn("reaction_percent", S.percent(S.reaction(F.col("review_sum"), F.col("order_sum")), F.col("all_reaction")))
        .withColumn("interpretation", S.band_text(F.col("product_percent"), F.col("reaction_percent"), F.col("product_count")))
        .drop("all_products", "all_reaction")
    )


def price_boundaries(products: DataFrame, scope: list[str], parts: int = 5) -> DataFrame:
    """``boundaries`` of each scope: least and most price and rounded steps strictly between."""
    bounds = products.where("price_krw > 0").groupBy(*scope).agg(F.min("price_krw").alias("lo"), F.max("price_krw").alias("hi"))
    lo, hi = F.col("lo"), F.col("hi")
    steps = F.array(*(S.round_boundary(lo + F.floor(((hi - lo) * i) / F.lit(parts)).cast("long")) for i in range(1, parts)))
    inner = F.array_distinct(F.filter(steps, lambda x: (x > lo) & (x < hi)))
    whole = F.when(lo == hi, F.array(lo, hi)).otherwise(F.array_sort(F.concat(F.array(lo), inner, F.array(hi))))
    return bounds.select(*scope, whole.alias("boundaries"))


def price_slices(products: DataFrame, scope: list[str], parts: int = 5) -> DataFrame:
    """``(scope, slice, range_low, range_high, range_key, range_label)``: at most ``parts`` a scope."""
    b = price_boundaries(products, scope, parts)
    cut = b.select(*scope, "boundaries", F.explode(F.sequence(F.lit(1), F.size("boundaries") - 1)).alias("slice"))
    high = F.col("boundaries")[F.col("slice")]
    low = F.col("boundaries")[F.col("slice") - 1] + F.when(F.col("slice") > 1, 1).otherwise(0)
    out = cut.select(*scope, "slice", low.alias("range_low"), high.alias("range_high")).where("range_low <= range_high")
    return out.withColumn("range_key", range_key(F.col("range_low"), F.col("range_high"))).withColumn("range_label", range_label(F.col("range_low"), F.col("range_high")))


def in_slices(products: DataFrame, slices: DataFrame, scope: list[str]) -> DataFrame:
    """Products with the slice of their scope that holds their price; slices are few for each scope."""
    return products.join(slices, scope).where(F.col("price_krw").between(F.col("range_low"), F.col("range_high")))


def seller_insights(categories: DataFrame) -> DataFrame:
    level, action = S.seller_level(F.col("low_price_percent"), F.col("discounted_percent"), F.col("product_count"))
    return categories.withColumn("competition_level", level).withColumn("recommended_action", action)


def category_counts(rows: DataFrame, category: str = "source_category") -> DataFrame:
    """Rows of each category, blank ones as ``other``, most first."""
    name = F.coalesce(F.nullif(F.trim(F.col(category)), F.lit("")), F.lit("other"))
    return rows.groupBy(name.alias("category")).agg(F.count("*").alias("row_count")).orderBy(F.desc("row_count"), "category")


def run_summary(rows: DataFrame, facts: dict[str, Column]) -> DataFrame:
    """One row with a column for each fact turned into ``(fact, value)`` rows."""
    one = rows.agg(*(c.cast("string").alias(k) for k, c in facts.items()))
    return one.unpivot([], list(facts), "fact", "value")


def code_begins(n: int) -> Column:
    """Provider and the beginning of the code, of which there are few: their order is the order by provider and code."""
    return F.struct(F.col("provider").alias("p"), F.substring("product_code", 1, n).alias("c"))


def keyword_search_text(exploded: DataFrame, keys: list[str], most: int = SEARCH_ROWS, chars: int = 12_000) -> DataFrame:
    """Texts of a key's first products in order, in lower case, spaces squeezed, cut to ``chars``."""
    from .ranking import may_be_first

    exploded = may_be_first(exploded, keys, code_begins(CODE_BEGINS[-1]), most, descending=False)
    w = W.partitionBy(*keys).orderBy("provider", "product_code")
    first = exploded.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= most)
    parts = F.array_sort(F.collect_list(F.struct("_rank", "text")))  # at most ``most`` of them
    joined = F.array_join(F.transform(parts, lambda x: x["text"]), " ")
    text = F.trim(F.regexp_replace(F.lower(joined), "\\s+", " "))
    return first.groupBy(*keys).agg(F.substring(text, 1, chars).alias("search_text"))
